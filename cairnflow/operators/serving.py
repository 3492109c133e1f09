"""Serving: parameterised screens, surfaces of one subject, readiness of a publication, and which objects a mode may read."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def capped(limit: int, most: int) -> int:
    """A row limit between 1 and ``most``."""
    return min(max(int(limit), 1), most)


def screen(df: DataFrame, least: Mapping[str, float | None] | None = None, most: Mapping[str, float | None] | None = None, equal: Mapping[str, object] | None = None, like: Mapping[str, str | None] | None = None) -> DataFrame:
    """Rows within the bounds that are given; NULL parameters and 'all' leave out their predicate, NULL values fail every bound that is given."""
    for c, v in (least or {}).items():
        df = df if v is None else df.where(F.col(c) >= v)
    for c, v in (most or {}).items():
        df = df if v is None else df.where(F.col(c) <= v)
    for c, v in (equal or {}).items():
        df = df if v is None or v == "all" else df.where(F.col(c) == v)
    for c, v in (like or {}).items():
        df = df if v is None else df.where(F.col(c).ilike(v))
    return df


def surface(df: DataFrame, key: str, order: Sequence[Column], limit: int, most: int = 200) -> DataFrame:
    """The first rows by ``order`` of every subject, at most ``limit`` each."""
    return df.withColumn("__r", F.row_number().over(Window.partitionBy(key).orderBy(*order))).where(F.col("__r") <= capped(limit, most)).drop("__r")


def touching(edges: DataFrame, nodes: DataFrame, source: str, target: str, node: str, keep: Sequence[str]) -> DataFrame:
    """Edges that begin or end at any of ``nodes``, with that node's columns ``keep``: one join per end, a loop once."""
    ends = nodes.select(F.col(node).alias("__n"), *keep)
    a = edges.join(ends, F.col(source) == F.col("__n"))
    b = edges.where(~F.col(source).eqNullSafe(F.col(target))).join(ends, F.col(target) == F.col("__n"))
    return a.unionByName(b).drop("__n")


def contract_status(publications: DataFrame, pointer: DataFrame, generation: str, ready: Column, order: Sequence[Column]) -> DataFrame:
    """The latest ready publication of the active generation, or one row that says why there is none.

    readiness_state is agent_ready or not_ready, not_ready_reason NULL or no_verified_publication; columns of a publication are NULL where none is ready.
    """
    active = pointer.select(F.col("active_generation_id").alias(generation), "activated_at")
    best = publications.join(F.broadcast(active), generation).where(ready).orderBy(*order).limit(1)  # a pointer has one row
    told = best.select(F.lit("agent_ready").alias("readiness_state"), F.lit(None).cast("string").alias("not_ready_reason"), *publications.columns, "activated_at")
    fallback = active.join(best.select(F.lit(True).alias("__some")), F.lit(True), "left_anti")
    return told.unionByName(fallback.select(F.lit("not_ready").alias("readiness_state"), F.lit("no_verified_publication").alias("not_ready_reason"), generation, "activated_at"), allowMissingColumns=True)


def latest_status(manifests: DataFrame, statuses: DataFrame, key: Sequence[str], at: str) -> DataFrame:
    """The newest manifest of every key beside its newest status; keys known on one side only keep NULLs on the other."""
    newest = lambda df, p: df.groupBy(*key).agg(F.max(F.struct(at, *(c for c in df.columns if c not in key and c != at))).alias("m")).select(*key, *(F.col(f"m.{c}").alias(f"{p}_{c}") for c in df.columns if c not in key))
    return newest(manifests, "manifest").join(newest(statuses, "status"), list(key), "full")


@dataclass
class Registry:
    """Named queries with the object each reads. In explore mode every object is free; in agent mode only ``allowed`` ones are."""

    allowed: frozenset[str]
    queries: dict[str, tuple[str, Callable[[], DataFrame]]] = field(default_factory=dict)

    def allows(self, mode: str, name: str) -> bool:
        """Names count in upper case, with or without what stands before their last dot."""
        full = (name or "").strip().upper()
        return mode == "explore" or full in self.allowed or full.split(".")[-1] in self.allowed

    def register(self, query_id: str, name: str, make: Callable[[], DataFrame]) -> None:
        self.queries[query_id] = (name, make)

    def run(self, mode: str, query_id: str) -> DataFrame:
        """The registered query; KeyError for an unknown one, PermissionError for an object that the mode may not read."""
        if query_id not in self.queries:
            raise KeyError(f"unregistered query: {query_id}")
        name, make = self.queries[query_id]
        if not self.allows(mode, name):
            raise PermissionError(f"{mode} mode may not read {name}")
        return make()
