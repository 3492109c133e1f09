"""Golden records: matching by thresholds, survivorship by field rules, review and universe."""

from __future__ import annotations

import math
from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cairnflow.functions.text import bare_name, jaro_winkler, jaro_winkler_rows
from cairnflow.session import cut

#: Thresholds of automatic and reviewed matches per kind (fixed values).
THRESHOLDS = {"person": (0.92, 0.80), "company": (0.95, 0.85), "adviser": (0.92, 0.80)}


def exact_matches(left: DataFrame, right: DataFrame, left_id: str, right_id: str, key: str) -> DataFrame:
    """(left_id, right_id, score, decision): equal identifiers merge by themselves; NULL ones never."""
    return left.where(F.col(key).isNotNull()).join(right, key).select(left_id, right_id, F.lit(1.0).alias("score"), F.lit("auto").alias("decision"))


#: Names of either side that are compared by one task at a time, on average at most.
CELL = 50_000


def similar_names(a: DataFrame, b: DataFrame, least: float) -> DataFrame:
    """(a, b, score): all pairs of the distinct names ``n`` of ``a`` and of ``b`` whose Jaro-Winkler similarity is at least ``least``, which is above 0.7.

    No pair is left out: names are compared with all names whose length allows the score. A similarity bounds the letters that two
    names don't share, and so the differing bits of signatures of 64 bits, which numpy counts for all pairs of a cell; only the
    pairs within that bound are compared letter by letter. The work grows with the product of both sides, some nanoseconds a pair.
    """

    def signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.column(0).to_pylist()
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(n) for n in names], pa.int32()), pa.array(letter_signatures(names))], names=["n", "len", "sig"])

    # A shared beginning of four letters asks least of the rest.
    shared = [3 * (least - 0.1 * p) / (1 - 0.1 * p) - 1 for p in range(5)]
    sides = [cut(x.select("n").distinct().mapInArrow(signed, "n string, len int, sig long")) for x in (a, b)]
    sizes = [sorted((r["len"], r["count"]) for r in x.groupBy("len").count().collect()) for x in sides]  # a row per length
    classes = []
    for rows in sizes:  # consecutive lengths share a class until that is full; a length with more names is cut by hash
        classes.append([])
        for length, n in rows:
            if classes[-1] and classes[-1][-1]["n"] + n <= CELL and length - classes[-1][-1]["lens"][0] < 3:
                classes[-1][-1]["n"] += n
                classes[-1][-1]["lens"].append(length)
            else:
                classes[-1].append({"lens": [length], "n": n})
    cells: list[dict[int, list[tuple[int, int, int]]]] = [{}, {}]  # per length (parts, number of the part, cell)
    many = 0
    for x in classes[0]:
        for y in classes[1]:
            if not any(_spare(i, j, shared[4]) >= 0 for i in x["lens"] for j in y["lens"]):
                continue
            parts = [math.ceil(c["n"] / CELL) for c in (x, y)]
            for k in np.ndindex(*parts):
                for side, c in enumerate((x, y)):
                    for length in c["lens"]:
                        cells[side].setdefault(length, []).append((parts[side], k[side], many))
                many += 1
    spark = a.sparkSession

    def spread(side: int) -> DataFrame:
        rows = [(length, *c) for length, cs in cells[side].items() for c in cs]
        where = F.broadcast(spark.createDataFrame(rows, "len int, parts int, part int, cell int"))  # some rows per length
        return sides[side].join(where, "len").where(F.pmod(F.xxhash64("n"), "parts") == F.col("part")).select("n", "len", "sig", "cell").repartition(max(1, min(many, 1_000)), "cell")

    def compared(x: pa.Table, y: pa.Table) -> pa.Table:
        parts = [pa.table(list(p), names=["a", "b", "score"]) for p in close_pairs(x, y, shared, least)]
        return pa.concat_tables(parts) if parts else pa.table([pa.array([], pa.string()), pa.array([], pa.string()), pa.array([], pa.float64())], names=["a", "b", "score"])

    return spread(0).groupBy("cell").cogroup(spread(1).groupBy("cell")).applyInArrow(compared, "a string, b string, score double")


def letter_signatures(names: Sequence[str]) -> np.ndarray:
    """64 bits per name, one turned for every letter and the how manieth it is: n letters that only one of two names has turn at most n bits."""
    out = np.zeros(len(names), dtype=np.uint64)
    for i, name in enumerate(names):
        seen: dict[str, int] = {}
        bits = 0
        for c in name:
            k = seen[c] = seen.get(c, 0) + 1
            bits ^= 1 << (ord(c) * 2_654_435_761 + k * 40_503 * 65_537 >> 13) % 64
        out[i] = bits
    return out.view(np.int64)


def _spare(i: int, j: int, shared: float) -> int:
    """Letters that names of i and j letters may have alone if matches / i + matches / j is at least ``shared``; below 0 if none can."""
    matches = max(0, math.ceil(shared * i * j / (i + j) - 1e-6))
    return i + j - 2 * matches if matches <= min(i, j) else -1


def close_pairs(x: pa.Table, y: pa.Table, shared: Sequence[float], least: float) -> Iterator[tuple[pa.Array, pa.Array, pa.Array]]:
    """(names, names, scores) of the pairs that reach ``least``, looked for where signatures differ in no more bits than ``shared``, by the letters that both begin with, allows."""
    sides = []
    for t in (x, y):
        t = t.sort_by("len")
        names, lens = np.array(t["n"].to_pylist(), dtype=object), t["len"].to_numpy()
        runs = []
        for length, start in zip(*(v.tolist() for v in np.unique(lens, return_index=True))):
            end = int(np.searchsorted(lens, length, "right"))
            codes = np.frombuffer("".join(names[start:end]).encode("utf-32-le"), dtype=np.uint32).reshape(-1, length)
            runs.append((length, names[start:end], t["sig"].to_numpy()[start:end].view(np.uint64), codes.astype(np.uint8) if codes.max() < 256 else codes))
        sides.append(runs)
    for i, names, sig, codes in sides[0]:
        for j, names2, sig2, codes2 in sides[1]:
            spare = [_spare(i, j, s) for s in shared]
            if spare[4] < 0:
                continue
            begin = min(4, i, j)
            wide = 1 << 15
            high = max(1, wide // min(wide, len(sig2)))
            for c in range(0, len(sig2), wide):
                right = sig2[c : c + wide]
                for r in range(0, len(sig), high):
                    apart = np.bitwise_count(sig[r : r + high, None] ^ right)
                    at, at2 = np.nonzero(apart <= spare[4])
                    if not len(at):
                        continue
                    same = np.logical_and.accumulate(codes[r + at, :begin] == codes2[c + at2, :begin], axis=1).sum(1)
                    ok = apart[at, at2].astype(np.int64) <= np.array(spare)[same]
                    at, at2 = r + at[ok], c + at2[ok]
                    if max(i, j) <= 64:
                        score = jaro_winkler_rows(codes[at], codes2[at2], least)
                    else:
                        score = np.array([jaro_winkler(v, w) for v, w in zip(names[at], names2[at2])], dtype=float)
                    ok = score >= least
                    if ok.any():
                        yield pa.array(names[at[ok]], pa.string()), pa.array(names2[at2[ok]], pa.string()), pa.array(score[ok], pa.float64())


def fuzzy_matches(left: DataFrame, right: DataFrame, left_id: str, right_id: str, left_name: str, right_name: str, kind: str = "company", context: tuple[str, str] | None = None, down_to: str = "quarantine") -> DataFrame:
    """The best Jaro-Winkler match of each left record among all right ones: (left_id, right_id, score, decision).

    With ``context`` a score reaches automatic only if that is known on both sides and equal. decision is auto, review or
    quarantine by the kind's thresholds; a record whose names reach no score of review is in quarantine without a right id. Ties go to
    the least right id. Rows below the decision ``down_to`` are left out, and not looked for.
    """
    auto, review = THRESHOLDS[kind]
    a = left.select(F.col(left_id).alias("__l"), bare_name(F.col(left_name)).alias("__a"), *([F.col(context[0]).cast("string").alias("__ca")] if context else [])).where("__a IS NOT NULL").distinct()
    b = right.select(F.col(right_id).alias("__r"), bare_name(F.col(right_name)).alias("__b"), *([F.col(context[1]).cast("string").alias("__cb")] if context else [])).where("__b IS NOT NULL")
    b = b.where("__r IS NOT NULL").groupBy("__b", *(["__cb"] if context else [])).agg(F.min("__r").alias("__r"))  # of records under one name only the least can win
    least = auto if down_to == "auto" else review
    met = similar_names(a.select(F.col("__a").alias("n")), b.select(F.col("__b").alias("n")), least).withColumnsRenamed({"a": "__a", "b": "__b"})
    scored = met.join(b, "__b").join(a, "__a")
    if context:
        agrees = F.coalesce(F.col("__ca") == F.col("__cb"), F.lit(False))
        scored = scored.withColumn("score", F.when(agrees, F.col("score")).otherwise(F.least("score", F.lit(auto - 0.01)))).where(F.col("score") >= least)
    best = scored.groupBy("__l").agg(F.min(F.struct((-F.col("score")).alias("s"), F.col("__r").alias("r"))).alias("m"))
    score = -F.col("m.s")
    decision = F.when(score >= auto, "auto").when(score >= review, "review").otherwise("quarantine")
    every = a.select("__l").distinct().join(best, "__l", "left") if down_to == "quarantine" else best
    return every.select(F.col("__l").alias(left_id), F.col("m.r").alias(right_id), score.alias("score"), decision.alias("decision"))


def first_decision(*matches: DataFrame, by: str) -> DataFrame:
    """The first automatic match in the order given, else the best score; one row per record."""
    out = None
    for i, m in enumerate(matches):
        one = m.withColumn("matcher", F.lit(i))
        out = one if out is None else out.unionByName(one)
    order = [F.desc(F.col("decision") == "auto"), F.when(F.col("decision") == "auto", F.col("matcher")).otherwise(99), F.desc("score"), F.col("matcher")]
    return out.withColumn("__r", F.row_number().over(Window.partitionBy(by).orderBy(*order))).where("__r = 1").drop("__r")


def survivors(stage: DataFrame, rules: Mapping[str, str], entity: str = "entity_id", preferred: Sequence[str] = ()) -> DataFrame:
    """One row per entity with the surviving value of every field.

    ``stage`` has entity, field, source, value, priority, effective_date, loaded_at. Rules: immutable (first loaded),
    most_recent, highest_source_rank (least priority) or source_priority (``preferred`` order first). A known value beats NULL;
    remaining ties go to the later effective date, then load, then the greatest value.
    """
    rule = F.lit("most_recent")
    for name, kind in rules.items():
        rule = F.when(F.col("field") == name, kind).otherwise(rule)
    place = F.coalesce(F.array_position(F.array(*(F.lit(x) for x in preferred)), F.col("source")), F.lit(0)) if preferred else F.lit(0)
    place = F.when(place == 0, 1_000).otherwise(place)
    order = [
        F.desc(F.col("value").isNotNull()),
        F.when(rule == "highest_source_rank", F.col("priority")).when(rule == "source_priority", place * 1_000 + F.col("priority")).otherwise(F.lit(0)),
        F.when(rule == "immutable", F.unix_micros("loaded_at")).otherwise(-F.unix_micros(F.coalesce(F.col("effective_date").cast("timestamp"), F.lit("1900-01-01").cast("timestamp")))),
        F.desc_nulls_last("loaded_at"), F.desc_nulls_last("value"),
    ]
    best = stage.withColumn("__r", F.row_number().over(Window.partitionBy(entity, "field").orderBy(*order))).where("__r = 1")
    return best.groupBy(entity).agg(*(F.max(F.when(F.col("field") == f, F.col("value"))).alias(f) for f in rules))


def unchanged(batch: DataFrame, seen: DataFrame, key: str, hash_column: str) -> DataFrame:
    """Rows of ``batch`` whose content hash is new for their key."""
    return batch.join(seen.select(key, hash_column), [key, hash_column], "left_anti")


def review_queue(matches: DataFrame) -> DataFrame:
    """Matches for a steward, likeliest first within the review band."""
    return matches.where(F.col("decision") == "review").orderBy(F.desc("score"))
