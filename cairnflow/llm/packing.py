"""Filling containers of fixed capacity with items of varying length.

Shortest-pack-first over the histogram of lengths: lengths are placed longest first, each
into the shortest pack so far, whole groups of equal packs at a time. What the driver handles are lengths and counts, at most one entry per token of
capacity, never items; items then find their place by their rank within their length.
"""

from __future__ import annotations

from bisect import insort
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cairnflow.operators.ranks import spread_sums

#: A pattern is (lengths with how often each), the count says how many containers have it.
Pattern = tuple[tuple[int, int], ...]


def pack_histogram(histogram: dict[int, int], capacity: int) -> list[tuple[Pattern, int]]:
    """Patterns with their counts for ``histogram`` (length to number of items), every length in 1..capacity.

    Longest lengths first, each item into the shortest pack; a new one only where not even
    that takes it. Equal packs are moved as one group, so work grows with lengths and
    groups, not with items.
    """
    room: dict[int, list[tuple[int, dict[int, int]]]] = {}  # room left -> groups of (count, pattern)
    rooms: list[int] = []

    def put(left: int, count: int, pattern: dict[int, int]) -> None:
        if left not in room:
            insort(rooms, left)
            room[left] = []
        room[left].append((count, pattern))

    for length in sorted(histogram, reverse=True):
        n = histogram[length]
        if not 0 < length <= capacity:
            raise ValueError(f"length {length} doesn't fit 1..{capacity}")
        while n:
            if rooms and rooms[-1] >= length:
                left = rooms[-1]
                count, pattern = room[left].pop()
                used = min(count, n)
                if used < count:
                    room[left].append((count - used, pattern))
                elif not room[left]:
                    del room[left]
                    rooms.pop()
                put(left - length, used, pattern | {length: pattern.get(length, 0) + 1})
                n -= used
            else:  # a new pack stays the shortest until it is full
                each = capacity // length
                full, rest = divmod(n, each)
                if full:
                    put(capacity - each * length, full, {length: each})
                if rest:
                    put(capacity - rest * length, 1, {length: rest})
                n = 0
    merged: dict[Pattern, int] = defaultdict(int)
    for groups in room.values():
        for count, pattern in groups:
            merged[tuple(sorted(pattern.items(), reverse=True))] += count
    return sorted(merged.items(), reverse=True)


def layout(patterns: list[tuple[Pattern, int]]) -> pd.DataFrame:
    """(length, first_rank, per_pack, first_pack): the items of a length from first_rank on fill packs from first_pack on, per_pack each."""
    taken: dict[int, int] = defaultdict(int)
    rows, pack = [], 0
    for pattern, count in patterns:
        for length, each in pattern:
            rows.append((length, taken[length], each, pack))
            taken[length] += each * count
        pack += count
    return pd.DataFrame(rows, columns=["length", "first_rank", "per_pack", "first_pack"]).astype("int64").sort_values(["length", "first_rank"], ignore_index=True)


def pieces(items: DataFrame, item: str, size: Column, capacity: int) -> DataFrame:
    """(item, piece, start, length): items within the capacity whole, longer ones cut into full pieces and a rest.

    Sizes that are NULL or not positive hold nothing: piece 0 of length 0.
    """
    n = F.greatest(F.coalesce(size, F.lit(0)), F.lit(0)).cast("long")
    cut_up = items.select(F.col(item), n.alias("__n")).select(item, "__n", F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.ceil(F.col("__n") / capacity) - 1, F.lit(0)))).alias("piece"))
    start = F.col("piece") * capacity
    return cut_up.select(item, "piece", start.alias("start"), F.least(F.lit(capacity), F.col("__n") - start).cast("long").alias("length"))


def pack(items: DataFrame, item: str, size: str, capacity: int) -> DataFrame:
    """(item, piece, start, length, container): the container of every item or piece.

    ``items`` has one row per item. Nothing is dropped: items without content go to container
    NULL with length 0. An item is cut only if it exceeds the capacity. Containers are numbered from 0; the sum
    of lengths in one never exceeds the capacity. Repeated and tied items get places of their own.
    """
    if capacity < 1:
        raise ValueError("capacity must be positive")
    parts = pieces(items, item, F.col(size), capacity)
    counts = {r["length"]: r["n"] for r in parts.where("length > 0").groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}  # at most one row per token of capacity
    plan = layout(pack_histogram(counts, capacity))
    ranked = spread_sums(parts.where("length > 0"), ["length"], [item, "piece"])
    lengths, firsts, each, packs = (plan[c].to_numpy() for c in plan.columns)
    starts = {int(n): (int(i), int(j)) for n, i, j in zip(*_runs(lengths))}

    def place(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            container = np.zeros(len(frame), dtype=np.int64)
            length, rank = frame["length"].to_numpy(), frame["rank"].to_numpy()
            for n in np.unique(length):
                here = length == n
                i, j = starts[int(n)]
                at = i + np.searchsorted(firsts[i:j], rank[here], side="right") - 1
                container[here] = packs[at] + (rank[here] - firsts[at]) // each[at]
            yield frame.assign(container=container)[[item, "piece", "start", "length", "container"]]

    kind = dict(items.dtypes)[item]
    placed = ranked.select(item, "piece", "start", "length", "rank").mapInPandas(place, f"`{item}` {kind}, piece bigint, start bigint, length bigint, container bigint")
    return placed.unionByName(parts.where("length = 0").withColumn("container", F.lit(None).cast("long")))


def _runs(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct values of a sorted array with the first and the last place (exclusive) of each."""
    found, first = np.unique(values, return_index=True)
    return found, first, np.append(first[1:], len(values))


def fills(packed: DataFrame, capacity: int) -> DataFrame:
    """(container, n_pieces, used, unused, fill) of every container."""
    out = packed.where(F.col("container").isNotNull()).groupBy("container").agg(F.count(F.lit(1)).alias("n_pieces"), F.sum("length").alias("used"))
    return out.withColumn("unused", F.lit(capacity) - F.col("used")).withColumn("fill", F.col("used") / capacity)
