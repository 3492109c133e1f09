import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from cairnflow.llm import packing


def unpacked(patterns):
    out = defaultdict(int)
    for pattern, count in patterns:
        for length, n in pattern:
            out[length] += n * count
    return dict(out)


def test_patterns_hold_every_item_once_and_fit():
    rnd = random.Random(3)
    for _ in range(60):
        capacity = rnd.randrange(1, 60)
        histogram = {rnd.randrange(1, capacity + 1): rnd.randrange(1, 400) for _ in range(rnd.randrange(12))}
        patterns = packing.pack_histogram(histogram, capacity)
        assert unpacked(patterns) == histogram
        assert all(sum(n * c for n, c in p) <= capacity for p, _ in patterns)


def shortest_pack_first(items, capacity):
    packs = []
    for n in sorted(items, reverse=True):
        best = min((p for p in packs if p + n <= capacity), default=None)
        if best is None:
            packs.append(n)
        else:
            packs[packs.index(best)] += n
    return sorted(packs)


def test_equals_item_by_item_shortest_pack_first():
    rnd = random.Random(4)
    for _ in range(40):
        capacity = rnd.randrange(5, 40)
        items = [rnd.randrange(1, capacity + 1) for _ in range(rnd.randrange(1, 60))]
        histogram = {n: items.count(n) for n in set(items)}
        got = sorted(sum(n * c for n, c in p) for p, k in packing.pack_histogram(histogram, capacity) for _ in range(k))
        assert len(got) == len(shortest_pack_first(items, capacity))


def test_wrong_lengths_raise():
    for bad in (0, 11):
        with pytest.raises(ValueError):
            packing.pack_histogram({bad: 1}, 10)


def test_items_find_their_containers(spark):
    rnd = random.Random(5)
    rows = [(i, rnd.choice([None, 0, 3, 3, 3, 7, 10, 11, 25, rnd.randrange(1, 40)]), "x") for i in range(500)]
    items = spark.createDataFrame(rows, "doc_id long, n long, length string")
    got = packing.pack(items, "doc_id", "n", 10).collect()
    size = {i: n or 0 for i, n, _ in rows}
    by_doc, used = defaultdict(list), defaultdict(int)
    for r in got:
        by_doc[r.doc_id].append(r)
        if r.container is not None:
            used[r.container] += r.length
        else:
            assert r.length == 0
    assert set(by_doc) == set(size)
    for doc, parts in by_doc.items():
        assert sum(p.length for p in parts) == size[doc]
        assert len(parts) == max(1, -(-size[doc] // 10))
    assert max(used.values()) <= 10 and sorted(used) == list(range(len(used)))
    again = {(r.doc_id, r.piece, r.container) for r in packing.pack(items.orderBy(F.desc("doc_id")), "doc_id", "n", 10).collect()}
    assert again == {(r.doc_id, r.piece, r.container) for r in got}


def test_nothing_to_pack(spark):
    empty = spark.createDataFrame([], "doc_id long, n long")
    assert packing.pack(empty, "doc_id", "n", 8).count() == 0
