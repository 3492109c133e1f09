from collections import Counter, defaultdict
from fractions import Fraction

from cairnflow.llm import mixing


def test_pfair_stays_within_a_block():
    for blocks in ({"a": 5, "b": 3, "c": 1}, {"a": 1}, {"a": 40, "b": 33, "c": 27, "d": 1, "e": 7}, {"x": 2, "y": 2}, {"x": 3, "none": 0}):
        order = mixing.pfair(blocks)
        total, done = sum(blocks.values()), Counter()
        assert len(order) == total and Counter(s for s, _ in order) == Counter({s: n for s, n in blocks.items() if n})
        for slot, (s, k) in enumerate(order):
            assert k == done[s]
            done[s] += 1
            for source, n in blocks.items():
                assert abs(done[source] - Fraction((slot + 1) * n, total)) < 1


def mix(spark, docs, targets, **kw):
    items = spark.createDataFrame(docs, "doc_id long, source string, n long")
    goal = spark.createDataFrame(targets, "source string, target_share double, max_repeats int")
    return items, goal, mixing.choose(items, goal, "doc_id", "source", "n", **kw)


def test_quotas_fill_the_mix_or_the_caps():
    assert mixing.quotas({"a": 100, "b": 10}, {"a": (0.5, 4), "b": (0.5, 2), "gone": (0.2, 9)}) == {"a": 90, "b": 20}  # b gives all it may, a takes the rest
    assert mixing.quotas({"a": 100, "b": 10}, {"a": (0.5, 1), "b": (0.5, 2)}, 1000) == {"a": 100, "b": 20}
    assert mixing.quotas({"a": 100, "b": 100}, {"a": (0.3, 1), "b": (0.7, 1)}, 50) == {"a": 15, "b": 35}
    assert mixing.quotas({}, {"a": (1.0, 1)}) == {} and mixing.quotas({"a": 5}, {"a": (1.0, 1)}, 0) == {}


def test_shares_and_caps(spark):
    docs = [(i, "big", 10) for i in range(400)] + [(1000 + i, "small", 7) for i in range(30)] + [(2000, "other", 5), (2001, None, 5), (2002, "small", 0), (2003, "small", None)]
    items, goal, chosen = mix(spark, docs, [("big", 0.6, 1), ("small", 0.3, 3), ("gone", 0.1, 2)])
    rows = chosen.collect()
    use = Counter((r.source, r.doc_id) for r in rows)
    assert max(n for (s, _), n in use.items() if s == "big") == 1 and {n for (s, _), n in use.items() if s == "small"} == {3}
    tokens = defaultdict(int)
    for r in rows:
        tokens[r.source] += r.n
    assert tokens == {"small": 3 * 30 * 7, "big": 3580} and sum(tokens.values()) == 4210  # as many tokens as both sources have
    report = {r.source: r for r in mixing.shares(chosen, items, goal, "source", "n", "doc_id").collect()}
    assert set(report) == {"big", "small", "gone", "other", None}
    assert report["gone"].chosen_tokens == 0 and report["other"].actual_share == 0 and report["small"].most_repeats <= 3
    assert report["small"].missing_tokens == round(0.3 * 4210) - 630 and report["gone"].missing_tokens == 421 and report["big"].missing_tokens == 0
    assert abs(sum(r.actual_share for r in report.values()) - 1) < 1e-9


def test_order_of_documents_keeps_to_the_shares(spark):
    """At every point of the mix a source is off its share by less than a block and what documents reach over block ends, over many rounds."""
    docs = [(i, "abc"[i % 3], 1 + i % 13) for i in range(3000)]
    _, _, chosen = mix(spark, docs, [("a", 0.6, 2), ("b", 0.3, 1), ("c", 0.1, 1)], block_tokens=40, period=20)
    rows = sorted(chosen.collect(), key=lambda r: (r.slot, r.offset))
    total, done, so_far = sum(r.n for r in rows), Counter(), 0
    whole = Counter()
    for r in rows:
        whole[r.source] += r.n
    for r in rows:
        done[r.source] += r.n
        so_far += r.n
        for s in whole:
            assert abs(done[s] - so_far * whole[s] / total) < 40 + 3 * 13
    assert max(r.slot for r in rows) > 100


def test_nothing_usable(spark):
    assert mix(spark, [(1, "a", 5)], [("b", 1.0, 1)])[2].count() == 0
    assert mix(spark, [], [("a", 1.0, 1)])[2].count() == 0
    assert mix(spark, [(1, "a", 5)], [])[2].count() == 0
