import json
import random

from cairnflow.operators import nested

LEVELS = {"owner": ["o"], "txn": ["o", "t"], "note": ["o", "t", "n"]}


def listed(x):
    return [] if x is None or x == {} else x if isinstance(x, list) else [x]


def holds(x):
    return x is not None and x != {} and x != []


def brute(doc):
    out = set()
    doc = doc.get("root", doc) if isinstance(doc, dict) else {}
    for i, o in enumerate(listed((doc or {}).get("o")), 1):
        if holds(o):
            out.add(("owner", i, 0, 0))
            t = o.get("t")
            t = t["w"] if isinstance(t, dict) and "w" in t else t
            for j, x in enumerate(listed(t), 1):
                if holds(x):
                    out.add(("txn", i, j, 0))
                    out |= {("note", i, j, k) for k, n in enumerate(listed(x.get("n")), 1) if holds(n)}
    return out


def random_doc(r):
    note = lambda: r.choice([None, {}, {"id": 1}, [{"id": 1}, None, {"id": "ü"}], []])
    txn = lambda: r.choice([{"a": r.random(), "n": note()}, {"a": None}, {}, None])
    many = lambda f: r.choice([f(), [f() for _ in range(r.randrange(4))]])
    owner = lambda: r.choice([{"id": {"value": 7}, "t": r.choice([many(txn), {"w": many(txn)}, None])}, {}])
    doc = {"o": many(owner), "x": r.choice([1, "s", None])}
    return r.choice([doc, {"root": doc}])


def test_parser_agrees_with_json():
    r = random.Random(2)
    for _ in range(400):
        text = json.dumps(random_doc(r))
        if r.random() < 0.5:
            text = text[: r.randrange(len(text))]
        try:
            json.loads(text)
            good = True
        except ValueError:
            good = False
        assert (nested.triples(text) is not None) == good, text
    for bad in ("", None, "{", "[1,]", '{"a" 1}', "nul", "01", '"a', "{}x"):
        assert nested.triples(bad) is None
    assert nested.triples('"{\\"a\\": 1}"') == nested.triples('{"a": 1}')


def test_rows_against_brute_force(spark):
    r = random.Random(9)
    docs = [(f"k{i}", j, json.dumps(random_doc(r)) if r.random() < 0.9 else "{cut") for i in range(60) for j in range(2)]
    docs += docs[:10] + [(None, 1, "{}"), ("deep", 1, "[" * 20_000), ("none", 1, None)]
    df = spark.createDataFrame(docs, "k string, at int, payload string")
    rows = nested.child_rows(nested.latest_readable(df, "payload", "k", ["at"], ["root", "w"]), "k", LEVELS)
    got = {(x.k, x.child_table, *(x.idx + [0, 0])[:3]) for x in rows.collect()}
    last = {}
    for k, at, p in docs:
        try:
            doc = json.loads(p) if p else None
        except (ValueError, RecursionError):
            doc = None
        if doc is not None and k is not None and (k not in last or at >= last[k][0]):
            last[k] = (at, doc)
    assert got == {(k, *row) for k, (_, doc) in last.items() for row in brute(doc)}


def test_pivot(spark):
    df = spark.createDataFrame([("k", json.dumps({"o": [{"id": {"value": 7}, "name": "x"}, {"name": None, "id": "8"}]}))], "k string, payload string")
    rows = nested.child_rows(nested.parse_records(df, "payload", ["k"]), "k", LEVELS)
    got = nested.child_table(rows, "k", "owner", {"id": ("id", "bigint"), "name": ("name", "string")}).orderBy("idx").collect()
    assert [(r.idx[0], r.id, r.name) for r in got] == [(1, 7, "x"), (2, 8, None)]


def test_repeated_ancestors_are_found_at_any_depth(spark):
    """Four levels, none of them declared; what never repeats stays a field of its row."""
    doc = {"a": [{"b": {"c": [{"d": [{"e": [{"x": 1}, {"x": 2}], "y": {"z": 3}}]}]}}], "plain": {"p": 1}}
    df = spark.createDataFrame([("k", json.dumps(doc)), ("m", json.dumps({"a": {"b": {"c": {"d": {"e": {"x": 5}}}}}}))], "k string, payload string")
    rows = nested.child_rows(nested.parse_records(df, "payload", ["k"]), "k").collect()
    got = {(r.k, r.child_table, tuple(r.idx)) for r in rows}
    one = [("a", (1,)), ("a.b.c", (1, 1)), ("a.b.c.d", (1, 1, 1)), ("a.b.c.d.e", (1, 1, 1, 1))]
    assert got == {("k", *x) for x in one} | {("k", "a.b.c.d.e", (1, 1, 1, 2))} | {("m", *x) for x in one}
    assert next(sorted((f.field, f.value) for f in r.fields) for r in rows if r.k == "k" and r.child_table == "a.b.c.d") == [("y.z", "3")]


def test_unreadable_latest_gives_way(spark):
    df = spark.createDataFrame([("k", 1, '{"o": [{"v": 1}]}'), ("k", 2, '{"o": [{"v": 2}, }'), ("k", 3, '{"o": [{"v"'), ("z", 1, '{"o": [}'), ("z", None, "{}")], "k string, at int, payload string")
    got = {r.k: len(r.cells) for r in nested.latest_readable(df, "payload", "k", ["at"]).collect()}
    assert got == {"k": 2, "z": 0}
