import datetime as dt
import random

from cairnflow.operators import history

SCHEMA = "e long, at timestamp, s long, name string, sic string, valid_from string"
T0 = dt.datetime(2024, 1, 1)


def norm(x):
    return None if x is None else " ".join(x.split()).lower()


def brute(rows):
    best = {}
    for r in rows:
        e, at, s, name, sic, _ = r
        if e is None or at is None:
            continue
        rank = (-(2**63) + 1 if s is None else s, name is not None, name or "", sic is not None, sic or "")
        if (e, at) not in best or rank > best[e, at][0]:
            best[e, at] = (rank, name, sic)
    out, state = set(), {}
    for (e, at), (_, name, sic) in sorted(best.items(), key=lambda kv: kv[0]):
        old = state.get(e)
        new = (name if name is not None else old and old[0], sic if sic is not None else old and old[1])
        if old is None or norm(new[0]) != norm(old[0]) or new[1] != old[1]:
            out.add((e, at))
        state[e] = new
    return out


def rows_of(n, seed, entities=4):
    r = random.Random(seed)
    return [(r.choice([None, *range(entities)]), r.choice([None] + [T0 + dt.timedelta(seconds=37 * r.randrange(n))] * 20), r.choice([None, r.randrange(9)]), r.choice([None, "Acme Co", " acme  CO", "Other"]), r.choice([None, "1", "2"]), "clash") for _ in range(n)]


def found(spark, rows, **kw):
    df = spark.createDataFrame(rows, SCHEMA)
    v = history.versions(df, "e", "at", ["name", "sic"], "s", {"name": history.blank_insensitive}, **kw)
    return v


def test_against_brute_force_whole_and_in_segments(spark):
    rows = rows_of(700, 3)
    rows += rows[:50]
    want = brute(rows)
    for size in (10_000, 7, 40):
        got = {(r.e, r.valid_from) for r in found(spark, rows, segment_rows=size).collect()}
        assert got == want, size


def test_periods_join_up(spark):
    rows = found(spark, rows_of(300, 4), segment_rows=9).orderBy("e", "valid_from").collect()
    for a, b in zip(rows, rows[1:]):
        assert (a.valid_to == b.valid_from and not a.is_current) if a.e == b.e else a.is_current


def test_return_is_a_version_and_nothing_gives_nothing(spark):
    at = lambda i: T0 + dt.timedelta(days=i)
    rows = [(1, at(0), 1, "A", None, None), (1, at(1), 2, "B", None, None), (1, at(2), 3, "a ", None, None), (1, at(3), 4, None, None, None)]
    assert found(spark, rows).count() == 3
    assert found(spark, []).count() == 0


def test_former_names(spark):
    rows = [(1, T0, 1, "New", None, None), (1, T0 + dt.timedelta(days=1), 1, "NEW ", "2", None)]
    former = spark.createDataFrame([(1, "Old", dt.date(2023, 5, 1), 1), (1, "Older", dt.date(2020, 5, 1), 2), (1, "Old", dt.date(2023, 5, 1), 1), (2, None, None, 1), (3, "Alone", None, 1)], "e long, former_name string, date_changed date, ordinal int")
    got = {(r.e, r.record_kind, r.name, r.valid_from and r.valid_from.date(), r.valid_to and r.valid_to.date()) for r in history.with_former_names(found(spark, rows), former, "e", "name").collect()}
    assert got == {(1, "observed", "New", T0.date(), None), (1, "former", "Old", dt.date(2020, 5, 1), dt.date(2023, 5, 1)), (1, "former", "Older", None, dt.date(2020, 5, 1)), (3, "former", "Alone", None, None)}
