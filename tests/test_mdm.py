"""Matching by names against all pairs."""

import random

import numpy as np
import pytest

from cairnflow.functions.text import jaro_winkler, jaro_winkler_rows
from cairnflow.operators import mdm


def spelled(n: int, seed: int) -> list[str]:
    """Names of few words, and the same with letters changed, set apart or swapped."""
    rnd = random.Random(seed)
    word = lambda: "".join(rnd.choice("bdgklmnrst" if i % 2 == 0 else "aeiou") for i in range(rnd.randint(3, 9))).capitalize()
    names = [" ".join([word(), rnd.choice(["Ridge", "Oak", "Meadow", word()]), *rnd.choice([[], ["Energy"], ["Asset", "Management"], ["Wealth", word(), word()]])]) for _ in range(n)]
    for name in names[: n // 2]:
        out = list(name)
        for _ in range(rnd.randint(1, 3)):
            i = rnd.randrange(len(out) - 1)
            kind = rnd.randrange(4)
            out[i : i + 2] = [[out[i + 1], out[i]], [out[i]], [*out[i : i + 2], "x"], ["q", out[i + 1]]][kind]
        names.append("".join(out))
    return sorted(set(names))


def test_jaro_winkler_of_rows():
    names = spelled(120, 1)
    for i in {len(n) for n in names}:
        for j in {len(n) for n in names}:
            pairs = [(x, y) for x in names if len(x) == i for y in names if len(y) == j]
            codes = [np.array([[ord(c) for c in p[k]] for p in pairs], dtype=np.uint32) for k in (0, 1)]
            want = [jaro_winkler(x, y) for x, y in pairs]
            assert jaro_winkler_rows(*codes, 0.75).tolist() == [s if s >= 0.75 else 0.0 for s in want]


@pytest.mark.parametrize("least,cell", [(0.95, 50_000), (0.85, 40), (0.75, 7)])
def test_no_similar_pair_is_left_out(spark, monkeypatch, least, cell):
    """Pairs without any common beginning or end of a rare word, long names, and cells of every size."""
    monkeypatch.setattr(mdm, "CELL", cell)
    a, b = [*spelled(150, 2), "Xabel", "Éclair Oak", "Word " * 20 + "One"], [*spelled(150, 2)[::2], *spelled(60, 3), "Yabelx", "Éclair Oaks", "Word " * 20 + "Ones", "A"]
    want = {(x, y): s for x in a for y in b if (s := jaro_winkler(x, y)) >= least}
    got = mdm.similar_names(*(spark.createDataFrame([(n,) for n in names], "n string") for names in (a, b)), least).collect()
    assert len(want) > 100 and len(got) == len(want) and {(r.a, r.b): r.score for r in got} == want


def test_best_match_of_all(spark):
    """Words that differ at both ends hide nothing; of equal scores the least id; what is below review has no right id."""
    left = spark.createDataFrame([(1, "Abcdefghijklmnopqrst"), (2, "Oak Energy Inc"), (3, "Nothing like it"), (4, None)], "l int, name string")
    right = spark.createDataFrame([(8, "Xbcdefghijklmnopqrsz"), (9, "OAK ENERGY LLC"), (7, "Oak Energy"), (5, None)], "r int, other string")
    got = {r.l: (r.r, r.decision) for r in mdm.fuzzy_matches(left, right, "l", "r", "name", "other").collect()}
    assert got == {1: (8, "review"), 2: (7, "auto"), 3: (None, "quarantine")}
    assert [(r.l, r.r) for r in mdm.fuzzy_matches(left, right, "l", "r", "name", "other", down_to="auto").collect()] == [(2, 7)]
    assert mdm.fuzzy_matches(left.where("false"), right, "l", "r", "name", "other").count() == 0
    assert {r.decision for r in mdm.fuzzy_matches(left, right.where("false"), "l", "r", "name", "other").collect()} == {"quarantine"}
