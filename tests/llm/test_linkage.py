import random

import numpy as np
from pyspark.sql import functions as F

from cairnflow.llm import linkage, queries


def test_place_codes(spark):
    got = [r[0] for r in spark.createDataFrame([("Delaware, USA",), ("NEW YORK",), ("ny",), ("Cayman Islands",), ("",), (None,), ("KY",)], "p string").select(linkage.place_code(F.col("p"))).collect()]
    assert got == ["DE", "NY", "NY", "KY", None, None, "KY"]


def test_rising():
    assert np.allclose(linkage.rising(np.array([0.1, 0.5, 0.3, 0.9]), np.ones(4)), [0.1, 0.4, 0.4, 0.9])


def test_mixture_separates_two_kinds_of_pairs():
    """Cells drawn from two known kinds: the greater classes get the greater probability, unknown features tell nothing, no pairs give a prior."""
    rnd = np.random.default_rng(1)
    match, other = rnd.choice(5, (300, 2), p=[0.1, 0.0, 0.1, 0.2, 0.6]), rnd.choice(5, (1500, 2), p=[0.1, 0.5, 0.3, 0.1, 0.0])
    cells, n = np.unique(np.concatenate([match, other]), axis=0, return_counts=True)
    p = linkage.mixture(cells, n.astype(float), (5, 5))
    assert p[4, 4] > 0.95 and p[1, 1] < 0.05 and p[4, 0] > p[1, 0] and np.all(np.diff(p[1:, 1:], axis=0) >= -1e-9)
    assert linkage.mixture(np.zeros((0, 2), dtype=int), np.zeros(0), (5, 5)).shape == (5, 5)


def test_walks_start_at_every_record_and_reach_all_of_a_word(spark):
    """No record is left out of the training, however many there are, and a common word leads to all its attributes."""
    n = 8_000
    links = spark.range(n).select(F.concat(F.lit("e:"), "id").alias("record"), F.concat(F.lit("name\t"), "id").alias("attribute"), F.explode(F.array(F.lit("common"), F.concat(F.lit("w"), "id"))).alias("word"))
    walked = linkage.walks(links, n).collect()
    assert len(walked) == len({r.walk for r in walked}) == linkage.COPIES * n
    met = {w for r in walked for w in r.words[4:]} - {"common"}
    assert {w for r in walked for w in r.words} == {"common", *(f"w{i}" for i in range(n))}
    assert len(met) > 0.75 * n
    assert all(len(r.words) >= 4 for r in walked)


def firms(spark):
    rnd = random.Random(3)
    word = lambda: "".join(rnd.choice("bdfgklmnprstvz" if i % 2 == 0 else "aeiou") for i in range(7)).capitalize()
    kinds, nature = ["Advisors LLC", "Capital Management LP", "Foods Co", "Energy Inc"], ["Oak", "Mesa", "Cove", "Eagle", "Bridge", "Amber"]
    index = [(f"e{i}", f"{w} {n} {t}", p, True) for i, (w, n, t, p) in enumerate([("Revukelt", "Bridge", "Advisors LLC", "UT"), ("Hufuzil", "Eagle", "Capital Management LP", "TX"), ("Hufuzil", "Eagle", "Capital Management LP", "FL"), ("Ziwarit", "Amber", "Manufacturing Inc", "DE")])]
    index += [(f"f{i}", f"{word()} {rnd.choice(nature)} {rnd.choice(kinds)}", "NY", True) for i in range(200)]
    index += [("twin", "Revukelt Bridge Advisors LLC", "UT", False), ("none", None, None, True)]
    told = [("1", "own", "Revukelt Brigde Advisers LLC (The)"), ("2", "own", None), ("3", "own", "Ziwarit Amber Asset Management LLC"), ("4", "own", "Nobody Knows LLC"), ("5", "own", "")]
    brands = [("1", "Revukelt Bridge"), ("2", "Hufuzil Eagle"), ("3", "Ziwarit Amber"), *((f"x{i}", f"{word()} {rnd.choice(nature)}") for i in range(100))]
    told += [(q, "part", f"{b} {s} Fund {n}, L.P.") for q, b in brands for s, n in (("Credit", "I"), ("Growth", "II"), ("Income", "IV"))]
    places = [("1", "UT", 4), ("2", "FL", 5), ("2", "KY", 1), ("3", "OH", 9), *((f"x{i}", "CA", 3) for i in range(100))]
    return (spark.createDataFrame(index + index[:3], "entity string, name string, place string, active boolean"), spark.createDataFrame(told + told[:2], "query string, kind string, text string"), spark.createDataFrame(places, "query string, place string, n long"))


def test_matches(spark):
    got = {(r.entity, r.query): r.confidence for r in linkage.match_records(*firms(spark)).collect()}
    assert set(got) == {("e0", "1"), ("e2", "2")}
    assert all(0 < c <= 1 for c in got.values())


def planned(df):
    """(exchanges, aggregates, joins that broadcast) of a plan."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.count("Exchange "), plan.count("Aggregate("), plan.count("BroadcastHashJoin")


def test_plans_stay_small(spark, monkeypatch):
    """The driver takes a plan anew, in text and as a tree, at every stage that ends, so no step has a long one."""
    plans, cut = [], linkage.cut
    monkeypatch.setattr(linkage, "cut", lambda df: plans.append(planned(df)) or cut(df))
    plans.append(planned(linkage.match_records(*firms(spark))))
    assert max(n for n, _, _ in plans) <= 10  # 16 before


def test_small_sides_are_not_broadcast_exploded(spark):
    """Indexed keys, exploded, are many times what their file leads to expect; the driver doesn't gather them."""
    rnd = np.random.default_rng(5)
    frame = spark.createDataFrame([(f"e{i}", list(map(float, rnd.standard_normal(linkage.DIMENSIONS)))) for i in range(40)], "record string, vector array<float>")
    index = linkage.cut(linkage.hash_keys(frame, 3).withColumn("id", F.xxhash64("record")))
    views = linkage.cut(linkage.hash_keys(frame, 3, True).withColumn("query", F.xxhash64("record")))
    assert planned(linkage.near(views, index))[2] == 0


def test_empty_sides(spark):
    index, told, places = firms(spark)
    assert linkage.match_records(index.where("false"), told, places).count() == 0
    assert linkage.match_records(index, told.where("false"), places.where("false")).count() == 0
    assert linkage.match_records(index, told, places, check=False).count() > 0


def looked_up(spark, base):
    """(vectors of every view and entity as a frame by record, links) of the test tables."""
    index, told, _ = queries._firms(spark, base)
    name = lambda prefix, c: F.concat(F.lit(prefix), c)
    entities = index.where("name IS NOT NULL").select(name("e:", F.lower("name")).alias("record"), F.lit("name").alias("kind"), F.col("name").alias("text"))
    views = [told.select(name("q:", F.col("query")).alias("record"), "kind", "text")] + [told.where(F.col("kind") == k).select(name(p, F.col("query")).alias("record"), "kind", "text") for k, p in (("own", "o:"), ("part", "p:"))]
    return linkage.attribute_words(entities.unionByName(views[0]).unionByName(views[1]).unionByName(views[2])).cache()


def test_recall_and_training(spark, small):
    """What the tables find of the records that brute force finds near; and trained vectors tell more than untrained ones.

    The trained part is judged by the parts' names alone: how often the nearest entity bears the query's own name.
    """
    links = looked_up(spark, small.replace("sf0.001", "sf0.01"))
    records = links.select("record").distinct().count()
    profiled = linkage.profiles(links, linkage.word_weights(links, records)).cache()
    random_rows = np.random.default_rng(7).standard_normal((linkage.ROWS, linkage.DIMENSIONS)).astype(np.float32)
    trained = linkage.train(linkage.walks(links, records))
    right = {}
    names = links.where("attribute LIKE 'own%' OR attribute LIKE 'name%'").groupBy("record").agg(F.array_sort(F.collect_set("word")).alias("w")).toPandas().set_index("record")["w"].map(tuple)
    for kind, vectors in (("untrained", random_rows / np.linalg.norm(random_rows, axis=1, keepdims=True)), ("trained", trained)):
        vectored = linkage.record_vectors(profiled, vectors).cache()
        frame = vectored.toPandas()
        e, p = frame[frame.record.str.startswith("e:")], frame[frame.record.str.startswith("p:")]
        cosine = np.stack(p.vector) @ np.stack(e.vector).T
        by_words = {}
        for r in e.record:
            by_words.setdefault(names.get(r), set()).add(r)
        known = [(i, by_words[names.get("o:" + r[2:])]) for i, r in enumerate(p.record) if by_words.get(names.get("o:" + r[2:]))]
        order = [np.flatnonzero(np.isin(e.record.to_numpy()[np.argsort(-cosine[i])], list(same)))[0] for i, same in known]
        right[kind] = float(np.mean(1 / (1 + np.array(order))))
    print("mean reciprocal rank", right, "of", len(known))
    assert right["trained"] > 0.8
    q = frame[~frame.record.str.startswith("e:")]
    cosine = np.stack(q.vector) @ np.stack(e.vector).T
    bits = linkage.hash_bits(len(e))
    index = linkage.hash_keys(vectored.where("record LIKE 'e:%'"), bits).withColumn("id", F.xxhash64("record"))
    views = linkage.hash_keys(vectored.where("record NOT LIKE 'e:%'"), bits, True).withColumn("query", F.xxhash64("record"))
    found = {(r[0], r[1]) for r in linkage.near(views, index).join(index.select("id", F.col("record").alias("y")), "id").join(views.select("query", F.col("record").alias("x")), "query").select("x", "y").collect()}
    close = [(x, y) for i, x in enumerate(q.record) for y in e.record.to_numpy()[cosine[i] >= 0.75]]
    hit = sum(pair in found for pair in close)
    print(f"recall {hit} of {len(close)}, {len(found)} candidates of {cosine.size} pairs")
    assert len(close) > 100 and hit >= 0.9 * len(close)


def test_full_buckets_are_refined(spark):
    """A bucket beyond the bound takes more signs; one of nearly equal vectors stays whole, and no pair within reach is lost."""
    rnd = np.random.default_rng(2)
    centre = rnd.standard_normal(linkage.DIMENSIONS)
    near = [(f"e{i}", list(map(float, v / np.linalg.norm(v)))) for i, v in enumerate(centre + 0.02 * rnd.standard_normal((60, linkage.DIMENSIONS)))]
    frame = spark.createDataFrame(near, "record string, vector array<float>")
    index = linkage.hash_keys(frame, 3).withColumn("id", F.xxhash64("record")).cache()
    views = linkage.hash_keys(frame, 3, True).withColumn("query", F.xxhash64("record")).cache()
    assert linkage.near(views, index, bucket=10).count() == linkage.near(views, index, bucket=1000).count() == 60 * 60


def test_cosines_are_exact(spark):
    rnd = np.random.default_rng(4)
    unit = lambda: (lambda v: v / np.linalg.norm(v))(rnd.standard_normal(linkage.DIMENSIONS))
    a, b, c = unit(), unit(), unit()
    pack = lambda v: v.astype(np.float16).tobytes()
    views = spark.createDataFrame([(1, "q", pack(a)), (1, "p", pack(b))], "query long, view string, packed binary")
    got = linkage.cosines(spark.createDataFrame([(1, 9)], "query long, id long"), views, spark.createDataFrame([(9, pack(c))], "id long, packed binary")).first()
    assert abs(got.cos_all - a @ c) < 2e-3 and abs(got.cos_part - b @ c) < 2e-3 and got.cos_own is None
