"""Matching entities across sources without keys.

Records, their attributes and the words of these form a graph. Random walks over it train
skip-gram vectors of words and of their character 3-grams; a record's vector is the
weighted sum of its words'. Records meet in the buckets of several hyperplane hash tables, their
cosines are computed exactly and calibrated to a probability, which decides; an exact check
of words, legal forms and places follows.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cairnflow.llm.names import _LEGAL_SET, name_tokens, organisation_likeness, word_likeness
from cairnflow.session import cut

#: Walks of every record, and sentences (two of a walk) that one task trains on.
COPIES, PART = 4, 100_000
#: Attributes of a word that lie together on average.
SLOTS = 8
#: Words and 3-grams are hashed to as many rows of the model, which bounds it whatever the vocabulary.
ROWS = 1 << 14
DIMENSIONS = 64
TABLES, MORE_BITS, PROBES = 16, 8, 4
#: Indexed records that a bucket holds on average, and those it may hold before its key is lengthened.
FILL, BUCKET = 16, 128
#: Marking signs of 128 in which a pair may differ: on average those of a cosine of 0.51; pairs of a cosine of 0.75 lose one in 300.
APART = 42
#: What rerank_score demands of a word: its likeness, the share of the attributes from which a word counts in full, and the product of both.
LIKE, FULL_SHARE, HIT = 0.74, 0.45, 0.7


def row_of(text: str) -> int:
    """The model row of a word or, marked by a leading '~', of a 3-gram."""
    return zlib.crc32(text.encode()) % ROWS


def grams(word: str) -> list[str]:
    padded = f"^{word}$"
    return [f"~{padded[i : i + 3]}" for i in range(len(padded) - 2)]


# ---------------------------------------------------------------- graph and walks


def attribute_words(attributes: DataFrame) -> DataFrame:
    """(record, attribute, word): the words of every record's attribute texts, by name_tokens without legal forms.

    ``attributes`` has record, kind and text; a place is its own single word. NULL and empty texts have none.
    """

    def words(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:  # beside every record, so that no join follows
        for frame in frames:
            found = [[f"@{t}"] if k == "place" else [w for w in dict.fromkeys(name_tokens(t)) if w not in _LEGAL_SET and w[0] != "#"] for k, t in zip(frame["kind"], frame["text"])]
            yield frame.assign(word=found)

    texts = attributes.select("record", "kind", "text").where(F.col("kind").isNotNull() & F.col("text").isNotNull()).distinct()
    split = texts.mapInPandas(words, "record string, kind string, text string, word array<string>")
    return split.select("record", F.concat_ws("\t", "kind", "text").alias("attribute"), F.explode("word").alias("word"))


def walks(links: DataFrame, records: int | None = None, seed: int = 7, hops: int = 3) -> DataFrame:
    """(walk, words): random walks attribute - record - attribute - word - attribute - word - ..., two words of every attribute passed.

    COPIES walks start at every record; ``records`` isn't needed. A walk goes on from a word to any of its attributes: these lie in drawers of SLOTS on
    average, one of which is drawn, so a place that a third of all records share is no hot spot. A walk that draws an empty drawer stays where it is.
    """
    sizes = links.select("record", "attribute", "word").distinct().groupBy("word").agg(F.ceil(F.count(F.lit(1)) / SLOTS).cast("int").alias("drawers"))
    attributes = cut(links.join(sizes, "word").groupBy("record", "attribute").agg(F.array_sort(F.collect_set(F.struct("word", "drawers"))).alias("words")))
    one = attributes.select(F.xxhash64("record", "attribute", F.lit(seed)).alias("h"), "words", F.explode("words").alias("w"))
    of_word = cut(one.groupBy(F.col("w.word").alias("word"), F.pmod("h", "w.drawers").alias("drawer")).agg(F.transform(F.array_sort(F.collect_list(F.struct("h", "words"))), lambda x: x["words"]).alias("onward")))
    drawn = lambda n, *what: F.pmod(F.xxhash64("walk", *map(F.lit, what), F.lit(seed)), n).cast("int")
    word = lambda c, *what: F.get(c, drawn(F.size(c), *what))
    # A record's attributes are drawn anew for every copy, by one aggregation that reduces on the map side.
    own = F.array(*(F.struct(*(F.min_by("words", F.xxhash64("attribute", "record", F.lit(2 * i + j))).alias("ab"[j]) for j in range(2))) for i in range(COPIES)))
    walkers = attributes.groupBy("record").agg(own.alias("own")).select("record", F.posexplode("own").alias("copy", "own")).select(F.xxhash64("record", "copy").alias("walk"), "own.a", "own.b")
    walkers = walkers.select("walk", F.array(word("a", 3), word("a", 4), word("b", 5), word("b", 6)).alias("seen"))
    for i in range(1, hops):
        at = walkers.select("walk", "seen", F.element_at("seen", -1).alias("last"))
        at = at.select("walk", "seen", F.col("last.word").alias("word"), drawn(F.col("last.drawers"), i, "drawer").cast("long").alias("drawer"))
        onward = at.join(of_word.withColumn("drawer", F.col("drawer").cast("long")), ["word", "drawer"], "left").select("walk", "seen", word("onward", i).alias("a"))
        walkers = onward.select("walk", F.when(F.col("a").isNull(), F.col("seen")).otherwise(F.concat("seen", F.array(word("a", i, 1), word("a", i, 2)))).alias("seen"))
    return walkers.select("walk", F.transform("seen", lambda x: x["word"]).alias("words"))


def train(walked: DataFrame, dimensions: int = DIMENSIONS, seed: int = 7) -> np.ndarray:
    """Vectors of all model rows, unit length: skip-gram over the words of every walk, alone and each with one of its 3-grams.

    Every row also has a fixed random direction, half of its vector, so that words of one company still differ and
    rows that no walk saw have one. Beyond PART sentences several tasks train on parts of them, and their vectors are averaged after each round.
    """
    from pyspark.ml.feature import Word2Vec

    def sentences(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for walk, words in zip(frame["walk"], frame["words"]):
                rows.append([str(row_of(w)) for w in words])
                rows.append([str(row_of(x)) for i, w in enumerate(words) for x in ((w,) if w[0] == "@" else (w, *[g for g in [grams(w)] for g in (g[(walk + i) % len(g)],)]))])
            yield pd.DataFrame({"rows": rows})

    vectors = np.random.default_rng(seed).standard_normal((ROWS, dimensions)).astype(np.float32)
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    corpus = cut(walked.mapInPandas(sentences, "rows array<string>").where(F.size("rows") > 1))
    if n := corpus.count():
        model = Word2Vec(vectorSize=dimensions, windowSize=4, minCount=1, numPartitions=math.ceil(n / PART), maxIter=2, seed=seed, inputCol="rows", outputCol="out").fit(corpus)
        seen = model.getVectors().toPandas()  # at most ROWS rows
        if len(seen):
            found = np.stack([v.toArray() for v in seen["vector"]]).astype(np.float32)
            at = seen["word"].astype(int).to_numpy()
            vectors[at] += found / np.maximum(np.linalg.norm(found, axis=1, keepdims=True), 1e-9)  # the trained direction beside the row's own
            vectors[at] /= np.linalg.norm(vectors[at], axis=1, keepdims=True)
    return vectors


def word_weights(links: DataFrame, records: int) -> DataFrame:
    """(word, idf) over all ``records``: ln(1 + records / records with the word)."""
    return links.groupBy("word").agg(F.log(1 + F.lit(float(records)) / F.countDistinct("record")).alias("idf"))


def profiles(links: DataFrame, weights: DataFrame) -> DataFrame:
    """(record, profile): every word of a record with the share of its attributes that hold it, and its idf."""
    of_record = links.groupBy("record").agg(F.countDistinct("attribute").alias("n"))
    held = links.groupBy("record", "word").agg(F.countDistinct("attribute").alias("k")).join(weights, "word").groupBy("record").agg(F.array_sort(F.collect_list(F.struct("word", "k", "idf"))).alias("held"))
    return held.join(of_record, "record").select("record", F.transform("held", lambda x: F.struct(x["word"].alias("word"), (x["k"] / F.col("n")).alias("share"), x["idf"].alias("idf"))).alias("profile"))


def record_vectors(profiled: DataFrame, vectors: np.ndarray) -> DataFrame:
    """(record, vector): unit sums of the vectors of a profile's words and 3-grams, less what all records have in common.

    The common part is the mean over all records, one vector; without it, unrelated records are far from orthogonal.
    """

    def summed(profile) -> np.ndarray:
        out = np.zeros(vectors.shape[1], dtype=np.float32)
        for p in profile:
            g = [row_of(x) for x in grams(p["word"])]
            out += p["share"] * p["idf"] ** 2 * (vectors[row_of(p["word"])] + vectors[g].sum(0) / math.sqrt(len(g)))
        return out

    def rows(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = np.stack([summed(p) for p in frame["profile"]])
            out /= np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-9)
            yield pd.DataFrame({"record": frame["record"], "vector": list(out)})

    def total(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        whole, n = np.zeros(vectors.shape[1]), 0
        for frame in frames:
            whole, n = whole + np.stack(frame["vector"]).sum(0, dtype=float), n + len(frame)
        yield pd.DataFrame({"whole": [whole], "n": [n]})

    plain = cut(profiled.select("record", "profile").mapInPandas(rows, "record string, vector array<float>"))
    parts = plain.select("vector").mapInPandas(total, "whole array<double>, n long").select(F.posexplode("whole").alias("at", "x"), "n")
    sums = parts.groupBy("at").agg(F.sum("x").alias("x"), F.sum("n").alias("n")).toPandas()  # a row per dimension
    mean = np.zeros(vectors.shape[1], dtype=np.float32)
    mean[sums["at"].to_numpy(dtype=int)] = sums["x"].to_numpy(dtype=float) / np.maximum(1, sums["n"].to_numpy(dtype=float))

    def centred(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = np.stack(frame["vector"]) - mean
            out /= np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-9)
            yield frame.assign(vector=list(out))

    return plain.mapInPandas(centred, "record string, vector array<float>")


# ---------------------------------------------------------------- hyperplane hashing


def hash_bits(n: int) -> int:
    """Signs of a key, such that an even spread of ``n`` records leaves FILL to a bucket."""
    return max(2, min(40, round(math.log2(max(1, n) / FILL)))) if n > 4 * FILL else 2


def hash_keys(vectored: DataFrame, bits: int, probing: bool = False, tables: int = TABLES, seed: int = 11, dimensions: int = DIMENSIONS) -> DataFrame:
    """(record, keys, s1, s2, packed): per table the signs of a vector against ``bits`` + 2 * MORE_BITS hyperplanes.

    With ``probing`` a table has PROBES keys: those with the one or two least certain of the first signs turned, too.
    s1 and s2 are 128 more signs, packed is the vector as bytes.
    """
    more = 2 * MORE_BITS
    random = np.random.default_rng(seed)
    planes = random.standard_normal((tables * (bits + more), dimensions)).astype(np.float32)
    marks = random.standard_normal((128, dimensions)).astype(np.float32)
    powers = 1 << np.arange(bits + more, dtype=np.int64)[::-1]
    weights = (np.uint64(1) << np.arange(64, dtype=np.uint64)).astype(np.uint64)

    def hashed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            vector = np.stack(frame["vector"]).astype(np.float32)
            far = (vector @ planes.T).reshape(len(frame), tables, bits + more)
            keys = ((far > 0) * powers).sum(-1)
            if probing:
                unsure = np.argsort(np.abs(far[:, :, :bits]), axis=-1)[:, :, :2]
                one, two = powers[unsure[:, :, 0]], powers[unsure[:, :, 1]]
                keys = np.stack([keys, keys ^ one, keys ^ two, keys ^ one ^ two], axis=-1).reshape(len(frame), -1)
            signs = (vector @ marks.T > 0).reshape(len(frame), 2, 64)
            both = (signs * weights).sum(-1, dtype=np.uint64).view(np.int64)
            yield pd.DataFrame({"record": frame["record"], "keys": list(keys), "s1": both[:, 0], "s2": both[:, 1], "packed": [v.tobytes() for v in vector.astype(np.float16)]})

    return vectored.mapInPandas(hashed, "record string, keys array<long>, s1 long, s2 long, packed binary")


def near(queries: DataFrame, index: DataFrame, bucket: int = BUCKET, apart: int = APART) -> DataFrame:
    """(query, id): all pairs that share a bucket in any table and differ in at most ``apart`` of the 128 marking signs.

    ``queries`` has query, keys (PROBES a table), s1 and s2 (several rows of one query are several views of it), ``index`` id, keys,
    s1 and s2. A bucket with more than ``bucket`` indexed records takes MORE_BITS more signs, twice at most; what is still
    fuller holds records of nearly one vector and stays whole. Index one record per distinct profile: copies share all buckets.
    """
    q = queries.select("query", F.col("s1").alias("q1"), F.col("s2").alias("q2"), F.posexplode("keys").alias("t", "k")).withColumn("t", F.expr(f"t div {PROBES}").cast("int"))
    x = index.select("id", "s1", "s2", F.posexplode("keys").alias("t", "k"))
    key = lambda level: F.shiftright("k", (2 - level) * MORE_BITS)
    b = lambda level: F.xxhash64("t", F.lit(level), key(level))
    q, x = q.withColumn("b", b(0)), x.withColumn("b", b(0))
    for level in (1, 2):
        full = cut(x.groupBy("b").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > bucket).select("b", F.lit(True).alias("full")))
        if full.isEmpty():
            break
        # Both sides move to the longer key, so one join meets all levels and the plan stays small.
        q, x = (side.join(full, "b", "left").withColumn("b", F.when(F.col("full"), b(level)).otherwise(F.col("b"))).drop("full") for side in (q, x))
    # An exploded side is taken for as small as its file; by the hint it isn't gathered on the driver, to be broadcast at many times that size.
    met = q.drop("t", "k").join(x.drop("t", "k").hint("merge"), "b")
    return met.where(F.bit_count(F.col("q1").bitwiseXOR(F.col("s1"))) + F.bit_count(F.col("q2").bitwiseXOR(F.col("s2"))) <= apart).select("query", "id").distinct()


def cosines(pairs: DataFrame, views: DataFrame, index: DataFrame) -> DataFrame:
    """(query, id, cos_all, cos_own, cos_part): the exact cosines of a pair, NULL for a view that the query lacks.

    ``views`` has query, view ('q', 'o' or 'p') and packed, ``index`` id and packed.
    """
    side = views.groupBy("query").agg(*(F.max(F.when(F.col("view") == v, F.col("packed"))).alias(f"v{v}") for v in "qop"))
    full = pairs.join(side, "query").join(index.select("id", F.col("packed").alias("ev")), "id").select("query", "id", "vq", "vo", "vp", "ev")
    width = 2 * DIMENSIONS

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            unit = lambda i: np.frombuffer(b"".join(v if v is not None else bytes(width) for v in batch.column(i).to_pylist()), dtype=np.float16).reshape(batch.num_rows, -1).astype(np.float32)
            entity = unit(5)
            columns = []
            for i in (2, 3, 4):
                columns.append(pa.array((unit(i) * entity).sum(1).astype(np.float64), mask=np.asarray(batch.column(i).is_null())))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *columns], names=["query", "id", "cos_all", "cos_own", "cos_part"])

    return full.mapInArrow(compute, "query long, id long, cos_all double, cos_own double, cos_part double")


# ---------------------------------------------------------------- calibration

#: Lower bounds of the cosine's classes.
STEPS = (0.5, 0.6, 0.7, 0.8, 0.87, 0.93, 0.97)


def cosine_class(c):
    """0 for an unknown cosine, else 1 and upwards by STEPS."""
    out = F.lit(1)
    for i, s in enumerate(STEPS):
        out = F.when(c >= s, i + 2).otherwise(out)
    return F.when(c.isNull(), 0).otherwise(out)


#: Pairs for which the assumptions of the first round stand.
PRIOR = 10.0


def mixture(cells: np.ndarray, n: np.ndarray, sizes: tuple[int, ...], rounds: int = 200) -> np.ndarray:
    """Probability of a match for every possible cell of classes (0 is unknown and tells nothing), by expectation maximisation.

    Two components, features independent within each; the likelihood ratio of every feature is kept from falling with its class, so
    that the component of greater cosines is the matches'. No labels and no cell's own verdict enter. What is assumed at first counts as PRIOR pairs,
    so that few pairs don't go astray.
    """
    every = np.stack(np.meshgrid(*(np.arange(s) for s in sizes), indexing="ij"), -1).reshape(-1, len(sizes))
    match = [np.concatenate([[1.0], np.linspace(0.02, 1, s - 1) ** 2]) for s in sizes]
    other = [np.concatenate([[1.0], np.linspace(1, 0.02, s - 1) ** 2]) for s in sizes]
    for f in (match, other):
        for k, x in enumerate(f):
            f[k] = np.concatenate([[1.0], x[1:] / x[1:].sum()])
    share, first = 0.2, ([x.copy() for x in match], [x.copy() for x in other])

    def posterior(at: np.ndarray) -> np.ndarray:
        m, u = np.full(len(at), share), np.full(len(at), 1 - share)
        for k in range(len(sizes)):
            m, u = m * match[k][at[:, k]], u * other[k][at[:, k]]
        return m / (m + u)

    for _ in range(rounds if n.sum() else 0):
        p = posterior(cells)
        share = float(np.clip(((p * n).sum() + 0.2 * PRIOR) / (n.sum() + PRIOR), 1e-4, 0.9))
        for k, s in enumerate(sizes):
            got, lost = (np.bincount(cells[:, k], weights=w * n, minlength=s)[1:] + PRIOR * start[k][1:] for w, start in zip((p, 1 - p), first))
            got, lost = got / got.sum(), lost / lost.sum()
            ratio = rising(got / lost, got + lost)
            match[k] = np.concatenate([[1.0], (got + lost) * ratio / (1 + ratio) / ((got + lost) * ratio / (1 + ratio)).sum()])
            other[k] = np.concatenate([[1.0], (got + lost) / (1 + ratio) / ((got + lost) / (1 + ratio)).sum()])
    return posterior(every).reshape(sizes)


def rising(values: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """The nearest non-decreasing values: neighbours that fall are pooled by weight."""
    blocks: list[list[float]] = []
    for v, w in zip(values, weights):
        blocks.append([v, w, 1])
        while len(blocks) > 1 and blocks[-2][0] > blocks[-1][0]:
            v2, w2, k2 = blocks.pop()
            v1, w1, k1 = blocks.pop()
            blocks.append([(v1 * w1 + v2 * w2) / (w1 + w2), w1 + w2, k1 + k2])
    return np.concatenate([[v] * int(k) for v, _, k in blocks]) if blocks else np.zeros(0)


# ---------------------------------------------------------------- exact reranking


def _places(counts: Mapping[str, int], place: str | None, background: Mapping[str, float], home: float = 0.55) -> float:
    """Log-likelihood ratio that reported places come from a firm at ``place`` rather than from any; 0 where it is unknown."""
    if not place:
        return 0.0
    total = 0.0
    for p, n in counts.items():
        base = background.get(p, 1e-4)
        total += n * math.log(((home if p == place else 0.0) + (1 - home) * base) / base)
    return max(-8.0, min(8.0, total))


def rerank_score(entity: Sequence[str], place: str | None, profile: Mapping[str, tuple[float, float]], own: Sequence[Sequence[str]], places: Mapping[str, int], background: Mapping[str, float], idf: Mapping[str, float], usual: Mapping[str, float]) -> tuple[float, float]:
    """(log odds, brand) of an indexed name against a query's profile.

    brand is how much of the entity's telling words (by idf) the query's attributes hold, spelling tolerated: below
    0.7 there is no match. A whole name among the query's own adds, a different kind of business takes away,
    ``usual`` being log ratios of words between the query side's names and the entities'.
    """
    words = [w for w in entity if w not in _LEGAL_SET and w[0] != "#"]
    if not words:
        return -9.0, 0.0
    top = max(idf.get(w, 0.0) for w in words)
    telling = [w for w in words if idf.get(w, 0.0) >= 0.45 * top or idf.get(w, 0.0) >= 4.0] or words
    hits, total = 0.0, 0.0
    rarest = max(telling, key=lambda w: idf.get(w, 0.0))
    rare_hit = 0.0
    for w in telling:
        weight = idf.get(w, 1.0)
        best = 0.0
        for v, (share, _) in profile.items():
            like = 1.0 if v == w else word_likeness(w, v) if v[0] == w[0] or v[-2:] == w[-2:] else 0.0
            if len(v) > len(w) + 2 and (v.startswith(w) or v.endswith(w)) and len(w) >= 4:
                like = max(like, 0.95)  # run together
            if like >= LIKE:
                best = max(best, like * min(1.0, share / FULL_SHARE))
        hits += weight * best
        total += weight
        if w == rarest:
            rare_hit = best
    brand = hits / total
    if brand < HIT or rare_hit < HIT:
        return -9.0, brand
    name = max((organisation_likeness(entity, o) for o in own), default=None)
    score = 8.0 * (brand - 0.75)
    kind = sum(usual.get(w, 0.0) for w in words if w not in telling or w in usual)
    if name is not None and name >= 0.75:
        legal_e, own_legal = {w for w in entity if w in _LEGAL_SET}, [{w for w in o if w in _LEGAL_SET} for o in own if organisation_likeness(entity, o) >= 0.75]
        score += 4.0 + (1.5 if any(legal_e & o or not legal_e or not o for o in own_legal) else -1.0)
    else:
        score += -1.0 if name is not None else 0.0
        score += max(-6.0, min(1.5, kind))
    return score + _places(places, place, background), brand


# ---------------------------------------------------------------- places (fixed values)

PLACES = {
    "alabama": "AL", "alaska": "AK", "arizona": "AZ", "arkansas": "AR", "california": "CA", "colorado": "CO", "connecticut": "CT", "delaware": "DE", "florida": "FL", "georgia": "GA", "hawaii": "HI", "idaho": "ID", "illinois": "IL", "indiana": "IN", "iowa": "IA", "kansas": "KS", "kentucky": "KENTUCKY", "louisiana": "LA",
    "maine": "ME", "maryland": "MD", "massachusetts": "MA", "michigan": "MI", "minnesota": "MN", "mississippi": "MS", "missouri": "MO", "montana": "MT", "nebraska": "NE", "nevada": "NV", "new hampshire": "NH", "new jersey": "NJ", "new mexico": "NM", "new york": "NY", "north carolina": "NC", "north dakota": "ND", "ohio": "OH",
    "oklahoma": "OK", "oregon": "OR", "pennsylvania": "PA", "rhode island": "RI", "south carolina": "SC", "south dakota": "SD", "tennessee": "TN", "texas": "TX", "utah": "UT", "vermont": "VT", "virginia": "VA", "washington": "WA", "west virginia": "WV", "wisconsin": "WI", "wyoming": "WY", "district of columbia": "DC",
    "cayman islands": "KY", "luxembourg": "LU", "ireland": "IE", "bermuda": "BM", "british virgin islands": "VG", "jersey": "JE", "guernsey": "GG",
}


def place_code(c):
    """A state or country under its code, however it is written; other text in upper case, blank as NULL."""
    bare = F.trim(F.regexp_replace(F.lower(F.trim(c)), r"[,\s]+(?:u\.?s\.?a?\.?|united states)$", ""))
    known = F.create_map(*(F.lit(x) for kv in PLACES.items() for x in kv))
    return F.when(bare != "", F.coalesce(F.try_element_at(known, bare), F.upper(bare)))


# ---------------------------------------------------------------- the operator

#: An own name that more queries than this bear is an agent's, not their own.
SHARED_NAME = 3
#: Places whose frequency is known apart; the rest count as rare.
PLACES_KNOWN = 500
#: Classes of the share of a query's places that an entity's place has; class 0 is unknown.
PLACE_STEPS = (0.001, 0.2, 0.5)
#: Probability from which a pair is accepted, subject to the exact check.
ACCEPT = 0.25
SIZES = (len(STEPS) + 2, len(STEPS) + 2, len(PLACE_STEPS) + 2)


def match_records(index: DataFrame, attributes: DataFrame, places: DataFrame, accept: float = ACCEPT, check: bool = True) -> DataFrame:
    """(entity, query, cosine, confidence, odds): at most one entity per query and one query per entity.

    ``index``: entity, name, place, active. ``attributes``: query, kind ('own' for its own name, 'part' for
    names of what belongs to it), text. ``places``: query, place, n. Entities of one name and place
    stand together and are represented by an active one with the least id.

    A pair is accepted where its cosines (own names, parts' names, places) give a probability of at least ``accept``, calibrated on the other
    half of the queries. With ``check`` an exact comparison of words, legal forms and places follows, which only takes pairs away
    and decides between candidates of equal probability; ties go to the least entity.
    NULL names and texts match nothing; empty sides give no row.
    """
    shared = attributes.where(F.col("kind") == "own").groupBy("text").agg(F.countDistinct("query").alias("n")).where(F.col("n") > SHARED_NAME).select(F.lit("own").alias("kind"), "text")
    # At every stage that ends, the driver takes the whole plan in text and as a tree anew: what several steps read is cut, so no plan grows long.
    own = cut(attributes.where(F.col("query").isNotNull() & F.col("text").isNotNull()).select("query", "kind", "text").distinct().join(shared, ["kind", "text"], "left_anti"))
    places = cut(places.select("query", "place", "n"))
    entity = index.where(F.col("entity").isNotNull() & F.col("name").isNotNull())
    named = cut(entity.select("entity", "name", "place", "active", F.concat(F.lit("e:"), F.lower(F.trim(F.regexp_replace("name", r"[\s.,]+", " ")))).alias("record")))
    told = named.select("record", F.lit("name").alias("kind"), F.col("name").alias("text")).unionByName(named.select("record", F.lit("place").alias("kind"), F.col("place").alias("text")))
    told = told.unionByName(own.select(F.concat(F.lit("q:"), "query").alias("record"), "kind", "text")).unionByName(places.where(F.col("query").isNotNull()).select(F.concat(F.lit("q:"), "query").alias("record"), F.lit("place").alias("kind"), F.col("place").alias("text")))
    links = cut(attribute_words(told))
    records = links.select("record").distinct().agg(F.count("record").alias("n"), F.count_if(F.col("record").startswith("e:")).alias("e")).first()
    vectors = train(walks(links))
    texts = links.where(~F.col("attribute").startswith("place\t"))
    # A query is looked up by all its names, by its own alone and by those of its parts alone: one badly typed name then hides nothing.
    also = lambda p: F.array("record", F.concat(F.lit(p), _bare("record")))
    seen_as = F.when(F.col("attribute").startswith("own\t"), also("o:")).when(F.col("attribute").startswith("part\t"), also("p:")).otherwise(F.array("record"))
    profiled = cut(profiles(texts.select(F.explode(seen_as).alias("record"), "attribute", "word"), word_weights(texts, records["n"])))
    vectored = cut(record_vectors(profiled, vectors))
    is_entity = F.col("record").startswith("e:")
    bits = hash_bits(records["e"])
    hashed_index = cut(hash_keys(vectored.where(is_entity), bits).withColumn("id", F.xxhash64("record")))
    hashed_views = cut(hash_keys(vectored.where(~is_entity), bits, True).withColumn("query", F.xxhash64(_bare("record"))).withColumn("view", F.left("record", F.lit(1))))
    pairs = near(hashed_views, hashed_index)
    names = own.groupBy("query").agg(F.collect_set(F.when(F.col("kind") == "own", F.col("text"))).alias("own"))
    lain = places.where(F.col("place").isNotNull() & F.col("query").isNotNull()).groupBy("query", "place").agg(F.sum("n").alias("n")).groupBy("query").agg(F.collect_list(F.struct("place", "n")).alias("places"))
    told = names.join(lain, "query", "left").withColumn("qid", F.xxhash64("query"))
    judged = _calibrated(cosines(pairs, hashed_views, hashed_index), named, told, accept)
    scored = cut(_checked(judged, profiled, places, links, records)) if check else judged.withColumn("odds", F.lit(0.0))
    likely = [F.desc(F.round("confidence", 2)), F.desc("odds"), F.desc("cosine")]
    best = lambda by, other: Window.partitionBy(by).orderBy(*likely, other)
    kept = scored.withColumn("r", F.row_number().over(best("query", "entity"))).where("r = 1").withColumn("r", F.row_number().over(best("entity", "query"))).where("r = 1")
    return kept.select("entity", "query", "cosine", "confidence", "odds")


def _bare(c: str):
    """A record's name without the two signs that mark its side."""
    return F.expr(f"substring({c}, 3)")


def _calibrated(found: DataFrame, named: DataFrame, told: DataFrame, accept: float) -> DataFrame:
    """Pairs of query and entity whose probability is at least ``accept``: the columns of both sides, cosine and confidence."""
    spark = found.sparkSession
    stands = named.groupBy("record", "place").agg(F.min(F.struct((~F.coalesce("active", F.lit(False))).alias("gone"), F.col("entity").alias("entity"))).alias("s"), F.min("name").alias("name"))
    stands = stands.select(F.xxhash64("record").alias("id"), "record", "place", F.col("s.entity").alias("entity"), "name")
    pairs = cut(found.where(F.greatest("cos_all", "cos_own", "cos_part") >= STEPS[0])).withColumnRenamed("query", "qid").join(stands, "id").join(told, "qid")
    total = lambda c: F.aggregate(c, F.lit(0).cast("long"), lambda x, y: x + y["n"])
    share = F.when(F.col("place").isNotNull() & F.col("places").isNotNull(), total(F.filter("places", lambda p: p["place"] == F.col("place"))) / total("places"))
    placed = F.when(share.isNull(), 0).when(share >= PLACE_STEPS[2], 4).when(share >= PLACE_STEPS[1], 3).when(share >= PLACE_STEPS[0], 2).otherwise(1)
    cell = (cosine_class(F.col("cos_own")) * SIZES[1] + cosine_class(F.col("cos_part"))) * SIZES[2] + placed
    pairs = cut(pairs.select("qid", "query", "own", "places", "record", "entity", "name", "place", F.greatest("cos_all", "cos_own", "cos_part").alias("cosine"), F.pmod("qid", F.lit(2)).cast("int").alias("half"), cell.alias("cell")))
    counts = pairs.groupBy("half", "cell").count().toPandas()  # at most 2 * 9 * 9 * 5 rows
    rows, cells = [], math.prod(SIZES)
    for half in (0, 1):
        other = counts[counts["half"] != half]
        p = mixture(np.stack(np.unravel_index(other["cell"].to_numpy(dtype=int), SIZES), -1), other["count"].to_numpy(dtype=float), SIZES)
        rows += [(half * cells + i, float(x)) for i, x in enumerate(p.ravel())]
    table = spark.createDataFrame(rows, "cell int, confidence double")
    pairs = pairs.withColumn("cell", F.col("half") * cells + F.col("cell"))
    return pairs.join(F.broadcast(table), "cell").where(F.col("confidence") >= accept).drop("half", "cell")  # 2 * 9 * 9 * 5 rows


def _checked(pairs: DataFrame, profiled: DataFrame, places: DataFrame, links: DataFrame, records) -> DataFrame:
    """The pairs with ``odds`` whose words, legal forms and places, compared exactly, don't contradict (odds above 0)."""
    # How much more usual a word is in the queries' own names than in the entities'.
    sides = links.where(F.col("attribute").startswith("own\t") | F.col("attribute").startswith("name\t"))
    counted = sides.select("word", "record").distinct().groupBy("word").agg(F.count_if(F.col("record").startswith("q:")).alias("nq"), F.count_if(F.col("record").startswith("e:")).alias("ne"))
    usual = counted.where(F.col("nq") + F.col("ne") >= 20).select("word", F.log(((F.col("nq") + 0.5) / (records["n"] - records["e"] + 1)) / ((F.col("ne") + 0.5) / (records["e"] + 1))).alias("usual"))
    entity_words = profiled.join(pairs.select("record"), "record", "left_semi").select("record", F.explode("profile").alias("p")).select("record", "p.word", "p.idf").join(usual, "word", "left")
    entity_words = cut(entity_words.groupBy("record").agg(F.collect_list(F.struct("word", "idf", "usual")).alias("words")))
    base = places.groupBy("place").agg(F.sum("n").alias("n")).where(F.col("place").isNotNull()).orderBy(F.desc("n"), "place").limit(PLACES_KNOWN).toPandas()
    background = dict(zip(base["place"], base["n"] / max(1, base["n"].sum())))
    profile = profiled.where(F.col("record").startswith("q:")).select(_bare("record").alias("query"), "profile")
    full = pairs.join(entity_words, "record").join(profile, "query").select("query", "entity", "cosine", "confidence", "name", "place", "words", "profile", "own", "places")

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 200):  # bounds what is unpacked at once
                part = batch.slice(start, 200)
                odds = []
                for r in part.select(["name", "place", "words", "profile", "own", "places"]).to_pylist():
                    profile = {p["word"]: (p["share"], p["idf"]) for p in r["profile"]}
                    idf = {w["word"]: w["idf"] for w in r["words"]}
                    ratio = {w["word"]: w["usual"] for w in r["words"] if w["usual"] is not None}
                    where = {p["place"]: p["n"] for p in r["places"] or ()}
                    odds.append(rerank_score(name_tokens(r["name"]), r["place"], profile, [name_tokens(x) for x in r["own"] or ()], where, background, idf, ratio)[0])
                yield pa.RecordBatch.from_arrays([*(part.column(i) for i in range(4)), pa.array(odds, pa.float64())], names=["query", "entity", "cosine", "confidence", "odds"])

    return full.mapInArrow(score, "query string, entity string, cosine double, confidence double, odds double").where(F.col("odds") > 0)
