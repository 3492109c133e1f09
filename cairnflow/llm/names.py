"""Variant spellings of names typed by people.

Suffix blocking: the suffixes of tokens are indexed; a suffix that is too common is refined
with other fields (a longer suffix, the other tokens of the name), and names that have what is
still common after all refinements are held against those with a word near their rarest one. Pairs are compared by the ratio of
their longest common subsequence, token by token and as a whole.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections.abc import Iterator, Sequence
from functools import lru_cache
from itertools import combinations

import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cairnflow.operators.graph import components
from cairnflow.session import cut

# ---------------------------------------------------------------- word lists (fixed values)

#: Legal forms, each under one name.
LEGAL = {
    "inc": "inc", "incorporated": "inc", "corp": "corp", "corporation": "corp", "co": "co", "company": "co", "ltd": "ltd", "limited": "ltd", "llc": "llc", "lp": "lp", "llp": "llp", "plc": "plc", "scsp": "scsp", "sa": "sa", "ag": "ag", "gmbh": "gmbh", "nv": "nv", "bv": "bv", "trust": "trust",
}
SPELLED_LEGAL = [("limited liability company", "llc"), ("limited partnership", "lp"), ("l l c", "llc"), ("l p", "lp"), ("l l p", "llp"), ("p l c", "plc"), ("s c sp", "scsp")]
#: Short forms of given names.
NICKNAMES = {
    "tom": "thomas", "tommy": "thomas", "tim": "timothy", "len": "leonard", "lenny": "leonard", "jen": "jennifer", "jenny": "jennifer", "sam": "samuel", "sammy": "samuel", "bill": "william", "will": "william", "billy": "william", "liam": "william", "bob": "robert", "rob": "robert", "bobby": "robert",
    "dick": "richard", "rick": "richard", "rich": "richard", "jim": "james", "jimmy": "james", "jamie": "james", "mike": "michael", "mick": "michael", "mickey": "michael", "dave": "david", "dan": "daniel", "danny": "daniel", "joe": "joseph", "joey": "joseph", "chuck": "charles", "charlie": "charles", "chas": "charles",
    "chris": "christopher", "topher": "christopher", "matt": "matthew", "tony": "anthony", "andy": "andrew", "drew": "andrew", "steve": "steven", "stephen": "steven", "ken": "kenneth", "ed": "edward", "eddie": "edward", "ted": "edward", "ned": "edward", "greg": "gregory", "larry": "lawrence", "laurence": "lawrence",
    "nick": "nicholas", "walt": "walter", "wally": "walter", "hank": "henry", "harry": "harold", "hal": "harold", "ron": "ronald", "ronnie": "ronald", "ben": "benjamin", "benny": "benjamin", "theo": "theodore", "alex": "alexander", "al": "albert", "fred": "frederick", "jack": "john", "johnny": "john", "jon": "john",
    "liz": "elizabeth", "beth": "elizabeth", "betty": "elizabeth", "eliza": "elizabeth", "lisa": "elizabeth", "peggy": "margaret", "meg": "margaret", "maggie": "margaret", "marge": "margaret", "kate": "katherine", "katie": "katherine", "kathy": "katherine", "kat": "katherine", "cathy": "katherine", "catherine": "katherine",
    "sue": "susan", "susie": "susan", "suzy": "susan", "deb": "deborah", "debbie": "deborah", "debra": "deborah", "barb": "barbara", "pat": "patricia", "patty": "patricia", "trish": "patricia", "tricia": "patricia", "vicky": "victoria", "vicki": "victoria", "tori": "victoria", "becky": "rebecca", "becca": "rebecca",
    "mina": "wilhelmina", "willa": "wilhelmina", "minnie": "wilhelmina", "fran": "frances", "frannie": "frances", "bobbie": "roberta", "robbie": "roberta", "linda": "linda", "mary": "mary", "nancy": "nancy",
}
ROMAN = {"i": 1, "ii": 2, "iii": 3, "iv": 4, "v": 5, "vi": 6, "vii": 7, "viii": 8, "ix": 9, "x": 10, "xi": 11, "xii": 12}
#: What filers append to names without meaning it.
_NOISE = re.compile(r"\s-\s*(?:registrant|filer|issuer|reporting owner|subject)\b.*$|/[a-z]{2,5}/?\s*$|/[a-z]{2,5}/|\((?:the|us|usa|uk|new|old|[a-z]{2})\)")
_WORD = re.compile(r"[a-z0-9]+")


def name_tokens(name: str | None) -> list[str]:
    """Words of a name: folded, without state marks and articles, legal forms under one name and numerals as #n.

    A comma before the last words ('Dune, The') is no matter; NULL and empty names have no words.
    """
    if not name:
        return []
    text = "".join(c for c in unicodedata.normalize("NFKD", name) if not unicodedata.combining(c)).lower().strip()
    text = _NOISE.sub(" ", _NOISE.sub(" ", text)).replace("&", " and ").replace("'", "")
    words = _WORD.findall(text)
    joined = " " + " ".join(words) + " "
    for spelled, short in SPELLED_LEGAL:
        joined = joined.replace(f" {spelled} ", f" {short} ")
    words = [w for w in joined.split() if w not in ("the", "of", "and")]
    out = []
    for i, w in enumerate(words):
        if i and w in LEGAL and w != "trust" and not (w == "company" and i + 1 < len(words)):
            out.append(LEGAL[w])
        elif i and w in ROMAN:
            out.append(f"#{ROMAN[w]}")
        elif w.isdigit() and len(w) <= 3:
            out.append(f"#{int(w)}")
        else:
            out.append(w)
    return out


def person_tokens(name: str | None) -> list[str]:
    """Words of a person's name with given names in full; suffixes like jr stay."""
    return [NICKNAMES.get(w, w) for w in name_tokens_plain(name)]


def name_tokens_plain(name: str | None) -> list[str]:
    if not name:
        return []
    text = "".join(c for c in unicodedata.normalize("NFKD", name) if not unicodedata.combining(c)).lower()
    return [w for w in _WORD.findall(_NOISE.sub(" ", text).replace("'", "")) if w not in ("mr", "mrs", "ms", "dr")]


# ---------------------------------------------------------------- comparison


def lcs(a: str, b: str) -> int:
    """Length of the longest common subsequence, by bits of one whole number."""
    if len(a) > len(b):
        a, b = b, a
    if not a:
        return 0
    masks: dict[str, int] = {}
    for i, c in enumerate(a):
        masks[c] = masks.get(c, 0) | 1 << i
    full = (1 << len(a)) - 1
    row = full
    for c in b:
        hit = row & masks.get(c, 0)
        row = (row + hit | row - hit) & full
    return len(a) - row.bit_count()


def lcs_ratio(a: str, b: str) -> float:
    return 2 * lcs(a, b) / (len(a) + len(b)) if a or b else 1.0


@lru_cache(maxsize=50_000)
def word_likeness(a: str, b: str) -> float:
    """How far two words may be one: 1 for equal ones, LCS ratio for typos, 0.9 for an abbreviation of the other."""
    if a == b:
        return 1.0
    short, long = (a, b) if len(a) <= len(b) else (b, a)
    common = lcs(a, b)
    if len(short) >= 2 and short[0] == long[0] and common == len(short) and len(long) - len(short) >= 2 and len(short) <= 0.8 * len(long):
        return 0.9 if len(short) >= 3 or len(short) == 2 and long.endswith(short[1]) else 0.8
    ratio = 2 * common / (len(a) + len(b))
    if sorted(a) == sorted(b):
        return max(ratio, 0.9)  # transposed letters
    if len(short) < 4 or abs(len(a) - len(b)) > 2 or len(long) - common > 2:
        return 0.0
    return ratio


def align(a: Sequence[str], b: Sequence[str]) -> tuple[list[tuple[str, str, float]], list[str], list[str]]:
    """Greedy alignment of words in any order, with words run together or split; what is left over on either side."""
    left, right = list(a), list(b)
    pairs: list[tuple[str, str, float]] = []
    for w in list(left):
        if w in right:
            pairs.append((w, w, 1.0))
            left.remove(w)
            right.remove(w)
    for x, y, flip in ((left, right, False), (right, left, True)):
        for i in range(len(x) - 1):  # two words here are one there
            if i + 1 < len(x) and x[i] is not None and x[i + 1] is not None:
                both = x[i] + x[i + 1]
                for k, w in enumerate(y):
                    if w is not None and len(w) >= 5 and (w == both or lcs_ratio(w, both) >= 0.9 and abs(len(w) - len(both)) <= 1):
                        pairs.append((w, both, lcs_ratio(w, both)) if flip else (both, w, lcs_ratio(w, both)))
                        x[i] = x[i + 1] = y[k] = None
                        break
        x[:] = [w for w in x if w is not None]
        y[:] = [w for w in y if w is not None]
    scored = sorted(((word_likeness(w, v), i, j) for i, w in enumerate(left) for j, v in enumerate(right)), reverse=True)
    used_i, used_j = set(), set()
    for s, i, j in scored:
        if s >= 0.7 and i not in used_i and j not in used_j:
            used_i.add(i)
            used_j.add(j)
            pairs.append((left[i], right[j], s))
    return pairs, [w for i, w in enumerate(left) if i not in used_i], [w for j, w in enumerate(right) if j not in used_j]


#: Likeness that every single word must reach; two typing errors in a short word fall below it.
WEAKEST = 0.75
_LEGAL_SET = set(LEGAL.values()) - {"trust"}


def organisation_likeness(a: Sequence[str], b: Sequence[str]) -> float:
    """LCS ratio of two organisations' names, 0 where a numeral, the legal form or a whole word contradicts."""
    na, nb = sorted(w for w in a if w[0] == "#"), sorted(w for w in b if w[0] == "#")
    if na != nb:
        return 0.0
    la, lb = [w for w in a if w in _LEGAL_SET], [w for w in b if w in _LEGAL_SET]
    wa, wb = [w for w in a if w[0] != "#" and w not in _LEGAL_SET], [w for w in b if w[0] != "#" and w not in _LEGAL_SET]
    if len(wa) == len(wb):
        x, y = [w for w in wa if w not in wb], [w for w in wb if w not in wa]
        if any(all(w not in v and v not in w and word_likeness(w, v) < WEAKEST for v in y) for w in x):
            return 0.0  # by far the most frequent case: a word has no counterpart
    pairs, left, right = align(wa, wb)
    if not pairs or [w for w in left + right if w not in LEGAL] or min(s for _, _, s in pairs) < WEAKEST:
        return 0.0
    letters = sum(max(len(x), len(y)) for x, y, _ in pairs)
    score = sum(s * max(len(x), len(y)) for x, y, s in pairs) / letters
    if la and lb and set(la).isdisjoint(lb):
        score *= 0.9
    return score


def person_likeness(a: Sequence[str], b: Sequence[str]) -> float:
    """Likeness of two persons' names: two long words must pair, initials and lone words must not contradict."""
    pairs, left, right = align([w for w in a if len(w) > 1], [w for w in b if len(w) > 1])
    strong = [p for p in pairs if min(len(p[0]), len(p[1])) >= 2]
    if len(strong) < 2:
        # A given name may be an initial on one side.
        if len(strong) == 1 and len(strong[0][0]) >= 5:
            ia, ib = [w[0] for w in a if w not in (strong[0][0],)], [w[0] for w in b if w not in (strong[0][1],)]
            if len(a) == len(b) and sorted(ia) == sorted(ib) and ia and (all(len(w) == 1 for w in a if w != strong[0][0]) or all(len(w) == 1 for w in b if w != strong[0][1])):
                return 0.85 * strong[0][2]
        return 0.0
    ia, ib = [w for w in a if len(w) == 1], [w for w in b if len(w) == 1]
    spare_a, spare_b = left + ia, right + ib
    for w in list(spare_a):
        mate = next((v for v in spare_b if v[0] == w[0] and (len(v) == 1 or len(w) == 1)), None)
        if mate:
            spare_a.remove(w)
            spare_b.remove(mate)
    if spare_a and spare_b:
        return 0.0
    score = sum(s * max(len(x), len(y)) for x, y, s in pairs) / sum(max(len(x), len(y)) for x, y, _ in pairs)
    return score - 0.02 * len(spare_a + spare_b)


# ---------------------------------------------------------------- blocking

SUFFIX = 4


def block_words(tokens: Sequence[str]) -> list[str]:
    """Words that are indexed: those long enough and each two neighbours run together, legal forms left out."""
    words = [w for w in tokens if w[0] != "#" and w not in _LEGAL_SET]
    out = [w for w in words if len(w) >= SUFFIX]
    return list(dict.fromkeys(out + [x + y for x, y in zip(words, words[1:])]))


def block_keys(tokens: Sequence[str], level: int, rare: Sequence[str] | None = None) -> list[tuple[str, str]]:
    """(parent, key) of a name at a level of refinement; level 0 is the bare suffix.

    Level 1 adds a longer suffix, the word's own beginning, the legal form or one of the ``rare`` words (by default all); level 2 two
    of these. Another word stands by its suffix and by its beginning: one typing error leaves either whole.
    """
    words = block_words(tokens)
    if level == 0:
        return list(dict.fromkeys((w[-SUFFIX:], w[-SUFFIX:]) for w in words))
    legal = [x for x in tokens if x in _LEGAL_SET]
    told = [w for w in tokens if len(w) > 1 and w[0] != "#" and w not in _LEGAL_SET and (rare is None or w in rare)]
    out = []
    for w in words:
        base = w[-SUFFIX:]
        others = [x for x in told if x != w and not w.endswith(x) and not w.startswith(x)]
        more = sorted({*[f"l{w[-6:]}"] * (len(w) >= 6), f"b{w[:2]}", *legal, *(f"s{x[-SUFFIX:]}" for x in others), *(f"p{x[:3]}" for x in others)})
        if level == 1:
            out += [(base, f"{base}|{x}") for x in more]
        else:
            out += [(f"{base}|{x}", f"{base}|{min(x, y)}|{max(x, y)}") for x in more for y in more if y != x]
    return list(dict.fromkeys(out))


#: Rarest words of a name that refine its keys: common ones tell little and only multiply keys.
RARE = 3


def with_rare_words(forms: DataFrame, most: int = RARE) -> DataFrame:
    """Adds ``rare``: the words of a name that fewest names of its kind have, ties by word. Counted over all forms."""
    words = forms.select("id", "kind", F.explode(F.array_distinct("tokens")).alias("w")).where((F.length("w") > 1) & ~F.col("w").startswith("#"))
    counts = words.groupBy("kind", "w").agg(F.count(F.lit(1)).alias("n"))
    least = words.join(counts, ["kind", "w"]).groupBy("id").agg(F.transform(F.slice(F.array_sort(F.collect_list(F.struct("n", "w"))), 1, most), lambda x: x["w"]).alias("rare"))
    return forms.join(least, "id", "left").withColumn("rare", F.coalesce("rare", F.array().cast("array<string>")))


#: Names that a block may hold; larger ones are refined.
BLOCK = 25
LEVELS = 3


def _tokens_of(kind: str, name: str) -> list[str]:
    return person_tokens(name) if kind == "person" else name_tokens(name)


def name_forms(names: DataFrame) -> DataFrame:
    """(kind, name, form, tokens) of distinct (kind, name): the form is what spellings without a difference share."""

    def forms(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            tokens = [_tokens_of(k, n) for k, n in zip(frame["kind"], frame["name"])]
            yield frame.assign(form=[f"{k}:{' '.join(sorted(t))}" for k, t in zip(frame["kind"], tokens)], tokens=tokens)

    distinct = names.select("kind", "name").where(F.col("name").isNotNull() & (F.trim("name") != "")).distinct()
    return distinct.mapInPandas(forms, "kind string, name string, form string, tokens array<string>").where(F.size("tokens") > 0)


def candidate_pairs(forms: DataFrame, block: int = BLOCK) -> DataFrame:
    """(a, b), a < b: ids of forms that share a key, but for organisations that share only common ones and are hopeless.

    ``forms`` has id, kind and tokens, one row per form. Level by level: keys of more than ``block`` names hand
    their names on to the refined keys of the next level; what is too common after the last goes to common_pairs.
    """
    out = None
    forms = cut(with_rare_words(forms.select("id", "kind", "tokens")))
    waiting = forms.select("id", "kind", "tokens", "rare", F.lit(None).cast("array<bigint>").alias("parents"))
    for level in range(LEVELS):

        def keys(batches: Iterator[pa.RecordBatch], level: int = level) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for start in range(0, batch.num_rows, 2_000):  # bounds what is held at once
                    ids, found = [], []
                    for row in batch.slice(start, 2_000).to_pylist():
                        known: dict[str, int] = {}
                        mine: set[int] = set()  # a key may come from two parents
                        live = None if row["parents"] is None else set(row["parents"])
                        field = block_field(row["kind"], row["tokens"])
                        for parent, key in block_keys(row["tokens"], level, row["rare"]):
                            if live is not None:
                                if parent not in known:
                                    known[parent] = _hash(field, parent)
                                if known[parent] not in live:
                                    continue
                            mine.add(_hash(field, key))
                        ids += [row["id"]] * len(mine)
                        found += mine
                    yield pa.RecordBatch.from_arrays([pa.array(ids, type=pa.int64()), pa.array(found, type=pa.int64())], names=["id", "h"])

        made = cut(waiting.mapInArrow(keys, "id long, h long"))
        counts = made.groupBy("h").agg(F.count(F.lit(1)).alias("n"))
        small = made.join(counts.where((F.col("n") > 1) & (F.col("n") <= block)).select("h"), "h", "left_semi")
        groups = small.groupBy("h").agg(F.array_sort(F.collect_set("id")).alias("ids"))  # at most ``block`` ids
        pairs = groups.select(F.explode(F.flatten(F.transform("ids", lambda x: F.transform(F.filter("ids", lambda y: y > x), lambda y: F.struct(x.alias("a"), y.alias("b")))))).alias("p")).select("p.a", "p.b")
        out = pairs if out is None else out.unionByName(pairs)
        if level + 1 < LEVELS:
            big = counts.where(F.col("n") > block).select("h")
            handed = made.join(big, "h", "left_semi").groupBy("id").agg(F.collect_set("h").alias("parents"))  # keys of one name
            waiting = forms.join(handed, "id").select("id", "kind", "tokens", "rare", "parents")
    common = made.join(counts.where(F.col("n") > block).select("h"), "h", "left_semi").select("id").distinct()
    return out.unionByName(common_pairs(forms.join(common, "id").select("id", "kind", "tokens"))).distinct()


#: Names with a word that are paired at a time, on average.
PART = 500
#: Likeness from which align() may pair two words.
NEAR = 0.7


def common_pairs(held: DataFrame, part: int = PART) -> DataFrame:
    """(a, b), a < b: pairs of the names ``held`` (id, kind, tokens), among them all that are alike; of organisations without the hopeless.

    No name is alike unless a word that it must pair has a word near it on the other side, so every name is held only against those with
    a word near the one that fewest names are near to; a word of many names is cut into parts by hash. Words that may be run together
    count as the word they then are near to. Of an organisation every telling word must pair, of a person all but one are looked up, for two must pair.
    """
    person = F.col("kind") == "person"
    words = F.array_distinct(F.filter("tokens", lambda w: F.when(person, F.length(w) > 1).otherwise(~w.startswith("#") & ~w.isin(*sorted(_LEGAL_SET)))))
    numerals = F.array_join(F.array_sort(F.filter("tokens", lambda w: w.startswith("#"))), "")  # as in block_field
    names = cut(held.select("id", "kind", "tokens", F.when(person, F.col("kind")).otherwise(F.concat("kind", numerals)).alias("field"), words.alias("words")))
    each = names.select("id", "kind", F.explode("words").alias("w"))
    vocabulary = cut(each.groupBy("kind", "w").agg(F.count(F.lit(1)).alias("n")))
    near = cut(near_words(vocabulary))
    weight = near.join(vocabulary.select("kind", F.col("w").alias("v"), "n"), ["kind", "v"]).groupBy("kind", "w").agg(F.sum("n").alias("weight"))
    telling = F.filter("words", lambda w: person | ~w.isin(*sorted({*LEGAL, *LEGAL.values()})))
    sought = names.select("id", "kind", F.when(F.size(telling) > 0, telling).otherwise(F.col("words")).alias("of"), (F.size(telling) > 0).alias("tells"))
    most = F.when(~F.first("tells"), F.count(F.lit(1))).when(F.first("kind") == "person", F.greatest(F.lit(1), F.count(F.lit(1)) - 1)).otherwise(1).cast("int")
    sought = sought.select("id", "kind", "tells", F.explode("of").alias("w")).join(weight, ["kind", "w"]).groupBy("id", "kind").agg(F.slice(F.array_sort(F.collect_list(F.struct("weight", "w"))), F.lit(1), most).alias("least"))  # words of one name
    joined = cut(joined_words(names, vocabulary))
    asked = cut(sought.select("id", "kind", F.explode("least.w").alias("w")).join(near, ["kind", "w"]).select("id", "v").unionByName(joined).distinct())
    there = cut(each.select("id", F.col("w").alias("v")).unionByName(joined).distinct().join(names.select("id", "field", "tokens"), "id"))
    parts = there.groupBy("field", "v").agg(F.ceil(F.count(F.lit(1)) / part).cast("int").alias("parts")).where("parts > 1")
    split = lambda df, at: df.join(parts, ["field", "v"], "left").withColumn("part", at(F.coalesce("parts", F.lit(1)))).drop("parts")
    left = split(asked.join(names.select("id", "kind", "field", "tokens"), "id"), lambda n: F.explode(F.sequence(F.lit(0), n - 1))).withColumnsRenamed({"id": "x", "tokens": "tx"})
    right = split(there, lambda n: F.pmod(F.xxhash64("id"), n).cast("int")).withColumnsRenamed({"id": "y", "tokens": "ty"})
    both = left.join(right, ["field", "v", "part"]).where((F.col("x") != F.col("y")) & (person | ~hopeless(F.col("tx"), F.col("ty"))))
    return cut(both.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct())


@lru_cache(maxsize=1_000)
def most_left_out(n: int) -> int:
    """Letters that a word of n letters may have more than its longest common subsequence with a word that is near by LCS ratio; -1: none is near."""
    return max([n - c for m in range(max(4, n - 2), n + 3) for c in range(max(1, max(m, n) - 2), min(m, n) + 1) if n >= 4 and 2 * c / (m + n) >= NEAR], default=-1)


def word_keys(w: str) -> Iterator[tuple[str, int]]:
    """Keys under which a word meets all words near it, and its role there: 0 either, 1 the short form, 2 the long one.

    Without letters that only one has, near words are equal; transposed letters are equal when sorted; an abbreviation's first letters are among those of the long form, in order.
    """
    for d in range(most_left_out(len(w)) + 1):
        yield from ((f"d{x}", 0) for x in {"".join(x) for x in combinations(w, len(w) - d)})
    yield f"s{''.join(sorted(w))}", 0
    if len(w) >= 2:
        yield f"a{w[:3]}", 1
    if len(w) >= 4:  # all short forms are two letters or more shorter
        yield from ((f"a{w[0]}{x}", 2) for x in {*w[1:], *("".join(x) for x in combinations(w[1:], 2))})


def near_words(vocabulary: DataFrame) -> DataFrame:
    """(kind, w, v): words of one kind of likeness NEAR or more, both ways, and every word with itself. ``vocabulary`` has kind and w, each once."""

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 2_000):  # bounds what is held at once
                rows = [(k, w, _hash(k, key), role) for k, w in zip(*(c.to_pylist() for c in batch.slice(start, 2_000).columns)) for key, role in word_keys(w)]
                yield pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(zip(*rows), (pa.string(), pa.string(), pa.int64(), pa.int32()))], names=["kind", "w", "h", "role"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array([word_likeness(w, v) >= NEAR for w, v in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())], type=pa.bool_()))

    made = cut(vocabulary.select("kind", "w").mapInArrow(keys, "kind string, w string, h long, role int"))
    of = lambda role, w: made.where(F.col("role") == role).select("kind", "h", F.col("w").alias(w))
    off = F.length("v") - F.length("w")
    alike = of(0, "w").join(of(0, "v"), ["kind", "h"]).where("w < v")
    short = of(1, "w").join(of(2, "v"), ["kind", "h"]).where((off >= 2) & (F.length("w") <= 0.8 * F.length("v") + 1e-9) & (F.levenshtein("w", "v") == off))  # the distance is the difference in length if all letters stand in order
    near = cut(alike.unionByName(short).select("kind", F.least("w", "v").alias("w"), F.greatest("w", "v").alias("v")).distinct().mapInArrow(compare, "kind string, w string, v string"))
    return near.unionByName(near.select("kind", F.col("v").alias("w"), F.col("w").alias("v"))).unionByName(vocabulary.select("kind", "w", F.col("w").alias("v")))


#: LCS ratio from which align() takes two words for one that runs them together, and letters that the one must have.
RUN_TOGETHER = 0.9
LEAST_RUN = 5


def segment_keys(w: str, whole: bool) -> Iterator[str]:
    """Keys under which a word (``whole``) meets two words run together to which it may be alike by RUN_TOGETHER, one letter longer or shorter at most.

    The lengths bound the letters that only one has, e: cut into e + 1 segments, the word has one that stands in the other, the letters
    before and after it bounding how far off.
    """
    for n in (len(w) - 1, len(w), len(w) + 1):
        one, two = (len(w), n) if whole else (n, len(w))
        e = math.floor((1 - RUN_TOGETHER) * (one + two) + 1e-9)
        e -= (e - one + two) % 2
        if one < LEAST_RUN or e < abs(two - one):
            continue
        ends = [one * i // (e + 1) for i in range(e + 2)]
        for i, (p, q) in enumerate(zip(ends, ends[1:])):
            offs = [0] if whole or i == 0 else [two - one] if i == e else [s for s in range(-e, e + 1) if abs(s) + abs(two - one - s) <= e]
            yield from (f"{one}|{two}|{i}|{w[p + s : q + s]}" for s in offs if p + s >= 0 and q + s <= len(w))


def joined_words(names: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """(id, v): words of the vocabulary that two words of a name, in their order, may be when run together. Others may stand between, for they may be paired before."""

    def joins(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                rows = [(i, k, w) for i, k, words in zip(*(c.to_pylist() for c in batch.slice(start, 500).columns)) for w in {x + y for x, y in combinations(words, 2)} if len(w) >= LEAST_RUN - 1]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(zip(*rows), (pa.int64(), pa.string(), pa.string()))], names=["id", "kind", "both"])

    def keys(batches: Iterator[pa.RecordBatch], whole: bool) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 2_000):
                rows = [(k, w, _hash(k, key)) for k, w in zip(*(c.to_pylist() for c in batch.slice(start, 2_000).columns)) for key in {*segment_keys(w, whole)}]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(zip(*rows), (pa.string(), pa.string(), pa.int64()))], names=["kind", "v" if whole else "both", "h"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array([lcs_ratio(w, v) >= RUN_TOGETHER for w, v in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())], type=pa.bool_()))

    # Of a word that stands twice, both may be run together, too.
    terms = F.filter("tokens", lambda w: F.array_contains("words", w))
    made = cut(names.select("id", "kind", terms).mapInArrow(joins, "id long, kind string, both string"))
    singles = vocabulary.select("kind", "w").where(F.length("w") >= LEAST_RUN).mapInArrow(lambda b: keys(b, True), "kind string, v string, h long")
    run = made.select("kind", "both").distinct().mapInArrow(lambda b: keys(b, False), "kind string, both string, h long")
    found = run.join(singles, ["kind", "h"]).select("kind", "both", "v").distinct().mapInArrow(compare, "kind string, both string, v string")
    return made.join(found, ["kind", "both"]).select("id", "v").distinct()


def block_field(kind: str, tokens: Sequence[str]) -> str:
    """The part of every key that spelling doesn't touch: the kind and, but for persons, the numerals, without which no names are alike."""
    return kind if kind == "person" else f"{kind}{''.join(sorted(w for w in tokens if w[0] == '#'))}"


def _hash(kind: str, key: str) -> int:
    return xxhash.xxh64_intdigest(f"{kind}:{key}") - 2**63


def likeness(kind: str, a: Sequence[str], b: Sequence[str]) -> float:
    return person_likeness(a, b) if kind == "person" else organisation_likeness(a, b)


def may_pair(w, v):
    """Whether organisation_likeness may pair the words w and v, alone or as parts of words run together: never false where it does.

    An LCS ratio r of words of together n letters bounds their edit distance by (1 - r) n; an abbreviation's letters stand in order in
    the other word, so the distance is the difference in length; transposed letters are equal when sorted; of a part of a joined word one half is left whole.
    """
    apart, off = F.levenshtein(w, v), F.abs(F.length(w) - F.length(v))
    half = lambda x: F.floor(F.length(x) / 2).cast("int")
    inside = lambda x, y: (F.length(x) >= 4) & (F.contains(y, F.left(x, half(x))) | F.contains(y, F.right(x, half(x))))
    letters = lambda c: F.array_sort(F.split(c, ""))
    close = (off <= (1 - WEAKEST) * (F.length(w) + F.length(v))) & (apart <= (1 - WEAKEST) * (F.length(w) + F.length(v)) + 1e-9)
    part = (F.length(w) <= 3) & (F.length(v) >= 5)  # too short to tell whether it is run together in v
    return (w == v) | part | inside(w, v) | inside(v, w) | close | (apart == off) | ((off == 0) & (letters(w) == letters(v)))


def hopeless(a, b):
    """Whether a telling word that only one of the tokens ``a`` and ``b`` has lacks a possible counterpart among those only the other has: such names are never alike."""
    only_a, only_b = F.array_except(a, b), F.array_except(b, a)
    telling = lambda w: ~w.startswith("#") & ~w.isin(*sorted({*LEGAL, *LEGAL.values()}))
    lone = lambda x, y: F.exists(x, lambda w: telling(w) & ~F.exists(y, lambda v: may_pair(w, v)))
    return lone(only_a, only_b) | lone(only_b, only_a)


def matched_forms(forms: DataFrame, threshold: float = 0.8, block: int = BLOCK) -> DataFrame:
    """(a, b, score) of the candidate pairs of forms at or above ``threshold``.

    Pairs of organisations with a word that has no counterpart are dropped in the JVM; only the others are compared word by word.
    """
    pairs = candidate_pairs(forms, block)
    left = forms.select(F.col("id").alias("a"), "kind", F.col("tokens").alias("ta"))
    right = forms.select(F.col("id").alias("b"), F.col("tokens").alias("tb"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = [likeness(k, x.split(" "), y.split(" ")) for k, x, y in zip(*(batch.column(i).to_pylist() for i in (2, 3, 4)))]
            found = pa.array([s >= threshold for s in score], type=pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(score, type=pa.float64())], names=["a", "b", "score"]).filter(found)

    full = pairs.join(left, "a").join(right, "b").where((F.col("kind") == "person") | ~hopeless(F.col("ta"), F.col("tb")))
    return full.select("a", "b", "kind", F.array_join("ta", " ").alias("ta"), F.array_join("tb", " ").alias("tb")).mapInArrow(compare, "a long, b long, score double")


def link_names(names: DataFrame, threshold: float = 0.8, block: int = BLOCK) -> DataFrame:
    """(kind, record, group): registrations that are one organisation, person or fund share a group.

    ``names`` has kind (person, organisation, fund, ...), record, name and mark; a record may have
    several names. ``mark`` is an identifier that can only contradict (NULL if unknown): records with
    different marks are never linked directly. Names are compared once per form, so exact copies cost nothing
    and only meet through their form. A form without a mark that is like forms of several marks follows the
    likest (ties: the least mark). NULL and empty names link nothing; records without any link are left out.
    """
    spelled = name_forms(names)
    held = names.join(spelled, ["kind", "name"]).select("kind", "record", F.xxhash64("form").alias("id"), F.coalesce("mark", F.lit("")).alias("mark")).distinct()
    held = cut(held)
    forms = cut(spelled.groupBy("form").agg(F.first("kind").alias("kind"), F.min("tokens").alias("tokens")).select(F.xxhash64("form").alias("id"), "kind", "tokens"))
    found = matched_forms(forms, threshold, block)
    nodes = held.select("id", "mark").distinct()
    same_form = forms.select(F.col("id").alias("a"), F.col("id").alias("b"), F.lit(1.0).alias("score"))
    links = found.unionByName(same_form).join(nodes.select(F.col("id").alias("a"), F.col("mark").alias("ma")), "a").join(nodes.select(F.col("id").alias("b"), F.col("mark").alias("mb")), "b")
    links = cut(links.where((F.col("ma") == F.col("mb")) | (F.col("ma") == "") | (F.col("mb") == "")))
    # An unmarked form near several marks keeps the likest.
    sides = links.where((F.col("ma") == "") & (F.col("mb") != "")).select(F.col("a").alias("n"), F.col("mb").alias("m"), "score").unionByName(links.where((F.col("mb") == "") & (F.col("ma") != "")).select(F.col("b").alias("n"), F.col("ma").alias("m"), "score"))
    best = sides.groupBy("n", "m").agg(F.max("score").alias("score")).withColumn("r", F.row_number().over(Window.partitionBy("n").orderBy(F.desc("score"), "m"))).where("r = 1").select("n", F.col("m").alias("best"))
    judged = links.join(best.withColumnsRenamed({"n": "a", "best": "best_a"}), "a", "left").join(best.withColumnsRenamed({"n": "b", "best": "best_b"}), "b", "left")
    agreed = judged.where(
        F.when((F.col("ma") == "") & (F.col("mb") != ""), F.col("best_a") == F.col("mb"))
        .when((F.col("mb") == "") & (F.col("ma") != ""), F.col("best_b") == F.col("ma"))
        .when((F.col("ma") == "") & (F.col("mb") == ""), F.coalesce(F.col("best_a") == F.col("best_b"), F.lit(True)))
        .otherwise(True)
    )
    node = lambda i, m: F.concat(F.lit("f"), F.col(i).cast("string"), F.lit("|"), F.col(m))
    edges = agreed.select(node("a", "ma").alias("a"), node("b", "mb").alias("b")).where("a != b")
    members = held.select(F.concat(F.lit("r"), F.col("kind"), F.lit("|"), F.col("record")).alias("a"), node("id", "mark").alias("b"))
    found_groups = components(edges.unionByName(members))
    rows = held.select("kind", "record", F.concat(F.lit("r"), F.col("kind"), F.lit("|"), F.col("record")).alias("node")).distinct()
    grouped = rows.join(found_groups, "node").select("kind", "record", F.col("component").alias("group"))
    several = grouped.groupBy("group").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("group")
    return grouped.join(several, "group", "left_semi")


def group_pairs(groups: DataFrame) -> DataFrame:
    """(kind, key_a, key_b), key_a < key_b: every pair of a group, made only where each is asked for."""
    other = groups.select(F.col("group"), F.col("record").alias("key_b"))
    return groups.select("kind", "group", F.col("record").alias("key_a")).join(other, "group").where(F.col("key_a") < F.col("key_b")).select("kind", "key_a", "key_b")
