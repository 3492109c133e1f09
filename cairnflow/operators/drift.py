"""Schemas that drift between the files of a feed.

Every file's schema is a tree. Consecutive trees are compared by tree edit distance with
a minimum-cost matching at each level; the cost of a rename comes from the content that
goes on under the other name. The scripts of adds, deletes, renames and moves are
compiled into one projection per file, under which all files read as one table.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from difflib import SequenceMatcher
from itertools import groupby

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cairnflow.session import cut

#: Cost of adding or deleting a node; a rename above twice this is never cheaper than both.
EDIT = 1.0
#: Share of the smaller value set that must go on under the new name for a rename.
SAME_CONTENT = 0.2
#: Distinct values per value from which one shared value is enough.
NEARLY_UNIQUE = 0.8

Tree = dict  # field name -> {"kind": str, "children": Tree}


def kind_of(schema: Column) -> Column:
    """JSON kind of a variant's schema text: string, number, boolean, object, array, or NULL for a null."""
    return (
        F.when(schema == "VOID", None)
        .when(schema.startswith("OBJECT"), "object")
        .when(schema.startswith("ARRAY"), "array")
        .when(schema == "BOOLEAN", "boolean")
        .when(schema.isin("STRING", "BINARY"), "string")
        .otherwise("number")
    )


def canonical_text(value: Column) -> Column:
    """One text for a value however it is written: wrapped in an object or array, as a number or text, as any kind of date."""
    bare = F.trim(F.regexp_replace(F.coalesce(F.try_variant_get(value, "$.value", "string"), F.try_variant_get(value, "$[0]", "string"), F.expr("cast(null as string)")), r"\s+", " "))
    text = F.coalesce(bare, F.trim(value.try_cast("string")))
    number = F.when(text.rlike(r"^[+-]?\d{1,17}(\.\d{1,8})?$"), text.try_cast("decimal(28,8)"))
    bit = F.when(number == 1, "1").when(number == 0, "0")  # a truth value may be written as a number
    iso = F.when(text.rlike(r"^\d{4}-\d\d-\d\d"), F.try_to_timestamp(text))
    us = F.when(text.rlike(r"^\d{1,2}/\d{1,2}/\d{4}$"), F.try_to_timestamp(text, F.lit("M/d/yyyy")))
    packed = F.when(text.rlike(r"^(19|20)\d{6}$"), F.try_to_timestamp(text, F.lit("yyyyMMdd")))
    day = F.coalesce(iso, us, packed)
    truth = F.when(F.lower(text).isin("true", "y", "yes", "t"), "1").when(F.lower(text).isin("false", "n", "no", "f"), "0")
    return F.coalesce(truth, bit, F.unix_seconds(day).cast("decimal(28,8)").cast("string"), number.cast("string"), F.lower(text))


def field_values(records: DataFrame, payload: str, keep: Sequence[str]) -> DataFrame:
    """(keep..., field, kind, tree, value): one row per key of each record's JSON object, names in lower case.

    Texts that are no JSON object give no row; NULL kinds mark nulls. tree is the schema text of an object or array.
    """
    parsed = records.select(*keep, F.try_parse_json(payload).alias("__v")).where(F.expr("schema_of_variant(__v) LIKE 'OBJECT%'"))
    exploded = parsed.lateralJoin(parsed.sparkSession.tvf.variant_explode(F.col("__v").outer()))
    kind = kind_of(F.schema_of_variant(F.col("value")))
    return exploded.select(*keep, F.lower("key").alias("field"), kind.alias("kind"), F.when(kind.isin("object", "array"), F.schema_of_variant(F.col("value"))).alias("tree"), canonical_text(F.col("value")).alias("value"))


def assignment(cost: Sequence[Sequence[float]]) -> list[int]:
    """Minimum-cost matching of a square matrix (shortest augmenting paths): the column of each row."""
    n = len(cost)
    u, v, match = [0.0] * (n + 1), [0.0] * (n + 1), [0] * (n + 1)
    for i in range(1, n + 1):
        match[0], j0 = i, 0
        least, used, way = [float("inf")] * (n + 1), [False] * (n + 1), [0] * (n + 1)
        while True:
            used[j0] = True
            i0, delta, j1 = match[j0], float("inf"), 0
            for j in range(1, n + 1):
                if not used[j]:
                    c = cost[i0 - 1][j - 1] - u[i0] - v[j]
                    if c < least[j]:
                        least[j], way[j] = c, j0
                    if least[j] < delta:
                        delta, j1 = least[j], j
            for j in range(n + 1):
                if used[j]:
                    u[match[j]] += delta
                    v[j] -= delta
                else:
                    least[j] -= delta
            j0 = j1
            if not match[j0]:
                break
        while j0:
            match[j0] = match[way[j0]]
            j0 = way[j0]
    out = [0] * n
    for j in range(1, n + 1):
        out[match[j] - 1] = j - 1
    return out


def tree_size(tree: Tree) -> int:
    return sum(1 + tree_size(x.get("children") or {}) for x in tree.values())


def parse_schema(text: str) -> Tree:
    """The tree of a variant's schema text: the members of an object, and of an array's elements those under '[]'."""

    def read(i: int) -> tuple[dict, int]:
        if text.startswith("OBJECT<", i):
            out, i = {"kind": "object", "children": {}}, i + 7
            while text[i] != ">":
                if text[i] == "`":
                    j = i + 1
                    while text[j] != "`" or text[j + 1 : j + 2] == "`":
                        j += 2 if text[j] == "`" else 1
                    name, i = text[i + 1 : j].replace("``", "`"), j + 1
                else:
                    j = text.index(":", i)
                    name, i = text[i:j], j
                out["children"][name.lower()], i = read(i + 2)
                i += 2 if text.startswith(", ", i) else 0
            return out, i + 1
        if text.startswith("ARRAY<", i):
            inner, i = read(i + 6)
            return {"kind": "array", "children": {"[]": inner} if inner["children"] else {}}, i + 1
        j = i
        depth = 0
        while j < len(text) and (depth or text[j] not in ",>"):
            depth += (text[j] == "(") - (text[j] == ")")
            j += 1
        word = text[i:j]
        kind = None if word == "VOID" else "boolean" if word == "BOOLEAN" else "string" if word in ("STRING", "BINARY") else "object" if word == "OBJECT" else "number"
        return {"kind": kind, "children": {}}, j

    return read(0)[0]["children"]


def merged(a: Tree, b: Tree) -> Tree:
    """The members of both trees; the first known kind stands."""
    out = dict(a)
    for k, x in b.items():
        y = out.get(k)
        out[k] = x if y is None else {"kind": y.get("kind") or x.get("kind"), "children": merged(y.get("children") or {}, x.get("children") or {})}
    return out


def edit_script(old: Tree, new: Tree, unlike: Callable[[str, str], float], at: str = "") -> tuple[float, list[tuple[str, str, str]]]:
    """(cost, script) of the cheapest constrained edit of two unordered trees.

    script has (action, path, new path) with action delete, add, rename, retype or move.
    ``unlike(old path, new path)`` in [0, 1] says how far the content differs; equal names cost
    nothing but their kinds' difference. A node deleted in one place and added with the same
    content at another level is a move.
    """
    cost, script = _edit(old, new, unlike, at, at)
    moved, script = paired_moves(script, lambda d, a: unlike(d, a) < 1 - SAME_CONTENT)
    return cost - EDIT * len(moved), script + moved


def paired_moves(script: list[tuple[str, str, str]], same: Callable[[str, str], bool]) -> tuple[list[tuple[str, str, str]], list[tuple[str, str, str]]]:
    """(moves, rest of the script): a node deleted under one parent and added with the ``same`` content under another was moved."""
    came = [s[1] for s in script if s[0] == "add"]
    moves, rest, taken = [], [], set()
    for s in script:
        to = next((a for a in came if a not in taken and s[1].rpartition(".")[0] != a.rpartition(".")[0] and same(s[1], a)), None) if s[0] == "delete" else None
        if to is None:
            rest.append(s)
        else:
            taken.add(to)
            moves.append(("move", s[1], to))
    return moves, [s for s in rest if not (s[0] == "add" and s[1] in taken)]


def _edit(old: Tree, new: Tree, unlike: Callable[[str, str], float], at_old: str, at_new: str) -> tuple[float, list[tuple[str, str, str]]]:
    a, b = sorted(old), sorted(new)
    if not a and not b:
        return 0.0, []
    join = lambda p, k: f"{p}.{k}" if p else k
    n = len(a) + len(b)
    inner: dict[tuple[int, int], tuple[float, list]] = {}
    cost = [[0.0] * n for _ in range(n)]
    for i in range(n):
        for j in range(n):
            if i < len(a) and j < len(b):
                x, y = old[a[i]], new[b[j]]
                below = _edit(x.get("children") or {}, y.get("children") or {}, unlike, join(at_old, a[i]), join(at_new, b[j]))
                inner[i, j] = below
                kinds = 0.25 * EDIT if x.get("kind") and y.get("kind") and x["kind"] != y["kind"] else 0.0
                far = 0.0 if a[i] == b[j] else unlike(join(at_old, a[i]), join(at_new, b[j]))
                far = 4 * EDIT if far > 1 - SAME_CONTENT else far * EDIT
                cost[i][j] = far + min(kinds, 0.25) + min(below[0], EDIT)
            elif i < len(a):
                cost[i][j] = EDIT * (1 + tree_size(old[a[i]].get("children") or {})) if j - len(b) == i else 1e6
            elif j < len(b):
                cost[i][j] = EDIT * (1 + tree_size(new[b[j]].get("children") or {})) if i - len(a) == j else 1e6
    total, script = 0.0, []
    for i, j in enumerate(assignment(cost)):
        total += cost[i][j]
        if i < len(a) and j < len(b):
            x, y = old[a[i]], new[b[j]]
            if a[i] != b[j]:
                script.append(("rename", join(at_old, a[i]), join(at_new, b[j])))
            if x.get("kind") and y.get("kind") and x["kind"] != y["kind"]:
                script.append(("retype", join(at_new, b[j]), y["kind"]))
            elif x.get("kind") == "object":
                script += inner[i, j][1]
        elif i < len(a):
            script.append(("delete", join(at_old, a[i]), ""))
        elif j < len(b):
            script.append(("add", join(at_new, b[j]), ""))
    return total, script


def file_schemas(values: DataFrame, feed: str, seq: str, file: str) -> DataFrame:
    """(feed, seq, file, field, kind): the fields of every file.

    The kind is the one most values have (ties: the greatest name); NULL if all are null.
    """
    each = values.groupBy(feed, seq, file, "field", "kind").agg(F.count(F.lit(1)).alias("n"))
    return each.groupBy(feed, seq, file, "field").agg(F.max(F.when(F.col("kind").isNotNull(), F.struct("n", "kind"))).alias("k")).select(feed, seq, file, "field", F.col("k.kind").alias("kind"))


def feed_scripts(values: DataFrame, files: DataFrame, feed: str = "feed_id", seq: str = "file_seq", file: str = "file_id") -> DataFrame:
    """(feed, seq, file, action, path, other, level): the edit script of every file's schema against that of the file before it, and where each field is.

    ``values`` comes from field_values() and holds feed, seq and file; ``files`` has one row per
    (feed, seq, file). action is added, removed, renamed (other is the new name), retyped (the kind differs from the last one known,
    through renames), moved (other is the new path), or source (path is where the line of fields named ``other`` lies in the file). level is the
    depth of the path, 1 for fields of the record. Trees of nested members are compared where both files know them.
    A rename is the match of a field that ended with one that began, chosen by the edit distance from the values
    that go on: values are compared as sets per pair of files, exactly and without caps. Equal names match at no cost in any cheapest script.
    A feed's first file has no changes; files without fields lose all of them; repeated records change nothing.
    Schemas of one feed go through one task in order, a file at a time; records never do.
    """
    order = Window.partitionBy(feed).orderBy(seq, file)
    places = cut(files.select(feed, seq, file).distinct().withColumn("pos", F.row_number().over(order)))
    schemas = cut(file_schemas(values, feed, seq, file).join(places, [feed, seq, file]).select(feed, "pos", "field", "kind"))
    by_field = Window.partitionBy(feed, "field").orderBy("pos")
    last = places.groupBy(feed).agg(F.max("pos").alias("last"))
    spans = schemas.withColumn("before", F.lag("pos").over(by_field)).withColumn("after", F.lead("pos").over(by_field)).join(last, feed)
    came = (F.col("pos") > 1) & ~F.col("before").eqNullSafe(F.col("pos") - 1)
    gone = (F.col("pos") < F.col("last")) & ~F.col("after").eqNullSafe(F.col("pos") + 1)
    sides = F.array_compact(F.array(F.when(came, F.struct(F.lit("came").alias("side"), F.col("pos").alias("pos"))), F.when(gone, F.struct(F.lit("gone").alias("side"), (F.col("pos") + 1).alias("pos")))))
    edges = spans.select(feed, F.col("pos").alias("at"), "field", F.explode(sides).alias("x")).select(feed, "at", "field", "x.side", "x.pos")

    # The distinct values of the fields that end or begin, and how many a pair shares.
    told = values.where(F.col("value").isNotNull() & (F.col("value") != "")).join(places, [feed, seq, file]).select(feed, F.col("pos").alias("at"), "field", F.xxhash64("value").alias("h"))
    texts = cut(told.join(edges, [feed, "at", "field"]).groupBy(feed, "pos", "side", "field", "h").agg(F.count(F.lit(1)).alias("times")))
    ended = texts.where(F.col("side") == "gone").select(feed, "pos", F.col("field").alias("old"), "h")
    began = texts.where(F.col("side") == "came").select(feed, "pos", F.col("field").alias("new"), "h")
    none, text = F.lit(0).cast("long"), F.lit(None).cast("string")
    rows = [
        places.select(feed, "pos", F.lit("file").alias("what"), text.alias("a"), text.alias("b"), none.alias("n"), none.alias("m")),
        schemas.select(feed, "pos", F.lit("field").alias("what"), F.col("field").alias("a"), F.col("kind").alias("b"), none.alias("n"), none.alias("m")),
        values.where(F.col("tree").contains("OBJECT<")).select(feed, seq, file, "field", "tree").distinct().join(places, [feed, seq, file]).select(feed, "pos", F.lit("shape").alias("what"), F.col("field").alias("a"), F.col("tree").alias("b"), none.alias("n"), none.alias("m")),
        texts.groupBy(feed, "pos", "side", "field").agg(F.count(F.lit(1)).alias("n"), F.sum("times").alias("m")).select(feed, "pos", F.lit("size").alias("what"), F.col("field").alias("a"), F.col("side").alias("b"), "n", "m"),
        ended.join(began, [feed, "pos", "h"]).groupBy(feed, "pos", "old", "new").agg(F.count(F.lit(1)).alias("n")).select(feed, "pos", F.lit("pair").alias("what"), F.col("old").alias("a"), F.col("new").alias("b"), "n", none.alias("m")),
    ]
    steps = rows[0]
    for more in rows[1:]:
        steps = steps.unionByName(more)
    kind = dict(files.dtypes)[feed]

    def scripts(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        columns = ["feed", "pos", "action", "path", "other", "level"]
        out: list[tuple] = []
        now, state = object(), FeedState()
        told = (r for frame in frames for r in frame.itertuples(index=False, name=None))
        for (name, pos), group in groupby(told, key=lambda r: (r[0], r[1])):
            if name != now:
                now, state = name, FeedState()
            out += [(name, pos, *s) for s in state.advance([r[2:] for r in group])]
            if len(out) > 5_000:
                yield pd.DataFrame(out, columns=columns)
                out = []
        yield pd.DataFrame(out, columns=columns)

    sorted_steps = steps.withColumnRenamed(feed, "feed").repartition("feed").sortWithinPartitions("feed", "pos", "what", "a", "b")
    made = sorted_steps.mapInPandas(scripts, f"feed {kind}, pos int, action string, path string, other string, level int")
    return made.withColumnRenamed("feed", feed).join(places, [feed, "pos"]).select(feed, seq, file, "action", "path", "other", "level")


class FeedState:
    """What is known of a feed's schema after each file: its tree, the last known kind of every field, and the line that each field goes on."""

    def __init__(self) -> None:
        self.fields: dict[str, str | None] | None = None
        self.kinds: dict[str, str] = {}
        self.trees: dict[str, Tree] = {}
        self.lines: dict[str, str] = {}

    def advance(self, rows: Sequence[tuple]) -> list[tuple[str, str, str, int]]:
        """(action, path, other, level) of the next file; rows are (what, a, b, n, m) as feed_scripts() makes them."""
        fields: dict[str, str | None] = {}
        shapes: dict[str, Tree] = {}
        sizes, pairs = {}, {}
        for what, a, b, n, m in rows:
            if what == "field":
                fields[a] = b if isinstance(b, str) else None
            elif what == "shape":
                shapes[a] = merged(shapes.get(a, {}), parse_schema(b))
            elif what == "size":
                sizes[b, a] = (n, m)
            elif what == "pair":
                pairs[a, b] = n
        out: list[tuple[str, str, str, int]] = []
        if self.fields is not None:
            gone, came = [f for f in self.fields if f not in fields], [f for f in fields if f not in self.fields]
            script = pair_script(gone, came, sizes, pairs)
            renamed = {a: b for action, a, b in script if action == "rename"}
            for a, b in renamed.items():
                for held in (self.kinds, self.trees, self.lines):
                    if a in held:
                        held[b] = held.pop(a)
                out.append(("renamed", a, b, 1))
            below = [x for f, tree in shapes.items() if f in self.trees for x in edit_script(self.trees[f], tree, named_alike, f)[1]]
            alike = lambda d, a: d.rpartition(".")[2] == a.rpartition(".")[2]
            # A field of the record that went into an object, or came out of one, is a move besides.
            flat = [(action, a, b) for action, a, b in script if action != "rename"]
            moves, _ = paired_moves(flat + [x for x in below if x[0] in ("delete", "add")], alike)
            crossing = [x for x in moves if ("." in x[1]) != ("." in x[2])]
            inner = {x[1:] for x in crossing}
            names = {"delete": "removed", "add": "added", "rename": "renamed", "retype": "retyped", "move": "moved"}
            out += [(names[action], a, "", 1) for action, a, _ in flat]
            out += [("moved", a, b, b.count(".") + 1 if "." in b else a.count(".") + 1) for _, a, b in crossing]
            taken = {p for pair in inner for p in pair if "." in p}
            out += [(names[action], a, b if action in ("rename", "move") else "", a.count(".") + 1) for action, a, b in below if a not in taken]
            for _, a, b in crossing:
                if a in self.lines:
                    self.lines[b] = self.lines.pop(a)
        for f, kind in fields.items():
            was = self.kinds.get(f)
            if kind and was and kind != was:
                out.append(("retyped", f, "", 1))
            if kind:
                self.kinds[f] = kind
            self.lines.setdefault(f, f)
        self.trees |= shapes
        self.fields = fields
        out += [("source", p, line, p.count(".") + 1) for p, line in self.lines.items() if p in fields or "." in p and p.partition(".")[0] in fields]
        return out


def named_alike(a: str, b: str) -> float:
    """How far two nested members differ: by their last names, for their values aren't gathered."""
    x, y = a.rpartition(".")[2], b.rpartition(".")[2]
    if x == y:
        return 0.0
    return 0.5 if SequenceMatcher(None, x, y).ratio() >= 0.6 else 1.0


def pair_script(gone: Sequence[str], came: Sequence[str], sizes: Mapping[tuple[str, str], tuple[int, int]], pairs: Mapping[tuple[str, str], int]) -> list[tuple[str, str, str]]:
    """The edit script of the fields that ended and those that began between two files."""
    leaf = lambda names: {f: {"kind": None, "children": {}} for f in names}
    telling = lambda side, f: sizes[side, f][0] >= NEARLY_UNIQUE * max(sizes[side, f][1], 1)

    def unlike(a: str, b: str) -> float:
        least = min(sizes.get(("gone", a), (0, 0))[0], sizes.get(("came", b), (0, 0))[0])
        share = pairs.get((a, b), 0) / least if least else 0.0
        if share and telling("gone", a) and telling("came", b):
            share = max(share, 0.5)  # values that hardly repeat don't agree by chance
        return 1.0 - share

    return _edit(leaf(gone), leaf(came), unlike, "", "")[1]


def schema_changes(scripts: DataFrame, feed: str = "feed_id", seq: str = "file_seq", file: str = "file_id") -> DataFrame:
    """(feed, seq, file, field_name, change_kind, new_name, level): every change of a file's schema; new_name is '' but for renames and moves."""
    return scripts.where(F.col("action") != "source").select(feed, seq, file, F.col("path").alias("field_name"), F.col("action").alias("change_kind"), F.col("other").alias("new_name"), "level")


def projections(scripts: DataFrame, columns: Sequence[str], feed: str = "feed_id", seq: str = "file_seq", file: str = "file_id") -> DataFrame:
    """(feed, file, sources): for every file a map from a target column to the path at which the file has it.

    A field belongs to the target column whose name it bears in any file of its feed, followed
    through renames and moves in both directions. Fields of no target column have no entry.
    """
    lined = scripts.where(F.col("action") == "source").select(feed, seq, file, F.col("path").alias("field"), F.col("other").alias("line"))
    target = lined.where(F.col("field").isin(*columns)).groupBy(feed, "line").agg(F.min(F.struct(seq, "field")).alias("t")).select(feed, "line", F.col("t.field").alias("column"))
    placed = lined.join(target, [feed, "line"]).groupBy(feed, file, "column").agg(F.min("field").alias("field"))
    return placed.groupBy(feed, file).agg(F.map_from_entries(F.collect_list(F.struct("column", "field"))).alias("sources"))


def read_as_one(records: DataFrame, payload: str, plan: DataFrame, columns: Mapping[str, str], keep: Sequence[str], feed: str = "feed_id", file: str = "file_id") -> DataFrame:
    """Every record under the names and types of ``columns`` (name to type), with ``keep`` in front.

    ``plan`` comes from projections(). A value that doesn't fit its type gives NULL, as do
    fields that the file lacks; wrapped values are unwrapped, dates read in any of the known ways.
    """
    names = F.expr(f"map_from_entries(array_distinct(transform(coalesce(json_object_keys({payload}), array()), k -> struct(lower(k) as n, k as k))))")
    planned = records.join(plan, [feed, file], "left").select(*keep, "sources", F.try_parse_json(payload).alias("__v"), names.alias("names"))
    out = []
    for name, kind in columns.items():
        source = F.split(F.try_element_at("sources", F.lit(name)), r"\.")
        key = F.coalesce(F.try_element_at("names", F.try_element_at("sources", F.lit(name))), F.try_element_at("names", F.get(source, F.lit(0))))
        below = F.when(F.try_element_at("names", F.try_element_at("sources", F.lit(name))).isNull(), F.array_join(F.transform(F.slice(source, 2, F.size(source)), lambda x: F.concat(F.lit("['"), x, F.lit("']"))), "")).otherwise("")
        path = F.concat(F.lit("$['"), key, F.lit("']"), below)
        direct = F.when(key.isNotNull(), F.try_variant_get("__v", path, "variant"))
        text = F.coalesce(F.try_variant_get(direct, "$.value", "string"), F.try_variant_get(direct, "$[0]", "string"), direct.try_cast("string"))
        if kind in ("timestamp", "date"):
            epoch = F.when(text.rlike(r"^\d{9,11}$"), F.timestamp_seconds(text.try_cast("long")))
            value = F.coalesce(epoch, F.when(text.rlike(r"^\d{8}$"), F.try_to_timestamp(text, F.lit("yyyyMMdd"))), F.when(text.rlike(r"^\d{1,2}/\d"), F.try_to_timestamp(text, F.lit("M/d/yyyy"))), F.try_to_timestamp(text)).cast(kind)
        elif kind == "boolean":
            value = F.when(F.lower(text).isin("true", "1", "y", "yes", "t"), True).when(F.lower(text).isin("false", "0", "n", "no", "f"), False)
        else:
            value = text.try_cast(kind)
        out.append(value.alias(name))
    return planned.select(*keep, *out)
