"""Nested records to flat tables.

A pull parser reads each JSON text once, keeping only its stack, and emits
path-value-ordinal triples. The paths that repeat are found in the data; triples are grouped
by their nearest repeated ancestor, and each group is pivoted into one table that keeps its
parent's key and position.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cairnflow.session import cut

_TOKEN = re.compile(r'[ \t\n\r]*(?:([{}\[\],:])|"((?:[^"\\\x00-\x1f]|\\(?:["\\/bfnrt]|u[0-9a-fA-F]{4}))*)"|(-?(?:0|[1-9][0-9]*)(?:\.[0-9]+)?(?:[eE][+-]?[0-9]+)?)|(true|false|null))')
_END = re.compile(r"[ \t\n\r]*\Z")
_ESCAPE = re.compile(r"\\(u[0-9a-fA-F]{4}|.)")
_PLAIN = {"b": "\b", "f": "\f", "n": "\n", "r": "\r", "t": "\t"}
PUNCTUATION, STRING, NUMBER, LITERAL = 1, 2, 3, 4

Triple = tuple[tuple[str, ...], tuple[int, ...], str, "str | None"]


def _text(s: str) -> str:
    if "\\" not in s:
        return s
    out = _ESCAPE.sub(lambda m: chr(int(m[1][1:], 16)) if m[1][0] == "u" else _PLAIN.get(m[1], m[1]), s)
    return out.encode("utf-16", "surrogatepass").decode("utf-16", "replace")


def triples(text: str | None) -> list[Triple] | None:
    """(path, ordinals, kind, value) of every node of a JSON text; None if it can't be read to its end.

    path has the object keys from the root; ordinals has, for the root and for every key,
    the position from 1 within an array, or 0 where the node is no element. An array in an
    array adds the key ''. kind is object, array, string, number, boolean or null;
    containers come after what they hold, with the number of their members as value. A text
    that is a single string is read as the JSON text within (records encoded twice).
    """
    if not text:
        return None
    out: list[Triple] = []
    stack: list[list] = []  # is object, path, ordinals, members
    path: tuple[str, ...] = ()
    ordinals: tuple[int, ...] = (0,)
    want, pos, match = "value", 0, _TOKEN.match
    while want != "end":
        m = match(text, pos)
        if not m:
            return None
        pos, kind = m.end(), m.lastindex
        mark = m[1] if kind == PUNCTUATION else None
        closing = mark in ("}", "]")
        if closing:
            if not stack or stack[-1][0] != (mark == "}") or want not in ("more", "first key", "first element"):
                return None
            is_object, path, ordinals, members = stack.pop()
            out.append((path, ordinals, "object" if is_object else "array", str(members)))
        elif want in ("first key", "key"):
            if kind != STRING:
                return None
            top = stack[-1]
            top[3] += 1
            path, ordinals, want = (*top[1], _text(m[2])), (*top[2], 0), "colon"
            continue
        elif want == "colon":
            if mark != ":":
                return None
            want = "value"
            continue
        elif want == "more":
            if mark != ",":
                return None
            want = "key" if stack[-1][0] else "element"
            continue
        else:  # a value
            if want in ("element", "first element"):
                top = stack[-1]
                top[3] += 1
                path, ordinals = ((*top[1], ""), (*top[2], top[3])) if top[2][-1] else (top[1], (*top[2][:-1], top[3]))
            if mark in ("{", "["):
                stack.append([mark == "{", path, ordinals, 0])
                want = "first key" if mark == "{" else "first element"
                continue
            if kind == PUNCTUATION:
                return None
            if kind == STRING:
                out.append((path, ordinals, "string", _text(m[2])))
            elif kind == NUMBER:
                out.append((path, ordinals, "number", m[3]))
            else:
                out.append((path, ordinals, "null" if m[4] == "null" else "boolean", None if m[4] == "null" else m[4]))
        want = "more" if stack else "end"
    if not _END.match(text, pos):
        return None
    return triples(out[0][3]) if len(out) == 1 and out[0][2] == "string" else out


#: Parts a path's keys from one another.
STEP = "\x1f"
#: Distinct paths that may repeat; a schema has few, and more would mean that keys are data.
MOST_PATHS = 10_000

Cell = tuple[str, list[int], str, "str | None"]


def cells(nodes: Sequence[Triple], optional: frozenset[str]) -> list[Cell]:
    """(path, ordinals, kind, value) of the nodes of a record, a path without the keys in ``optional``.

    Such a key merely wraps: it adds no step, and its ordinal counts for the key before it; an object
    that holds a wrapper is no node. Arrays are no nodes either, only their elements are.
    """
    wrappers = set()
    for path, ordinals, _, _ in nodes:
        for i, k in enumerate(path):
            if k in optional:
                wrappers.add((path[:i], ordinals[: i + 1]))
    out: list[Cell] = []
    for path, ordinals, kind, value in nodes:
        if kind == "array" or (path, ordinals) in wrappers or (path and path[-1] not in optional and kind != "object" and (path[:-1], ordinals[:-1]) in wrappers):
            continue
        keys: list[str] = []
        at: list[int] = []
        for k, o in zip(path, ordinals[1:]):
            if k not in optional:
                keys.append(k)
                at.append(o)
            elif at:
                at[-1] = max(at[-1], o)
        if keys:
            out.append((STEP.join(keys), at, kind, value))
    return out


_CELLS = "array<struct<path: string, at: array<int>, kind: string, value: string>>"
_SHAPE = "array<struct<path: string, repeats: boolean>>"


def parse_records(df: DataFrame, payload: str, keep: Sequence[str], optional: Sequence[str] = ()) -> DataFrame:
    """``keep`` columns, ``cells`` and ``shape`` of every readable record; unreadable, empty and NULL ones give no row.

    Records without any cell keep an empty array: they are readable. The shapes of all records together name every path that any has, and
    whether it is an array's element in any; one record of some hundred carries what these have.
    """
    optional = frozenset(optional)
    kinds = dict(df.dtypes)
    schema = ", ".join(f"`{c}` {kinds[c]}" for c in keep) + f", cells {_CELLS}, shape {_SHAPE}"

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 500):  # bounds what is held at once
                part = batch.slice(start, 500)
                found = [triples(x) for x in part.column(len(keep)).to_pylist()]
                good = pa.array([x is not None for x in found])
                rows = [cells(x, optional) for x in found if x is not None]
                if not rows:
                    continue
                flat = [c for row in rows for c in row]
                steps = [i for c in flat for i in c[1]]
                ends = lambda sizes: pa.array(np.concatenate([[0], np.cumsum(np.fromiter(sizes, dtype=np.int64))]).astype(np.int32))
                at = pa.ListArray.from_arrays(ends(len(c[1]) for c in flat), pa.array(steps, pa.int32()))
                fields = [pa.array([c[0] for c in flat], pa.string()), at, pa.array([c[2] for c in flat], pa.string()), pa.array([c[3] for c in flat], pa.string())]
                told = pa.ListArray.from_arrays(ends(map(len, rows)), pa.StructArray.from_arrays(fields, ["path", "at", "kind", "value"]))
                shape = sorted(shape_of(flat).items())
                pairs = pa.StructArray.from_arrays([pa.array([x for x, _ in shape], pa.string()), pa.array([y for _, y in shape], pa.bool_())], ["path", "repeats"])
                shapes = pa.ListArray.from_arrays(ends([len(shape), *([0] * (len(rows) - 1))]), pairs)
                yield pa.RecordBatch.from_arrays([*(part.column(i).filter(good) for i in range(len(keep))), told, shapes], names=[*keep, "cells", "shape"])

    return df.select(*keep, payload).mapInArrow(parse, schema)


def shape_of(flat: Sequence[Cell]) -> dict[str, bool]:
    """Every path of some cells, and of what is above them, with whether it is an array's element in any."""
    out: dict[str, bool] = {}
    seen: set[tuple[str, tuple[bool, ...]]] = set()
    for path, at, _, _ in flat:
        which = (path, tuple(map(bool, at)))
        if which not in seen:
            seen.add(which)
            keys = path.split(STEP)
            for i in range(1, len(keys) + 1):
                above = STEP.join(keys[:i])
                out[above] = out.get(above, False) or which[1][i - 1]
    return out


def plausible(payload: Column) -> Column:
    """Whether a text ends as it begins: what parse_records can read always does, what was cut off mostly doesn't."""
    bare = F.btrim(payload, F.lit(" \t\n\r"))
    first, last = F.left(bare, F.lit(1)), F.right(bare, F.lit(1))
    return F.when(first == "{", last == "}").when(first == "[", last == "]").when(first == '"', last == '"').otherwise(bare != "")


def latest_readable(df: DataFrame, payload: str, key: str, order: Sequence[str], optional: Sequence[str] = ()) -> DataFrame:
    """(key, cells, shape) of the readable record that is greatest by ``order`` per key; NULL keys have no record.

    Only the latest plausible record of a key is parsed; where it can't be read, the one before it is tried. Ties go to the
    greater content hash. The latest are found by an aggregation without the payloads, and a key of any number of records is nowhere gathered.
    """
    rows = df.where(F.col(key).isNotNull()).withColumn("__h", F.xxhash64(payload))
    order = [*order, "__h"]
    place = F.struct(*order)
    rows, texts_of = cut(rows.where(plausible(F.col(payload))).select(key, *order)), rows
    todo, out = rows.groupBy(key).agg(F.max(place).alias("__p")), None
    while True:
        chosen = todo.select(F.col(key).alias("__k"), *(F.col(f"__p.{c}").alias(f"__{c}") for c in order))
        same = F.col(key) == F.col("__k")
        for c in order:
            same = same & F.col(c).eqNullSafe(F.col(f"__{c}"))
        texts = texts_of.join(chosen, same, "left_semi").select(key, payload).dropDuplicates([key])  # repeats of one content
        read = cut(parse_records(texts, payload, [key], optional))
        out = read if out is None else out.unionByName(read)
        failed = todo.join(read.select(key), key, "left_anti").withColumnRenamed("__p", "__last")
        todo = cut(rows.join(failed, key).where(place < F.col("__last")).groupBy(key).agg(F.max(place).alias("__p")))
        if todo.isEmpty():
            return out


def paths_of(records: DataFrame, names: Mapping[str, Sequence[str]] | None = None, most: int = MOST_PATHS) -> DataFrame:
    """(path, child_table, field, steps): where the nodes of every path belong: to the nearest path at or above that repeats in any record.

    ``names`` as in child_rows(). steps are the places of the repeated keys in the path. Paths below none have no row. Raises beyond ``most`` paths.
    """
    named = {STEP.join(keys): name for name, keys in (names or {}).items()}
    found = records.select(F.explode("shape").alias("s")).groupBy("s.path").agg(F.max("s.repeats").alias("repeats")).limit(most + 1).collect()
    if len(found) > most:
        raise ValueError(f"more than {most} paths: keys seem to be data")
    repeated = {r["path"] for r in found if r["repeats"]} | set(named)
    rows = []
    for path in sorted(r["path"] for r in found):
        keys = path.split(STEP)
        steps = [i for i in range(1, len(keys) + 1) if STEP.join(keys[:i]) in repeated]
        if steps:
            owner = STEP.join(keys[: steps[-1]])
            rows.append((path, named.get(owner, owner.replace(STEP, ".")), ".".join(keys[steps[-1] :]), steps))
    return records.sparkSession.createDataFrame(rows, "path string, child_table string, field string, steps array<int>")


def _placed(records: DataFrame, key: str, names: Mapping[str, Sequence[str]] | None) -> DataFrame:
    """(key, child_table, idx, field, kind, value) of every cell at or below a repeated path."""
    cell = records.select(key, F.explode("cells").alias("c")).select(key, "c.*")
    placed = cell.join(F.broadcast(paths_of(records, names)), "path")  # at most MOST_PATHS rows
    return placed.select(key, "child_table", F.transform("steps", lambda i: F.greatest(F.get("at", i - 1), F.lit(1))).alias("idx"), "field", "kind", "value")


def _holds() -> Column:
    return (F.col("field") == "") & F.when(F.col("kind") == "object", F.col("value").try_cast("int") > 0).otherwise(F.col("kind") != "null")


def child_keys(records: DataFrame, key: str, names: Mapping[str, Sequence[str]] | None = None) -> DataFrame:
    """(key, child_table, idx) of the rows of child_rows(), without their fields."""
    return _placed(records, key, names).where(_holds()).select(key, "child_table", "idx").distinct()


def child_rows(records: DataFrame, key: str, names: Mapping[str, Sequence[str]] | None = None) -> DataFrame:
    """(key, child_table, idx, fields) of the elements of every repeated path, only of rows that hold something.

    ``names`` maps a table's name to the keys of its path; named paths count as repeated even where no record repeats them, other
    repeated paths are named by their keys. idx has the position from 1 of each repeated ancestor, outermost first; one that is
    no array's element is its single element. A row is a non-empty object or a non-NULL scalar in an element's place; its fields
    are the nodes below it that no deeper repeated path has.
    """
    return _placed(records, key, names).groupBy(key, "child_table", "idx").agg(
        F.max(_holds()).alias("__holds"),
        F.collect_list(F.when((F.col("field") != "") & (F.col("kind") != "object"), F.struct("field", "value"))).alias("fields"),
    ).where("__holds").drop("__holds")


def child_table(rows: DataFrame, key: str, name: str, columns: Mapping[str, tuple[str, str]]) -> DataFrame:
    """One flat table of ``name``: key, idx, and ``columns`` (result name to dotted path and type).

    A path that ends in an object with only ``value`` may be given without it. A field given
    twice in a row takes its first value; text that doesn't fit the type gives NULL.
    """

    def picked(path: str) -> Column:
        return F.filter("fields", lambda x: x["field"].isin(path, f"{path}.value") & x["value"].isNotNull())

    return rows.where(F.col("child_table") == name).select(
        key, "idx",
        *(F.try_element_at(picked(path), F.lit(1))["value"].try_cast(kind).alias(c) for c, (path, kind) in columns.items()),
    )
