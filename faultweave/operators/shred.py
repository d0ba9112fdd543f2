"""Deeply nested records into related flat tables, by shared inlining.

1. Analyse: one pass over all texts gives the schema graph: which field names hold objects, which of them repeat, which
   have several kinds of parent or reach themselves.
2. Lay out: a field that repeats, is shared by several parents' tables or recurs gets a table of its own; every other
   object is inlined into the table of its nearest ancestor that has one, as columns named by their path. An object with very
   many child names is a map: its entries stay one text, but the tables' fields below it, at any depth, go to their tables.
3. Shred: a second pass fills the tables. Every row carries the record's key, its position and the position of its parent row.

JSON of unknown shape has no Catalyst expression for "at any depth", so both passes are Arrow batches through Python;
the rows stay where they are read, nothing is shuffled.
"""

from __future__ import annotations

import json
import re
from collections import defaultdict
from collections.abc import Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from faultweave.sources.tables import Scratch, ship

ROOT = "event"
#: An object field with more distinct child names than this is a map: its children are data, not schema, and stay JSON text,
#: except what belongs to tables. So is the event itself.
MAP_WIDTH = 256


class NotJson(ValueError):
    """The text is not JSON."""


def _no_constant(name: str) -> None:
    raise NotJson(name)


_fast = json.JSONDecoder(parse_constant=_no_constant).decode
_long_numbers = json.JSONDecoder(parse_constant=_no_constant, parse_int=str).decode
_TOKEN = re.compile(r'[ \t\n\r]*(?:([{}\[\],:])|("(?:[^"\\\x00-\x1f]|\\(?:["\\/bfnrt]|u[0-9a-fA-F]{4}))*")|(-?(?:0|[1-9]\d*)(?:\.\d+)?(?:[eE][+-]?\d+)?)|(true|false|null))')
_WORDS = {"true": True, "false": False, "null": None}


def _deep(text: str) -> Any:
    """A parser with its own stack, for texts nested too deeply for the recursive one."""
    text = text.rstrip(" \t\n\r")
    result: list = []
    boxes, names, want, pos = [result], [None], "value", 0
    while pos < len(text):
        m = _TOKEN.match(text, pos)
        if not m:
            raise NotJson
        pos, (sign, string, number, word), box = m.end(), m.groups(), boxes[-1]
        if want in ("value", "first value") and sign not in (",", ":", "}", "]"):
            value = {} if sign == "{" else [] if sign == "[" else json.loads(string) if string else number if number else _WORDS[word]
            if isinstance(box, dict):
                box[names[-1]] = value
            else:
                box.append(value)
            want = "comma"
            if sign:
                boxes.append(value)
                names.append(None)
                want = "first key" if sign == "{" else "first value"
        elif want in ("key", "first key") and string:
            names[-1], want = json.loads(string), "colon"
        elif want == "colon" and sign == ":":
            want = "value"
        elif want == "comma" and sign == "," and len(boxes) > 1:
            want = "key" if isinstance(box, dict) else "value"
        elif len(boxes) > 1 and (sign == "}" and isinstance(box, dict) and want in ("comma", "first key") or sign == "]" and isinstance(box, list) and want in ("comma", "first value")):
            boxes.pop()
            names.pop()
            want = "comma"
        else:
            raise NotJson
    if len(boxes) != 1 or len(result) != 1:
        raise NotJson
    return result[0]


def parse(text: str) -> Any:
    """The JSON value of a text. Of equal names in an object the last counts; NaN and Infinity are no JSON."""
    try:
        return _fast(text)
    except json.JSONDecodeError as e:
        raise NotJson from e
    except RecursionError:
        return _deep(text)
    except NotJson:
        raise
    except ValueError:  # an integer of thousands of digits
        return _long_numbers(text)


def _unwrapped(value: Any) -> Any:
    """A field value; a string that holds an object or array, serialized once more, is that object or array."""
    if type(value) is str and (head := value[:1]) and (head in "{[" or head in " \t\n\r" and value.lstrip(" \t\n\r")[:1] in ("{", "[")):
        try:
            return parse(value)
        except NotJson:
            return value
    return value


def events_of(text: str | None, ord_: int | None, is_array: bool) -> Iterator[tuple[int | None, dict]]:
    """The events that a text holds: the objects of an array with their positions, or the one object (perhaps serialized twice)."""
    if text is None:
        return
    try:
        value = parse(text)
        if not is_array and type(value) is str:
            value = parse(value)
    except NotJson:
        return
    if is_array and type(value) is list:
        for i, v in enumerate(value):
            if type(v) is dict:
                yield i, v
    elif not is_array and type(value) is dict:
        yield ord_, value


def _edges(batches: Iterator[pa.RecordBatch], maps: set[str] = frozenset(), named: set[str] = frozenset()) -> Iterator[pa.RecordBatch]:
    """The distinct edges (parent, child, kind) of the schema graph in a partition. kind: value, object or array.

    Below ``maps`` only the fields in ``named`` that hold objects or arrays give an edge, from the map itself."""
    seen: dict[str, dict[str, set[str]]] = {"value": defaultdict(set), "object": defaultdict(set), "array": defaultdict(set)}  # children by kind and parent
    values = seen["value"]
    for batch in batches:
        for text, ord_, is_array in zip(*(batch.column(i).to_pylist() for i in range(3))):
            for _, event in events_of(text, ord_, is_array):
                todo = [(ROOT, ROOT in maps, event)]
                while todo:
                    name, in_map, box = todo.pop()
                    if type(box) is list:
                        todo += [(name, in_map, x) for x in box if type(x) is dict or type(x) is list]
                        continue
                    plain = values[name]
                    for k, v in box.items():
                        if type(v) is str:
                            v = _unwrapped(v)
                        if type(v) is not dict and type(v) is not list:
                            if not in_map:
                                plain.add(k)
                        elif not in_map or k in named:
                            seen["object" if type(v) is dict else "array"][name].add(k)
                            todo.append((k, k in maps, v))
                        else:
                            todo.append((name, True, v))
    edges = [(name, k, kind) for kind, by in seen.items() for name, ks in by.items() for k in ks]
    if edges:
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*edges)], names=["parent", "child", "kind"])


class Layout:
    """The tables of a schema graph: ``tables[name]`` lists the columns (paths of inlined fields) of a table. Fields in ``named``
    get tables of their own wherever they hold objects."""

    def __init__(self, edges: list[tuple[str, str, str]], maps: set[str] = frozenset(), named: set[str] = frozenset()):
        objects: dict[str, set[str]] = {}
        arrays, values = set(), {}
        for parent, child, kind in edges:
            if kind == "value":
                values.setdefault(parent, set()).add(child)
            else:
                objects.setdefault(child, set()).add(parent)
            if kind == "array":
                arrays.add(child)
        self.maps = set(maps)
        below = {p: {c for c, ps in objects.items() if p in ps} for ps in objects.values() for p in ps}
        self.shared = {c for c, ps in objects.items() if len(ps) > 1}
        self.recursive = {c for c in objects if self._reaches(below, c)}
        own = (arrays | self.shared | self.recursive | ({ROOT} & set(objects))) - self.maps | (set(named) & set(objects))
        self.names = own
        self.tables: dict[str, list[str]] = {}
        for name in sorted({ROOT, *own}):
            cols, todo = [], [(name, "")]
            while todo:
                at, prefix = todo.pop()
                cols += [prefix + v for v in values.get(at, ())]
                for c in below.get(at, ()):
                    if c in own:
                        continue
                    if c in self.maps:
                        cols.append(prefix + c)
                    else:
                        todo.append((c, f"{prefix}{c}."))
            self.tables[name] = sorted(set(cols))

    @staticmethod
    def _reaches(below: dict[str, set[str]], start: str) -> bool:
        seen, todo = set(), list(below.get(start, ()))
        while todo:
            x = todo.pop()
            if x == start:
                return True
            if x not in seen:
                seen.add(x)
                todo += below.get(x, ())
        return False


_EDGE = "parent string, child string, kind string"


def analyse(df: DataFrame, text: Column, is_array: Column, named: set[str] = frozenset()) -> Layout:
    """The layout for all texts of ``df``; fields in ``named`` are tables in any case. The edges are made distinct on the executors.

    If there are maps, a second pass gives the edges without the maps' entries, so that the driver gets those of the schema, at
    most ``MAP_WIDTH`` for each field name, and the names of fields that repeat or are shared. Of a field that scatters (more than
    ``MAP_WIDTH`` children that hold objects) the children are data, too, however wide they are themselves; their names stay on the
    executors unless other fields have them as well."""
    ship(df.sparkSession)
    source = df.select(text.alias("t"), F.lit(0).alias("o"), is_array.alias("a"))
    edges = Scratch(df.sparkSession).save(source.mapInArrow(_edges, _EDGE).distinct(), "edges")
    holds = F.col("kind") != "value"
    fan = edges.groupBy("parent").agg(F.count_distinct("child").alias("width"), F.count_distinct(F.when(holds, F.col("child"))).alias("boxes"))
    wide = fan.where(F.col("width") > MAP_WIDTH)
    if wide.isEmpty():
        return Layout([tuple(r) for r in edges.toLocalIterator()], named=named)
    scatters = fan.select("parent", (F.col("boxes") > MAP_WIDTH).alias("scatters"))
    children = edges.where(holds).join(scatters, "parent").groupBy("child").agg(F.max(F.col("kind") == "array").alias("repeats"), F.count_distinct("parent").alias("parents"), F.max(~F.col("scatters")).alias("elsewhere"))
    schema = children.where("elsewhere")
    of_schema = (F.col("parent") == ROOT) | F.col("child").isNotNull()
    maps = {r.parent for r in wide.join(schema.select("child"), F.col("parent") == F.col("child"), "left").where(of_schema).select("parent").toLocalIterator()}
    tables = set(named) | {r.child for r in schema.where(F.col("repeats") | (F.col("parents") > 1)).select("child").toLocalIterator()} - maps
    found = source.mapInArrow(lambda batches: _edges(batches, maps, tables), _EDGE).distinct()
    return Layout([tuple(r) for r in found.toLocalIterator()], maps, tables)


def _escaped(name: str) -> str:
    return name.replace("%", "%25").replace("/", "%2F").replace("[", "%5B")


def _text(value: Any) -> str | None:
    if value is None or type(value) is str:
        return value
    return int.__repr__(value) if type(value) is int else json.dumps(value, ensure_ascii=False, separators=(",", ":"))


def _split(value: Any, path: str, names: set[str]) -> tuple[Any, list[tuple[str, str, Any]]]:
    """An object or array without the fields below it that belong to tables, and these as (name, path, value)."""
    taken: list = []
    top: list = [None]
    todo = [(top, 0, value, path)]
    while todo:
        box, at, v, path = todo.pop()
        box[at] = {} if type(v) is dict else [None] * len(v)
        for k, x in v.items() if type(v) is dict else enumerate(v):
            y, below = x, f"{path}[{k}]"
            if type(v) is dict:
                y, below = _unwrapped(x) if type(x) is str else x, f"{path}/{_escaped(k)}" if path else _escaped(k)
            holds = type(y) is dict or type(y) is list
            if holds and type(v) is dict and k in names:
                taken.append((k, below, y))
                continue
            box[at][k] = x
            if holds:
                todo.append((box[at], k, y, below))
    return (top[0] if taken else value), taken


def shred_event(event: dict, names: set[str], maps: set[str] = frozenset(), only: set[str] | None = None, wanted: bool = True) -> Iterator[tuple[str, str, str | None, int, bool, dict]]:
    """Rows (table, id, parent id, position, is an object, fields) of one event; parents come before their children.

    A map is a field with the text of what no table below it has, in a table of its own the field ``value``; the ids of rows
    below a map hold the whole path from the map on. Fields are empty in tables that are not in ``only``, and where none are ``wanted``."""
    todo: list = [(ROOT, "", None, 0, event, {})]
    while todo:
        table, id_, parent, pos, value, fields = todo.pop()
        is_object = type(value) is dict
        kept = wanted and (only is None or table in only)
        children: list = []

        def add(name: str, at: str, v: Any) -> None:
            children.extend((name, f"{at}[{i}]", id_, i, x, {}) for i, x in enumerate(v if type(v) is list else (v,)))

        def under(k: str) -> str:
            return f"{id_}/{_escaped(k)}" if id_ else _escaped(k)

        def rest(v: Any, at: str) -> str | None:
            box = _unwrapped(v)
            if type(box) is not dict and type(box) is not list:
                return _text(v)
            left, taken = _split(box, at, names)
            for t in taken:
                add(*t)
            return _text(left if taken else v) if kept else None

        whole = is_object and table not in maps
        if not whole and (kept or type(value) is not str):
            fields["value"] = rest(value, id_) if is_object or type(value) is list else _text(value)
        inner = [("", value)] if whole else []
        while inner:
            prefix, box = inner.pop()
            for k, v in box.items():
                if type(v) is str:
                    v = _unwrapped(v)
                holds = type(v) is dict or type(v) is list
                if holds and k in names:
                    add(k, under(k), v)
                elif k in maps or type(v) is list:
                    fields[prefix + k] = rest(box[k], under(k))
                elif holds:
                    inner.append((f"{prefix}{k}.", v))
                elif kept:
                    fields[prefix + k] = _text(v)
        if only is None or table in only:
            yield table, id_, parent, pos, is_object, fields
        todo += reversed(children)


def shred(df: DataFrame, keys: list[str], ord_: Column, text: Column, is_array: Column, layout: Layout, only: set[str] | None = None, fields: bool = True) -> DataFrame:
    """All tables' rows in one long form: keys, event_ord, table_name, row_id, parent_id, position, is_object, fields.

    ``row_id`` is unique within a record ("attempts[0]/steps[2]", '' for the event) and ``parent_id`` is its parent's, so
    (keys, event_ord, parent_id) is the foreign key. A null text, one that is no JSON, and one of the wrong shape (no array
    where ``is_array``, no object elsewhere) give nothing; elements that are no objects keep their position and have a
    ``value`` field. A field is text, null where it is missing or JSON null. ``only`` names the tables to emit. Other columns of
    ``df`` are not read; empty tables give an empty result; repeated rows are shredded as often as they occur.
    """
    names, maps = set(layout.names), set(layout.maps)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols = [c.to_pylist() for c in batch.columns]
            for start in range(0, batch.num_rows, 1000):
                where, out = [], []
                for i in range(start, min(start + 1000, batch.num_rows)):
                    for o, event in events_of(cols[-1][i], cols[-3][i], cols[-2][i]):
                        for row in shred_event(event, names, maps, only, fields):
                            where.append(i)
                            out.append((o, *row))
                at = pa.array(where, pa.int32())
                kept = [batch.column(i).take(at) for i in range(len(keys))]
                got = list(zip(*out)) or [[]] * 7
                types = (pa.int32(), pa.string(), pa.string(), pa.string(), pa.int32(), pa.bool_())
                made = [pa.array(c, t) for c, t in zip(got, types)]
                if fields:
                    made.append(pa.array([list(f.items()) for f in got[6]], pa.map_(pa.string(), pa.string())))
                yield pa.RecordBatch.from_arrays([*kept, *made], names=schema.names)

    source = df.select(*(F.col(f"`{k}`") for k in keys), ord_.cast("int").alias("__ord"), is_array.alias("__array"), text.alias("__text"))
    made = [("event_ord", T.IntegerType()), ("table_name", T.StringType()), ("row_id", T.StringType()), ("parent_id", T.StringType()), ("position", T.IntegerType()), ("is_object", T.BooleanType())]
    made += [("fields", T.MapType(T.StringType(), T.StringType()))] * fields
    schema = T.StructType([*source.schema.fields[: len(keys)], *(T.StructField(n, t) for n, t in made)])
    return source.mapInArrow(run, schema)


def flat_table(rows: DataFrame, keys: list[str], layout: Layout, name: str) -> DataFrame:
    """One table of ``shred``'s result: keys, event_ord, row_id, parent_id, position and a column for each inlined field."""
    cols = [c for c in layout.tables.get(name, []) if c not in {*keys, "event_ord", "row_id", "parent_id", "position"}]
    return rows.where(F.col("table_name") == name).select(
        *(F.col(f"`{k}`") for k in keys), "event_ord", "row_id", "parent_id", "position", *(F.col("fields")[F.lit(c)].alias(c) for c in cols), F.col("fields")["value"].alias("element_value")
    )
