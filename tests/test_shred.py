import json
import random

import pytest
from pyspark.sql import functions as F

from faultweave.operators import shred
from faultweave.plans import preparation
from faultweave.sources.tables import table


def brute_cases(text, is_array, ord_):
    """Attempts and steps by plain recursion, written apart from the operator."""

    def load(t):
        try:
            return json.loads(t, parse_constant=lambda c: (_ for _ in ()).throw(ValueError(c)))
        except ValueError:
            return None

    def undo(v):
        if isinstance(v, str) and v.strip()[:1] in ("{", "["):
            w = load(v)
            return v if w is None else w
        return v

    def find(box, name):
        if isinstance(box, dict):
            for k, v in box.items():
                v = undo(v)
                if k == name:
                    yield v
                else:
                    yield from find(v, name)
        elif isinstance(box, list):
            for x in box:
                yield from find(x, name)

    def cases(event, o):
        for attempts in find(event, "attempts"):
            for i, a in enumerate(attempts if isinstance(attempts, list) else [attempts]):
                if isinstance(a, dict):
                    yield o, i, -1
                    for steps in find(a, "steps"):
                        for j, x in enumerate(steps if isinstance(steps, list) else [steps]):
                            if isinstance(x, dict):
                                yield o, i, j

    v = load(text) if text is not None else None
    if is_array:
        return {c for o, e in enumerate(v) if isinstance(e, dict) for c in cases(e, o)} if isinstance(v, list) else set()
    if isinstance(v, str):
        v = load(v)
    return set(cases(v, ord_)) if isinstance(v, dict) else set()


def run_cases(spark, rows):
    df = spark.createDataFrame(rows, "run_id string, ord int, is_array boolean, text string")
    layout = shred.analyse(df, F.col("text"), F.col("is_array"))
    out = shred.shred(df, ["run_id"], F.col("ord"), F.col("text"), F.col("is_array"), layout)
    return out, layout


def found(out):
    in_attempt = F.col("row_id").rlike(r"(\A|/)attempts\[\d+\]/")
    rows = out.where(F.col("is_object") & ((F.col("table_name") == "attempts") | (F.col("table_name") == "steps") & in_attempt))
    place = F.regexp_extract("row_id", r"(?:\A|.*/)attempts\[(\d+)\]", 1).cast("int")
    got = rows.select("run_id", "event_ord", place.alias("a"), F.when(F.col("table_name") == "steps", F.col("position")).otherwise(-1).alias("s")).distinct().collect()
    return {tuple(r) for r in got}


def test_shapes(spark):
    two = json.dumps(json.dumps({"note": {"attempts": [{"steps": json.dumps([{"op": 1}, "x", {"op": 2}])}]}}))
    rows = [
        ("a", 0, False, '{"attempts":{"no":1,"detail":{"inner":{"steps":{"op":"x"}}}}}'),
        ("b", 1, False, '{"note":{"transfer":{"attempts":[1,null,{"steps":[]},"n/a",{"no":2}]}}}'),
        ("c", 2, False, two),
        ("d", 3, False, '{"note":"{\\"attempts\\":[{}]}"}'),
        ("e", 4, False, "{broken"), ("f", 5, False, None), ("g", 6, False, "[]"), ("h", 7, False, '"text"'), ("i", 8, False, '{"attempts":NaN}'),
        ("j", None, True, '[null,{"attempts":[{}]},"s",[],{"a\\u0074tempts":[{"steps":[{}]}]}]'),
        ("k", None, True, '{"attempts":[{}]}'), ("l", None, True, "null"), ("m", None, True, ""),
        ("a", 0, False, '{"attempts":{"no":1,"detail":{"inner":{"steps":{"op":"x"}}}}}'),
    ]
    out, layout = run_cases(spark, rows)
    assert found(out) == {(r[0], *c) for r in rows for c in brute_cases(r[3], r[2], r[1])}
    assert {"attempts", "steps"} <= set(layout.names) and "note" not in layout.names
    steps = shred.flat_table(out, ["run_id"], layout, "steps")
    assert {r.op for r in steps.where("run_id = 'c'").collect()} == {"1", "2", None}
    # every child has its parent
    keys = {(r.run_id, r.event_ord, r.row_id) for r in out.collect()}
    assert all((r.run_id, r.event_ord, r.parent_id) in keys for r in out.where("parent_id IS NOT NULL").collect())


def test_empty_and_clashing_names(spark):
    out, layout = run_cases(spark, [])
    assert out.count() == 0 and layout.tables == {"event": []}
    df = spark.createDataFrame([("r", '{"run_id":"x","row_id":1,"attempts":[{"position":2}]}', 1)], "event_ord string, t string, text int")
    layout = shred.analyse(df, F.col("t"), F.lit(False))
    rows = shred.shred(df.withColumnRenamed("event_ord", "k"), ["k"], F.lit(7), F.col("t"), F.lit(False), layout)
    assert {(r.k, r.event_ord, r.table_name) for r in rows.collect()} == {("r", 7, "event"), ("r", 7, "attempts")}
    assert shred.flat_table(rows, ["k"], layout, "attempts").count() == 1


def test_recursion_shared_and_maps():
    edges = [("event", "node", "object"), ("node", "node", "object"), ("event", "a", "object"), ("event", "b", "object"), ("a", "c", "object"), ("b", "c", "object"), ("c", "x", "value")]
    layout = shred.Layout(edges)
    assert layout.recursive == {"node"} and layout.shared == {"c", "node"} and {"c", "node"} <= layout.names and "a" not in layout.names
    assert layout.tables["c"] == ["x"]


def test_map_stays_text(spark):
    wide = {"m": {f"k{i}": i for i in range(shred.MAP_WIDTH + 1)}, "attempts": [{}]}
    out, layout = run_cases(spark, [("a", 0, False, json.dumps(wide))])
    assert layout.maps == {"m"}
    row = out.where("table_name = 'event'").first()
    assert json.loads(row.fields["m"]) == wide["m"]


def p5_of(spark, tmp_path, rows):
    spark.createDataFrame([(r, t, None) for r, _, a, t in rows if a], "run_id string, warn_error_logs string, inserted_at timestamp").write.parquet(f"{tmp_path}/app_run_logs.parquet")
    spark.createDataFrame([(r, o, t) for r, o, a, t in rows if not a], "run_id string, event_ord int, raw_event string").write.parquet(f"{tmp_path}/error_events.parquet")
    return {tuple(r) for r in preparation.p5_found(spark, str(tmp_path)).collect()}


def uuid_of(i):
    return f"00000000-0000-4000-8000-{i:012d}"


def test_cases_below_maps(spark, tmp_path):
    """Wide objects above, between and at attempts and steps lose no case: keys by host, of values, objects and arrays."""
    many = range(shred.MAP_WIDTH + 1)
    steps = {"steps": [{"op": 1}, "x", {"op": 2}]}
    values = [{"note": {f"k{i}": i, "transfer": {"attempts": [1, {"no": i, **steps}]}}} for i in many]
    boxes = [{"hosts": {f"h{i}": {"detail": json.dumps({"attempts": [{f"a{i}": {"deep": [[steps]]}}]})}}} for i in many]
    arrays = [{"jobs": json.dumps({f"j{i}": [{"n": 1}, {"attempts": {"steps": {f"s{i}": 1}}}]})} for i in many]
    rows = [(uuid_of(i), i, False, json.dumps(e)) for i, e in enumerate(values + boxes + arrays)] + [(uuid_of(9999), None, True, json.dumps(values[:2] + boxes[:2] + arrays[:2]))]
    want = {(r[0], *c) for r in rows for c in brute_cases(r[3], r[2], r[1])}
    assert len(want) > 8 * len(many) and p5_of(spark, tmp_path, rows) == want


def test_single_objects_are_cases(spark, tmp_path):
    rows = [(uuid_of(1), 0, False, '{"note":{"attempts":{"no":1,"x":[[{"steps":{"op":2}}]]}}}')]
    assert p5_of(spark, tmp_path, rows) == {(uuid_of(1), 0, 0, -1), (uuid_of(1), 0, 0, 0)}


def test_names_that_are_data_stay_on_the_executors(spark):
    """Hosts, each with as many metrics as hosts, and events without two fields of one name: only names of the schema are collected."""
    many = range(shred.MAP_WIDTH + 1)
    hosts = {"note": {"hosts": {f"h{i}": {**{f"m{i}x{j}": j for j in many}, "attempts": {"no": i}} for i in many}}}
    out, layout = run_cases(spark, [("a", 0, False, json.dumps(hosts))])
    assert layout.maps == {"hosts"} and set(layout.tables) == {"event", "attempts"} and found(out) == {("a", 0, 0, -1)}
    assert out.where("table_name = 'attempts'").count() == len(many)
    events = [("a", i, False, json.dumps({f"f{i}": i, f"g{i}": {"attempts": [{"no": i, "steps": [{}]}]}})) for i in many]
    out, layout = run_cases(spark, events)
    assert layout.maps == {"event"} and layout.tables == {"event": [], "attempts": ["no"], "steps": []}
    assert found(out) == {("a", *c) for _, i, _, t in events for c in brute_cases(t, False, i)}
    kept = {r.event_ord: json.loads(r.fields["value"]) for r in out.where("table_name = 'event'").collect()}
    assert kept == {i: {f"f{i}": i, f"g{i}": {}} for i in many}


def test_map_keeps_what_no_table_has(spark):
    wide = {f"k{i}": i for i in range(shred.MAP_WIDTH + 1)}
    event = {"m": json.dumps({**wide, "h1": {"tries": [{"n": 1}], "z": 3}, "h2": {"tries": [{"n": 2}]}})}
    out, layout = run_cases(spark, [("a", 0, False, json.dumps(event))])
    assert layout.maps == {"m"} and layout.tables == {"event": ["m"], "tries": ["n"]}
    assert json.loads(out.where("table_name = 'event'").first().fields["m"]) == {**wide, "h1": {"z": 3}, "h2": {}}
    assert {(r.row_id, r.parent_id, r.fields["n"]) for r in out.where("table_name = 'tries'").collect()} == {("m/h1/tries[0]", "", "1"), ("m/h2/tries[0]", "", "2")}


@pytest.mark.parametrize("text", ["[" * 50_000 + "]" * 50_000, '{"a":' * 30_000 + "1" + "}" * 30_000, '{"n":' + "9" * 6000 + "}"])
def test_very_deep_and_long(text):
    assert shred.parse(text) is not None


@pytest.mark.parametrize("text", ['{"a":1,}', "[1 2]", '{"a" 1}', "[", "]", "", "{]", "[1,]", '{"a":[1}', "1 2", '["\\x"]', '[tru]', '{1:2}', "[,1]"])
def test_no_json(text):
    with pytest.raises(shred.NotJson):
        shred.parse(text)
    with pytest.raises(shred.NotJson):
        shred._deep(text)


def test_deep_parser_agrees():
    r = random.Random(5)

    def value(d):
        k = r.randrange(7 if d else 5)
        return [None, True, "ä\"\\\n", 3, -1.5e3][k] if k < 5 else [value(d - 1) for _ in range(r.randrange(4))] if k == 5 else {f"k{i}": value(d - 1) for i in range(r.randrange(4))}

    for _ in range(300):
        v = value(4)
        text = json.dumps(v, ensure_ascii=r.random() < 0.5, indent=r.choice([None, 1]))
        deep = json.loads(json.dumps(shred._deep(text)))
        assert deep == json.loads(text, parse_int=str, parse_float=str)


def test_query_equals_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    want = set()
    for r in preparation._nested(spark, sf).collect():
        want |= {(r.run_id, *c) for c in brute_cases(r.text, r.is_array, r.ord)}
    assert {tuple(r) for r in preparation.p5_found(spark, sf).collect()} == want
    assert table(spark, sf, "app_run_logs").count() > 0


def test_flat_tables_have_every_record(spark, tmp_path):
    sf = "/root/testdata/sf0.001"
    flat = {n: preparation.QUERIES[f"p5_{n}"](spark, sf) for n in ("events", "attempts", "steps")}
    rows = preparation._nested(spark, sf).collect()
    events = [(r.run_id, o, e) for r in rows for o, e in shred.events_of(r.text, r.ord, r.is_array)]
    scalar = {k for _, _, e in events for k, v in e.items() if not isinstance(v, (dict, list)) and shred._unwrapped(v) is v}
    assert scalar and scalar <= set(flat["events"].columns) | {"run_id", "event_ord", "position"}
    for n, df in flat.items():
        df.write.parquet(f"{tmp_path}/{n}")
    written = {n: spark.read.parquet(f"{tmp_path}/{n}") for n in flat}
    assert sorted((r.run_id, r.event_ord) for r in written["events"].collect()) == sorted((i, o) for i, o, _ in events)
    want = {(r.run_id, *c) for r in rows for c in brute_cases(r.text, r.is_array, r.ord)}
    assert {(r.run_id, r.event_ord, r.position, -1) for r in written["attempts"].collect()} == {c for c in want if c[3] == -1}
    assert {(r.run_id, r.event_ord, r.attempt_ord, r.position) for r in written["steps"].collect()} == {c for c in want if c[3] != -1}
