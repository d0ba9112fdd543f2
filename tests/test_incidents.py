"""Incremental maintenance of incidents: any split and order gives the rebuild; guards; run statistics."""

import random
from datetime import UTC, datetime, timedelta

from pyspark.sql import functions as F

from faultweave.operators import incidents, runstats
from faultweave.streaming import events

T0 = datetime(2026, 6, 1, tzinfo=UTC)
SCHEMA = (
    "run_id string, event_ord int, src_app_name string, type string, func string, err_msg string, note_message string, system_id string, entity string, fingerprint string, "
    "error_category string, error_type string, dt timestamp, raw_event string, inserted_at timestamp"
)


def facts(spark, n=300, seed=2):
    r = random.Random(seed)
    rows = []
    for i in range(n):
        t = T0 + timedelta(minutes=r.randrange(400))
        rows.append((
            f"run{r.randrange(40):03d}", i, r.choice(["data_acquisition", "hhm_rpp_ge", None]), "WARN", f"f{r.randrange(3)}", r.choice([None, " ", "m1"]), r.choice([None, "m2"]), r.choice([None, "SME00001", "SME00002"]),
            r.choice(["e1", "e2"]), r.choice(["fp1", "fp2", "fp3"]), r.choice(["unknown", "max_retries"]), "", r.choice([None, t]), r.choice([None, '{"note":{"txt":"deep"}}', "{bad"]), T0 + timedelta(minutes=i),
        ))
    return spark.createDataFrame(rows, SCHEMA)


def outcomes(spark):
    rows = [("SME00001", "disk", T0), ("SME00001", "net", T0 + timedelta(hours=1)), ("SME00001", "unknown", T0 + timedelta(hours=2)), ("SME00002", None, T0)]
    return spark.createDataFrame(rows, "system_id string, error_category string, inserted_at timestamp")


def build(spark, df):
    return incidents.enrich(incidents.rollup(incidents.message(df)), outcomes(spark))


def shown(df):
    return sorted(map(repr, map(tuple, df.select("fingerprint", "entity", "occurrence_count", "first_seen", "last_seen", "apps", "systems", "sample_run_id", "sample_message", "category", "category_source").collect())))


def test_rebuild_equals_incremental_in_either_order(spark):
    df = facts(spark)
    whole = shown(build(spark, df))
    for cut in (1, 77, 299):
        a, b = build(spark, df.where(F.col("event_ord") < cut)), build(spark, df.where(F.col("event_ord") >= cut))
        assert shown(incidents.merge(a, b)) == whole
        assert shown(incidents.merge(b, a)) == whole


def test_merge_with_empty(spark):
    df = facts(spark, 20)
    empty = build(spark, df.limit(0))
    assert shown(incidents.merge(empty, build(spark, df))) == shown(build(spark, df)) == shown(incidents.merge(build(spark, df), empty))


def test_provenance(spark):
    got = {(r.category, r.category_source) for r in build(spark, facts(spark)).collect()}
    assert got <= {("net", "oracle"), ("unknown", "classifier"), ("max_retries", "classifier")} and len(got) > 1


def test_guarded_update(spark):
    current = spark.createDataFrame([("a", "1", None, 5), ("b", "1", "open", 5), ("c", "2", None, None)], "k string, v string, state string, seen int")
    updates = spark.createDataFrame([("a", None, 5, "new"), ("b", None, 5, "new"), ("c", None, None, "new")], "k string, prev_state string, prev_seen int, state string")
    got = {r.k: (r.state, r.outcome) for r in incidents.guarded_update(current, updates, ["k"], ["state", "seen"], ["state"]).collect()}
    assert got == {"a": ("new", "updated"), "b": ("open", "skipped"), "c": ("new", "updated")}


def test_changed_only(spark):
    old = spark.createDataFrame([("a", 1, None), ("b", 2, "x"), (None, 3, "y")], "k string, n int, s string")
    new = spark.createDataFrame([("a", 1, None), ("b", 2, None), (None, 4, "y"), ("z", 1, "q")], "k string, n int, s string")
    assert sorted((r.k or "") for r in incidents.changed_only(old, new, ["k"], ["n", "s"]).collect()) == ["", "b"]


def test_duration_stats_floor_quantiles(spark):
    values = [5, 1, 9, 9, 2, 7, 7, 7, 3, 100_000]
    df = spark.createDataFrame([("a", v) for v in values] + [("b", 4), ("c", None)], "g string, ms long")
    got = {r.g: tuple(r)[1:] for r in runstats.duration_stats(df, ["g"]).collect()}
    v = sorted(values)
    assert got == {"a": (10, 1, v[int(9 * 0.5)], v[int(9 * 0.95)], 100_000), "b": (1, 4, 4, 4, 4)}
    b = runstats.duration_buckets(spark.createDataFrame([("a", x) for x in (0, 9_999, 10_000, 59_999, 60_000, 90_000)], "g string, ms long"), ["g"]).first()
    assert tuple(b)[1:] == (2, 1, 1, 1, 1)


def test_prefixes_and_subnets(spark):
    rows = [("r", "exec.a"), ("r", "exec.b"), ("r", "exec.c"), ("r", "io.a"), ("r", "io.a"), ("r", "boot"), ("r", ".x"), ("q", "exec.a")]
    got = sorted((r.run, r.shown) for r in runstats.label_prefix(spark.createDataFrame(rows, "run string, label string")).collect())
    assert got == sorted([("r", "exec.*")] * 3 + [("r", "io.a")] * 2 + [("r", "boot"), ("r", ".x"), ("q", "exec.a")])
    ips = [("r", "10.0.0.1", 1), ("r", "10.0.0.9", 3), ("r", "10.0.1.1", 5), ("r", "10.0.0.1x", 7), ("r", None, 9)]
    s = runstats.subnet_stats(spark.createDataFrame(ips, "run string, ip string, ms long")).collect()
    assert [(x.subnet, x["count"], x.max_ms) for x in s] == [("10.0.0", 2, 3)]


def test_stream_sink_replay_changes_nothing(spark):
    df = facts(spark, 60)
    sink = events.IncidentSink(spark, outcomes(spark))
    sink(df.where("event_ord < 30"), 0)
    sink(df.where("event_ord >= 30"), 1)
    before = shown(sink.current())
    sink(df.where("event_ord >= 30"), 1)
    assert shown(sink.current()) == before == shown(build(spark, df))


def test_stream_drops_late_rows(spark, tmp_path):
    """A file that arrives after the watermark has passed is left out, copies within it are one."""
    src = str(tmp_path / "src")
    schema = "run_id string, event_ord int, inserted_at timestamp"
    for i, rows in enumerate([[("a", 1, T0), ("a", 1, T0)], [("b", 1, T0 + timedelta(days=30))], [("a", 1, T0), ("c", 1, T0 + timedelta(days=30))]]):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{src}/{i}")
    s = events.file_stream(spark, f"{src}/*", spark.read.parquet(f"{src}/0").schema, 1)
    out = events.run_available(events.first_deliveries(s, "1 day").select("run_id"))
    assert sorted(r.run_id for r in out.collect()) == ["a", "b", "c"]
