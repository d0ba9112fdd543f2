"""The job end to end: windows, replays, two writers, run log; and what its plans read."""

import json
from datetime import UTC, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from faultweave.__main__ import main
from faultweave.operators import incidents, materialize
from faultweave.operators.pipeline import FACTS, LOGS, IncidentStore
from faultweave.plans import incidents as plans
from faultweave.sources.tables import ConcurrentWriterError

T0 = datetime(2026, 6, 1, tzinfo=UTC)
LOG = "run_id string, app_name string, warn_error_logs string, inserted_at timestamp"
OUTCOME = "run_id string, system_id string, successful_acquisition boolean, error_category string, phase string, capture_datetime timestamp, inserted_at timestamp"


def run_id(i):
    return f"00000000-0000-4000-8000-{i:012d}"


def event(text, sme="SME00001", dt="2026-06-01T00:00:00Z"):
    return {"dt": dt, "type": "ERROR", "func": "f", "tag": "T", "err_msg": text, "note": {"sme": sme}}


def tables(spark):
    rows = [
        (run_id(1), "hhm_rpp_ge", json.dumps([event("disk 1 full"), event("net down")]), T0),
        (run_id(1).upper(), "hhm_rpp_ge", json.dumps([event("disk 1 full"), event("net down"), event("disk 2 full", dt="2026-06-01T00:30:00Z")]), T0 + timedelta(hours=2)),  # delivered again, with one more
        (run_id(2), "data_acquisition", json.dumps([event("disk 3 full", "SME00002"), "x", None]), T0 + timedelta(hours=2)),
        (run_id(3), "elsewhere", json.dumps([event("disk 3 full")]), T0), (None, "hhm_rpp_ge", json.dumps([event("lost")]), T0), (run_id(4), "hhm_rpp_ge", "{", T0),
    ]
    return spark.createDataFrame(rows, LOG), spark.createDataFrame([(run_id(2), "SME00001", True, "cooling", None, None, T0)], OUTCOME)


def shown(df):
    return {(r.sample_message, r.entity): (r.occurrence_count, r.category, r.category_source, r.created_at, r.updated_at) for r in df.collect()}


def test_runs_windows_and_replays(spark):
    logs, outcomes = tables(spark)
    store = IncidentStore(spark)
    one, two = T0 + timedelta(hours=1), T0 + timedelta(hours=3)
    assert store.run(logs, outcomes, one) == {"appended": 2, "inserted": 2, "incidents": 2}
    assert store.run(logs, outcomes, one) == {"appended": 0, "inserted": 0, "incidents": 2}
    assert store.run(logs, outcomes, two) == {"appended": 2, "inserted": 1, "incidents": 3}
    again = IncidentStore(spark, store.files.path)
    before = shown(again.incidents())
    assert again.cursor(LOGS) == again.cursor(FACTS) == two and again.run(logs, outcomes, two) == {"appended": 0, "inserted": 0, "incidents": 3}
    assert shown(again.incidents()) == before
    at = lambda t: t.replace(tzinfo=None)
    assert {k: (v[0], v[1], v[2]) for k, v in before.items()} == {("disk 2 full", "SME00001"): (2, "cooling", "oracle"), ("net down", "SME00001"): (1, "cooling", "oracle"), ("disk 3 full", "SME00002"): (1, "unknown", "classifier")}
    assert {k: tuple(map(at, v[3:])) for k, v in before.items()} == {("disk 2 full", "SME00001"): (at(one), at(two)), ("net down", "SME00001"): (at(one), at(one)), ("disk 3 full", "SME00002"): (at(two), at(two))}
    assert len(again.state.value["loads"]) == 2  # runs that append nothing leave no load
    rows = sorted(map(str, again.facts().collect()))
    again.compact()
    assert len(again.state.value["loads"]) == 1 and sorted(map(str, again.facts().collect())) == rows
    # all at once gives the same incidents
    whole = IncidentStore(spark)
    whole.run(logs, outcomes, two)
    assert {k: v[:3] for k, v in shown(whole.incidents()).items()} == {k: v[:3] for k, v in before.items()}


def test_states_are_written_back_and_kept(spark):
    logs, outcomes = tables(spark)
    store, one, two, now = IncidentStore(spark), T0 + timedelta(hours=1), T0 + timedelta(hours=3), T0 + timedelta(hours=9)
    store.run(logs, outcomes, one)
    states = store.files.save(store.incidents().select("fingerprint", "entity", F.col("last_seen").alias("prev_last_seen"), F.lit("open").alias("state"), F.lit(None).cast("timestamp").alias("resolved_at")), "s")
    store.run(logs, outcomes, two)
    assert store.update(states, ["last_seen"], ["state", "resolved_at"], now) == {"updated": 1, "skipped": 1, "same": 0}
    assert store.update(states, ["last_seen"], ["state", "resolved_at"], now + timedelta(days=1)) == {"updated": 0, "skipped": 1, "same": 1}
    store.run(logs, outcomes, two + timedelta(hours=1))
    got = {r.sample_message: (r.state, r.updated_at) for r in IncidentStore(spark, store.files.path).incidents().collect()}
    at = lambda t: t.replace(tzinfo=None)
    assert got == {"net down": ("open", at(now)), "disk 2 full": (None, at(two)), "disk 3 full": (None, at(two))}


def test_second_writer_is_refused(spark):
    logs, outcomes = tables(spark)
    a = IncidentStore(spark)
    a.materialize(logs, T0)
    b = IncidentStore(spark, a.files.path)
    a.aggregate(outcomes, T0, T0)
    with pytest.raises(ConcurrentWriterError):
        b.materialize(logs, T0 + timedelta(hours=3))
    assert IncidentStore(spark, a.files.path).facts().count() == 2


def test_empty_sources(spark):
    logs, outcomes = tables(spark)
    store = IncidentStore(spark)
    assert store.run(logs.limit(0), outcomes.limit(0), T0) == {"appended": 0, "inserted": 0, "incidents": 0}
    assert store.run(logs, outcomes, T0 + timedelta(hours=1))["appended"] == 2 or store.facts().count() == 0


def test_command_line(spark, tmp_path, capsys):
    logs, outcomes = tables(spark)
    logs.write.parquet(f"{tmp_path}/logs")
    outcomes.write.parquet(f"{tmp_path}/outcomes")
    base = ["--store", f"file://{tmp_path}/store", "--until", "2026-06-01T03:00:00+00:00"]
    assert main(["run", *base, "--logs", f"{tmp_path}/logs", "--outcomes", f"{tmp_path}/outcomes"], spark) == 0
    assert main(["noop", *base], spark) == 0
    assert main(["aggregate", *base, "--outcomes", f"{tmp_path}/nowhere"], spark) == 1 and "nowhere" in capsys.readouterr().err
    assert IncidentStore(spark, f"file://{tmp_path}/store").incidents().count() == 3
    own = spark.read.parquet(f"{tmp_path}/store/runs/app_run_logs")
    assert own.count() == 3 and [len(json.loads(r.warn_error_logs)) for r in own.orderBy("inserted_at").collect()] == [0, 0, 1]
    with pytest.raises(SystemExit):
        main(["materialize", *base], spark)


def plan_of(df):
    df.sparkSession.conf.set("spark.sql.maxMetadataStringLength", 5000)
    return df._jdf.queryExecution().executedPlan().toString()


def test_what_the_plans_read(spark):
    sf = "/root/testdata/sf0.001"
    drill = plan_of(incidents.latest_events(plans._facts(spark, sf), "fp", "e").select("run_id", "event_ord", "dt"))
    assert "EqualTo(fingerprint,fp)" in drill and "EqualTo(entity,e)" in drill and "raw_event" not in drill and "TakeOrdered" in drill
    window = plan_of(plans._incidents(spark, sf, plans.CUTS[0], plans.CUTS[1]))
    assert "arrived" in window.split("PartitionFilters: [")[1].split("]")[0] and "GreaterThan(inserted_at" in window and "raw_event" not in window
    for name in ("incremental_merge", "enriched_incidents", "incident_rollup", "drilldown_topn"):
        assert "raw_event" not in plan_of(plans.QUERIES[name](spark, sf)), name


def test_mixed_types_are_found(spark):
    df = spark.createDataFrame([("a", "WARN"), ("a", "ERROR"), ("b", "WARN"), ("b", "WARN"), (None, "x"), (None, "y"), ("c", None), ("c", "WARN")], "fingerprint string, type string")
    assert [tuple(r) for r in incidents.mixed_types(df).collect()] == [("a", 2)]


def test_state_and_resolution_updates(spark):
    """A state-only update cannot touch the resolution; a resolution changes all its columns or none."""
    at = T0.replace(tzinfo=None)
    current = spark.createDataFrame([("a", "open", None, None, 1), ("b", "resolved", at, "stale", 2), ("c", None, None, None, 3)], "id string, state string, resolved_at timestamp, resolved_reason string, seen int")
    states = spark.createDataFrame([("a", "open", 1, "acknowledged"), ("b", "resolved", 2, "open"), ("c", "open", 3, "acknowledged")], "id string, prev_state string, prev_seen int, state string")
    got = incidents.guarded_update(current, states, ["id"], ["state", "seen"], ["state"])
    assert {tuple(r) for r in got.select("id", "state", "resolved_reason", "outcome").collect()} == {("a", "acknowledged", None, "updated"), ("b", "open", "stale", "updated"), ("c", None, None, "skipped")}
    done = spark.createDataFrame([("a", "open", 1, "resolved", at, "auto_recovery"), ("b", "resolved", 9, "resolved", at, "auto_recovery")], "id string, prev_state string, prev_seen int, state string, resolved_at timestamp, resolved_reason string")
    got = incidents.guarded_update(current, done, ["id"], ["state", "seen"], ["state", "resolved_at", "resolved_reason"])
    assert {tuple(r) for r in got.select("id", "state", "resolved_at", "resolved_reason", "outcome").collect()} == {("a", "resolved", at, "auto_recovery", "updated"), ("b", "resolved", at, "stale", "skipped"), ("c", None, None, None, "kept")}


def test_unchanged_rows_keep_their_time(spark):
    """What changed_only names is all that an update writes."""
    old = spark.createDataFrame([("a", 1, 5), ("b", 2, 5)], "k string, v int, updated_at int")
    new = spark.createDataFrame([("a", 1), ("b", 3)], "k string, v int")
    changed = incidents.changed_only(old, new, ["k"], ["v"])
    out = old.join(changed.withColumnRenamed("v", "w"), "k", "left").select("k", F.coalesce("w", "v").alias("v"), F.when(F.col("w").isNotNull(), 9).otherwise(F.col("updated_at")).alias("at"))
    assert {tuple(r) for r in out.collect()} == {("a", 1, 5), ("b", 3, 9)}


def test_overlap_is_scanned_again(spark):
    logs, _ = tables(spark)
    assert materialize.source_scan(logs, T0 + timedelta(seconds=20), T0 + timedelta(hours=1)).count() == 3  # the three rows of 20 seconds before
    assert materialize.source_scan(logs, T0 + timedelta(seconds=40), T0 + timedelta(hours=1)).count() == 0
