"""Text functions, classification and flattening on small inputs."""

import hashlib
import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from faultweave.functions import classify, text
from faultweave.operators import materialize
from faultweave.sources.tables import SELF_APP

CURL = "  % Total    % Received % Xferd\n   Dload  Upload   Total\n 12 100k    0  12k\n 98 772k    0   6k\ncurl: (28) Operation timed out after 99 milliseconds with 7 bytes received"

NORMAL = [
    ("", ""), (None, ""), ("  Hello \t World ", "hello world"),
    ("at 2026-06-02T14:03:31.122Z and 2026-06-02 14:03:31+02:00", "at <ts> and <ts>"),
    ("Jun 3 14:03 up", "<ts> up"),
    ("run 8f04ee01-069c-4b3a-a11e-99e62ec2b86a of SME01004 at 192.0.2.7:22", "run <uuid> of <sme> at <ip>"),
    ("/vault/cold/f83629.dat (code 11) deadbeefcafe", "<path> (code <n>) <hex>"),
    (CURL, "curl: (<n>) operation timed out after <n> milliseconds with <n> bytes received"),
    ("12 34k outside a table stays", "<n> <n>k outside a table stays"),
    ("TypeError: x\n    at f (/a/b.js:1:2)\n    at <anonymous>\nend", "typeerror: x end"),
    ("  % Total % Received\n 1 2k 3\nplain\n 1 2k 3", "plain <n> <n>k <n>"),
]


def one(spark, column, **values):
    return spark.range(1).select(*(F.lit(v).alias(k) for k, v in values.items())).select(column.alias("x")).first().x


@pytest.mark.parametrize("raw,normal", NORMAL)
def test_normalize(spark, raw, normal):
    df = spark.createDataFrame([(raw,)], "t string")
    assert df.select(text.normalize(F.col("t"))).first()[0] == normal
    assert spark.createDataFrame([(normal,)], "t string").select(text.normalize(F.col("t"))).first()[0] == normal  # stable


def test_long_message_is_kept_whole(spark):
    raw = "word " * 50_000 + "\n" + "x " * 20_000
    assert len(spark.createDataFrame([(raw,)], "t string").select(text.normalize(F.col("t"))).first()[0]) == 250_000 + 40_000 - 1


def test_fingerprint(spark):
    df = spark.createDataFrame([("app|1", "f\\g", None, "WARN", "Disk 7 full at 192.0.2.1")], "a string, f string, t string, y string, m string")
    got = df.select(text.fingerprint(*(F.col(c) for c in "aftym"))).first()[0]
    assert got == hashlib.sha1(rb"app\|1|f\\g||WARN|disk <n> full at <ip>").hexdigest()


@pytest.mark.parametrize("sme,system,want", [("x", "SME00001", "x"), (" ", "SME00001", "SME00001"), (None, None, "__global__"), ("y" * 80, None, "y" * 64)])
def test_entity(spark, sme, system, want):
    df = spark.createDataFrame([(sme, system)], "s string, y string")
    assert df.select(text.entity(F.col("s"), F.col("y"))).first()[0] == want


@pytest.mark.parametrize("raw,want", [("sme00012", "SME00012"), (" SME00012 ", "SME00012"), ("SME0001", None), ("SME000123", None), ("SME00012\nx", None), (None, None)])
def test_system_id(spark, raw, want):
    assert spark.createDataFrame([(raw,)], "s string").select(text.system_id(F.col("s"))).first()[0] == want


CATEGORIES = [
    ("Connection timed out", "connection_timeout"), ("CONNECTION TO 10.0.0.1 port 22 timed out", "connection_timeout"),
    ("curl: (28) Operation timed out after 5 milliseconds with 0 bytes received", "partial_transfer_timeout"), ("curl: (28) Operation timed out", "connection_timeout"),
    ("ssh: connect to host 10.0.0.1 port 22: Connection refused", "connection_refused"), ("LOGIN INCORRECT", "credentials"), ("mget: Access failed: Permission denied (/x)", "permission_denied_partial"),
    ("JOB HALTED -> NON-CONFORMANT config", "config_missing"), ("JOB HALTED -> other", "job_halted"), ("NO TUNNEL FOUND", "tunnel_not_found"), ("NO TUNNEL FOUND\n", "unknown"),
    ("No new files detected", "no_new_data"), ("No new monitoring data found.", "unknown"), ("", "unknown"), (None, "unknown"), ("File not found", "unknown"),
]


def test_classify(spark):
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(CATEGORIES)], "i int, t string")
    got = [r.c for r in df.select("i", classify.category(F.col("t")).alias("c")).orderBy("i").collect()]
    assert got == [c for _, c in CATEGORIES]
    assert classify.taxonomy(spark).count() == 29 and not ({r[0] for r in classify.TRANSPORT} & {r[0] for r in classify.ENGINE})


def logs(spark, *payloads, app="hhm_rpp_ge"):
    return spark.createDataFrame([(f"r{i}", app, p, datetime(2026, 6, 1)) for i, p in enumerate(payloads)], "run_id string, app_name string, warn_error_logs string, inserted_at timestamp")


def test_flatten(spark):
    event = {"dt": "2026-06-02T14:03:31.1229+02:00", "type": "WARN-too-long", "func": "f" * 100, "tag": 7, "err_msg": "  \u0000 ", "note": {"sme": "s" * 33, "system_id": "sme00007", "message": "NO TUNNEL FOUND", "job_id": " j "}}
    df = logs(spark, json.dumps([event, "str", None, [1], {}]), '{"a":1}', "null", None, "<x/>", "[]", "")
    rows = {r.event_ord: r for r in materialize.flatten(df).collect()}
    assert set(rows) == {0, 4}
    r = rows[0]
    assert (r.type, len(r.func), r.tag, r.err_msg, r.note_message, len(r.sme), r.job_id, r.system_id, r.error_category) == ("WARN-too", 64, None, None, "NO TUNNEL FOUND", 16, "j", "SME00007", "tunnel_not_found")
    assert r.entity == "s" * 16 and str(r.dt) == "2026-06-02 12:03:31.122000"
    assert (rows[4].entity, rows[4].event_text, rows[4].dt) == ("__global__", "", None)
    skipped = sorted((r.run_id, r.event_ord if r.event_ord is not None else -1) for r in materialize.skipped(df).collect())
    assert skipped == [("r0", 1), ("r0", 2), ("r0", 3), ("r1", -1), ("r4", -1), ("r6", -1)]


@pytest.mark.parametrize("raw,want", [("Sun May 31 2026 14:40:29 GMT+0200 (x)", "2026-05-31 12:40:29"), ("2026-05-31", "2026-05-31 00:00:00"), ("soon", None), ("2026-13-01T00:00:00Z", None), (None, None)])
def test_event_time(spark, raw, want):
    got = spark.createDataFrame([(raw,)], "t string").select(materialize.event_time(F.col("t"))).first()[0]
    assert (str(got) if got else None) == want


def test_append_is_idempotent(spark):
    old = spark.createDataFrame([("a", 1, "x")], "run_id string, event_ord int, v string")
    new = spark.createDataFrame([("a", 1, "y"), ("b", 1, "z"), ("b", 1, "z"), (None, 1, "n")], "run_id string, event_ord int, v string")
    got = materialize.append_new(old, new, ["run_id", "event_ord"])
    assert [tuple(r) for r in got.collect()] == [("b", 1, "z")]
    assert materialize.append_new(old.unionByName(got), new, ["run_id", "event_ord"]).count() == 0


def test_cursors_are_monotone():
    late, early = datetime.fromisoformat("2026-06-02T00:00:00+00:00"), datetime.fromisoformat("2026-06-01T00:00:00+00:00")
    cursors = materialize.moved(materialize.moved({}, "s", late), "s", early)
    assert materialize.cursor({}, "s") == materialize.EPOCH and materialize.cursor(cursors, "s") == late


def test_of_equal_names_the_last_counts(spark):
    df = logs(spark, '[{"err_msg":"first","err_msg":"last","note":{"sme":"a","sme":"b"}}]')
    r = materialize.flatten(df).first()
    assert (r.err_msg, r.sme, materialize.skipped(df).count()) == ("last", "b", 0)
    assert spark.conf.get("spark.sql.variant.allowDuplicateKeys") == "false"


def test_raw_event_has_no_nul(spark):
    cases = ['{"a":"x\\u0000y","k\\u0000":[{"b":"\\u0000\\u0000"}]}', '{"a":"\\\\u0000"}', '{"a":"\\\\\\u0000z"}']
    df = logs(spark, "[" + ",".join(cases) + "]")
    got = [json.loads(r.raw_event) for r in materialize.flatten(df).orderBy("event_ord").collect()]
    assert got == [{"a": "xy", "k": [{"b": ""}]}, {"a": "\\u0000"}, {"a": "\\z"}]


def test_config(monkeypatch):
    with pytest.raises(ValueError):
        materialize.Config(producers=(SELF_APP,))
    monkeypatch.setenv("MATERIALIZE_OVERLAP_MS", " ")
    assert materialize.Config.from_env().overlap.total_seconds() == 30
    monkeypatch.setenv("MATERIALIZE_OVERLAP_MS", "-1")
    with pytest.raises(ValueError):
        materialize.Config.from_env()


def test_scan_reads_few_columns(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", 2000)
    df = materialize.source_scan(spark.read.parquet("/root/testdata/sf0.001/app_run_logs.parquet"), datetime.fromisoformat("2026-06-02T00:00:00+00:00"), datetime.fromisoformat("2026-06-09T00:00:00+00:00"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "verbose_log" not in plan and "PushedFilters: [" in plan and "In(app_name" in plan
