"""Defined results of the general operators: nulls, empty tables, ties, repeats, clashing names, hot keys."""

import itertools
import random
from collections import Counter, defaultdict
from datetime import UTC, datetime, timedelta

from pyspark.sql import functions as F

from faultweave.functions.ids import canonical_run_id
from faultweave.operators import late, orphans, skew
from faultweave.operators.dedupe import COPIES, RUN, UpsertStore, keep_one

T0 = datetime(2026, 6, 1, tzinfo=UTC)


def at(hours):
    return None if hours is None else T0 + timedelta(hours=hours)


def test_canonical_run_id(spark):
    u = "0de7103d-d48a-4617-a64f-6fc99d9cba0c"
    spelt = [u, u.upper(), u.replace("-", ""), "{" + u + "}", f" {u} ", f"{u}\t", "urn:uuid:" + u, None, "", "  ", "Not-A Uuid", "NOT-A uuid "]
    df = spark.createDataFrame([(i, s) for i, s in enumerate(spelt)], "i int, s string")
    got = [r.c for r in df.select("i", canonical_run_id("s").alias("c")).orderBy("i").collect()]
    assert got == [u] * 7 + [None] * 3 + ["not-a uuid"] * 2


def brute_states(rows, gap):
    groups = defaultdict(list)
    for k, e, t in rows:
        groups[k, e].append(t)
    out = {}
    for k, ts in groups.items():
        timed = sorted(t for t in ts if t is not None)
        gaps = [b - a for a, b in itertools.pairwise(timed)]
        out[k] = (len(ts), len(timed), timed[0] if timed else None, timed[-1] if timed else None, (1 + sum(g > gap for g in gaps)) if timed else 0, max(gaps, default=0))
    return out


def test_key_states_of_a_hot_key(spark):
    r = random.Random(3)
    rows = [(r.choice(["hot"] * 6 + ["a", "b", None]), r.choice(["x", "x", None]), r.choice([None, *range(0, 4000, 7)])) for _ in range(6000)]
    df = spark.createDataFrame([(k, e, at(t / 60) if t is not None else None, i, 1) for i, (k, e, t) in enumerate(rows)], "fp string, k0 string, us timestamp, id int, n int")
    out = skew.key_states(df, ["fp", "k0"], "us", ["id"], gap_seconds=600, partitions=7)
    us = lambda t: None if t is None else int(T0.timestamp() * 1e6) + t * 60_000_000
    want = {k: (v[0], v[1], us(v[2]), us(v[3]), v[4], v[5] * 60_000_000) for k, v in brute_states(rows, 10).items()}
    assert {(x.fp, x.k0): tuple(x)[2:] for x in out.collect()} == want


def test_key_states_empty(spark):
    df = spark.createDataFrame([], "k string, t timestamp, id int")
    assert skew.key_states(df, ["k"], "t", ["id"]).count() == 0


def test_key_states_splits_the_hot_key(spark):
    df = spark.range(20000).select(F.lit("hot").alias("k"), F.timestamp_seconds("id").alias("t"), "id")
    parts = df.repartitionByRange(8, "k", "t", "id").groupBy(F.spark_partition_id()).count().collect()
    assert len(parts) == 8 and max(p["count"] for p in parts) < 2 * 20000 / 8


def test_late_status_edges(spark):
    """Exactly at publication is in time, exactly at closing is a correction."""
    rows = [("s", f"r{i}", "1", at(0.5), at(1) + timedelta(hours=h, microseconds=u)) for i, (h, u) in enumerate([(2, 0), (2, 1), (72, 0), (72, 1), (-5, 0)])]
    store = late.PeriodStore(spark)
    store.ingest("b", spark.createDataFrame(rows, "source string, run_id string, item string, event_time timestamp, arrival timestamp"))
    assert {r.run_id: r.status for r in store.records().collect()} == {"r0": "in_time", "r1": "corrected", "r2": "corrected", "r4": "in_time"}


def test_late_batches_equal_one_batch(spark):
    r = random.Random(8)
    rows = []
    for i in range(400):
        t = at(r.uniform(0, 60)) if r.random() > 0.05 else None
        base = (r.choice(["s", "t"]), f"r{r.randrange(90)}" if r.random() > 0.05 else None, str(r.randrange(3)) if r.random() > 0.05 else None, t)
        for _ in range(r.choice([1, 1, 1, 2, 3])):
            rows.append((*base, at(r.choice([0, 1, 2.5, 5, 40, 80, 200]) + (t - T0).total_seconds() / 3600 if t else 5) if r.random() > 0.03 else None))
    df = spark.createDataFrame(rows, "source string, run_id string, item string, event_time timestamp, arrival timestamp")
    one = late.PeriodStore(spark)
    one.ingest("all", df)
    many = late.ingest_by_arrival(late.PeriodStore(spark), df)
    assert len(many.state.value["batches"]) > 8 and many.state.value["closed"] > "2026-06-01" and many.expired().count() == one.expired().count() > 0
    assert sorted(map(tuple, one.counts().collect())) == sorted(map(tuple, many.counts().collect()))
    key = lambda s: Counter((x.source, x.run_id, x.item, x.event_time, x.arrival, x.status) for x in s.records().collect())
    assert key(one) == key(many)


def test_late_replay_and_reopen(spark):
    df = spark.createDataFrame([("s", "r", "1", at(0), at(1)), ("s", "q", "1", at(0), at(6))], "source string, run_id string, item string, event_time timestamp, arrival timestamp")
    store = late.PeriodStore(spark)
    assert store.ingest("b1", df) == ["2026-06-01"] and store.ingest("b1", df) == []
    again = late.PeriodStore(spark, store.files.path)
    assert again.ingest("b1", df) == []
    assert [(x.published, x.corrections, x.records) for x in again.counts().collect()] == [(1, 1, 2)]


def test_late_empty(spark):
    store = late.PeriodStore(spark)
    store.ingest("e", spark.createDataFrame([], "source string, run_id string, item string, event_time timestamp, arrival timestamp"))
    assert store.counts().count() == 0 and store.records().count() == 0


def test_orphans(spark):
    r = random.Random(1)
    parents = [(f"p{i}", i) for i in range(3000)] + [(None, 1), ("p1", 2)]
    refs = [("hot", "d", "p7")] * 500 + [(r.choice("xy"), r.choice("de"), f"p{r.randrange(2000, 4000)}") for _ in range(800)] + [("x", None, None), ("x", None, "zz"), ("x", None, "zz")]
    p, f = spark.createDataFrame(parents, "block string, bits int"), spark.createDataFrame(refs, "bits string, block string, k string")
    have = {k for k, _ in parents}
    want = {x for x in refs if x[2] is not None and x[2] not in have}
    assert sorted(map(repr, map(tuple, orphans.orphans(f, p, "k", "block").collect()))) == sorted(map(repr, want))
    assert sorted(map(repr, map(tuple, orphans.orphans(f, p, "k", "block", max_bits=1).collect()))) == sorted(map(repr, want))


def test_orphans_of_empty_tables(spark):
    p, f = spark.createDataFrame([], "id string"), spark.createDataFrame([("a",), ("a",), (None,)], "k string")
    assert [tuple(x) for x in orphans.orphans(f, p, "k", "id").collect()] == [("a",)]
    assert orphans.orphans(f.limit(0), p, "k", "id").count() == 0


def test_bloom_filter_has_no_false_negatives(spark):
    p = spark.range(20000).select(F.concat(F.lit("k"), "id").alias("k"))
    words = orphans.bloom_filter(p, "k", orphans.filter_blocks(20000))
    blocks = orphans.filter_blocks(20000)
    test = lambda df: df.withColumn("block", orphans._block(F.col("k"), blocks)).join(words, "block", "left").where(F.coalesce(F.col("bits").bitwiseAND(orphans._mask(F.col("k"))) == orphans._mask(F.col("k")), F.lit(False)))
    assert test(p).count() == 20000
    other = spark.range(20000, 40000).select(F.concat(F.lit("k"), "id").alias("k"))
    assert test(other).count() < 1000  # most orphans are proven by the filter


def rows_of(df):
    return sorted(map(repr, map(tuple, df.collect())))


def test_keep_one(spark):
    df = spark.createDataFrame([("a", 1, 5, "x"), ("a", 1, 7, "y"), ("a", 1, 7, "z"), (None, 1, None, None), (None, 1, None, None), ("b", None, None, "q"), ("b", None, 1, None)], "row string, o0 int, __t int, v string")
    got = keep_one(df.withColumnRenamed("__t", "t"), ["row", "o0"], [F.col("t")])
    assert rows_of(got) == sorted(map(repr, [("a", 1, 7, "z", 3), (None, 1, None, None, 2), ("b", None, 1, None, 2)]))
    assert keep_one(df.limit(0), ["row"], [F.col("o0")]).count() == 0


def test_upsert_store_is_idempotent(spark):
    schema = "id string, ord int, at int, body string"
    b1 = spark.createDataFrame([("a", 1, 1, "old"), ("a", 1, 1, "old"), ("b", 1, 1, "one"), (None, None, 0, "null")], schema)
    b2 = spark.createDataFrame([("a", 1, 3, "new"), ("c", 2, 2, "two"), (None, None, 0, "null")], schema)
    store = UpsertStore(spark, ["id", "ord"], ["at"], buckets=4)
    assert store.upsert("1", b1) and not store.upsert("1", b1) and store.upsert("2", b2) and store.upsert("3", b1.limit(0))
    want = sorted(map(repr, [("a", 1, "new", 3), ("b", 1, "one", 1), ("c", 2, "two", 1), (None, None, "null", 2)]))
    shown = lambda df: rows_of(df.select("id", "ord", "body", COPIES))
    assert shown(store.merged()) == want
    assert shown(store.compact()) == want
    # a batch that was written but not published counts once when it is sent again
    store._append(store._one(b2).withColumn(RUN, F.lit("lost")), store.state.value["folder"], 4)
    assert shown(store.merged()) == want
    store.upsert("4", b2)
    assert {r.id: r[COPIES] for r in store.merged().collect()} == {"a": 4, "b": 1, "c": 2, None: 3}
    again = UpsertStore(spark, ["id", "ord"], ["at"], path=store.files.path)
    assert not again.upsert("4", b2) and shown(again.merged()) == shown(store.merged())


def test_compaction_does_not_shuffle(spark):
    store = UpsertStore(spark, ["id"], ["at"], buckets=4)
    for i in range(3):
        store.upsert(str(i), spark.range(1000).select("id", F.lit(i).alias("at")))
    plan = store.merged()._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    out = store.compact()
    assert out.count() == 1000 and out.where(f"at = 2 AND {COPIES} = 3").count() == 1000
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("fw_")]


def test_compaction_makes_more_buckets(spark):
    store = UpsertStore(spark, ["id"], ["at"], buckets=2, bucket_rows=100)
    store.upsert("a", spark.range(1000).select("id", F.lit(1).alias("at")))
    assert store.compact().count() == 1000 and store.state.value["buckets"] == 10
    store.upsert("b", spark.range(500, 1500).select("id", F.lit(2).alias("at")))
    plan = store.merged()._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and store.compact().where("at = 2").count() == 1000 and store.merged().count() == 1500


def test_p6_found_keeps_the_messages(spark, monkeypatch):
    from faultweave.plans import preparation

    kept = []
    compact = preparation.UpsertStore.compact

    def spy(store):
        kept.append(compact(store))
        return kept[-1]

    monkeypatch.setattr(preparation.UpsertStore, "compact", spy)
    preparation.p6_found(spark, "/root/testdata/sf0.001").count()
    assert set(preparation._MESSAGE) <= set(kept[0].columns)


def test_large_filter_is_joined_by_block(spark):
    p, f = spark.range(0, 5000, 2).select(F.col("id").cast("string").alias("id")), spark.range(5000).select(F.col("id").cast("string").alias("k"))
    out = orphans.orphans(f, p, "k", "id", max_bits=1)
    assert {int(r.k) for r in out.collect()} == set(range(1, 5000, 2)) and out.count() == 2500
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "bit_or" in plan and "strategy=broadcast" not in plan
