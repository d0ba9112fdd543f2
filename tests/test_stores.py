"""Stores whose writer dies between any two steps, and stores with two writers."""

import pytest
from pyspark.sql import functions as F

from faultweave.operators import late
from faultweave.operators.dedupe import COPIES, UpsertStore
from faultweave.sources.tables import ConcurrentWriterError, Scratch, Versions
from tests.test_preparation import at

EVENTS = "source string, run_id string, item string, event_time timestamp, arrival timestamp"


class Died(Exception):
    pass


def dying(monkeypatch, step, after):
    """Let the ``step``-th call that touches the store's folder fail, before or after its work; returns the calls seen."""
    seen = []
    for owner, name in ((Scratch, "save"), (Scratch, "create"), (Scratch, "drop"), (UpsertStore, "_append")):
        real = getattr(owner, name)

        def call(*args, _real=real, **kw):
            seen.append(1)
            if len(seen) == step and not after:
                raise Died
            out = _real(*args, **kw)
            if len(seen) == step:
                raise Died
            return out

        monkeypatch.setattr(owner, name, call)
    return seen


def check(spark, make, first, second, shown):
    """Whenever the writer of ``second`` dies, a new store shows what was before or what comes after, and a retry gives the latter."""
    old_store = make(None)
    first(old_store)
    old = shown(make(old_store.files.path))
    second(old_store)
    new = shown(make(old_store.files.path))
    assert old != new
    step, outcomes = 1, set()
    while True:
        for after in (False, True):
            store = make(None)
            first(store)
            with pytest.MonkeyPatch.context() as mp:
                seen = dying(mp, step, after)
                try:
                    second(store)
                except Died:
                    pass
            found = shown(make(store.files.path))
            assert found in (old, new), (step, after)
            outcomes.add(found == new)
            again = make(store.files.path)
            second(again)
            assert shown(again) == shown(make(store.files.path)) == new, (step, after)
        if len(seen) < step:
            break
        step += 1
    assert outcomes == {False, True} and step > 2


def test_period_store_survives(spark):
    b1 = spark.createDataFrame([("s", "r", "1", at(0), at(1)), ("s", "q", "1", at(30), at(31)), ("s", "x", "1", at(0), at(400))], EVENTS)
    b2 = spark.createDataFrame([("s", "q", "1", at(30), at(36)), ("s", "q", "2", at(30), at(36)), ("s", "p", "1", at(1), at(9))], EVENTS)
    check(
        spark, lambda path: late.PeriodStore(spark, path), lambda s: s.ingest("1", b1), lambda s: s.ingest("2", b2),
        lambda s: (sorted(map(str, s.counts().collect())), s.expired().count()),
    )


def test_upsert_store_survives(spark):
    b1 = spark.createDataFrame([("a", 1, "old"), ("b", 1, "one")], "id string, at int, body string")
    b2 = spark.createDataFrame([("a", 2, "new"), ("c", 1, "two")], "id string, at int, body string")

    def second(s):
        s.upsert("2", b2)
        s.compact()

    check(spark, lambda path: UpsertStore(spark, ["id"], ["at"], buckets=2, path=path), lambda s: s.upsert("1", b1), second, lambda s: sorted(map(tuple, s.merged().select("id", "body", COPIES).collect())))


def test_vacuum_removes_only_what_is_lost(spark):
    store = late.PeriodStore(spark)
    store.ingest("1", spark.createDataFrame([("s", "r", "1", at(0), at(1)), ("s", "x", "1", at(0), at(400))], EVENTS))
    store.ingest("2", spark.createDataFrame([("s", "r", "2", at(0), at(2))], EVENTS))
    before = sorted(map(str, store.counts().collect()))
    store.files.save(spark.range(1), "raw/attempt=lost")
    store.files.save(spark.range(1), "state/v=lost")
    again = late.PeriodStore(spark, store.files.path)
    assert sorted(x for x in again.vacuum() if "lost" in x) == ["raw/attempt=lost", "state/v=lost"]
    assert sorted(map(str, again.counts().collect())) == before and again.expired().count() == 1
    again.ingest("3", spark.createDataFrame([("s", "r", "3", at(0), at(3))], EVENTS))
    assert again.records().count() == 3


def test_second_writer_is_refused(spark):
    a = late.PeriodStore(spark)
    a.ingest("1", spark.createDataFrame([("s", "r", "1", at(0), at(1))], EVENTS))
    b = late.PeriodStore(spark, a.files.path)
    a.ingest("2", spark.createDataFrame([("s", "r", "2", at(0), at(2))], EVENTS))
    with pytest.raises(ConcurrentWriterError):
        b.ingest("3", spark.createDataFrame([("s", "r", "3", at(0), at(2))], EVENTS))
    assert late.PeriodStore(spark, a.files.path).records().count() == 2
    m = UpsertStore(spark, ["id"], ["id"], buckets=2)
    m.upsert("1", spark.range(5))
    n = UpsertStore(spark, ["id"], ["id"], path=m.files.path)
    m.upsert("2", spark.range(5, 9))
    with pytest.raises(ConcurrentWriterError):
        n.upsert("3", spark.range(20))
    assert UpsertStore(spark, ["id"], ["id"], path=m.files.path).merged().count() == 9


def test_versions_are_whole_and_few(spark):
    files = Scratch(spark)
    a = Versions(files, "v", {"n": 0})
    for n in range(5):
        a.publish({"n": n})
    assert Versions(files, "v", {}).value == {"n": 4} and len(files.list()) == 2
    assert not files.create("v-000000000005.json", "{}") and files.read("v-000000000005.json") == '{"n": 4}'


def test_shared_folder_is_needed_on_a_cluster(spark):
    from types import SimpleNamespace

    from faultweave.sources.tables import shared_root

    cluster = SimpleNamespace(conf=SimpleNamespace(get=lambda *_: None), sparkContext=SimpleNamespace(master="spark://host:7077"))
    with pytest.raises(RuntimeError):
        shared_root(cluster)


def test_closed_days_keep_their_counts_and_lose_their_events(spark):
    store = late.PeriodStore(spark)
    store.ingest("1", spark.createDataFrame([("s", "r", "1", at(0), at(1)), ("s", "r", "9", at(49), at(50))], EVENTS))
    assert store.close(at(24 + 72).replace(tzinfo=at(0).tzinfo)) == []  # an arrival exactly at the closing still counts
    assert store.close(at(24 + 72 + 1)) == ["2026-06-01"] and list(store.state.value["raw"]) == ["2026-06-03"]
    assert store.ingest("2", spark.createDataFrame([("s", "r", "2", at(1), at(2))], EVENTS)) == []  # in time by itself, but its batch came after the day was closed
    assert store.records().count() == 2 and store.expired().count() == 1
    assert store.files.list("raw") and F is not None
