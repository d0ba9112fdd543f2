"""Streams over tables of many files, several of them a micro-batch."""

import os
from datetime import UTC, datetime, timedelta

from faultweave.plans import streams
from faultweave.streaming import events
from tests.oracle import compare


def test_sessions_keep_a_far_off_time_in_a_late_file(spark, tmp_path, monkeypatch):
    t = datetime(2026, 6, 1, 10, tzinfo=UTC)
    files = [[(t + timedelta(days=i % 15, seconds=i), "a"), (t + timedelta(minutes=20 * i), "b"), (None, "a")] for i in range(30)]
    files[25] += [(datetime(1970, 1, 1, tzinfo=UTC), "a"), (datetime(1970, 1, 1, 0, 20, tzinfo=UTC), "a")]
    files[29] += [(datetime(1970, 1, 1, 0, 40, tzinfo=UTC), "a")]
    at = tmp_path / "error_events.parquet"
    for i, rows in enumerate(files):
        spark.createDataFrame(rows, "dt timestamp, entity string").coalesce(1).write.mode("append").parquet(str(at))
        for p in at.glob("*.parquet"):  # files are taken by their age
            if p.stat().st_mtime > 2000 + i:
                os.utime(p, (1000 + i, 1000 + i))
    monkeypatch.setattr(streams, "_stream", lambda s, d, name: events.file_stream(s, f"{d}/{name}.parquet", s.read.parquet(f"{d}/{name}.parquet").schema, 4))
    compare(spark, streams.stream_sessions, streams.SQL["stream_sessions"], str(tmp_path))


def test_watermark_drops_state_but_no_event_in_time(spark, tmp_path):
    """Arrivals in order, event times up to 72 hours behind: every micro-batch after the first one has a watermark, nothing is lost, and
    what is further off is left out by its own arrival."""
    t = datetime(2026, 6, 1, tzinfo=UTC)
    rows = [(t + timedelta(hours=h) - timedelta(hours=late), t + timedelta(hours=h), "ab"[h % 2]) for h in range(0, 800, 2) for late in (0, 0.5, 71.9, 72, 72.1, 500, -1, -1.1, -9000)] + [(None, t, "a"), (t, None, "a")]
    spark.createDataFrame(rows, "dt timestamp, inserted_at timestamp, type string").coalesce(1).write.parquet(f"{tmp_path}/error_events.parquet")
    compare(spark, streams.stream_hourly, streams.SQL["stream_hourly"], str(tmp_path))
    seen = []
    s = events.windowed_counts(events.plausible(streams._stream(spark, str(tmp_path), "error_events")).select("dt", "type"), lateness="73 hours")
    q = s.writeStream.outputMode("update").trigger(availableNow=True).option("checkpointLocation", f"{tmp_path}/c").foreachBatch(lambda b, i: seen.append((i, b.count()))).start()
    q.awaitTermination()
    assert len(seen) >= streams.BATCHES
    progress = [p for p in q.recentProgress if p.stateOperators]
    assert sum(p.stateOperators[0].numRowsRemoved for p in progress) > 0 and sum(p.stateOperators[0].numRowsDroppedByWatermark for p in progress) == 0


def test_latest_sink_replaces_keys_and_skips_replays(spark):
    b = [spark.createDataFrame(x, "k string, n int") for x in ([("a", 1), (None, 1)], [("a", 2), ("b", 1)], [(None, 5)])]
    sink = events.LatestSink(spark, b[0].schema, ["k"])
    for i in (0, 1, 1, 0, 2):
        sink(b[i], i)
    assert {tuple(r) for r in events.LatestSink(spark, b[0].schema, ["k"], sink.files.path).current().collect()} == {("a", 2), ("b", 1), (None, 5)}


def test_timers_tell_of_keys_that_fell_silent(spark, tmp_path):
    t = datetime(2026, 6, 1, tzinfo=UTC)
    days = {"a": (0, 1, 9, 9.5, 30), "b": (0, 7, 14, 21, 28), "c": (5,), "d": (29.9,), None: (1, 20), "e": tuple(x / 1000 for x in range(0, 30_000, 7))}
    rows = [("f", k, t + timedelta(days=x)) for k, xs in days.items() for x in xs] + [("f", "a", None), (None, "a", t)]
    spark.createDataFrame(rows, "fingerprint string, entity string, inserted_at timestamp").coalesce(1).write.parquet(f"{tmp_path}/error_events.parquet")
    compare(spark, streams.stream_quiet, streams.SQL["stream_quiet"], str(tmp_path))
    got = {(r.entity, r.last_seen) for r in streams.stream_quiet(spark, str(tmp_path)).collect()}
    at = lambda x: (t + timedelta(days=x)).replace(tzinfo=None)
    assert got == {("a", at(1)), ("a", at(9.5)), ("c", at(5)), (None, at(1)), (None, at(20))}
