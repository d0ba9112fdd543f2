"""Streams of run logs and facts: flattening, deduplication within a watermark, windows of event time, and incremental incidents.

The column functions are those of the batch plans. Sources are file streams, so offsets are exactly-once; sinks that merge do
so in ``foreachBatch`` with the batch id in the manifest, so that a replayed batch changes nothing.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from datetime import timedelta

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState

from faultweave.functions.ids import canonical_run_id
from faultweave.functions.time import DAY_US, HOUR_US
from faultweave.operators import incidents
from faultweave.sources.tables import Scratch, Versions


def file_stream(spark: SparkSession, path: str, schema, files_per_trigger: int | None = None) -> DataFrame:
    """A stream of the Parquet files under ``path`` (a folder or one file)."""
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    if p.getFileSystem(spark._jsc.hadoopConfiguration()).isFile(p):  # a stream watches folders
        return reader.option("pathGlobFilter", p.getName()).parquet(p.getParent().toString())
    return reader.parquet(path)


def first_deliveries(events: DataFrame, lateness: str = "10 days") -> DataFrame:
    """Each (run_id, event_ord) once, as long as its copies arrive within ``lateness`` of each other; state is dropped after that."""
    e = events.withColumn("run_id", canonical_run_id("run_id"))
    return e.withWatermark("inserted_at", lateness).dropDuplicatesWithinWatermark(["run_id", "event_ord"])


def windowed_counts(events: DataFrame, window: str = "1 hour", lateness: str = "3 days", time: str = "dt", by: tuple[str, ...] = ("type",)) -> DataFrame:
    """Counts per window of event time and ``by``; a record later than ``lateness`` behind the newest one is left out."""
    e = events.where(F.col(time).isNotNull()).withWatermark(time, lateness)
    return e.groupBy(F.window(time, window).alias("w"), *by).agg(F.count(F.lit(1)).alias("events")).select(F.col("w.start").alias("window_start"), *by, "events")


def sessions(events: DataFrame, gap: str = "30 minutes", lateness: str | None = "3 days", time: str = "dt", by: tuple[str, ...] = ("entity",)) -> DataFrame:
    """Counts per session of event time: events at most ``gap`` apart. A record later than ``lateness`` behind the newest one is
    left out, in complete mode too; with None there is no watermark and every record counts, in complete mode only."""
    e = events.where(F.col(time).isNotNull())
    e = e if lateness is None else e.withWatermark(time, lateness)
    s = e.groupBy(F.session_window(time, gap).alias("w"), *by).agg(F.count(F.lit(1)).alias("events"))
    return s.select(F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"), *by, "events")


def _run(batch: DataFrame) -> None:
    """Run a micro-batch whose rows are known already: its state has to be committed all the same."""
    batch.write.format("noop").mode("overwrite").save()


class IncidentSink:
    """``foreachBatch`` target that keeps the incidents as versioned snapshots.

    Each micro-batch is rolled up and merged with the current version into a new one, which the sink's state then names together
    with the batch id; a batch id at or below the last one is skipped.
    """

    def __init__(self, spark: SparkSession, outcomes: DataFrame, path: str | None = None):
        self.spark, self.outcomes = spark, outcomes
        self.files = Scratch(spark, path)
        self.state = Versions(self.files, "incidents", {"batch": -1, "version": None})

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        if batch_id <= self.state.value["batch"]:
            return _run(batch)
        self.state.check()
        rolled = self.files.save(incidents.rollup(incidents.message(batch.where("fingerprint IS NOT NULL"))), "delta")  # the micro-batch runs once
        delta = incidents.enrich(rolled, self.outcomes)
        old = self.current()
        merged = incidents.merge(old, delta).drop("inserted") if old is not None else delta
        version, before = f"v={batch_id:09d}-{uuid.uuid4().hex[:8]}", self.state.value["version"]
        self.files.save(merged, version)
        self.state.publish({"batch": batch_id, "version": version})
        if before:
            self.files.drop(before)

    def current(self) -> DataFrame | None:
        v = self.state.value["version"]
        return self.spark.read.parquet(self.files.at(v)) if v else None


def quiet_spells(events: DataFrame, keys: list[str], at: str = "inserted_at", quiet: timedelta = timedelta(days=7), lateness: str = "1 hour") -> DataFrame:
    """The spells of more than ``quiet`` (a day at least) without an event of a key: the keys, ``last_seen`` and ``quiet_at``.

    An event-time timer per key: each event sets it anew, and it goes off once the watermark has passed, so that a key that fell
    silent is told of without any event of its own; then its state goes. The state is one time per key. A micro-batch's events of a
    key are read in chunks and kept as the first and last of each day, so a heavy key takes no more memory than others.
    """
    spell = quiet // timedelta(microseconds=1)

    def run(key: tuple, chunks: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        last = state.get[0] if state.exists else None
        silent = []
        if state.hasTimedOut:
            silent.append(last)
            state.remove()
        else:
            days: dict[int, tuple[int, int]] = {}
            for chunk in chunks:
                for day, (low, high) in chunk["us"].groupby(chunk["us"] // DAY_US).agg(["min", "max"]).iterrows():
                    a, b = days.get(day, (low, high))
                    days[day] = min(a, low), max(b, high)
            for low, high in sorted(days.values()):
                if last is not None and low - last > spell:
                    silent.append(last)
                last = high if last is None else max(last, high)
            state.update((int(last),))
            state.setTimeoutTimestamp((int(last) + spell) // 1000)
        yield pd.DataFrame([(*key, x, x + spell) for x in silent], columns=[*keys, "last_us", "quiet_us"]).astype({"last_us": "int64", "quiet_us": "int64"})

    kinds = ", ".join(f"`{k}` {events.schema[k].dataType.simpleString()}" for k in keys)
    timed = events.where(F.col(at).isNotNull()).withWatermark(at, lateness).select(*keys, at, F.unix_micros(at).alias("us"))
    spells = timed.groupBy(*keys).applyInPandasWithState(run, f"{kinds}, last_us long, quiet_us long", "last long", "append", "EventTimeTimeout")
    return spells.select(*keys, F.timestamp_micros("last_us").alias("last_seen"), F.timestamp_micros("quiet_us").alias("quiet_at"))


class LatestSink:
    """``foreachBatch`` target for update and complete mode: a table in versions.

    A micro-batch replaces the rows of its ``keys``, without keys all rows; a batch id at or below the last one is skipped, so a
    replay changes nothing.
    """

    def __init__(self, spark: SparkSession, schema, keys: list[str] | None = None, path: str | None = None):
        self.spark, self.keys, self.schema = spark, keys, schema
        self.files = Scratch(spark, path)
        self.state = Versions(self.files, "latest", {"batch": -1, "version": None})

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        if batch_id <= self.state.value["batch"]:
            return _run(batch)
        self.state.check()
        before, version = self.state.value["version"], f"v={batch_id:09d}-{uuid.uuid4().hex[:8]}"
        if self.keys:
            batch = self.files.save(batch, "delta")  # the micro-batch runs once
            same = [F.col(f"o.{k}").eqNullSafe(F.col(f"n.{k}")) for k in self.keys]
            batch = self.current().alias("o").join(batch.select(*self.keys).alias("n"), same, "left_anti").unionByName(batch)
        self.files.save(batch, version)
        self.state.publish({"batch": batch_id, "version": version})
        if before:
            self.files.drop(before)

    def current(self) -> DataFrame:
        v = self.state.value["version"]
        return self.spark.read.schema(self.schema).parquet(self.files.at(v)) if v else self.spark.createDataFrame([], self.schema)


def in_order(rows: DataFrame, at: str, path: str, least: int = 8, rows_per_file: int = 2_000_000) -> str:
    """``rows`` as files whose times ascend with the column ``at``, as if they had been delivered in that order; a stream over the
    folder gets them one after the other. Rows without ``at`` come first."""
    files = Scratch(rows.sparkSession, path)
    number = max(least, -(-rows.count() // rows_per_file))
    files.save(rows.repartitionByRange(number, F.col(at).asc_nulls_first()), "arrived")
    for i, name in enumerate(n for n in files.list("arrived") if n.startswith("part-")):
        files.touch(f"arrived/{name}", 1_000_000_000_000 + i * 1000)
    return files.at("arrived")


def plausible(events: DataFrame, time: str = "dt", arrival: str = "inserted_at", late_hours: int = 72, early_hours: int = 1) -> DataFrame:
    """The events whose time is at most ``late_hours`` before and ``early_hours`` after their arrival: what is later or further off is no
    business of a stream. If arrivals ascend, a watermark of the sum of both hours drops none of these."""
    age = F.unix_micros(arrival) - F.unix_micros(time)
    return events.where((age <= late_hours * HOUR_US) & (age >= -early_hours * HOUR_US))


def run_available(df: DataFrame, name: str = "out", mode: str = "append", each: Callable[[DataFrame, int], None] | None = None) -> DataFrame | None:
    """Run a stream over what is there now, in micro-batches. Without ``each`` its rows go to a table, which is returned: all of them in
    append mode, the last version in complete mode."""
    spark = df.sparkSession
    s = Scratch(spark)
    writer = df.writeStream.option("checkpointLocation", s.at("checkpoint")).trigger(availableNow=True)
    if each is not None:
        writer.outputMode(mode).foreachBatch(each).start().awaitTermination()
        return None
    if mode == "append":
        writer.format("parquet").outputMode("append").option("path", s.at(name)).start().awaitTermination()
        return spark.read.schema(df.schema).parquet(s.at(name))
    sink = LatestSink(spark, df.schema)
    writer.outputMode(mode).foreachBatch(sink).start().awaitTermination()
    return sink.current()
