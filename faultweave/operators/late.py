"""Late and out-of-order events: counts per event-time period, corrected until a cut-off.

Raw events are retained, partitioned by day of event time and by batch. Each new batch names the days that it touches; those
partitions are recomputed entirely from the retained raw events and published by one new version of the store's state, which maps
each day to its current folder. A record that arrives after its hour was closed is put aside: it touches no day. Once a day is
closed, its counts are final and its raw events go.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import UTC, date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from faultweave.functions.time import DAY_US, HOUR_US, hour_us, utc_day, utc_hour
from faultweave.sources.tables import Scratch, Versions

PUBLISH_HOURS, CLOSE_HOURS = 2, 72
EXPIRED = "expired"
_EARLIEST = 10_000_000  # added to days, so that all are positive numbers of eight digits


def status(hour: Column, arrival: Column, publish_hours: int = PUBLISH_HOURS, close_hours: int = CLOSE_HOURS) -> Column:
    """``in_time`` up to publication (included), ``corrected`` up to the closing (included), then ``expired``. ``hour``: its start in µs."""
    after = F.unix_micros(arrival) - hour - HOUR_US
    return F.when(after <= publish_hours * HOUR_US, "in_time").when(after <= close_hours * HOUR_US, "corrected").when(after.isNotNull(), EXPIRED)


def _own(*columns: str) -> Column:
    """What tells rows without an identifier apart; null for the others."""
    return F.when(F.col("run_id").isNull() | F.col("item").isNull(), F.struct(*columns)).alias("own")


class PeriodStore:
    """Per-hour counts of records by event time.

    Input rows have ``source``, ``run_id``, ``item``, ``event_time`` and ``arrival``. A record is one (source, run_id, item); it
    arrives at the earliest arrival among its rows and belongs to the hour of its earliest event time among the rows of that
    day; a row that arrives after its own hour was closed is put aside (``expired()``) and counts for nothing, one that is early
    counts in its hour however far ahead that lies. Rows without event time or arrival belong to no hour and are left out; rows
    without run_id or item are records of their own per distinct (event_time, arrival). A batch id is ingested once; replays are
    skipped. Two writers of one store: the slower one gets a ``ConcurrentWriterError`` and its batch is in no version.
    """

    RAW = ("source", "run_id", "item", "event_time", "arrival")
    _SCHEMA = "source string, run_id string, item string, event_time timestamp, arrival timestamp, attempt string, day string, batch string"
    _RECORDS = "source string, run_id string, item string, event_time timestamp, arrival timestamp, rows bigint, hour timestamp, status string"

    def __init__(self, spark: SparkSession, path: str | None = None, publish_hours: int = PUBLISH_HOURS, close_hours: int = CLOSE_HOURS):
        self.spark, self.publish_hours, self.close_hours = spark, publish_hours, close_hours
        self.files = Scratch(spark, path)
        #: batches: ids; days: the folder of each day's records; raw: the folders of each open day's events; expired: those of what was put aside; closed: the last closed day; old: folders that the version before this one replaced
        self.state = Versions(self.files, "periods", {"batches": [], "days": {}, "raw": {}, "expired": [], "closed": "", "old": []})

    def ingest(self, batch_id: str, rows: DataFrame) -> list[str]:
        """Retain a batch and recompute what it touches; returns the touched days."""
        return self.ingest_all(rows, F.lit(batch_id)).get(batch_id, [])

    def ingest_all(self, rows: DataFrame, batch: Column, opens: Callable[[str], datetime] | None = None) -> dict[str, list[str]]:
        """Retain several batches in one pass over ``rows``, then take them one after the other in the order of their ids; returns the
        days that each touched. ``opens`` may give the time before which nothing of a batch arrived: days that have closed by
        then are final."""
        known = self.state.value["batches"]
        new = rows.select(*self.RAW, batch.cast("string").alias("batch")).where(F.col("event_time").isNotNull() & F.col("arrival").isNotNull())
        if known:
            new = new.where(~F.col("batch").isin(known))
        late = self._status("event_time") == EXPIRED
        attempt = f"raw/attempt={uuid.uuid4().hex}"
        self.files.save(new.withColumn("day", F.when(late, EXPIRED).otherwise(utc_day("event_time"))).hint("rebalance", "day", "batch"), attempt, "day", "batch")
        folders: dict[str, dict[str, str]] = {}
        for day in self.files.list(attempt):
            for b in self.files.list(f"{attempt}/{day}") if day.startswith("day=") else ():
                folders.setdefault(b.removeprefix("batch="), {})[day.removeprefix("day=")] = f"{attempt}/{day}/{b}"
        touched = {}
        for b in sorted(folders):
            if opens:
                self.close(opens(b))
            touched[b] = self._take(b, folders[b])
        return touched

    def _take(self, batch: str, folders: dict[str, str]) -> list[str]:
        """Recompute the days that one retained batch touches and publish them."""
        self.state.check()
        was = self.state.value
        put_aside = [at for day, at in folders.items() if day == EXPIRED or day <= was["closed"]]
        days = sorted(day for day in folders if day != EXPIRED and day > was["closed"])
        raw = was["raw"] | {day: [*was["raw"].get(day, ()), folders[day]] for day in days}
        version, replaced = f"state/v={self.state.number + 1:09d}-{uuid.uuid4().hex[:8]}", []
        if days:
            self.files.save(self._recomputed([at for day in days for at in raw[day]]), version, "day")
            replaced = [f"{was['days'][day]}/day={day}" for day in days if day in was["days"]]
        self._publish(was | {"batches": [*was["batches"], batch], "days": was["days"] | dict.fromkeys(days, version), "raw": raw, "expired": [*was["expired"], *put_aside]}, replaced)
        return days

    def _publish(self, value: dict, replaced: list[str]) -> None:
        """A new version; what it replaces goes with the next one, so that who reads the last version can finish."""
        old = self.state.value["old"]
        self.state.publish(value | {"old": replaced})
        for folder in old:
            self.files.drop(folder)

    def close(self, until: datetime) -> list[str]:
        """Close the days whose last hour closed before ``until``: their counts are final and their raw events go. Returns them."""
        was = self.state.value
        over = -(-(until.timestamp() - self.close_hours * 3600) // 86_400) - 2  # the last such day, counted from 1970
        last = str(date.fromordinal(max(1, date(1970, 1, 1).toordinal() + int(over))))
        days = [day for day in was["raw"] if day <= last]
        if days:
            self._publish(was | {"raw": {d: x for d, x in was["raw"].items() if d not in days}, "closed": max(last, was["closed"])}, [at for d in days for at in was["raw"][d]])
        return days

    def vacuum(self) -> list[str]:
        """Remove what writers left that died before they published; only while no writer is at work. Returns the folders."""
        v = self.state.value
        used = {x.split("/")[1] for x in (*(at for at_ in v["raw"].values() for at in at_), *v["expired"], *v["days"].values(), *v["old"])}
        lost = [f"{kind}/{name}" for kind in ("raw", "state") for name in self.files.list(kind) if name not in used]
        for folder in lost:
            self.files.drop(folder)
        return lost

    def _status(self, time: str) -> Column:
        return status(hour_us(time), F.col("arrival"), self.publish_hours, self.close_hours)

    def _raw(self, folders: list[str]) -> DataFrame:
        return self.spark.read.schema(self._SCHEMA).option("basePath", self.files.at("raw")).parquet(*map(self.files.at, folders))

    def _recomputed(self, folders: list[str]) -> DataFrame:
        """The records of the days in ``folders``: one shuffle by record; adaptive execution sizes its partitions and so the files."""
        records = (
            self._raw(folders).groupBy("day", "source", "run_id", "item", _own("event_time", "arrival"))
            .agg(F.min("event_time").alias("event_time"), F.min("arrival").alias("arrival"), F.count(F.lit(1)).alias("rows"))
        )
        return records.select("source", "run_id", "item", "event_time", "arrival", "rows", utc_hour("event_time").alias("hour"), self._status("event_time").alias("status"), "day")

    def expired(self) -> DataFrame:
        """The rows that arrived after their hour was closed."""
        at = self.state.value["expired"]
        return self._raw(at).select(*self.RAW) if at else self.spark.createDataFrame([], self._SCHEMA).select(*self.RAW)

    def records(self) -> DataFrame:
        """The records of all published days, each with its hour, arrival and status."""
        paths = [self.files.at(f"{v}/day={d}") for d, v in sorted(self.state.value["days"].items())]
        return self.spark.read.schema(self._RECORDS).parquet(*paths) if paths else self.spark.createDataFrame([], self._RECORDS)

    def counts(self) -> DataFrame:
        """Per source and hour: the records when it was published, the corrections since, and the corrected count."""
        n = lambda s: F.count_if(F.col("status") == s)
        return self.records().groupBy("source", "hour").agg(n("in_time").alias("published"), n("corrected").alias("corrections"), F.count(F.lit(1)).alias("records"))


def ingest_by_arrival(store: PeriodStore, rows: DataFrame) -> PeriodStore:
    """Feed ``rows`` to the store in the order of arrival, a batch for each day (UTC) of arrival, and close days as it goes on.

    The number of batches is bounded by the calendar, not by the rows: a year has 366.
    """
    number = F.floor(F.unix_micros("arrival") / F.lit(DAY_US)) + _EARLIEST
    store.ingest_all(rows, F.lpad(number.cast("string"), 8, "0"), lambda batch: datetime.fromtimestamp((int(batch) - _EARLIEST) * 86_400, UTC))
    return store
