"""The incident store end to end: facts at rest, incidents as versioned snapshots, and the cursors of both.

All three change together: a step writes its files first and then publishes one new version of the store's state, which names
them. A replayed or overlapping window appends nothing that is there already; of two writers one is refused.
"""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faultweave.functions.time import utc_day
from faultweave.operators import incidents, materialize
from faultweave.operators.runlog import RunLog
from faultweave.sources.tables import Scratch, Versions

KEYS = ["run_id", "event_ord"]
#: Cursor names: of the logs' arrival, and of the facts' arrival.
LOGS, FACTS = "util.app_run_logs", "incidents.error_events"


class IncidentStore:
    """Facts and incidents under one folder.

    Facts are partitioned by the UTC day of their arrival and sorted by incident and time within a file, so that a window of arrival
    reads its days and a drill-down the row groups of its incident. Each has ``ts`` and ``msg``, the representative text, so
    that no later step parses ``raw_event`` again.
    """

    def __init__(self, spark: SparkSession, path: str | None = None, config: materialize.Config = materialize.Config()):
        self.spark, self.config = spark, config
        self.files = Scratch(spark, path)
        #: loads: folders of facts; schema: of the facts; snapshot: folder of the incidents; cursors: by source; old: folders that the version before this one replaced
        self.state = Versions(self.files, "store", {"loads": [], "schema": None, "snapshot": None, "cursors": {}, "old": []})

    def _publish(self, value: dict, replaced: list[str]) -> None:
        old = self.state.value["old"]
        self.state.publish(value | {"old": replaced})
        for folder in old:
            self.files.drop(folder)

    def there(self) -> bool:
        """Whether the folders that the state names are still there."""
        v = self.state.value
        return all(map(self.files.exists, [*v["loads"], *([v["snapshot"]] if v["snapshot"] else [])]))

    def cursor(self, source: str) -> datetime:
        return materialize.cursor(self.state.value["cursors"], source)

    def facts(self, after: datetime | None = None, until: datetime | None = None) -> DataFrame:
        """The facts that arrived in (after, until]; the days outside are not listed in the scan."""
        v, at, day = self.state.value, F.col("inserted_at"), F.col("arrived")
        if not v["loads"]:
            raise ValueError("the store has no facts yet")
        df = self.spark.read.schema(f"{v['schema']}, load string, arrived string").option("basePath", self.files.at("facts")).parquet(*map(self.files.at, v["loads"]))
        if after is not None and after > materialize.EPOCH:
            df = df.where((day >= str(after.date())) & (at > F.lit(after)))
        if until is not None and until.year < 9999:
            df = df.where((day <= str(until.date())) & (at <= F.lit(until)))
        return df.drop("load", "arrived")

    def incidents(self) -> DataFrame | None:
        v = self.state.value["snapshot"]
        return self.spark.read.parquet(self.files.at(v)).drop("outcome") if v else None

    def _load(self, rows: DataFrame) -> str:
        folder = f"facts/load={uuid.uuid4().hex}"
        laid = rows.withColumn("arrived", F.coalesce(utc_day("inserted_at"), F.lit("unknown"))).hint("rebalance", "arrived")
        self.files.save(laid.sortWithinPartitions("arrived", "fingerprint", "entity", F.desc("dt")), folder, "arrived")
        return folder

    def append(self, rows: DataFrame, cursors: dict[str, str] | None = None) -> int:
        """Append the facts whose (run_id, event_ord) the store has not, each once: its first delivery. Returns how many; the cursors are
        published with them. Rows without a key are refused."""
        self.state.check()
        was = self.state.value
        new = incidents.without_repeats(rows.where("run_id IS NOT NULL AND event_ord IS NOT NULL"))
        if was["loads"]:
            # written first, so that its size is known: the stored keys are filtered by those of a small window without being shuffled
            new = self.files.save(new, pending := f"pending-{uuid.uuid4().hex}")
            known = self.facts().select(*KEYS).join(new.select(*KEYS), KEYS, "left_semi")
            new = new.join(known, KEYS, "left_anti").select(*new.columns)
        schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in new.schema)
        if was["schema"] not in (None, schema):
            raise ValueError(f"the store's facts are {was['schema']}, not {schema}")
        folder = self._load(new)
        appended = self.spark.read.schema(schema).parquet(self.files.at(folder)).count()  # from the files' footers
        if was["loads"]:
            self.files.drop(pending)
        loads = [*was["loads"], folder] if appended or not was["loads"] else was["loads"]
        self._publish(was | {"loads": loads, "schema": schema, "cursors": cursors or was["cursors"]}, [] if folder in loads else [folder])
        return appended

    def compact(self) -> None:
        """Many small loads become one."""
        was = self.state.value
        if len(was["loads"]) > 1:
            self.state.check()
            folder = self._load(self.facts())
            self._publish(was | {"loads": [folder]}, was["loads"])

    def materialize(self, logs: DataFrame, until: datetime) -> dict[str, int]:
        """Flatten the log rows that arrived since the cursor (less the overlap) and append their facts."""
        scan = materialize.source_scan(logs, self.cursor(LOGS), until, self.config)
        flat = materialize.flatten(scan).withColumnRenamed("event_text", "msg").withColumn("ts", F.coalesce("dt", "inserted_at"))
        return {"appended": self.append(flat, materialize.moved(self.state.value["cursors"], LOGS, until))}

    def aggregate(self, outcomes: DataFrame, until: datetime, now: datetime) -> dict[str, int]:
        """Merge the facts that arrived since the cursor into the next snapshot of the incidents."""
        self.state.check()
        was, old = self.state.value, self.incidents()
        delta = incidents.enrich(incidents.rollup(self.facts(self.cursor(FACTS), until).where("fingerprint IS NOT NULL")), outcomes)
        merged = incidents.merge(delta.limit(0) if old is None else old.drop("inserted"), delta, now)
        folder = f"incidents/v={self.state.number + 1:09d}-{uuid.uuid4().hex[:8]}"
        counted = self.files.save(merged, folder).agg(F.count_if("inserted").alias("inserted"), F.count(F.lit(1)).alias("incidents")).first()
        self._publish(was | {"snapshot": folder, "cursors": materialize.moved(was["cursors"], FACTS, until)}, [was["snapshot"]] if was["snapshot"] else [])
        return {"inserted": counted.inserted, "incidents": counted.incidents}

    def update(self, updates: DataFrame, expected: list[str], columns: list[str], now: datetime) -> dict[str, int]:
        """Write prepared ``columns`` (states, say) of some incidents. ``updates`` has the key, the columns, and ``prev_*`` of the ``expected``
        ones: a row is written where the incident has not moved on since (null-safe) and where anything differs; only then does
        ``updated_at`` change. Returns how many were updated, were skipped for having moved on, and were the same already."""
        self.state.check()
        was, current = self.state.value, self.incidents()
        if current is None:
            raise ValueError("the store has no incidents yet")
        kinds = {f.name: f.dataType for f in updates.schema}
        current = current.withColumns({c: F.lit(None).cast(kinds[c]) for c in columns if c not in current.columns})
        changed = incidents.changed_only(current, updates, incidents.KEYS, columns)
        done = incidents.guarded_update(current, changed, incidents.KEYS, expected, columns)
        stamped = done.withColumn("updated_at", F.when(F.col("outcome") == "updated", F.lit(now)).otherwise(F.col("updated_at")))
        folder = f"incidents/v={self.state.number + 1:09d}-{uuid.uuid4().hex[:8]}"
        counted = {r.outcome: r["count"] for r in self.files.save(stamped, folder).groupBy("outcome").count().collect()}
        asked = updates.join(current, incidents.KEYS, "left_semi").count()
        self._publish(was | {"snapshot": folder}, [was["snapshot"]])
        result = {o: counted.get(o, 0) for o in ("updated", "skipped")}
        return result | {"same": asked - sum(result.values())}

    def run(self, logs: DataFrame, outcomes: DataFrame, until: datetime, log: RunLog | None = None) -> dict[str, int]:
        """Both steps, timed in the run log."""
        log = log or RunLog(self.spark)
        with log.timer("run.materialize", until=until.isoformat()):
            done = self.materialize(logs, until)
        with log.timer("run.aggregate", until=until.isoformat()):
            done |= self.aggregate(outcomes, until, until)
        log.add("INFO", "run", note=done)
        return done
