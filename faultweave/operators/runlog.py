"""The engine's own run log: events with timers, a summary, a JSON file per run and a row in the log table.

A run's events are few and live on the driver; the row has the shape of the log source, under the engine's own app name, which
the source scan leaves out, so that the engine never reads itself.
"""

from __future__ import annotations

import json
import time
import uuid
from contextlib import contextmanager
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession

from faultweave.operators import runstats
from faultweave.sources.tables import SELF_APP, Scratch

LEVELS = ("INFO", "WARN", "ERROR")


class RunLog:
    """Collects events ``{run_id, dt, type, func, tag, note, err_msg}`` of one run and writes them at its end."""

    def __init__(self, spark: SparkSession, app: str = SELF_APP):
        if app != SELF_APP:
            raise ValueError(f"the run log writes as {SELF_APP} only")
        self.spark, self.run_id, self.events = spark, str(uuid.uuid4()), []

    def add(self, level: str, func: str, tag: str = "DETAILS", note: dict | None = None, error: BaseException | str | None = None) -> None:
        if level not in LEVELS:
            raise ValueError(f"unknown level {level}")
        event = {"run_id": self.run_id, "dt": datetime.now(UTC).isoformat(timespec="milliseconds").replace("+00:00", "Z"), "type": level, "func": func, "tag": tag, "note": note or {}}
        self.events.append(event | ({"err_msg": str(error)} if error is not None else {}))

    @contextmanager
    def timer(self, label: str, **note):
        """Time a step; a failing step is logged as an error and raised again."""
        began = time.monotonic()
        try:
            yield
        except BaseException as e:
            self.add("ERROR", label, "CATCH", note, e)
            raise
        finally:
            self.add("INFO", label, "DETAILS", {**note, "duration_ms": round((time.monotonic() - began) * 1000)})

    def timers(self) -> DataFrame:
        """The timer events as a table for the run statistics: run, label, ms, ip (the first IPv4 value in the note)."""
        rows = []
        for e in self.events:
            if isinstance(ms := e["note"].get("duration_ms"), int):
                parts = [v for v in e["note"].values() if isinstance(v, str) and v.count(".") == 3 and all(p.isdigit() and len(p) <= 3 for p in v.split("."))]
                rows.append((self.run_id, e["func"], ms, parts[0] if parts else None))
        return self.spark.createDataFrame(rows, "run string, label string, ms long, ip string")

    def summary(self) -> DataFrame:
        """Duration statistics per label, or per ``prefix.*`` where a prefix has at least three sub-labels."""
        return runstats.duration_stats(runstats.label_prefix(self.timers()), ["run", "shown"])

    def finish(self, path: str) -> bool:
        """Write the JSON file and the log row under ``path``. One sink's failure does not keep the other from its work; False: one failed."""
        files, fine = Scratch(self.spark, path), True
        for sink in (self._file, self._row):
            try:
                sink(files)
            except Exception as e:  # noqa: BLE001
                self.add("ERROR", sink.__name__, "CATCH", None, e)
                fine = False
        return fine

    def _file(self, files: Scratch) -> None:
        if not files.create(f"run-{self.run_id}.json", json.dumps({"run_id": self.run_id, "log_events": self.events})):
            raise FileExistsError(self.run_id)

    def _row(self, files: Scratch) -> None:
        loud = [e for e in self.events if e["type"] != "INFO"]
        row = [(SELF_APP, self.run_id, json.dumps(self.events), json.dumps(loud), datetime.now(UTC))]
        df = self.spark.createDataFrame(row, "app_name string, run_id string, verbose_log string, warn_error_logs string, inserted_at timestamp")
        df.coalesce(1).write.mode("append").parquet(files.at("app_run_logs"))
