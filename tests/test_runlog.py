import json

import pytest

from faultweave.operators.materialize import EPOCH, source_scan
from faultweave.operators.runlog import RunLog
from faultweave.sources.tables import Scratch


def test_run_log(spark, tmp_path):
    log = RunLog(spark)
    for i in range(3):
        with log.timer(f"step.{i}", host=f"10.0.0.{i}"):
            pass
    with pytest.raises(KeyError), log.timer("boom"):
        raise KeyError("x")
    assert {r.shown: r["count"] for r in log.summary().collect()} == {"step.*": 3, "boom": 1}
    assert {r.ip for r in log.timers().collect()} == {"10.0.0.0", "10.0.0.1", "10.0.0.2", None}
    path = f"file://{tmp_path}/log"
    assert log.finish(path)
    rows = spark.read.parquet(f"{path}/app_run_logs")
    assert [e["type"] for e in json.loads(rows.first().warn_error_logs)] == ["ERROR"]
    assert source_scan(rows, EPOCH, rows.first().inserted_at.replace(year=2100)).count() == 0
    assert len(json.loads(Scratch(spark, path).read(f"run-{log.run_id}.json"))["log_events"]) == len(log.events)


def test_refusals(spark):
    with pytest.raises(ValueError):
        RunLog(spark, "other")
    with pytest.raises(ValueError):
        RunLog(spark).add("DEBUG", "f")
