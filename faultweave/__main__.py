"""Jobs: ``python -m faultweave materialize|aggregate|run|noop --store FOLDER --logs TABLE --outcomes TABLE``."""

from __future__ import annotations

import argparse
import sys
from datetime import UTC, datetime

from pyspark.sql import SparkSession

from faultweave.operators.materialize import Config
from faultweave.operators.pipeline import IncidentStore
from faultweave.operators.runlog import RunLog


def main(args: list[str] | None = None, spark: SparkSession | None = None) -> int:
    """The exit code: 0, or 1 if a step or a sink of the run log failed."""
    p = argparse.ArgumentParser(prog="faultweave", description=__doc__)
    p.add_argument("job", choices=("materialize", "aggregate", "run", "noop"))
    p.add_argument("--store", required=True, help="folder of the facts and incidents, shared by all executors")
    p.add_argument("--logs", help="Parquet table of run logs")
    p.add_argument("--outcomes", help="Parquet table of outcomes")
    p.add_argument("--until", type=datetime.fromisoformat, help="snapshot time (default: now)")
    a = p.parse_args(args)
    for need in {"materialize": ("logs",), "aggregate": ("outcomes",), "run": ("logs", "outcomes"), "noop": ()}[a.job]:
        if getattr(a, need) is None:
            p.error(f"{a.job} needs --{need}")
    spark = spark or SparkSession.builder.appName("faultweave").getOrCreate()
    until = a.until or datetime.now(UTC)
    until = until if until.tzinfo else until.replace(tzinfo=UTC)
    log, code = RunLog(spark), 0
    try:
        with log.timer(f"job.{a.job}"):
            store = IncidentStore(spark, a.store, Config.from_env())
            if a.job == "materialize":
                store.materialize(spark.read.parquet(a.logs), until)
            elif a.job == "aggregate":
                store.aggregate(spark.read.parquet(a.outcomes), until, until)
            elif a.job == "run":
                store.run(spark.read.parquet(a.logs), spark.read.parquet(a.outcomes), until, log)
    except Exception as e:  # noqa: BLE001
        print(e, file=sys.stderr)
        code = 1
    return code if log.finish(f"{a.store.rstrip('/')}/runs") else 1


if __name__ == "__main__":
    sys.exit(main())
