"""Messages delivered more than once: an idempotent upsert store.

Storage is hash-bucketed by the identifier. Every upserted batch adds one run to each bucket, sorted by the identifier and with
equal identifiers already collapsed. Compaction reads a bucket's runs one after the other in one task (the scan keeps the
bucketing, so nothing is shuffled again). The task's sorter is a natural merge sort (TimSort): it finds the sorted runs in what it
reads and merges them, n log(runs) comparisons, spilling to disk where a bucket exceeds memory; one pass over the merged order
then collapses equal identifiers, which are neighbours.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from faultweave.sources.tables import Scratch, Versions, setting

COPIES, RUN = "__copies", "__run"
#: Rows of a bucket at most on average, copies in different runs included; beyond it a compaction makes more buckets.
BUCKET_ROWS = 4_000_000
_ROW = "__row"


def keep_one(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row per ``keys``: that with the greatest ``order``, ties decided by the whole row; ``__copies`` counts the rows.

    A single hash exchange, with the copies of a map task combined before it, so that an identifier delivered very often is
    no hot spot. Nulls in keys group together, null order values are lowest; an empty table gives an empty result. Names never
    clash because the row travels as one struct; an existing ``__copies`` is added up.
    """
    names = df.columns
    rest = [c for c in names if c not in keys]
    best = F.struct(*(o.alias(f"o{i}") for i, o in enumerate(order)), F.struct(*(F.col(f"`{c}`") for c in rest)).alias("row"))
    copies = F.sum(F.col(f"`{COPIES}`")) if COPIES in names else F.count(F.lit(1))
    out = df.groupBy(*(f"`{k}`" for k in keys)).agg(F.max(best).alias(_ROW), copies.alias(COPIES))
    return out.select(*(F.col(f"`{k}`") if k in keys else F.col(f"{_ROW}.row.`{k}`").alias(k) for k in names if k != COPIES), COPIES)


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)


class UpsertStore:
    """Hash-bucketed, sorted storage of messages by identifier.

    ``upsert(batch_id, df)`` is idempotent: a batch id that the store's state holds is skipped, and what a writer left that died
    before it published is never read, since its run is not named by the state. ``compact()`` merges all runs into a new folder
    and publishes that; the old one goes with the next publication. Rows of one identifier collapse to the one with the
    greatest ``order`` columns (nulls lowest), ties by the whole row; ``__copies`` counts the deliveries over all batches.
    Null identifiers are kept as one identifier; empty batches add an empty run; columns of any name, except those that
    start with two underscores, pass through. Two writers of one store: the slower one gets a ``ConcurrentWriterError``.
    """

    def __init__(self, spark: SparkSession, keys: list[str], order: list[str], buckets: int | None = None, path: str | None = None, bucket_rows: int = BUCKET_ROWS):
        self.spark, self.keys, self.order, self.bucket_rows = spark, list(keys), list(order), bucket_rows
        self.files = Scratch(spark, path)
        #: batches: ids; folder: where the runs are; runs: the rows of each; buckets: how many; schema: of the rows; old: folders that the version before this one replaced
        self.state = Versions(self.files, "messages", {"batches": [], "folder": self._new_folder(), "runs": {}, "buckets": buckets or int(spark.conf.get("spark.sql.shuffle.partitions")), "schema": None, "old": []})

    @staticmethod
    def _new_folder() -> str:
        return f"t-{uuid.uuid4().hex}"

    def _one(self, df: DataFrame) -> DataFrame:
        return keep_one(df, self.keys, [F.col(f"`{c}`") for c in self.order])

    @contextmanager
    def _named(self, folder: str, schema: str, buckets: int) -> Iterator[str]:
        """A folder of runs as a bucketed table that is in the catalog for a moment; the files stay."""
        name, keys = f"fw_{uuid.uuid4().hex}", ", ".join(f"`{k}`" for k in self.keys)
        self.spark.sql(f"CREATE TABLE {name} ({schema}) USING parquet CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {buckets} BUCKETS LOCATION '{self.files.at(folder)}'")
        try:
            yield name
        finally:
            self.spark.sql(f"DROP TABLE {name}")

    def _append(self, df: DataFrame, folder: str, buckets: int) -> int:
        """Add a run: a sorted file for each bucket. The exchange before it has as many partitions as there are buckets, so that a task
        writes whole buckets. Returns the rows."""
        rows = Observation()
        df = df.observe(rows, F.count(F.lit(1)).alias("n"))
        with self._named(folder, _ddl(df), buckets) as name, setting(self.spark, "spark.sql.shuffle.partitions", buckets):
            df.write.format("parquet").option("compression", "zstd").bucketBy(buckets, *self.keys).sortBy(*self.keys).mode("append").saveAsTable(name)
        return rows.get["n"]

    def _table(self) -> DataFrame:
        """The rows of the runs that belong to the store."""
        v = self.state.value
        with self._named(v["folder"], v["schema"], v["buckets"]) as name:
            return self.spark.table(name).where(F.col(RUN).isin(list(v["runs"])))

    def upsert(self, batch_id: str, df: DataFrame) -> bool:
        """Add a batch as one sorted run per bucket. False: the store already holds this batch."""
        was = self.state.value
        if batch_id in was["batches"]:
            return False
        self.state.check()
        run = uuid.uuid4().hex
        rows = self._one(df).withColumn(RUN, F.lit(run))
        schema = _ddl(rows)
        if was["schema"] not in (None, schema):
            raise ValueError(f"the store's columns are {was['schema']}, not {schema}")
        n = self._append(rows, was["folder"], was["buckets"])
        self._publish(was | {"batches": [*was["batches"], batch_id], "runs": was["runs"] | {run: n}, "schema": schema}, [])
        return True

    def _publish(self, value: dict, replaced: list[str]) -> None:
        old = self.state.value["old"]
        self.state.publish(value | {"old": replaced})
        for folder in old:
            self.files.drop(folder)

    def merged(self) -> DataFrame:
        """The collapsed rows over all runs: each bucket's runs are read together, without an exchange, and merged."""
        if not self.state.value["batches"]:
            raise ValueError("nothing was upserted")
        return self._one(self._table().drop(RUN))

    def compact(self) -> DataFrame:
        """Merge the runs into one, publish it, and return its rows. Where buckets have outgrown ``bucket_rows`` there are more of them
        afterwards; only then rows are shuffled."""
        self.state.check()
        was, run, folder = self.state.value, uuid.uuid4().hex, self._new_folder()
        rows, buckets = self.merged().withColumn(RUN, F.lit(run)), was["buckets"]
        if (n := sum(was["runs"].values())) > buckets * self.bucket_rows:
            buckets = -(-n // self.bucket_rows)
            rows = rows.repartition(buckets, *(F.col(f"`{k}`") for k in self.keys))
        n = self._append(rows, folder, buckets)
        self._publish(was | {"folder": folder, "runs": {run: n}, "buckets": buckets}, [was["folder"]])
        return self._table().drop(RUN)
