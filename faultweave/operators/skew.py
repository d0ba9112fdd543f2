"""A few keys holding most records: per-key results over a range partitioning that splits heavy keys.

Rows are range-partitioned by key and secondary order with sampled quantiles, so every partition gets about the same number
of rows and a heavy key is spread over as many partitions as its rows need. Each partition is sorted and scanned once into
partial states, one per key in it; the states of a key, at most one per partition, are stitched in order.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from faultweave.sources.tables import ship

#: Rows of a partition at most, on average.
PARTITION_ROWS = 2_000_000
_FIELDS = "n", "timed", "first_us", "last_us", "bursts", "max_gap_us"


def _partials(gap_us: int, width: int):
    """Partial states of runs of equal keys in sorted batches; the run at a batch's end stays open."""

    def codes(batch: pa.RecordBatch) -> np.ndarray:
        """Where a key starts."""
        start = np.zeros(batch.num_rows, dtype=bool)
        start[0] = True
        for i in range(width):
            c = batch.column(i)
            a, b = c.slice(1), c.slice(0, len(c) - 1)
            differs = pc.fill_null(pc.not_equal(a, b), False).to_numpy(zero_copy_only=False)
            start[1:] |= differs | (pc.is_null(a).to_numpy(zero_copy_only=False) != pc.is_null(b).to_numpy(zero_copy_only=False))
        return start

    def merge(x: list, y: list) -> list:
        if x[1] == 0 or y[1] == 0:
            t = y if x[1] == 0 else x
            return [x[0] + y[0], *t[1:]]
        gap = y[2] - x[3]
        return [x[0] + y[0], x[1] + y[1], x[2], y[3], x[4] + y[4] - (gap <= gap_us), max(x[5], y[5], gap)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_key, open_state, schema = None, None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            at = np.flatnonzero(codes(batch))
            us = batch.column(width)
            known = us.is_valid().to_numpy(zero_copy_only=False)
            t = pc.fill_null(us, 0).to_numpy(zero_copy_only=False)
            gap = np.zeros(len(t), dtype=np.int64)
            gap[1:] = np.where(known[1:] & known[:-1], t[1:] - t[:-1], 0)  # times ascend within a key, unknown ones first
            gap[at] = 0
            n = np.diff(np.append(at, len(t)))
            timed = np.add.reduceat(known.astype(np.int64), at)
            last = t[at + n - 1]
            first = t[np.minimum(at + n - timed, len(t) - 1)]
            bursts = np.add.reduceat((gap > gap_us).astype(np.int64), at) + (timed > 0)
            states = np.stack([n, timed, first, last, bursts, np.maximum.reduceat(gap, at)], axis=1)
            keys = pa.RecordBatch.from_arrays([batch.column(i).take(pa.array(at)) for i in range(width)], names=batch.schema.names[:width])
            schema = keys.schema
            tops, ends = keys.slice(0, 1).to_pylist()[0], keys.slice(len(at) - 1, 1).to_pylist()[0]
            if open_key is not None and open_key == tops:
                states[0] = merge(open_state, states[0].tolist())
            elif open_key is not None:
                yield emit(pa.RecordBatch.from_pylist([open_key], schema=schema), np.array([open_state]))
            if len(at) > 1:
                yield emit(keys.slice(0, len(at) - 1), states[:-1])
            open_key, open_state = ends, states[-1].tolist()
        if open_key is not None:
            yield emit(pa.RecordBatch.from_pylist([open_key], schema=schema), np.array([open_state]))

    def emit(keys: pa.RecordBatch, states: np.ndarray) -> pa.RecordBatch:
        timed = states[:, 1] > 0
        cols = [pa.array(states[:, i], mask=~timed if i in (2, 3) else None) for i in range(6)]
        return pa.RecordBatch.from_arrays([*keys.columns, *cols], names=[*keys.schema.names, *_FIELDS])

    return run


def ranges_for(rows: int, least: int) -> int:
    """How many ranges so many rows need: ``least``, more where one would exceed ``PARTITION_ROWS`` on average."""
    return max(least, -(-rows // PARTITION_ROWS))


def key_states(df: DataFrame, keys: list[str], time: str, tie: list[str], gap_seconds: int = 1800, partitions: int | None = None) -> DataFrame:
    """Per key: rows ``n``, rows with a time ``timed``, ``first_us``/``last_us`` (µs), ``bursts`` and ``max_gap_us``.

    A burst is a maximal run of timed rows whose neighbours are at most ``gap_seconds`` apart. Null keys are keys of their own;
    rows without time count in ``n`` only, and a key with none has null first and last, 0 bursts and gap 0. Equal times are
    gaps of 0; repeated rows count as often as they occur (dedupe first). Other columns, whatever their names, are not read.
    No task gets more than its share of rows, however heavy a key is: the range bounds are sampled quantiles over
    keys, time and ``tie``. There are ``partitions`` ranges (see ``ranges_for``), by default as many as the session has
    shuffle partitions.
    """
    ship(df.sparkSession)
    cols = [F.col(f"`{k}`").alias(f"k{i}") for i, k in enumerate(keys)]
    order = [F.col(f"`{t}`").alias(f"o{i}") for i, t in enumerate(tie)]
    rows = df.select(*cols, F.unix_micros(F.col(f"`{time}`")).alias("us"), *order)
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    by = [c for c in rows.columns if c.startswith("k")] + [c for c in rows.columns if not c.startswith("k")]
    sorted_rows = rows.repartitionByRange(n, *by).sortWithinPartitions(*by)
    schema = T.StructType([*rows.schema.fields[: len(keys)], *(T.StructField(f, T.LongType()) for f in _FIELDS)])
    parts = sorted_rows.select(*(f"k{i}" for i in range(len(keys))), "us").mapInArrow(_partials(gap_seconds * 1_000_000, len(keys)), schema)
    by_key = [f"k{i}" for i in range(len(keys))]
    before = F.max("last_us").over(Window.partitionBy(*by_key).orderBy(F.col("first_us").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1))
    joined = F.col("first_us") - before
    stitched = (
        parts.withColumn("seam", joined)
        .groupBy(*by_key)
        .agg(
            F.sum("n").alias("n"), F.sum("timed").alias("timed"), F.min("first_us").alias("first_us"), F.max("last_us").alias("last_us"),
            (F.sum("bursts") - F.sum(F.when(F.col("seam") <= gap_seconds * 1_000_000, 1).otherwise(0))).alias("bursts"),
            F.greatest(F.max("max_gap_us"), F.coalesce(F.max("seam"), F.lit(0))).alias("max_gap_us"),
        )
    )
    return stitched.select(*(F.col(f"k{i}").alias(k) for i, k in enumerate(keys)), *_FIELDS)
