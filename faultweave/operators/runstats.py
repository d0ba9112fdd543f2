"""Run summaries: duration statistics by label, duration buckets, label prefixes and networks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Buckets of durations (fixed values): name and upper bound in milliseconds.
BUCKETS = (("<10s", 10_000), ("10-30s", 30_000), ("30-60s", 60_000), ("60-90s", 90_000), (">=90s", None))
MIN_SUBLABELS, MIN_PER_SUBNET = 3, 2


def bucket(ms: Column) -> Column:
    out = None
    for name, below in BUCKETS[:-1]:
        out = F.when(ms < below, name) if out is None else out.when(ms < below, name)
    return out.when(ms.isNotNull(), BUCKETS[-1][0])


def duration_stats(timers: DataFrame, by: list[str], ms: str = "ms") -> DataFrame:
    """count, min, p50, p95 and max; a quantile q is the value at place floor((n - 1) * q) in order.

    Durations are counted per value first, so a group's size bounds nothing that one task holds: a window walks the distinct
    values, and whatever repeats is one row.
    """
    from pyspark.sql import Window

    values = timers.where(F.col(ms).isNotNull()).groupBy(*by, F.col(ms).alias("v")).agg(F.count(F.lit(1)).alias("c"))
    w = Window.partitionBy(*by)
    ranked = values.withColumn("upto", F.sum("c").over(w.orderBy("v").rowsBetween(Window.unboundedPreceding, 0))).withColumn("n", F.sum("c").over(w))
    at = lambda q: F.min(F.when(F.col("upto") > F.floor((F.col("n") - 1) * q), F.col("v")))
    return ranked.groupBy(*by).agg(F.max("n").alias("count"), F.min("v").alias("min_ms"), at(0.5).alias("p50_ms"), at(0.95).alias("p95_ms"), F.max("v").alias("max_ms"))


def duration_buckets(timers: DataFrame, by: list[str], ms: str = "ms") -> DataFrame:
    """How many durations of a group fall in each bucket; all buckets as columns."""
    b = timers.withColumn("__b", bucket(F.col(ms)))
    names = ("b0_10", "b10_30", "b30_60", "b60_90", "b90")
    return b.groupBy(*by).agg(*(F.count_if(F.col("__b") == name).alias(c) for c, (name, _) in zip(names, BUCKETS)))


def label_prefix(timers: DataFrame, run: str = "run", label: str = "label") -> DataFrame:
    """``timers`` with ``shown``: ``prefix.*`` where a run has at least 3 sub-labels of the prefix, else the label itself."""
    prefix = F.when(F.instr(F.col(label), ".") > 1, F.substring_index(F.col(label), ".", 1))
    marked = timers.withColumn("__p", prefix)
    wide = marked.where("__p IS NOT NULL").groupBy(run, "__p").agg(F.count_distinct(label).alias("__k")).where(F.col("__k") >= MIN_SUBLABELS)
    return marked.join(wide, [run, "__p"], "left").withColumn("shown", F.when(F.col("__k").isNotNull(), F.concat("__p", F.lit(".*"))).otherwise(F.col(label))).drop("__p", "__k")


def subnet(ip: Column) -> Column:
    """The first three parts of an IPv4 address, null for other text."""
    return F.when(ip.rlike(r"\A\d{1,3}(?:\.\d{1,3}){3}\z"), F.substring_index(ip, ".", 3))


def subnet_stats(timers: DataFrame, run: str = "run", ip: str = "ip", ms: str = "ms") -> DataFrame:
    """Statistics per run and /24 network, of networks with at least two timers."""
    t = timers.withColumn("subnet", subnet(F.col(ip))).where("subnet IS NOT NULL")
    return duration_stats(t, [run, "subnet"], ms).where(F.col("count") >= MIN_PER_SUBNET)


def run_span(events: DataFrame, run: str, at: str) -> DataFrame:
    """Events of a run and the milliseconds between its first and last."""
    return events.groupBy(run).agg(F.count(F.lit(1)).alias("event_count"), F.floor((F.unix_micros(F.max(at)) - F.unix_micros(F.min(at))) / 1000).alias("wall_clock_ms"))


def last_values(timers: DataFrame, run: str = "run", label: str = "label", ms: str = "ms", at: str = "ts") -> DataFrame:
    """The labels that ``label_prefix`` shows as they are: a scalar each, the last one by time (ties: the greatest) wins."""
    alone = label_prefix(timers, run, label).where(F.col("shown") == F.col(label))
    return alone.groupBy(run, label).agg(F.max_by(ms, F.struct(at, ms)).alias("last_ms"))
