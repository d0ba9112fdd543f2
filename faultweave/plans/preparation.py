"""Queries of the general data-preparation problems (p1, p2, p3, p5, p6)."""

from __future__ import annotations

from datetime import UTC, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faultweave.functions.ids import canonical_run_id
from faultweave.functions.time import utc_day
from faultweave.operators import late, orphans, shred, skew
from faultweave.operators.dedupe import COPIES, UpsertStore, keep_one
from faultweave.sources.tables import Scratch, spread, table


def event_records(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """One row per record (canonical run_id, event_ord) of error_events: the row that arrived last."""
    rows = table(spark, sf_dir, "error_events").select(canonical_run_id("run_id").alias("run_id"), "event_ord", "inserted_at", *columns)
    return keep_one(rows, ["run_id", "event_ord"], [F.col("inserted_at")])


def _pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = event_records(spark, sf_dir, "fingerprint", "entity", "dt")
    deliveries = table(spark, sf_dir, "error_events").count()  # from the files' footers; there are no more records than that
    ranges = skew.ranges_for(deliveries, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return skew.key_states(records, ["fingerprint", "entity"], "dt", ["run_id", "event_ord"], partitions=ranges)


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    states = Scratch(spark).save(_pairs(spark, sf_dir), "pairs")
    total = states.agg(F.sum("n")).first()[0] or 0
    return states.where(F.col("fingerprint").isNotNull() & (F.col("n") * 100 >= total)).select("fingerprint", "entity")


def p1_pair_bursts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per pair: records, timed records, first and last time, bursts (gaps over 30 minutes end one) and the longest gap."""
    return _pairs(spark, sf_dir)


def _arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "error_events").select(
        F.lit("error_events").alias("source"), canonical_run_id("run_id").alias("run_id"), F.col("event_ord").cast("string").alias("item"), F.col("dt").alias("event_time"), F.col("inserted_at").alias("arrival")
    )
    a = table(spark, sf_dir, "acquisition_history").select(
        F.lit("acquisition_history").alias("source"), canonical_run_id("run_id").alias("run_id"), F.col("system_id").alias("item"), F.col("capture_datetime").alias("event_time"), F.col("inserted_at").alias("arrival")
    )
    return e.unionByName(a)


def _late_store(spark: SparkSession, sf_dir: str) -> late.PeriodStore:
    return late.ingest_by_arrival(late.PeriodStore(spark), _arrivals(spark, sf_dir))


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    late_ones = _late_store(spark, sf_dir).records().where((F.col("status") == "corrected") & F.col("run_id").isNotNull())
    return late_ones.select(F.col("source").alias("table_name"), "run_id", "item").distinct()


def p2_hourly_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records per table and hour of event time: when published, corrected since, and in all."""
    return _late_store(spark, sf_dir).counts().select(F.col("source").alias("table_name"), F.col("hour").cast("timestamp_ntz").alias("hour"), "published", "corrections", "records")


def _references(spark: SparkSession, sf_dir: str) -> DataFrame:
    def of(name: str) -> DataFrame:
        return table(spark, sf_dir, name).select(F.lit(name).alias("table_name"), utc_day("inserted_at").alias("period"), canonical_run_id("run_id").alias("run_id"))

    return of("acquisition_history").unionByName(of("error_events"))


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    parents = table(spark, sf_dir, "app_run_logs").select(canonical_run_id("run_id").alias("run_id"))
    return orphans.orphans(_references(spark, sf_dir), parents, "run_id", "run_id").select("table_name", "period", "run_id")


def p3_orphan_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unresolved run_ids per table and day."""
    return p3_found(spark, sf_dir).groupBy("table_name", "period").agg(F.count(F.lit(1)).alias("orphan_runs"), F.min("run_id").alias("first_run"), F.max("run_id").alias("last_run"))


def _nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    logs = table(spark, sf_dir, "app_run_logs").select(canonical_run_id("run_id").alias("run_id"), F.lit(None).cast("int").alias("ord"), F.lit(True).alias("is_array"), F.col("warn_error_logs").alias("text"))
    raw = table(spark, sf_dir, "error_events").select(canonical_run_id("run_id").alias("run_id"), F.col("event_ord").alias("ord"), F.lit(False).alias("is_array"), F.col("raw_event").alias("text"))
    return spread(logs, "run_id").unionByName(spread(raw, "run_id", "ord")).where(F.col("text").isNotNull())


def _shredded(spark: SparkSession, sf_dir: str, only: set[str] | None = None, fields: bool = True) -> tuple[DataFrame, shred.Layout]:
    df = _nested(spark, sf_dir)
    layout = shred.analyse(df, F.col("text"), F.col("is_array"), {"attempts", "steps"})
    return shred.shred(df, ["run_id"], F.col("ord"), F.col("text"), F.col("is_array"), layout, only, fields), layout


def _place(name: str) -> F.Column:
    return F.regexp_extract("row_id", rf"(?:\A|.*/){name}\[(\d+)\]", 1).cast("int")


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, _ = _shredded(spark, sf_dir, {"attempts", "steps"}, fields=False)
    in_attempt = F.col("row_id").rlike(r"(\A|/)attempts\[\d+\]/")
    cases = rows.where(F.col("is_object") & ((F.col("table_name") == "attempts") | in_attempt)).select(
        "run_id", "event_ord", _place("attempts").alias("attempt_ord"), F.when(F.col("table_name") == "steps", F.col("position")).otherwise(-1).alias("step_ord")
    )
    return cases.distinct()


def p5_table_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and objects of every table that the schema graph of the nested events gives."""
    rows, _ = _shredded(spark, sf_dir, fields=False)
    return rows.groupBy("table_name").agg(F.count(F.lit(1)).alias("rows"), F.count_if("is_object").alias("objects"), F.count_if(F.col("parent_id") != "").alias("below_another_table"))


def _named(flat: DataFrame) -> DataFrame:
    """Paths of inlined fields as plain column names."""
    return flat.withColumnsRenamed({c: c.replace(".", "__") for c in flat.columns if "." in c})


def p5_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flat table of events with its inlined fields."""
    rows, layout = _shredded(spark, sf_dir, {shred.ROOT})
    return _named(shred.flat_table(rows.where(F.col("is_object") & (F.col("row_id") == "")), ["run_id"], layout, shred.ROOT))


def p5_attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flat table of attempts with its inlined fields; ``position`` is the attempt's place."""
    rows, layout = _shredded(spark, sf_dir, {"attempts"})
    return _named(shred.flat_table(rows.where("is_object"), ["run_id"], layout, "attempts"))


def p5_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flat table of steps with its inlined fields and the keys of its parents."""
    rows, layout = _shredded(spark, sf_dir, {"steps"})
    return _named(shred.flat_table(rows.where("is_object"), ["run_id"], layout, "steps")).withColumn("attempt_ord", _place("attempts"))


#: Batches in which the store gets the messages: weeks of arrival.
_WEEK = timedelta(days=7)


def _stored(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """The compacted store of all messages, upserted in weekly batches. A batch is a range of arrival that reaches the scan; rows without
    arrival come with the first."""
    rows = table(spark, sf_dir, "error_events").select(canonical_run_id("run_id").alias("run_id"), "event_ord", "inserted_at", *columns)
    store = UpsertStore(spark, ["run_id", "event_ord"], ["inserted_at"])
    at = F.col("inserted_at")
    span = table(spark, sf_dir, "error_events").agg(F.unix_micros(F.min(at)).alias("first"), F.unix_micros(F.max(at)).alias("last")).first()
    first, last = span.first or 0, span.last or 0
    epoch, week = datetime(1970, 1, 1, tzinfo=UTC), _WEEK // timedelta(microseconds=1)
    for w in range(first // week, last // week + 1):  # bounded by the calendar
        mine = (at >= F.lit(epoch + w * _WEEK)) & (at < F.lit(epoch + (w + 1) * _WEEK))
        store.upsert(str(w), rows.where(mine | at.isNull() if w == first // week else mine))
    return store.compact()


_MESSAGE = "src_app_name", "type", "func", "tag", "err_msg", "note_message", "entity", "fingerprint", "dt", "raw_event"


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stored(spark, sf_dir, *_MESSAGE).where(F.col(COPIES) > 1).select("run_id", "event_ord")


def p6_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exactly one copy of every record, the one that arrived last, with the number of copies."""
    rows = _stored(spark, sf_dir, *_MESSAGE).withColumn("copies", F.col(COPIES)).drop(COPIES)
    return rows.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("inserted_at", "dt")})


QUERIES = {f.__name__: f for f in (p1_found, p1_pair_bursts, p2_found, p2_hourly_counts, p3_found, p3_orphan_report, p5_found, p5_table_sizes, p5_events, p5_attempts, p5_steps, p6_found, p6_messages)}
