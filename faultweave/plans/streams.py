"""Queries that run as streams over the files of a table and return what the stream wrote."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faultweave.functions.ids import canonical_run_id
from faultweave.operators import materialize
from faultweave.plans.incidents import _flat, _ntz
from faultweave.plans.preparation_sql import canonical
from faultweave.sources.tables import PRODUCERS, SELF_APP, Scratch, table
from faultweave.streaming import events

#: How long copies of a record may arrive after each other: their state goes after that. Event times (dt) lie further apart;
#: windows in complete mode drop nothing behind the watermark, but sessions do and so go without.
SPAN = "60 days"
#: Micro-batches that a table is streamed in.
BATCHES = 4


def _stream(spark: SparkSession, d: str, name: str) -> DataFrame:
    """A table as a stream of files in the order of their arrival, some of them a micro-batch."""
    rows = table(spark, d, name)
    files = events.in_order(rows, "inserted_at", Scratch(spark).path)
    number = max(8, -(-rows.count() // 2_000_000))
    return events.file_stream(spark, files, rows.schema, -(-number // BATCHES))


def stream_dedupe(spark: SparkSession, d: str) -> DataFrame:
    s = events.first_deliveries(_stream(spark, d, "error_events").select("run_id", "event_ord", "inserted_at"), SPAN)
    return events.run_available(s.select("run_id", "event_ord"))


def stream_windows(spark: SparkSession, d: str) -> DataFrame:
    s = events.windowed_counts(_stream(spark, d, "error_events").select("dt", "type"), lateness=SPAN)
    return _ntz(events.run_available(s, mode="complete"))


def stream_hourly(spark: SparkSession, d: str) -> DataFrame:
    """Events per hour and type that are at most 72 hours late and one early, with a watermark that drops the state of hours gone by."""
    e = events.plausible(_stream(spark, d, "error_events").select("dt", "inserted_at", "type"))
    counts = events.windowed_counts(e.select("dt", "type"), lateness="73 hours")
    sink = events.LatestSink(spark, counts.schema, ["window_start", "type"])
    events.run_available(counts, mode="update", each=sink)
    return _ntz(sink.current())


def stream_quiet(spark: SparkSession, d: str) -> DataFrame:
    """Incidents that fell silent for more than a week, by timers."""
    s = events.quiet_spells(_stream(spark, d, "error_events").select("fingerprint", "entity", "inserted_at").where("fingerprint IS NOT NULL"), ["fingerprint", "entity"])
    return _ntz(events.run_available(s))


def stream_sessions(spark: SparkSession, d: str) -> DataFrame:
    s = events.sessions(_stream(spark, d, "error_events").select("dt", "entity"), lateness=None)
    return _ntz(events.run_available(s, mode="complete"))


def stream_flatten(spark: SparkSession, d: str) -> DataFrame:
    """Flattened facts, written by micro-batches, per app and type."""
    logs = _stream(spark, d, "app_run_logs").select("run_id", "app_name", "warn_error_logs", "inserted_at")
    kept = logs.where(F.col("app_name").isin(*PRODUCERS) & (F.col("app_name") != SELF_APP) & F.col("warn_error_logs").isNotNull())
    out = Scratch(spark)

    def each(batch: DataFrame, batch_id: int) -> None:
        out.save(materialize.flatten(batch).select("run_id", "event_ord", "src_app_name", "type"), f"facts/batch={batch_id:09d}")

    events.run_available(kept, each=each)
    facts = spark.read.schema("run_id string, event_ord int, src_app_name string, type string").parquet(out.at("facts"))
    return facts.groupBy("src_app_name", "type").agg(F.count(F.lit(1)).alias("events"), F.count_distinct("run_id").alias("runs"))


def stream_incidents(spark: SparkSession, d: str) -> DataFrame:
    """Incidents merged by micro-batches of the deduplicated facts: the same as one batch over all of them."""
    e = _stream(spark, d, "error_events").withColumn("run_id", canonical_run_id("run_id"))
    unique = e.withWatermark("inserted_at", SPAN).dropDuplicatesWithinWatermark(["run_id", "event_ord"])
    sink = events.IncidentSink(spark, table(spark, d, "acquisition_history"))
    events.run_available(unique, each=sink)
    return _flat(sink.current()).select("fingerprint", "entity", "occurrence_count", "first_seen", "last_seen", "apps", "systems")


QUERIES = {f.__name__: f for f in (stream_dedupe, stream_windows, stream_hourly, stream_quiet, stream_sessions, stream_flatten, stream_incidents)}

SQL = {
    "stream_dedupe": f"SELECT DISTINCT {canonical('run_id')} AS run_id, event_ord FROM error_events",
    "stream_windows": "SELECT date_trunc('hour', dt AT TIME ZONE 'UTC') AS window_start, type, count(*) AS events FROM error_events WHERE dt IS NOT NULL GROUP BY ALL",
    "stream_hourly": """
      SELECT date_trunc('hour', dt AT TIME ZONE 'UTC') AS window_start, type, count(*) AS events FROM error_events
      WHERE dt >= inserted_at - INTERVAL 72 HOUR AND dt <= inserted_at + INTERVAL 1 HOUR GROUP BY ALL""",
    "stream_quiet": """
      SELECT fingerprint, entity, t AS last_seen, t + INTERVAL 7 DAY AS quiet_at FROM (
        SELECT *, lead(t) OVER (PARTITION BY fingerprint, entity ORDER BY t) AS following, max(t) OVER () AS newest
        FROM (SELECT fingerprint, entity, inserted_at AT TIME ZONE 'UTC' AS t FROM error_events WHERE fingerprint IS NOT NULL AND inserted_at IS NOT NULL))
      WHERE coalesce(following, newest - INTERVAL 1 HOUR) > t + INTERVAL 7 DAY""",
    "stream_sessions": """
      SELECT min(t) AS session_start, max(t) + INTERVAL 30 MINUTE AS session_end, entity, count(*) AS events FROM (
        SELECT *, sum(CASE WHEN t - before < INTERVAL 30 MINUTE THEN 0 ELSE 1 END) OVER (PARTITION BY entity ORDER BY t ROWS UNBOUNDED PRECEDING) AS nth FROM (
          SELECT entity, dt AT TIME ZONE 'UTC' AS t, lag(dt AT TIME ZONE 'UTC') OVER (PARTITION BY entity ORDER BY dt) AS before FROM error_events WHERE dt IS NOT NULL)) GROUP BY entity, nth""",
    "stream_flatten": """
      SELECT app_name AS src_app_name, CASE WHEN json_type(ev, '$.type') = 'VARCHAR' THEN ev ->> '$.type' END AS type, count(*) AS events, count(DISTINCT rid) AS runs FROM (
        SELECT app_name, %s AS rid, unnest(json_extract(warn_error_logs, '$[*]')) AS ev FROM app_run_logs
        WHERE app_name IN (%s) AND json_valid(warn_error_logs) AND json_type(warn_error_logs) = 'ARRAY') WHERE json_type(ev) = 'OBJECT' GROUP BY ALL"""
    % (canonical("run_id"), ", ".join(f"'{p}'" for p in PRODUCERS)),
    "stream_incidents": f"""
      SELECT fingerprint, entity, count(*) AS occurrence_count, min(ts) AT TIME ZONE 'UTC' AS first_seen, max(ts) AT TIME ZONE 'UTC' AS last_seen,
             coalesce(string_agg(DISTINCT src_app_name, ',' ORDER BY src_app_name), '') AS apps, coalesce(string_agg(DISTINCT system_id, ',' ORDER BY system_id), '') AS systems
      FROM (SELECT {canonical("run_id")} AS rid, event_ord, any_value(fingerprint) AS fingerprint, any_value(entity) AS entity, coalesce(min(dt), min(inserted_at)) AS ts,
                   any_value(src_app_name) AS src_app_name, any_value(system_id) AS system_id FROM error_events GROUP BY ALL)
      WHERE fingerprint IS NOT NULL GROUP BY ALL""",
}
