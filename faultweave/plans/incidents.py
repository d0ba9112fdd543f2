"""Queries of the incident pipeline's relational operators, over the domain tables."""

from __future__ import annotations

import uuid
from datetime import UTC, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from faultweave.functions import classify as taxonomy
from faultweave.functions import text as tx
from faultweave.functions.ids import canonical_run_id
from faultweave.operators import incidents, materialize, runstats
from faultweave.operators.pipeline import IncidentStore
from faultweave.sources.tables import spread, stamp, table

#: The pinned evaluation time and the cuts of the incremental windows.
NOW = datetime(2026, 6, 30, tzinfo=UTC)
CUTS = tuple(datetime(2026, 6, d, tzinfo=UTC) for d in (8, 15, 22))
BEFORE, AFTER = datetime(1970, 1, 1, tzinfo=UTC), datetime(2100, 1, 1, tzinfo=UTC)


def _ntz(df: DataFrame) -> DataFrame:
    return df.withColumns({f.name: F.col(f.name).cast("timestamp_ntz") for f in df.schema.fields if f.dataType.simpleString() == "timestamp"})


def _logs(spark: SparkSession, d: str) -> DataFrame:
    return spread(materialize.source_scan(table(spark, d, "app_run_logs"), BEFORE, AFTER), "run_id", "inserted_at")


_stores: dict[tuple[str, str], IncidentStore] = {}


def _store(spark: SparkSession, d: str) -> IncidentStore:
    """error_events as a store of facts: appended once for each application, as the append leaves them (canonical run_ids, the first
    delivery of every record), and again when the table's files change."""
    path = f"{d}/error_events.parquet"
    key = (spark.sparkContext.applicationId, stamp(spark, path))
    if key not in _stores or not _stores[key].there():
        made = IncidentStore(spark)
        made.append(incidents.message(table(spark, d, "error_events").withColumn("run_id", canonical_run_id("run_id"))))
        _stores[key] = made
    return _stores[key]


def _facts(spark: SparkSession, d: str) -> DataFrame:
    return _store(spark, d).facts()


def source_scan_window(spark: SparkSession, d: str) -> DataFrame:
    rows = materialize.source_scan(table(spark, d, "app_run_logs"), CUTS[0], CUTS[1])
    return _ntz(rows.select("run_id", "app_name", F.length("warn_error_logs").alias("payload_chars"), "inserted_at"))


def flatten_events(spark: SparkSession, d: str) -> DataFrame:
    return _ntz(materialize.flatten(_logs(spark, d)).drop("raw_event"))


def raw_event_keys(spark: SparkSession, d: str) -> DataFrame:
    """The fields of the events as they are kept: how many have each, and the first and last of its texts."""
    raw = materialize.flatten(_logs(spark, d)).select(F.try_parse_json("raw_event").alias("v"))
    fields = raw.lateralJoin(spark.tvf.variant_explode(F.col("v").outer()))
    text = F.when(F.schema_of_variant("value") == "STRING", F.try_variant_get("value", "$", "string"))
    return fields.groupBy("key").agg(F.count(F.lit(1)).alias("events"), F.min(text).alias("first_text"), F.max(text).alias("last_text"))


def event_text(spark: SparkSession, d: str) -> DataFrame:
    return materialize.flatten(_logs(spark, d)).groupBy("event_text").agg(F.count(F.lit(1)).alias("events"))


def fingerprint(spark: SparkSession, d: str) -> DataFrame:
    return materialize.flatten(_logs(spark, d)).groupBy("fingerprint", "src_app_name", "type").agg(F.count(F.lit(1)).alias("events"))


def entity_key(spark: SparkSession, d: str) -> DataFrame:
    return materialize.flatten(_logs(spark, d)).groupBy("entity", "system_id").agg(F.count(F.lit(1)).alias("events"))


def skipped_events(spark: SparkSession, d: str) -> DataFrame:
    return materialize.skipped(_logs(spark, d))


def malformed_payloads(spark: SparkSession, d: str) -> DataFrame:
    """Skipped records of all apps per reason."""
    logs = table(spark, d, "app_run_logs").select("run_id", "app_name", "warn_error_logs", "inserted_at")
    return materialize.skipped(logs).groupBy("reason").agg(F.count(F.lit(1)).alias("records"))


def dedupe_append(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "error_events").withColumn("run_id", canonical_run_id("run_id"))
    at = F.col("inserted_at")
    old, new = e.where(at <= F.lit(CUTS[1])), e.where(at > F.lit(CUTS[1]))
    return materialize.append_new(old, new, ["run_id", "event_ord"]).select("run_id", "event_ord")


def _messages(spark: SparkSession, d: str) -> DataFrame:
    return _facts(spark, d)


def normalize_text(spark: SparkSession, d: str) -> DataFrame:
    m = _messages(spark, d).select("msg").distinct()
    return m.groupBy(tx.normalize(F.col("msg")).alias("normal")).agg(F.count(F.lit(1)).alias("messages"))


def classify_events(spark: SparkSession, d: str) -> DataFrame:
    c = taxonomy.classify(F.col("msg"))
    m = _messages(spark, d).withColumn("c", c)
    return m.groupBy("c.category", "c.error_type", "c.manual_intervention", "c.successful_acquisition").agg(F.count(F.lit(1)).alias("events"), F.min("msg").alias("first_message"))


def classify_layers(spark: SparkSession, d: str) -> DataFrame:
    return _messages(spark, d).groupBy(taxonomy.layer(F.col("msg")).alias("layer"), "error_category").agg(F.count(F.lit(1)).alias("events"))


def backfill_category(spark: SparkSession, d: str) -> DataFrame:
    """Facts without a category get that of their message; how many, per category."""
    m = _messages(spark, d).where("error_category IS NULL")
    return m.groupBy(taxonomy.category(F.col("msg")).alias("category")).agg(F.count(F.lit(1)).alias("filled"))


def taxonomy_table(spark: SparkSession, d: str) -> DataFrame:
    return taxonomy.taxonomy(spark)


def _flat(rolled: DataFrame) -> DataFrame:
    joined: list[Column | str] = [F.array_join(c, ",").alias(c) if c in ("apps", "systems") else c for c in rolled.columns]
    return _ntz(rolled.select(*joined))


def agg_incidents(spark: SparkSession, d: str) -> DataFrame:
    rolled = incidents.rollup(_messages(spark, d))
    return _flat(rolled.drop("rep"))


def representative(spark: SparkSession, d: str) -> DataFrame:
    r = incidents.rollup(_messages(spark, d))
    return r.select("fingerprint", "entity", F.col("rep.run_id").alias("run_id"), F.col("rep.event_ord").alias("event_ord"), F.col("rep.msg").alias("msg"), F.col("rep.error_category").alias("error_category"))


def _incidents(spark: SparkSession, d: str, after: datetime = BEFORE, until: datetime = AFTER) -> DataFrame:
    facts = _store(spark, d).facts(after, until).where("fingerprint IS NOT NULL")
    return incidents.enrich(incidents.rollup(facts), table(spark, d, "acquisition_history"))


def enriched_incidents(spark: SparkSession, d: str) -> DataFrame:
    return _flat(_incidents(spark, d))


def category_source(spark: SparkSession, d: str) -> DataFrame:
    return _incidents(spark, d).groupBy("category", "category_source").agg(F.count(F.lit(1)).alias("incidents"), F.sum("occurrence_count").alias("events"))


def _merged(spark: SparkSession, d: str) -> DataFrame:
    bounds = (BEFORE, *CUTS, AFTER)
    deltas = [_incidents(spark, d, a, b) for a, b in zip(bounds, bounds[1:])]
    out = deltas[0]
    for delta in deltas[1:]:
        out = incidents.merge(out, delta).drop("inserted")
    return out


def incremental_merge(spark: SparkSession, d: str) -> DataFrame:
    """Four windows of arrival, merged one after the other."""
    return _flat(_merged(spark, d))


_COMPARED = "occurrence_count", "first_seen", "last_seen", "apps", "systems", "sample_run_id", "sample_message", "category", "category_source"


def rebuild_equals_incremental(spark: SparkSession, d: str) -> DataFrame:
    """Incidents in one pass against four merged windows: how many, and how many differ."""
    one, many = _incidents(spark, d), _merged(spark, d)
    j = one.select("fingerprint", "entity", F.struct(*_COMPARED).alias("a")).join(many.select("fingerprint", "entity", F.struct(*_COMPARED).alias("b")), ["fingerprint", "entity"], "full_outer")
    return j.agg(F.count(F.lit(1)).alias("incidents"), F.count_if(~F.col("a").eqNullSafe(F.col("b"))).alias("different"))


def merge_inserted(spark: SparkSession, d: str) -> DataFrame:
    """One merge: how many incidents are new and how many were there."""
    merged = incidents.merge(_incidents(spark, d, BEFORE, CUTS[1]), _incidents(spark, d, CUTS[1], AFTER))
    return merged.groupBy("inserted").agg(F.count(F.lit(1)).alias("incidents"), F.sum("occurrence_count").alias("events"))


def blast_radius(spark: SparkSession, d: str) -> DataFrame:
    return incidents.with_blast_radius(_incidents(spark, d)).select("fingerprint", "entity", "occurrence_count", "entity_count")


def recovery_semi(spark: SparkSession, d: str) -> DataFrame:
    return _ntz(incidents.last_success(table(spark, d, "acquisition_history"), table(spark, d, "app_run_logs"), NOW))


def incident_last_success(spark: SparkSession, d: str) -> DataFrame:
    """Incidents with the latest success of their equipment, if it came after their last event."""
    s = incidents.last_success(table(spark, d, "acquisition_history"), table(spark, d, "app_run_logs"), NOW)
    i = _incidents(spark, d).join(s, "entity", "left")
    return _ntz(i.select("fingerprint", "entity", "last_seen", F.when(F.col("last_success") > F.col("last_seen"), F.col("last_success")).alias("recovered_at")))


def success_after_incident(spark: SparkSession, d: str) -> DataFrame:
    """Incidents for which some success of the same equipment is later than their last event (semi-join with a range)."""
    i = _incidents(spark, d).alias("i")
    s = table(spark, d, "acquisition_history").where("successful_acquisition").select("system_id", F.coalesce("capture_datetime", "inserted_at").alias("at")).alias("s")
    return i.join(s, (F.col("i.entity") == F.col("s.system_id")) & (F.col("s.at") > F.col("i.last_seen")), "left_semi").select("fingerprint", "entity")


def foreign_audit(spark: SparkSession, d: str) -> DataFrame:
    f = incidents.foreign_outcomes(table(spark, d, "acquisition_history"), table(spark, d, "app_run_logs"), NOW)
    return f.groupBy("app_name").agg(F.count(F.lit(1)).alias("foreign_rows"))


def unlinked_anti(spark: SparkSession, d: str) -> DataFrame:
    u = incidents.unlinked_outcomes(table(spark, d, "acquisition_history"), table(spark, d, "app_run_logs"), NOW)
    return u.agg(F.count(F.lit(1)).alias("unlinked_rows"))


def noop_update(spark: SparkSession, d: str) -> DataFrame:
    """The incidents whose category or sample an update has to write after the last window."""
    old, new = _incidents(spark, d, BEFORE, CUTS[2]), _merged(spark, d)
    return incidents.changed_only(old, new, ["fingerprint", "entity"], ["sample_run_id", "category", "category_source"]).select("fingerprint", "entity", "sample_run_id", "category", "category_source")


def state_guard(spark: SparkSession, d: str) -> DataFrame:
    """Updates made from an older snapshot: written where the incident has not moved on since, else skipped."""
    current = _incidents(spark, d).select("fingerprint", "entity", "last_seen", F.lit(None).cast("string").alias("mark"))
    updates = _incidents(spark, d, BEFORE, CUTS[2]).select("fingerprint", "entity", F.col("last_seen").alias("prev_last_seen"), F.lit("seen").alias("mark"))
    done = incidents.guarded_update(current, updates, ["fingerprint", "entity"], ["last_seen"], ["mark"])
    return done.groupBy("outcome", "mark").agg(F.count(F.lit(1)).alias("incidents"))


def drilldown_topn(spark: SparkSession, d: str) -> DataFrame:
    """The latest 50 events of the incident with the most events."""
    facts = _facts(spark, d)
    top = facts.where("fingerprint IS NOT NULL AND entity IS NOT NULL").groupBy("fingerprint", "entity").count().orderBy(F.desc("count"), "fingerprint", "entity").first()
    if top is None:
        return _ntz(facts.select("run_id", "event_ord", "dt", "type", "func").limit(0))
    return _ntz(incidents.latest_events(facts, top.fingerprint, top.entity).select("run_id", "event_ord", "dt", "type", "func"))


def incident_list_topk(spark: SparkSession, d: str) -> DataFrame:
    i = _incidents(spark, d)
    return _ntz(i.orderBy(F.desc("occurrence_count"), F.desc("last_seen"), "fingerprint", "entity").limit(20).select("fingerprint", "entity", "occurrence_count", "last_seen", "category"))


def incident_rollup(spark: SparkSession, d: str) -> DataFrame:
    """The reader's overview: incidents and events by category and type."""
    return _incidents(spark, d).groupBy("category", "type").agg(F.count(F.lit(1)).alias("incidents"), F.sum("occurrence_count").alias("events"), F.count_distinct("fingerprint").alias("fingerprints"))


def mixed_type_guard(spark: SparkSession, d: str) -> DataFrame:
    return incidents.mixed_types(_facts(spark, d))


def duplicate_key_guard(spark: SparkSession, d: str) -> DataFrame:
    """The uniqueness constraint on records: raw deliveries by how many rows carry the record."""
    e = table(spark, d, "error_events").groupBy(canonical_run_id("run_id").alias("run_id"), "event_ord").count()
    return e.groupBy(F.col("count").alias("deliveries")).agg(F.count(F.lit(1)).alias("records"))


def watermark_advance(spark: SparkSession, d: str) -> DataFrame:
    at = lambda name, key: table(spark, d, name).select(F.lit(key).alias("source_key"), F.col("inserted_at").alias("to_inserted_at"))
    moves = at("app_run_logs", "util.app_run_logs").unionByName(at("error_events", "incidents.error_events"))
    return _ntz(materialize.advanced(table(spark, d, "pipeline_state"), moves))


def _timers(spark: SparkSession, d: str) -> DataFrame:
    """Timers from the events stream: a run is a user's day, labels are ``type.k``, durations follow the value, addresses the user."""
    e = table(spark, d, "events")
    k = F.get_json_object("props", "$.k").cast("int")
    return e.select(
        F.concat_ws("-", "user_id", F.date_format(F.col("ts"), "yyyyMMdd")).alias("run"), F.concat("event_type", F.when(k % 3 != 0, F.concat(F.lit("."), (k % 5).cast("string"))).otherwise("")).alias("label"),
        F.floor(F.col("value") * 1000).cast("bigint").alias("ms"), F.concat_ws(".", F.lit("10.0"), (k % 4).cast("string"), (F.col("user_id") % 250).cast("string")).alias("ip"), "ts",
    )


def run_stats_quantiles(spark: SparkSession, d: str) -> DataFrame:
    return runstats.duration_stats(_timers(spark, d), ["label"])


def duration_buckets(spark: SparkSession, d: str) -> DataFrame:
    return runstats.duration_buckets(_timers(spark, d), ["label"])


def prefix_rollup(spark: SparkSession, d: str) -> DataFrame:
    return runstats.duration_stats(runstats.label_prefix(_timers(spark, d)), ["run", "shown"])


def subnet_rollup(spark: SparkSession, d: str) -> DataFrame:
    return runstats.subnet_stats(_timers(spark, d))


def run_span(spark: SparkSession, d: str) -> DataFrame:
    return runstats.run_span(_timers(spark, d).withColumn("ts", F.col("ts").cast("timestamp")), "run", "ts")


def materialize_runs(spark: SparkSession, d: str) -> DataFrame:
    """The job over the run logs, four runs and a replay of the third: what each appended and how many incidents it made."""
    store, logs, outcomes = IncidentStore(spark), table(spark, d, "app_run_logs"), table(spark, d, "acquisition_history")
    done = [store.run(logs, outcomes, until) for until in (*CUTS, CUTS[-1], AFTER)]
    return spark.createDataFrame([(i + 1, r["appended"], r["inserted"], r["incidents"]) for i, r in enumerate(done)], "run int, appended long, inserted long, incidents long")


def materialized_incidents(spark: SparkSession, d: str) -> DataFrame:
    """The incidents that four runs of the job leave, with the times of the runs that made and last touched them."""
    store, logs, outcomes = IncidentStore(spark), table(spark, d, "app_run_logs"), table(spark, d, "acquisition_history")
    for until in (*CUTS, AFTER):
        store.run(logs, outcomes, until)
    return _flat(store.incidents()).select("fingerprint", "entity", "occurrence_count", "first_seen", "last_seen", "sample_run_id", "sample_message", "created_at", "updated_at")


def state_writeback(spark: SparkSession, d: str) -> DataFrame:
    """Marks prepared after the third run of the job and written after the fourth, twice: where an incident has moved on since, and where
    the mark is there already, nothing is written."""
    store, logs, outcomes = IncidentStore(spark), table(spark, d, "app_run_logs"), table(spark, d, "acquisition_history")
    for until in CUTS:
        store.run(logs, outcomes, until)
    marks = store.files.save(store.incidents().select("fingerprint", "entity", F.col("last_seen").alias("prev_last_seen"), F.lit("seen").alias("mark")), "marks")
    store.run(logs, outcomes, AFTER)
    done = [store.update(marks, ["last_seen"], ["mark"], AFTER) for _ in range(2)]
    marked = store.incidents().where("mark = 'seen'").count()
    return spark.createDataFrame([(i + 1, r["updated"], r["skipped"], r["same"], marked) for i, r in enumerate(done)], "attempt int, updated long, skipped long, same long, marked long")


def dossiers(spark: SparkSession, d: str) -> DataFrame:
    return _ntz(incidents.dossiers(_incidents(spark, d)))


def recovery_facts(spark: SparkSession, d: str) -> DataFrame:
    return _ntz(incidents.recovery_facts(_incidents(spark, d), incidents.last_success(table(spark, d, "acquisition_history"), table(spark, d, "app_run_logs"), NOW)))


def incident_detail(spark: SparkSession, d: str) -> DataFrame:
    """One incident by its identifier: that which the list shows first."""
    i = _incidents(spark, d).withColumn("id", incidents.incident_id())
    top = i.orderBy(F.desc("occurrence_count"), F.desc("last_seen"), "fingerprint", "entity").select("id").first()
    return _flat(i.where(F.col("id") == (top.id if top else None)))


def apps_contain(spark: SparkSession, d: str) -> DataFrame:
    """Incidents that the acquisition app has a part in, and those that it has not."""
    has = F.array_contains("apps", incidents.ORACLE_APP)
    return _incidents(spark, d).groupBy(has.alias("has_app")).agg(F.count(F.lit(1)).alias("incidents"), F.sum("occurrence_count").alias("events"))


def filtered_counts(spark: SparkSession, d: str) -> DataFrame:
    """Aggregates with filters of their own, per entity."""
    f = _facts(spark, d)
    f.createOrReplaceTempView(view := f"fw_{uuid.uuid4().hex}")
    out = spark.sql(f"""
        SELECT entity, count(*) FILTER (WHERE type = 'ERROR') AS errors, count(*) FILTER (WHERE type = 'WARN') AS warnings, count(DISTINCT fingerprint) FILTER (WHERE type = 'ERROR') AS error_kinds,
               max(inserted_at) FILTER (WHERE dt IS NULL) AS last_untimed
        FROM {view} GROUP BY entity""")
    spark.catalog.dropTempView(view)
    return _ntz(out)


def skipped_samples(spark: SparkSession, d: str) -> DataFrame:
    logs = table(spark, d, "app_run_logs").select("run_id", "app_name", "warn_error_logs", "inserted_at")
    return materialize.samples(materialize.skipped(logs))


def timer_scalars(spark: SparkSession, d: str) -> DataFrame:
    return runstats.last_values(_timers(spark, d))


QUERIES = {
    f.__name__: f
    for f in (
        source_scan_window, flatten_events, raw_event_keys, event_text, fingerprint, entity_key, skipped_events, malformed_payloads, dedupe_append, normalize_text, classify_events, classify_layers, backfill_category,
        taxonomy_table, agg_incidents, representative, enriched_incidents, category_source, incremental_merge, rebuild_equals_incremental, merge_inserted, blast_radius, recovery_semi,
        incident_last_success, success_after_incident, foreign_audit, unlinked_anti, noop_update, state_guard, drilldown_topn, incident_list_topk, incident_rollup, mixed_type_guard, duplicate_key_guard,
        watermark_advance, run_stats_quantiles, duration_buckets, prefix_rollup, subnet_rollup, run_span,
        materialize_runs, materialized_incidents, state_writeback, dossiers, recovery_facts, incident_detail, apps_contain, filtered_counts, skipped_samples, timer_scalars,
    )
}
