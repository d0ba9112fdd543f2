"""Facts to incidents: windowed roll-up by (fingerprint, entity), incremental merge, enrichment, recovery facts and audits."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from faultweave.functions import text as tx
from faultweave.functions.ids import canonical_run_id
from faultweave.operators.materialize import parsed

KEYS = ["fingerprint", "entity"]
#: The app whose runs the outcome history belongs to (a fixed value).
ORACLE_APP = "data_acquisition"


def window_of(facts: DataFrame, after: datetime, until: datetime) -> DataFrame:
    """The strictly half-open window (after, until] on arrival: no overlap, so that additive counts stay exact."""
    return facts.where((F.col("inserted_at") > F.lit(after)) & (F.col("inserted_at") <= F.lit(until)))


def message(facts: DataFrame) -> DataFrame:
    """``facts`` with ``ts`` (event time, else arrival) and ``msg``, the representative text."""
    inner = lambda p: tx.non_blank(tx.only_string(F.col("__raw"), p))
    msg = F.coalesce(tx.non_blank(F.col("err_msg")), tx.non_blank(F.col("note_message")), inner("$.note.txt"), inner("$.note.skip_reason"), F.lit(""))
    return parsed(facts, "raw_event", "__raw").withColumns({"ts": F.coalesce("dt", "inserted_at"), "msg": msg}).drop("__raw")


def rollup(facts: DataFrame) -> DataFrame:
    """One row per key: count, first and last time, the sorted sets of apps and systems, and the latest event as representative.

    One hash aggregation with map-side partial states; the representative is an algebraic maximum over (ts, run_id, event_ord), so
    neither a join nor a sort of the key's events is needed, and merging roll-ups in any order gives the same.
    """
    order = F.struct("ts", "run_id", "event_ord")
    payload = F.struct("run_id", "system_id", "msg", "error_category", "error_type", "type", "func", "event_ord")
    return facts.groupBy(*KEYS).agg(
        F.count(F.lit(1)).alias("occurrence_count"), F.min("ts").alias("first_seen"), F.max("ts").alias("last_seen"),
        F.array_sort(F.collect_set("src_app_name")).alias("apps"), F.array_sort(F.collect_set("system_id")).alias("systems"), F.max_by(payload, order).alias("rep"),
    )


def latest_outcome_category(outcomes: DataFrame) -> DataFrame:
    """Per system the category of its latest outcome that has a telling one; ties by category."""
    telling = outcomes.where(F.col("error_category").isNotNull() & (F.col("error_category") != "unknown"))
    return telling.groupBy("system_id").agg(F.max_by("error_category", F.struct("inserted_at", "error_category")).alias("enr_category"))


def enrich(rolled: DataFrame, outcomes: DataFrame) -> DataFrame:
    """Roll-ups with the final category and where it comes from; only outcomes of systems in the batch are aggregated (semi-join)."""
    systems = rolled.select(F.col("rep.system_id").alias("system_id")).where("system_id IS NOT NULL").distinct()
    known = latest_outcome_category(outcomes.join(systems, "system_id", "left_semi"))
    joined = rolled.withColumn("system_id", F.col("rep.system_id")).join(known, "system_id", "left")
    unknown = F.col("rep.error_category") == "unknown"
    return joined.select(
        *KEYS, "occurrence_count", "first_seen", "last_seen", "apps", "systems", F.col("rep.run_id").alias("sample_run_id"), F.col("rep.msg").alias("sample_message"),
        F.when(unknown, F.coalesce("enr_category", "rep.error_category")).otherwise(F.col("rep.error_category")).alias("category"),
        F.when(unknown & F.col("enr_category").isNotNull(), "oracle").otherwise("classifier").alias("category_source"),
        F.col("rep.error_type").alias("error_type"), F.col("rep.type").alias("type"), F.lit("").alias("phase"), F.col("rep.func").alias("func"),
    )


_GUARDED = "sample_run_id", "sample_message", "category", "category_source", "error_type", "func"


def merge(old: DataFrame, delta: DataFrame, now: datetime | None = None) -> DataFrame:
    """The next version of the incidents: counts add up, times widen, sets unite, and the sample columns change together if the delta's
    representative is later. ``inserted`` says that a key is new. With ``now`` there are ``created_at`` and ``updated_at``, which changes
    for the keys that the delta has and stays for the others. Further columns of ``old``, such as states, stay as they are."""
    o, d = old.select(F.struct("*").alias("o"), *KEYS), delta.select(F.struct("*").alias("d"), *KEYS)
    j = o.join(d, KEYS, "full_outer")
    newer = F.coalesce(F.struct("d.last_seen", "d.sample_run_id") > F.struct("o.last_seen", "o.sample_run_id"), F.col("o").isNull())
    both = lambda c: F.array_sort(F.array_distinct(F.concat(F.coalesce(f"o.{c}", F.array()), F.coalesce(f"d.{c}", F.array()))))
    newer = F.when(F.col("o").isNull(), True).when(F.col("d").isNull(), False).otherwise(newer)
    at = lambda c: F.col(f"o.{c}") if c in old.columns else F.lit(None).cast("timestamp")
    stamps = [F.coalesce(at("created_at"), F.lit(now)).alias("created_at"), F.when(F.col("d").isNotNull(), F.lit(now)).otherwise(at("updated_at")).alias("updated_at")] if now else []
    more = [F.col(f"o.{c}").alias(c) for c in old.columns if c not in {*delta.columns, "inserted", "created_at", "updated_at"}]
    return j.select(
        *KEYS, (F.coalesce("o.occurrence_count", F.lit(0)) + F.coalesce("d.occurrence_count", F.lit(0))).alias("occurrence_count"),
        F.least("o.first_seen", "d.first_seen").alias("first_seen"), F.greatest("o.last_seen", "d.last_seen").alias("last_seen"), both("apps").alias("apps"), both("systems").alias("systems"),
        *(F.when(newer, F.col(f"d.{c}")).otherwise(F.col(f"o.{c}")).alias(c) for c in _GUARDED),
        F.coalesce("o.type", "d.type").alias("type"), F.coalesce("o.phase", "d.phase").alias("phase"), F.col("o").isNull().alias("inserted"), *stamps, *more,
    )


def with_blast_radius(incidents: DataFrame) -> DataFrame:
    """Incidents with the number of entities that share their fingerprint."""
    radius = incidents.groupBy("fingerprint").agg(F.count(F.lit(1)).alias("entity_count"))
    return incidents.join(radius, incidents["fingerprint"].eqNullSafe(radius["fingerprint"]), "inner").drop(radius["fingerprint"])


def last_success(outcomes: DataFrame, logs: DataFrame, now: datetime, days: int = 14) -> DataFrame:
    """Per system the latest success of a run of the acquisition app within ``days``."""
    since = F.lit(now - timedelta(days=days))
    runs = logs.where((F.col("inserted_at") > since) & (F.col("app_name") == ORACLE_APP)).select(canonical_run_id("run_id").alias("run_id")).where("run_id IS NOT NULL")
    good = outcomes.where(F.col("successful_acquisition") & (F.col("inserted_at") > since)).withColumn("run_id", canonical_run_id("run_id"))
    return good.join(runs, "run_id", "left_semi").groupBy(F.col("system_id").alias("entity")).agg(F.max(F.coalesce("capture_datetime", "inserted_at")).alias("last_success"))


def foreign_outcomes(outcomes: DataFrame, logs: DataFrame, now: datetime, days: int = 14) -> DataFrame:
    """Outcome rows whose run belongs to another app, one for each such log row."""
    since = F.lit(now - timedelta(days=days))
    other = logs.where((F.col("inserted_at") > since) & (F.col("app_name") != ORACLE_APP)).select(canonical_run_id("run_id").alias("run_id"), "app_name")
    return outcomes.where(F.col("inserted_at") > since).withColumn("run_id", canonical_run_id("run_id")).join(other, "run_id")


def unlinked_outcomes(outcomes: DataFrame, logs: DataFrame, now: datetime) -> DataFrame:
    """Outcome rows of the last two days but the last hour without a log row in 14 days; a missing run_id has none."""
    runs = logs.where(F.col("inserted_at") > F.lit(now - timedelta(days=14))).select(canonical_run_id("run_id").alias("run_id"))
    recent = outcomes.where(F.col("inserted_at").between(F.lit(now - timedelta(days=2)), F.lit(now - timedelta(hours=1)))).withColumn("run_id", canonical_run_id("run_id"))
    return recent.join(runs, "run_id", "left_anti")


def changed_only(stored: DataFrame, new: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """The rows of ``new`` that differ from what is stored in any of ``columns`` (null-safe): what an update has to write."""
    s = stored.select(*(F.col(k).alias(f"__{k}") for k in keys), F.struct(*columns).alias("__s"))
    on = [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys]
    return new.join(s, on, "inner").where(~F.struct(*columns).eqNullSafe(F.col("__s"))).drop("__s", *(f"__{k}" for k in keys))


def guarded_update(current: DataFrame, updates: DataFrame, keys: list[str], expected: list[str], columns: list[str]) -> DataFrame:
    """``current`` with ``columns`` replaced where ``prev_*`` of an update still equals it (null-safe); ``outcome`` says updated, skipped or kept."""
    u = updates.select(*keys, F.struct("*").alias("__u"))
    same = F.lit(True)
    for c in expected:
        same = same & F.col(c).eqNullSafe(F.col(f"__u.prev_{c}"))
    joined = current.join(u, keys, "left")
    hit = F.col("__u").isNotNull() & same
    rest = [c for c in current.columns if c not in columns]
    outcome = F.when(hit, "updated").when(F.col("__u").isNotNull(), "skipped").otherwise("kept")
    return joined.select(*rest, *(F.when(hit, F.col(f"__u.{c}")).otherwise(F.col(c)).alias(c) for c in columns), outcome.alias("outcome"))


def mixed_types(facts: DataFrame) -> DataFrame:
    """Fingerprints with more than one event type: must be none."""
    return facts.where("fingerprint IS NOT NULL").groupBy("fingerprint").agg(F.count_distinct("type").alias("types")).where("types > 1")


def latest_events(facts: DataFrame, fingerprint: str, entity: str, n: int = 50) -> DataFrame:
    """The drill-down: the latest ``n`` events of one incident, a top-n without a full sort. Over facts at rest the filter reaches the
    scan; facts that still have to be made free of repeats are read whole first."""
    order: list[Column] = [F.desc_nulls_last("dt"), F.desc("run_id"), F.desc("event_ord")]
    return facts.where((F.col("fingerprint") == fingerprint) & (F.col("entity") == entity)).orderBy(*order).limit(n)


def without_repeats(facts: DataFrame) -> DataFrame:
    """The first delivery of every (run_id, event_ord), by arrival and then by content: one aggregation, whose map tasks combine
    the copies that they hold. Only the columns that ``facts`` has are read and compared."""
    keys = ["run_id", "event_ord"]
    rest = [c for c in facts.columns if c not in (*keys, "inserted_at")]
    first = F.min(F.struct("inserted_at", *(F.col(f"`{c}`") for c in rest))).alias("__first")
    return facts.groupBy(*keys).agg(first).select(*(F.col(c) if c in keys else F.col(f"__first.`{c}`").alias(c) for c in facts.columns))


def incident_id() -> Column:
    """A stable identifier of an incident, from its key."""
    return F.md5(F.concat_ws("|", F.col("fingerprint"), F.coalesce("entity", F.lit(""))))


def dossiers(incidents: DataFrame) -> DataFrame:
    """What an assessment reads of every incident, with the number of entities that share its fingerprint."""
    return with_blast_radius(incidents).select(
        incident_id().alias("id"), "category", "category_source", "type", "entity_count", "occurrence_count", "entity", "func", "first_seen", "last_seen", "sample_message"
    )


def recovery_facts(incidents: DataFrame, successes: DataFrame) -> DataFrame:
    """What a recovery check reads of every incident: its times, its first application, and the latest success of its equipment."""
    return incidents.join(successes, "entity", "left").select(incident_id().alias("id"), "entity", "last_seen", F.try_element_at("apps", F.lit(1)).alias("src_app"), "last_success")
