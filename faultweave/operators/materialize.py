"""Run logs to facts: incremental scan, flattening of nested events, skipped records, idempotent append, watermarks."""

from __future__ import annotations

import os
from dataclasses import dataclass
from datetime import UTC, datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faultweave.functions import classify as taxonomy
from faultweave.functions import text as tx
from faultweave.functions.ids import canonical_run_id
from faultweave.sources.tables import PRODUCERS, SELF_APP, setting

EPOCH = datetime(1970, 1, 1, tzinfo=UTC)


def env_int(name: str, default: int) -> int:
    """A non-negative integer from the environment; unset or blank gives the default, anything else is refused."""
    raw = os.environ.get(name, "").strip()
    if not raw:
        return default
    if not raw.isdigit():
        raise ValueError(f"{name} must be a non-negative integer, not {raw!r}")
    return int(raw)


@dataclass(frozen=True)
class Config:
    """How a materialization scans: the producers and how far before the watermark it looks again."""

    producers: tuple[str, ...] = PRODUCERS
    overlap: timedelta = timedelta(seconds=30)

    def __post_init__(self):
        if SELF_APP in self.producers:
            raise ValueError("the engine's own logs are not a source")

    @classmethod
    def from_env(cls) -> Config:
        return cls(overlap=timedelta(milliseconds=env_int("MATERIALIZE_OVERLAP_MS", 30_000)))


def source_scan(logs: DataFrame, after: datetime, until: datetime, config: Config = Config()) -> DataFrame:
    """The rows of (after - overlap, until] of the producers, three columns of them; filters and columns reach the Parquet scan."""
    at = F.col("inserted_at")
    mine = F.col("app_name").isin(*config.producers) & (F.col("app_name") != SELF_APP)
    start = max(after - config.overlap, EPOCH) if after > EPOCH else EPOCH
    return logs.where((at > F.lit(start)) & (at <= F.lit(until)) & mine & F.col("warn_error_logs").isNotNull()).select("run_id", "app_name", "warn_error_logs", "inserted_at")


def parsed(df: DataFrame, text: str, value: str) -> DataFrame:
    """``df`` with the VARIANT of a JSON text, null if it is none. Of equal names in an object the last counts."""
    with setting(df.sparkSession, "spark.sql.variant.allowDuplicateKeys", "true"):  # looked up when the expression is analysed
        return df.withColumn(value, F.try_parse_json(text))


def _is_array(v: Column) -> Column:
    return F.schema_of_variant(v).startswith("ARRAY<")


def exploded(logs: DataFrame) -> DataFrame:
    """One row per array element with its 0-based place ``event_ord`` (kept across malformed elements) and its VARIANT ``event``."""
    array = logs.withColumn("__a", F.when(F.col("warn_error_logs").rlike(r"\A\s*\["), F.col("warn_error_logs")))
    elements = parsed(array, "__a", "__v").lateralJoin(logs.sparkSession.tvf.variant_explode(F.col("__v").outer()))
    return elements.withColumnsRenamed({"pos": "event_ord", "value": "event"}).drop("__a", "__v", "key", "warn_error_logs")


def _is_object(v: Column) -> Column:
    return F.schema_of_variant(v).startswith("OBJECT<")


def flatten(logs: DataFrame) -> DataFrame:
    """The facts of all well-formed events: one row per object element, 18 columns and the event's JSON text."""
    e = F.col("event")
    rows = exploded(logs).where(_is_object(e))
    text = rows.withColumn("__text", tx.event_text(e)).withColumn("__sme", tx.non_blank(tx.only_string(e, "$.note.sme")))
    sme = F.left(F.col("__sme"), F.lit(16))
    system = F.coalesce(tx.system_id(tx.only_string(e, "$.note.system_id")), tx.system_id(F.col("__sme")))
    cls = taxonomy.classify(F.col("__text"))
    cap = lambda path, n: F.left(tx.only_string(e, path), F.lit(n))
    made = text.withColumns({"__sys": system, "__cls": cls})
    return made.select(
        canonical_run_id("run_id").alias("run_id"), "event_ord", F.left("app_name", F.lit(64)).alias("src_app_name"), cap("$.type", 8).alias("type"), cap("$.func", 64).alias("func"),
        cap("$.tag", 32).alias("tag"), tx.non_blank(tx.only_string(e, "$.err_msg")).alias("err_msg"), tx.non_blank(tx.only_string(e, "$.note.message")).alias("note_message"), sme.alias("sme"),
        tx.non_blank(tx.only_string(e, "$.note.job_id")).alias("job_id"), F.col("__sys").alias("system_id"), tx.entity(sme, F.col("__sys")).alias("entity"),
        tx.fingerprint(F.col("app_name"), tx.as_text(e, "$.func"), tx.as_text(e, "$.tag"), tx.as_text(e, "$.type"), F.col("__text")).alias("fingerprint"),
        F.lit(tx.FP_VERSION).cast("smallint").alias("fp_version"), F.left(F.col("__cls.category"), F.lit(64)).alias("error_category"), F.left(F.col("__cls.error_type"), F.lit(16)).alias("error_type"),
        F.lit("").alias("phase"), event_time(tx.only_string(e, "$.dt")).alias("dt"), F.col("__text").alias("event_text"), without_nul(F.to_json(e)).alias("raw_event"), "inserted_at",
    )


def without_nul(json: Column) -> Column:
    """JSON text without the character U+0000 in keys and values. It stands there as an escape, which only counts as one behind an even
    number of backslashes; behind an odd number it is a backslash and five characters."""
    return F.regexp_replace(json, r"(?<!\\)((?:\\\\)*)(?:\\u0000)+", "$1")


def event_time(text: Column) -> Column:
    """The instant of a date text in milliseconds, null if it is none: ISO forms, and the long form of date printers."""
    iso = F.when(text.rlike(r"\A\s*[+-]?\d{4}-\d{2}(-\d{2})?([T ]\d{2}:\d{2}.*)?\s*\z"), text.try_cast("timestamp"))
    long = F.regexp_extract(text, r"\A\w{3} (\w{3} \d{2} \d{4} \d{2}:\d{2}:\d{2}) GMT([+-]\d{4})", 0)
    parts = F.concat_ws(" ", F.regexp_extract(text, r"\A\w{3} (\w{3} \d{2} \d{4} \d{2}:\d{2}:\d{2}) GMT([+-]\d{4})", 1), F.regexp_extract(text, r"GMT([+-]\d{4})", 1))
    printed = F.when(F.length(long) > 0, F.try_to_timestamp(parts, F.lit("MMM dd yyyy HH:mm:ss xx")))
    at = F.coalesce(iso, printed)
    us = F.unix_micros(at)
    return F.timestamp_micros(us - F.pmod(us, F.lit(1000)))


def skipped(logs: DataFrame) -> DataFrame:
    """What flattening leaves out: payloads that are no arrays (place null) and elements that are no objects; null payloads are neither."""
    whole = parsed(logs.where(F.col("warn_error_logs").isNotNull()), "warn_error_logs", "__v")
    not_array = whole.where(F.col("__v").isNull() | ~_is_array(F.col("__v"))).where(~F.coalesce(F.is_variant_null("__v"), F.lit(False)))
    payloads = not_array.select(canonical_run_id("run_id").alias("run_id"), F.lit(None).cast("int").alias("event_ord"), F.lit("payload is not an array").alias("reason"))
    elements = exploded(logs).where(~_is_object(F.col("event"))).select(canonical_run_id("run_id").alias("run_id"), "event_ord", F.lit("event is not an object").alias("reason"))
    return payloads.unionByName(elements)


def samples(rows: DataFrame, n: int = 20) -> DataFrame:
    """The first ``n`` skipped records, by run and place: what a report shows of them."""
    return rows.orderBy("run_id", F.asc_nulls_first("event_ord"), "reason").limit(n)


def append_new(existing: DataFrame, rows: DataFrame, keys: list[str]) -> DataFrame:
    """The rows to append: one per key, of keys that ``existing`` has not (replays append nothing). Null keys are refused."""
    return rows.where(" AND ".join(f"`{k}` IS NOT NULL" for k in keys)).dropDuplicates(keys).join(existing.select(*keys), keys, "left_anti")


def moved(cursors: dict[str, str], source: str, to: datetime) -> dict[str, str]:
    """The cursors (ISO texts by source) with one moved to ``to``, never back."""
    return cursors | {source: max(cursor(cursors, source), to).isoformat()}


def cursor(cursors: dict[str, str], source: str) -> datetime:
    at = cursors.get(source)
    return datetime.fromisoformat(at) if at else EPOCH


def advanced(state: DataFrame, moves: DataFrame) -> DataFrame:
    """Relational form: stored cursors and new ones by source_key, the greater of both, the epoch where there was none."""
    m = moves.groupBy("source_key").agg(F.max("to_inserted_at").alias("to_inserted_at"))
    at = F.greatest(F.coalesce("last_inserted_at", F.timestamp_seconds(F.lit(0))), F.col("to_inserted_at"))
    return state.join(m, "source_key", "full_outer").select("source_key", at.alias("last_inserted_at"))
