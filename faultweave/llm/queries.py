"""Queries of the text problems and of top N (p4, p7, p8, p9)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faultweave.llm import leakage, packing, textquality, topn
from faultweave.plans.preparation import event_records
from faultweave.plans.preparation_sql import _RECORDS
from faultweave.sources.tables import spread, table


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = event_records(spark, sf_dir, "fingerprint", "entity", "dt").where(F.col("fingerprint").isNotNull())
    return topn.top_n(records, ["fingerprint", "entity"], ["dt", "run_id", "event_ord"], 3, unique=True).select("fingerprint", "entity", "run_id", "event_ord")


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id")


def p7_assignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's container of 4,096 tokens; longer texts in parts."""
    return packing.containers(_documents(spark, sf_dir), "doc_id", "text")


def p7_fill_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Containers by whether they are full: how many, their tokens and the unused ones."""
    bins = p7_assignment(spark, sf_dir).groupBy("container").agg(F.sum("tokens").alias("fill"), F.count(F.lit(1)).alias("items"))
    return bins.groupBy((F.col("fill") == packing.CAPACITY).alias("is_full")).agg(
        F.count(F.lit(1)).alias("containers"), F.sum("fill").alias("tokens"), F.sum(packing.CAPACITY - F.col("fill")).alias("unused"), F.max("items").alias("most_items")
    )


#: Words in a row that make a leak, and the share of an item that makes one when its pieces were put in another order.
LEAK_WORDS, LEAK_COVERAGE = 13, 0.5


def _leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leakage.leaks(_documents(spark, sf_dir), "doc_id", "text", table(spark, sf_dir, "eval_items"), "item_id", "text")


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _leaks(spark, sf_dir).where(F.col("longest") >= LEAK_WORDS).select(F.col("doc").alias("doc_id"), F.col("item").alias("item_id"))


def p8_leak_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaked pairs, also reordered ones, with their tiles and the item's suite."""
    pairs = _leaks(spark, sf_dir).where((F.col("longest") >= LEAK_WORDS) | (F.col("coverage") >= LEAK_COVERAGE))
    items = table(spark, sf_dir, "eval_items").select(F.col("item_id").alias("item"), "suite").groupBy("item").agg(F.max("suite").alias("suite"))
    return pairs.join(items, "item", "left").select(F.col("doc").alias("doc_id"), F.col("item").alias("item_id"), "suite", "longest", "tiles", "covered", "coverage")


def p9_text_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's statistics, the posteriors of the text types and the likeliest type."""
    common = textquality.common_words(table(spark, sf_dir, "common_words"))
    return textquality.text_types(_documents(spark, sf_dir), "doc_id", "text", common)


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p9_text_types(spark, sf_dir).where(F.col("p_prose") < 0.5).select("doc_id")


QUERIES = {f.__name__: f for f in (p4_found, p7_assignment, p7_fill_report, p8_found, p8_leak_report, p9_found, p9_text_types)}

SQL = {
    "p4_found": f"""
      SELECT fingerprint, entity, rid AS run_id, event_ord FROM (
        SELECT *, row_number() OVER (PARTITION BY fingerprint, entity ORDER BY dt DESC, rid DESC, event_ord DESC) AS place
        FROM ({_RECORDS}) WHERE fingerprint IS NOT NULL AND dt IS NOT NULL)
      WHERE place <= 3""",
}
