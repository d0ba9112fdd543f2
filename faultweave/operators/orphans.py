"""References to records that do not exist.

A blocked Bloom filter of the parent keys, broadcast if it is small and else joined by block, proves most orphans; only the references that
pass it are joined exactly with the parents. References are made distinct before anything is joined, so a key that a third of
all rows name is one row in the joins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A filter of more bits than this (8 MB of filter) is not broadcast; then its words and the references are shuffled by block.
MAX_BITS = 1 << 26
BITS_PER_KEY = 12
_WORD = 64


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks))


def _mask(key: Column, probes: int = 6) -> Column:
    """``probes`` bits in one 64-bit word, from a second hash: one lookup answers a membership test."""
    h = F.xxhash64(key, F.lit("mask"))
    mask = F.lit(0).cast("long")
    for i in range(probes):
        mask = mask.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(F.shiftrightunsigned(h, 6 * i), F.lit(_WORD)).cast("int")))
    return mask


def filter_blocks(expected: int) -> int:
    """Words of a filter for so many keys."""
    return (1 << max(12, (BITS_PER_KEY * max(expected, 1) - 1).bit_length())) // _WORD


def bloom_filter(parents: DataFrame, key: str, blocks: int) -> DataFrame:
    """The filter's non-empty words as rows (``block``, ``bits``), at most ``blocks`` of them; null keys are not in it."""
    k = F.col(f"`{key}`")
    return parents.where(k.isNotNull()).groupBy(_block(k, blocks).alias("block")).agg(F.bit_or(_mask(k)).alias("bits"))


def orphans(refs: DataFrame, parents: DataFrame, key: str, parent_key: str, max_bits: int = MAX_BITS) -> DataFrame:
    """The distinct rows of ``refs`` whose ``key`` no row of ``parents`` has.

    Null keys are no references and never orphans; null parent keys match nothing. An empty ``parents`` makes every reference
    an orphan; an empty ``refs`` gives an empty result. ``refs`` may have any columns: they are kept and made distinct.
    """
    r = refs.where(F.col(f"`{key}`").isNotNull()).distinct()
    keys = parents.select(F.col(f"`{parent_key}`").alias("__parent")).where(F.col("__parent").isNotNull())
    p = keys.distinct()
    n = keys.agg(F.approx_count_distinct("__parent", 0.05)).first()[0]  # sketches of the map tasks; no exchange of keys
    blocks = filter_blocks(n)
    words = bloom_filter(keys, "__parent", blocks).select(F.col("block").alias("__block"), F.col("bits").alias("__bits"))
    k = F.col(f"`{key}`")
    words = F.broadcast(words) if blocks * _WORD <= max_bits else words.hint("merge")
    marked = r.withColumn("__block", _block(k, blocks)).join(words, "__block", "left")
    passes = F.coalesce(F.col("__bits").bitwiseAND(_mask(k)) == _mask(k), F.lit(False))
    tested = marked.withColumn("__maybe", passes).select(*(F.col(f"`{c}`") for c in r.columns), "__maybe")
    proven = tested.where(~F.col("__maybe")).drop("__maybe")
    return proven.unionByName(_exact(tested.where("__maybe").drop("__maybe"), p, key))


def _exact(refs: DataFrame, parents: DataFrame, key: str) -> DataFrame:
    return refs.join(parents, F.col(f"`{key}`") == F.col("__parent"), "left_anti")
