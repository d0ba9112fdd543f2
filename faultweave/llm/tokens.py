"""Token counts with a public byte-level BPE vocabulary."""

from __future__ import annotations

import base64
import os
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faultweave.sources.tables import ship

#: A rank file: base64 token and rank per line. Any vocabulary of that form can be named instead.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: How that vocabulary splits text before its merges (a fixed value).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

_encoders: dict = {}


def encoder(path: str = VOCABULARY):
    """The tokenizer; loaded once in each Python worker."""
    if path not in _encoders:
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        _encoders[path] = tiktoken.Encoding("public", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _encoders[path]


@contextmanager
def small_batches(spark: SparkSession, rows: int = 500) -> Iterator[None]:
    """Fewer rows in an Arrow batch than usual while what is in here runs: a text may have hundreds of thousands of characters."""
    ship(spark)
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    usual = spark.conf.get(key)
    spark.conf.set(key, rows)
    try:
        yield
    finally:
        spark.conf.set(key, usual)


def count_tokens(df: DataFrame, key: str, text: str, vocabulary: str = VOCABULARY) -> DataFrame:
    """``key`` and the ``tokens`` of the whole ``text``; a null or empty text has 0. The vocabulary's file is sent to the executors; run
    the result inside ``small_batches``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent = SparkFiles.get(os.path.basename(vocabulary))
        encode = encoder(sent if os.path.exists(sent) else vocabulary).encode_ordinary
        for b in batches:
            n = [len(encode(t)) if t else 0 for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int32())], names=[key, "tokens"])

    df.sparkSession.sparkContext.addFile(vocabulary)
    source = df.select(F.col(f"`{key}`"), F.col(f"`{text}`").alias("__text"))
    return source.mapInArrow(run, f"`{key}` {source.schema[0].dataType.simpleString()}, tokens int")
