"""Evaluation texts leaking into a corpus: greedy string tiling.

The evaluation items are a query set; all documents are scanned against them, in blocks of items that bound what is broadcast.
A document's words become numbers of the block's vocabulary; a Karp-Rabin hash that runs over them finds the seeds
(``min_tile`` words that an item has too). Each pair with a seed is tiled: of all common runs of words the longest is marked
first, then the longest that is left without overlap, and so on. The tiles' longest and the share of the item that they cover
decide; coverage also catches passages whose pieces were put in another order.
"""

from __future__ import annotations

import heapq
import re
import unicodedata
from collections.abc import Iterator
from itertools import count, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from faultweave.llm.mail import html_text, visible_text
from faultweave.llm.tokens import small_batches
from faultweave.sources.tables import Scratch

#: Words of a tile at least; the seeds' length.
MIN_TILE = 8
#: Words of the items of one block at most (an item that is longer is a block of its own); 24 bytes of broadcast for each.
BLOCK_WORDS = 1_000_000
#: Blocks that one pass over the documents takes; each document is decoded once in a pass.
PASS_BLOCKS = 8
#: Pairs of a seed in the document and in an item that are held at once; where there are more, the items are taken in parts.
PAIRS = 2_000_000

_WORDS = re.compile(r"[^\W_]+")
_BASE = np.uint64(0x9E3779B97F4A7C15)


def words(text: str) -> list[str]:
    """Maximal runs of letters and digits, compared without case."""
    if not text.isascii() and not unicodedata.is_normalized("NFC", text):
        text = unicodedata.normalize("NFC", text)
    return _WORDS.findall(text.casefold())


def _hashes(ids: np.ndarray, k: int) -> np.ndarray:
    """The running hash of every ``k`` consecutive numbers, by doubling: h(2m) = h(m) * base^m + h(m) shifted."""
    if len(ids) < k:
        return np.empty(0, np.uint64)
    with np.errstate(over="ignore"):
        x = (ids.astype(np.uint64) + np.uint64(2)) * np.uint64(0xD6E8FEB86659FD93)
        x ^= x >> np.uint64(32)
        out, done, power, span, base = None, 0, x, 1, _BASE
        while True:
            if k & span:
                if out is None:
                    out = power
                else:
                    n = len(ids) - done - span + 1
                    out = out[:n] * base + power[done : done + n]
                done += span
            if done == k:
                return out[: len(ids) - k + 1]
            n = len(power) - span
            power = power[:n] * base + power[span : span + n]
            base = base * base
            span *= 2


class Block:
    """Evaluation items as numbers, with an index of their seeds."""

    def __init__(self, items: list[tuple[object, list[str]]], k: int):
        self.k = k
        self.vocabulary = {w: i for i, w in enumerate(sorted({w for _, ws in items for w in ws}))}
        self.keys = [key for key, _ in items]
        self.items = [np.array([self.vocabulary[w] for w in ws], np.int64) for _, ws in items]
        hashed = [_hashes(x, k) for x in self.items]
        self.owner = np.repeat(np.arange(len(items)), [len(h) for h in hashed])
        self.place = np.concatenate([np.arange(len(h)) for h in hashed]) if hashed else np.empty(0, np.int64)
        seeds = np.concatenate(hashed) if hashed else np.empty(0, np.uint64)
        order = np.argsort(seeds, kind="stable")
        self.seeds, self.owner, self.place = seeds[order], self.owner[order], self.place[order]
        self.sketch = np.zeros(1 << 22, bool)  # a first test: the hash's upper bits
        self.sketch[(self.seeds >> np.uint64(42)).astype(np.int64)] = True

    def numbers(self, ws: list[str]) -> np.ndarray:
        get = self.vocabulary.get
        return np.fromiter((get(w, -1) for w in ws), np.int64, len(ws))

    def tiles(self, ids: np.ndarray) -> Iterator[tuple[object, list[tuple[int, int, int]]]]:
        """For each item with a seed in the document: its tiles (start in the item, start in the document, length)."""
        h = _hashes(ids, self.k)
        if not len(h) or not len(self.seeds):
            return
        at = np.flatnonzero(self.sketch[(h >> np.uint64(42)).astype(np.int64)])
        lo, hi = np.searchsorted(self.seeds, h[at], "left"), np.searchsorted(self.seeds, h[at], "right")
        hit = hi > lo
        at, lo, n = at[hit], lo[hit], (hi - lo)[hit]
        if len(at):
            yield from self._of_items(ids, at, lo, n, 0, len(self.items))

    def _of_items(self, ids: np.ndarray, at: np.ndarray, lo: np.ndarray, n: np.ndarray, first: int, end: int) -> Iterator[tuple[object, list[tuple[int, int, int]]]]:
        """The tiles of the items from ``first`` to before ``end``, whose seeds (equal ones are in the order of their items) start at
        ``lo`` and are ``n`` for each place ``at`` of the document."""
        if n.sum() > PAIRS and end - first > 1:
            middle = (first + end) // 2
            less = np.array([np.searchsorted(self.owner[i : i + k], middle) for i, k in zip(lo, n)], np.int64)
            for part, start, many, a, b in ((less > 0, lo, less, first, middle), (n > less, lo + less, n - less, middle, end)):
                if part.any():
                    yield from self._of_items(ids, at[part], start[part], many[part], a, b)
            return
        doc = np.repeat(at, n)
        seed = np.repeat(lo, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        owner, place = self.owner[seed], self.place[seed]
        order = np.lexsort((doc, place - doc, owner))  # by item, then by diagonal
        owner, place, doc = owner[order], place[order], doc[order]
        fresh = np.ones(len(doc), bool)
        fresh[1:] = (owner[1:] != owner[:-1]) | (place[1:] - doc[1:] != place[:-1] - doc[:-1]) | (doc[1:] != doc[:-1] + 1)
        start = np.flatnonzero(fresh)
        length = np.diff(np.append(start, len(doc))) + self.k - 1
        whose = owner[start]
        for cut in np.split(np.arange(len(start)), np.flatnonzero(np.diff(whose)) + 1):
            item = int(whose[cut[0]])
            runs = [(int(place[start[c]]), int(doc[start[c]]), int(length[c])) for c in cut]
            exact = [r for r in (self._verified(item, ids, *r) for r in runs) if r]
            if exact:
                yield self.keys[item], tile(exact, self.k)

    def _verified(self, item: int, ids: np.ndarray, a: int, b: int, n: int) -> tuple[int, int, int] | None:
        """The run word by word, in case two different ones have the same hash."""
        return (a, b, n) if np.array_equal(self.items[item][a : a + n], ids[b : b + n]) else None


def tile(runs: list[tuple[int, int, int]], k: int) -> list[tuple[int, int, int]]:
    """Greedy tiling of maximal common runs: longest first (ties: earliest), each word of either text in one tile, tiles of ``k`` at least."""
    heap = [(-n, a, b) for a, b, n in runs]
    heapq.heapify(heap)
    marked_a, marked_b, out = set(), set(), []
    while heap:
        n, a, b = heapq.heappop(heap)
        n = -n
        free = [i for i in range(n) if a + i not in marked_a and b + i not in marked_b]
        if len(free) == n:
            out.append((a, b, n))
            marked_a.update(range(a, a + n))
            marked_b.update(range(b, b + n))
            continue
        left = 0
        for j in range(1, len(free) + 1):  # what is left of a run that was cut goes back in line
            if j == len(free) or free[j] != free[j - 1] + 1:
                if j - left >= k:
                    heapq.heappush(heap, (-(j - left), a + free[left], b + free[left]))
                left = j
    return out


def blocks_of(items: DataFrame, key: str, text: str, k: int, limit: int = BLOCK_WORDS) -> Iterator[Block]:
    """The items in blocks of bounded size, streamed through the driver one partition at a time."""
    block, size = [], 0
    for r in items.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text")).where("text IS NOT NULL").distinct().orderBy("key", "text").toLocalIterator():
        ws = words(html_text(r.text) if "<" in r.text else r.text)
        if block and size + len(ws) > limit:
            yield Block(block, k)
            block, size = [], 0
        block.append((r.key, ws))
        size += len(ws)
    if block:
        yield Block(block, k)


def leaks(docs: DataFrame, doc_key: str, doc_text: str, items: DataFrame, item_key: str, item_text: str, min_tile: int = MIN_TILE, block_words: int = BLOCK_WORDS) -> DataFrame:
    """Pairs of a document and an item that share a tile: doc, item, longest (words), tiles, covered (words), item_words, coverage.

    Documents are read whole, as their readers see them. Null and empty texts share nothing; an item of fewer than
    ``min_tile`` words has no seed. Repeated rows of a document or an item give one pair, with the best tiles. Empty tables
    give an empty result. Only the four named columns are read. The result has one row for each pair that shares a passage;
    documents without one give none.
    """
    spark = docs.sparkSession
    source = docs.select(F.col(f"`{doc_key}`").alias("doc"), F.col(f"`{doc_text}`").alias("text")).where("text IS NOT NULL")
    kinds = [t.schema[f"{k}"].dataType for t, k in ((docs, doc_key), (items, item_key))]
    schema = f"doc {kinds[0].simpleString()}, item {kinds[1].simpleString()}, longest int, tiles int, covered int, item_words int"
    item_type, s, found = to_arrow_type(kinds[1]), Scratch(spark), spark.createDataFrame([], schema)
    blocks = blocks_of(items, item_key, item_text, min_tile, block_words)
    for number in count():
        held = list(islice(blocks, PASS_BLOCKS))
        if not held:
            break
        sent = spark.sparkContext.broadcast(held)

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            lengths = [{k: len(x) for k, x in zip(b.keys, b.items)} for b in sent.value]
            for batch in batches:
                rows = []
                for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    ws = words(visible_text(text))
                    for b, length in zip(sent.value, lengths):
                        for item, ts in b.tiles(b.numbers(ws)):
                            rows.append((doc, item, max(t[2] for t in ts), len(ts), sum(t[2] for t in ts), length[item]))
                names = ["doc", "item", "longest", "tiles", "covered", "item_words"]
                types = [batch.schema.field(0).type, item_type, *[pa.int32()] * 4]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * 6, types)], names=names)

        with small_batches(spark):
            found = found.unionByName(s.save(source.mapInArrow(run, schema), f"pairs{number}"))
        sent.unpersist()
    best = found.groupBy("doc", "item").agg(F.max(F.struct("longest", "covered", "tiles", "item_words")).alias("b")).select("doc", "item", "b.*")
    return best.withColumn("coverage", F.col("covered") / F.col("item_words"))
