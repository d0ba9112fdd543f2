"""Per-document text statistics, and the type of a text by labelling functions whose accuracies are learned.

Thresholds on the statistics are noisy labelling functions: each says high, low or nothing about a document, by one property of its
text. How often each is right about each type is not known; expectation-maximization learns it from where they agree, over the
histogram of vote patterns, which has at most 3 to the power of their number rows whatever the corpus. The posterior of a
document's pattern is its text type.

What many messages end with is not their senders' text: the last paragraph of a body is boilerplate where it also ends other bodies,
behind at least ``MIN_ENDS`` different paragraphs. That is learned from all documents before their statistics are taken.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faultweave.llm.mail import body_of
from faultweave.llm.tokens import small_batches
from faultweave.llm.topn import attach
from faultweave.sources.tables import Scratch

TYPES = ("prose", "list", "table", "junk")
#: The components of the mixture and the type of each: junk that is noise and junk that repeats a few words vote quite differently.
COMPONENTS = {"prose": "prose", "list": "list", "table": "table", "noise": "junk", "echo": "junk"}
#: The common words are a fixed, small table; more than this are refused.
MAX_COMMON = 100_000
#: Different paragraphs before a last one that make it boilerplate; a longer last paragraph never is.
MIN_ENDS, MAX_END = 3, 1000

_EDGE = "\"'“”„«»‘’()[]{}<>.,;:!?¡¿…*_-–—/|#~"
_LETTERS = re.compile(r"[^\W\d_]+(?:['’-][^\W\d_]+)*\Z")
_BULLET = re.compile(r"\s*(?:[-*•·+–o]\s|\[[ xX]?\]|\(?\d{1,3}[.)]\s|\(?[a-z][.)]\s)")
_ROW = re.compile(r"\t|\||;|\S {2,}\S|,\S")
_END = re.compile(r"[.!?…;][\"'”’)\]]*\Z")

#: What is counted of a paragraph; all of it adds up.
SUMS = ("chars", "lines", "words", "letters", "tokens", "commons", "ended", "symbols", "digits", "bulleted", "short", "rows", "odd", "wordy", "lettered", "closed", "echoed")
#: The statistics of a document: name, type, and the two sums that it is the ratio of, or the sum.
_RATIOS = (
    ("mean_word_length", "letters", "words"), ("symbol_ratio", "symbols", "chars"), ("digit_ratio", "digits", "chars"), ("end_mark_share", "ended", "lines"), ("common_share", "commons", "tokens"),
    ("words_per_line", "words", "lines"), ("bullet_share", "bulleted", "chars"), ("short_line_share", "short", "chars"), ("row_share", "rows", "chars"), ("odd_share", "odd", "chars"),
    ("wordy_share", "wordy", "chars"), ("lettered_share", "lettered", "chars"), ("closed_share", "closed", "chars"), ("echo_share", "echoed", "chars"),
)
STATS = (("chars", "int"), ("lines", "int"), ("words", "int"), *((n, "double") for n, _, _ in _RATIOS))


def paragraph_sums(lines: list[str], common: frozenset[str] | set[str]) -> list[int]:
    """The values of ``SUMS`` for the lines of a paragraph.

    chars: non-blank characters, which also weigh the lines; tokens are apart by blanks, and those are words that are letters alone
    once marks at their edges are gone. symbols, digits, odd: characters; odd ones are in tokens that mix letters with digits or
    symbols or exceed 24 characters, addresses and rows of cells aside. ended: lines with an end mark. bulleted: list items.
    short: lines of at most five tokens without an end mark. rows: of two separators or more and few common words. wordy: at least
    four words and four fifths of the tokens. lettered: three words, and four fifths of the characters are in words. closed: the
    whole paragraph, if it ends with an end mark and has four words. echoed: the whole paragraph, if its words repeat so much that
    the square of the different ones is under six times their number, of twelve at least.
    """
    chars = words = letters = tokens = commons = ended = symbols = digits = bulleted = short = rows = odd = wordy = lettered = 0
    seen: set[str] = set()
    marked = False
    for line in lines:
        parts = line.lower().split()
        size = sum(map(len, parts))
        n = known = mine = strange = 0
        for p in parts:
            w = p if p.isalpha() else p.strip(_EDGE)
            if w in common:
                known += 1
            if w.isalpha() or w and _LETTERS.match(w):
                n += 1
                mine += len(w)
                seen.add(w)
                if len(w) > 24:
                    strange += len(p)
            elif "@" not in w and (len(p) > 24 or len(w) > 2 and any(map(str.isalpha, w))):
                strange += len(p)
        alnum, alpha = sum(map(str.isalnum, line)), sum(map(str.isalpha, line))
        marked = bool(_END.search(line.rstrip()))
        cells = len(_ROW.findall(line)) >= 2 and known * 5 < len(parts)
        chars += size
        words += n
        letters += mine
        tokens += len(parts)
        commons += known
        ended += marked
        symbols += size - alnum
        digits += alnum - alpha
        odd += 0 if cells else strange
        rows += size if cells else 0
        bulleted += size if len(parts) <= 8 and _BULLET.match(line) else 0  # a longer line that starts with "511. So we" is a sentence's end
        short += size if len(parts) <= 5 and not marked else 0
        wordy += size if n >= 4 and 5 * n >= 4 * len(parts) else 0
        lettered += size if n >= 3 and 5 * mine >= 4 * size else 0
    closed = chars if marked and words >= 4 else 0
    echoed = chars if words >= 12 and len(seen) ** 2 < 6 * words else 0
    return [chars, len(lines), words, letters, tokens, commons, ended, symbols, digits, bulleted, short, rows, odd, wordy, lettered, closed, echoed]


def _paragraphs(body: str) -> list[list[str]]:
    blocks = ([x for x in b.split("\n") if x and not x.isspace()] for b in body.split("\n\n"))
    return [b for b in blocks if b]


def _name(lines: list[str]) -> int:
    """A paragraph by a 64-bit hash, blanks and case aside."""
    return int.from_bytes(hashlib.blake2b(" ".join(" ".join(lines).lower().split()).encode("utf-8", "replace"), digest_size=8).digest(), "big", signed=True)


def body_sums(body: str, common: frozenset[str] | set[str]) -> tuple[list[int], list[int], int | None, int | None]:
    """The sums of a body but its last paragraph, those of that, and the names of the last paragraph and the one before. The first
    name is null where the last is too long for boilerplate or there is none."""
    rest, last, blocks = [0] * len(SUMS), [0] * len(SUMS), _paragraphs(body)
    for b in blocks[:-1]:
        rest = [x + y for x, y in zip(rest, paragraph_sums(b, common))]
    if not blocks:
        return rest, last, None, None
    last = paragraph_sums(blocks[-1], common)
    return rest, last, _name(blocks[-1]) if last[0] <= MAX_END else None, _name(blocks[-2]) if len(blocks) > 1 else None


def statistics(body: str, common: frozenset[str] | set[str]) -> dict[str, float]:
    """``STATS`` of one body, all of it."""
    rest, last, _, _ = body_sums(body, common)
    sums = dict(zip(SUMS, (x + y for x, y in zip(rest, last))))
    return {n: sums[n] for n, k in STATS if k == "int"} | {n: sums[a] / sums[b] if sums[b] else 0.0 for n, a, b in _RATIOS}


def common_words(words: DataFrame, column: str = "word") -> frozenset[str]:
    """The frequent words of all languages, from a table whose size is checked."""
    rows = words.select(F.lower(F.trim(F.col(f"`{column}`"))).alias("w")).where("w <> ''").distinct().limit(MAX_COMMON + 1).collect()
    if len(rows) > MAX_COMMON:
        raise ValueError(f"more than {MAX_COMMON} common words")
    return frozenset(r.w for r in rows)


def _sums(docs: DataFrame, key: str, text: str, common: frozenset[str]) -> DataFrame:
    """One row per document: its ``key``, ``rest`` and ``last`` (sums), ``h`` and ``before`` (names)."""
    sent = docs.sparkSession.sparkContext.broadcast(common)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = [body_sums(body_of(t) if t else "", sent.value) for t in b.column(1).to_pylist()]
            cols = list(zip(*got)) if got else [[]] * 4
            kinds = (pa.list_(pa.int64()), pa.list_(pa.int64()), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(c, k) for c, k in zip(cols, kinds))], names=["key", "rest", "last", "h", "before"])

    source = docs.select(F.col(f"`{key}`"), F.col(f"`{text}`").alias("__text"))
    return source.mapInArrow(run, f"key {source.schema[0].dataType.simpleString()}, rest array<long>, last array<long>, h long, before long")


def boilerplate(sums: DataFrame, min_ends: int = MIN_ENDS) -> DataFrame:
    """The names ``h`` of the last paragraphs that end bodies behind ``min_ends`` different paragraphs, with ``size``, the bodies that they end.

    Pairs of the two names are counted first, so that a paragraph that ends a third of all bodies is no hot key."""
    pairs = sums.where("h IS NOT NULL").groupBy("h", "before").agg(F.count(F.lit(1)).alias("c"))
    return pairs.groupBy("h").agg(F.count(F.lit(1)).alias("ends"), F.sum("c").alias("size")).where(F.col("ends") >= min_ends).select("h", "size")


def text_statistics(docs: DataFrame, key: str, text: str, common: frozenset[str], min_ends: int = MIN_ENDS) -> DataFrame:
    """One row per document: its key and the statistics of what its sender wrote; null and empty texts have 0 everywhere.

    Repeated rows give as many rows; only the two named columns are read; an empty table gives an empty result.
    """
    s = Scratch(docs.sparkSession)
    with small_batches(docs.sparkSession):
        sums = s.save(_sums(docs, key, text, common), "sums")
    ends = s.save(boilerplate(sums, min_ends), "boilerplate")
    found = ends.agg(F.sum("size").alias("total"), F.count(F.lit(1)).alias("number")).first()
    known = attach(sums, ends, ["h"], sums.count(), found.number, how="left")  # documents without a name have no match
    total = known.select("key", *((F.col("rest")[i] + F.when(F.col("size").isNull(), F.col("last")[i]).otherwise(0)).alias(f"__{n}") for i, n in enumerate(SUMS)))
    whole = [F.col(f"__{n}").cast("int").alias(n) for n, k in STATS if k == "int"]
    ratios = [F.when(F.col(f"__{b}") > 0, F.col(f"__{a}") / F.col(f"__{b}")).otherwise(0.0).alias(n) for n, a, b in _RATIOS]
    return total.select(F.col("key").alias(key), *whole, *ratios)


_P, _L, _T, _N, _E = ("prose",), ("list",), ("table",), ("noise",), ("echo",)
#: Labelling functions: statistic, high from, low below, the components that high speaks for, and those that low speaks for.
FUNCTIONS: tuple[tuple[str, float, float, tuple[str, ...], tuple[str, ...]], ...] = (
    ("common_share", 0.25, 0.15, _P, _L + _T + _N + _E),
    ("closed_share", 0.5, 0.25, _P, _L + _T + _N + _E),
    ("wordy_share", 0.5, 0.25, _P + _E, _L + _T + _N),
    ("lettered_share", 0.8, 0.6, _P + _L + _E, _T + _N),
    ("short_line_share", 0.5, 0.2, _L, _P + _T + _N + _E),
    ("bullet_share", 0.5, 0.1, _L, _P + _T + _N + _E),
    ("row_share", 0.5, 0.1, _T, _P + _L + _N + _E),
    ("digit_ratio", 0.15, 0.05, _T + _N, _P + _L + _E),
    ("symbol_ratio", 0.2, 0.08, _T + _N, _P + _L + _E),
    ("odd_share", 0.3, 0.1, _N, _P + _L + _T + _E),
    ("echo_share", 0.3, 0.1, _E, _P + _L + _T + _N),
)

Function = tuple[str, float, float, tuple[str, ...], tuple[str, ...]]


def _votes(functions: tuple[Function, ...] = FUNCTIONS) -> Column:
    """The vote pattern as a number in base 3: digit 2 high, 1 low, 0 nothing."""
    code = F.lit(0).cast("long")
    for i, (stat, high, low, _, _) in enumerate(functions):
        code = code + F.when(F.col(stat) >= high, 2).when(F.col(stat) < low, 1).otherwise(0) * 3**i
    return code


def learn(patterns: np.ndarray, counts: np.ndarray, functions: tuple[Function, ...] = FUNCTIONS, rounds: int = 200, smoothing: float = 1.0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Expectation-maximization over vote patterns: posteriors (pattern, component), each function's vote rates
    (function, component, vote), and the components' shares. It starts from what the functions are meant to say and ends when
    the posteriors move by less than 1e-6."""
    names, m = tuple(COMPONENTS), len(functions)
    votes, n, k = np.stack([(patterns // 3**i) % 3 for i in range(m)], axis=1), counts.astype(float), len(names)
    start = np.zeros((len(patterns), k))
    for i, (_, _, _, high, low) in enumerate(functions):
        for digit, speaks_for in ((2, high), (1, low)):
            for t in speaks_for:
                start[votes[:, i] == digit, names.index(t)] += 1.0 / len(speaks_for)
    post = np.exp(2 * (start - start.max(axis=1, keepdims=True)))
    post /= post.sum(axis=1, keepdims=True)
    rates, share = np.ones((m, k, 3)) / 3, np.ones(k) / k
    for _ in range(rounds):
        weight = post * n[:, None]
        share = (weight.sum(axis=0) + smoothing) / (weight.sum() + k * smoothing)
        for i in range(m):
            for d in range(3):
                rates[i, :, d] = weight[votes[:, i] == d].sum(axis=0) + smoothing
            rates[i] /= rates[i].sum(axis=1, keepdims=True)
        logs = np.log(share)[None, :] + sum(np.log(rates[i])[:, votes[:, i]].T for i in range(m))
        new = np.exp(logs - logs.max(axis=1, keepdims=True))
        new /= new.sum(axis=1, keepdims=True)
        moved = np.abs(new - post).max() if len(new) else 0.0
        post = new
        if moved < 1e-6:
            break
    return post, rates, share


def of_types(posteriors: np.ndarray) -> np.ndarray:
    """Posteriors of the types from those of the components."""
    return np.stack([posteriors[:, [t == u for u in COMPONENTS.values()]].sum(axis=1) for t in TYPES], axis=1)


def type_statistics(stats: DataFrame, functions: tuple[Function, ...] = FUNCTIONS) -> DataFrame:
    """``text_types`` of statistics that are at rest."""
    spark = stats.sparkSession
    voted = stats.withColumn("pattern", F.when(F.col("chars") > 0, _votes(functions)))
    found = voted.where("pattern IS NOT NULL").groupBy("pattern").count().collect()  # at most 3 ** len(functions) rows
    patterns = np.array([r["pattern"] for r in found], np.int64)
    post = of_types(learn(patterns, np.array([r["count"] for r in found], np.int64), functions)[0])
    names = [f"p_{t}" for t in TYPES]
    schema = ", ".join(["pattern long", *(f"{n} double" for n in names)])
    table = spark.createDataFrame([(int(p), *map(float, q)) for p, q in zip(patterns, post)], schema)
    typed = voted.join(F.broadcast(table), "pattern", "left")
    filled = typed.withColumns({n: F.coalesce(F.col(n), F.lit(float(n == "p_junk"))) for n in names})
    best = F.greatest(*names)
    return filled.withColumn("text_type", F.coalesce(*(F.when(F.col(f"p_{t}") == best, t) for t in TYPES))).drop("pattern")


def text_types(docs: DataFrame, key: str, text: str, common: frozenset[str], min_ends: int = MIN_ENDS) -> DataFrame:
    """Every document's statistics, the posterior of each type (``p_prose``, ...) and the likeliest ``text_type``.

    A document without a body is junk, with posterior 1, and takes no part in the learning. Null and empty texts have no body.
    Repeated rows are typed alike. An empty table gives an empty result.
    """
    return type_statistics(Scratch(docs.sparkSession).save(text_statistics(docs, key, text, common, min_ends), "stats"))
