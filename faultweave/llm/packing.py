"""Filling fixed-capacity containers: best fit, then a swap-based local search.

Items are hashed into groups of bounded size, which are packed independently and in parallel; a group leaves at most a few
underfull containers, so the loss against one global packing shrinks with the group's size, not with the data. Within a group,
best-fit decreasing gives a start. The search then goes over the underfull containers from the fullest down and moves an item in,
or exchanges one for one, two for one or one for two with less full ones, always so that the sum of squared fills grows; that drains
the emptiest containers until they are gone. It ends where no such move or exchange in the group is left.
"""

from __future__ import annotations

from collections import Counter
from itertools import combinations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faultweave.llm.tokens import VOCABULARY, count_tokens, small_batches
from faultweave.sources.tables import Scratch

CAPACITY = 4096
#: Items of a group on average: some tens of MB in a Python worker.
GROUP_ITEMS = 20_000
#: Passes of the search at most; None: until one improves nothing. Each exchange raises the squared fill, so it ends.
PASSES = None


def best_fit(sizes: list[int], capacity: int) -> list[list[int]]:
    """Best-fit decreasing; containers as lists of item numbers. Sizes are at most ``capacity``; items of size 0 go anywhere."""
    room: list[list[int]] = [[] for _ in range(capacity + 1)]
    open_ = 0  # bit r: some container has room r
    bins: list[list[int]] = []
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        s = sizes[i]
        fitting = open_ >> s
        if fitting:
            r = s + ((fitting & -fitting).bit_length() - 1)
            b = room[r].pop()
            if not room[r]:
                open_ ^= 1 << r
        else:
            b, r = len(bins), capacity
            bins.append([])
        bins[b].append(i)
        room[r - s].append(b)
        open_ |= 1 << (r - s)
    return bins


class _Search:
    """The local search over one group's containers."""

    def __init__(self, sizes: list[int], bins: list[list[int]], capacity: int):
        self.sizes, self.bins, self.capacity = sizes, bins, capacity
        self.fill = [sum(sizes[i] for i in b) for b in bins]
        self.home: dict[int, int] = {}
        self.by_size: dict[int, set[int]] = {}
        self.mask = 0  # bit s: an item of size s is in an underfull container
        for b in range(len(bins)):
            if self.fill[b] < capacity:
                for i in bins[b]:
                    self._index(i, b)
        self.by_sum: dict[int, set[int]] = {}
        self.sums: dict[int, set[int]] = {}  # of the pairs of items in an underfull container
        self.sum_mask = 0
        for b in range(len(bins)):
            self._index_pairs(b)

    def _index(self, i: int, b: int) -> None:
        s = self.sizes[i]
        self.home[i] = b
        if s:
            self.by_size.setdefault(s, set()).add(i)
            self.mask |= 1 << s

    def _forget(self, i: int) -> None:
        s = self.sizes[i]
        if s and (at := self.by_size.get(s)) and i in at:
            at.discard(i)
            if not at:
                self.mask &= ~(1 << s)

    def _index_pairs(self, b: int) -> None:
        """Bring the index of pair sums up to what ``b`` holds now."""
        for s in self.sums.pop(b, ()):
            self.by_sum[s].discard(b)
            if not self.by_sum[s]:
                self.sum_mask &= ~(1 << s)
        if 0 < self.fill[b] < self.capacity:
            held = Counter(self.sizes[i] for i in self.bins[b] if self.sizes[i])
            self.sums[b] = {s + t for s, t in combinations(held, 2)} | {2 * s for s, n in held.items() if n > 1}
            for s in self.sums[b]:
                self.by_sum.setdefault(s, set()).add(b)
                self.sum_mask |= 1 << s

    def _pair(self, total: int, b: int) -> tuple[int, int]:
        """Two items of ``b`` with so many tokens."""
        seen: dict[int, int] = {}
        for i in sorted(self.bins[b]):
            if (s := self.sizes[i]) and total - s in seen:
                return seen[total - s], i
            if s:
                seen.setdefault(s, i)
        raise KeyError(total)

    def _largest_pair(self, low: int, high: int, into: int, removed: int, donors: list[int] | None) -> tuple[int, int] | None:
        """As ``_largest`` for two items of one container: their tokens and the container."""
        while high > low:
            s = (self.sum_mask & ((1 << (high + 1)) - 1)).bit_length() - 1
            if s <= low:
                return None
            fit = [(self.fill[b], b) for b in self.by_sum[s] if b != into and self.fill[into] + s - removed > self.fill[b] and (donors is None or b in donors)]
            if fit:
                return s, min(fit)[1]
            high = s - 1
        return None

    def _largest(self, low: int, high: int, into: int, removed: int) -> int | None:
        """An item of the largest size in (low, high] whose exchange for ``removed`` tokens of ``into`` raises the squared fill."""
        while high > low:
            below = self.mask & ((1 << (high + 1)) - 1)
            s = below.bit_length() - 1
            if s <= low:
                return None
            gain = s - removed
            best = None
            for i in self.by_size[s]:
                b = self.home[i]
                if b != into and self.fill[into] + gain > self.fill[b] and (best is None or (self.fill[b], i) < best):
                    best = (self.fill[b], i)
            if best:
                return best[1]
            high = s - 1
        return None

    def _exchange(self, a: int, out: tuple[int, ...], b: int, in_: tuple[int, ...]) -> None:
        for i in out:
            self.bins[a].remove(i)
            self.bins[b].append(i)
            self._forget(i)
            self._index(i, b)
        for i in in_:
            self.bins[b].remove(i)
            self.bins[a].append(i)
            self._forget(i)
            self._index(i, a)
        d = sum(self.sizes[i] for i in in_) - sum(self.sizes[i] for i in out)
        self.fill[a] += d
        self.fill[b] -= d
        for x in (a, b):
            if self.fill[x] == self.capacity:
                for i in self.bins[x]:
                    self._forget(i)
            self._index_pairs(x)

    def _improve(self, a: int, donors: list[int] | None = None) -> bool:
        """The best exchange for container ``a``; False if there is none. ``donors`` limits where pairs are taken from."""
        room, best = self.capacity - self.fill[a], None
        mine = sorted((self.sizes[i], i) for i in self.bins[a])
        options: dict[int, tuple[int, ...]] = {0: ()}  # by the tokens that go out: only those matter
        for s, i in mine:
            options.setdefault(s, (i,))
        singles = list(options.items())
        firsts = [(s, out[0]) for s, out in singles if s]
        for k, (s, i) in enumerate(firsts):
            for t, j in firsts[k + 1 :]:
                options.setdefault(s + t, (i, j))
        for (s, i), (t, j) in zip(mine, mine[1:]):
            if s == t:
                options.setdefault(s + t, (i, j))
        for removed, out in options.items():
            i = self._largest(removed, removed + room, a, removed)
            if i is not None and (best is None or self.sizes[i] - removed > best[0]):
                best = (self.sizes[i] - removed, out, self.home[i], (i,))
                if best[0] == room:
                    break
        if best is None or best[0] < room:  # two for one (or for none)
            for removed, out in singles:
                found = self._largest_pair(removed + (best[0] if best else 0), removed + room, a, removed, donors)
                if found:
                    best = (found[0] - removed, out, found[1], self._pair(*found))
                    if best[0] == room:
                        break
        if best is None:
            return False
        _, out, b, in_ = best
        self._exchange(a, out, b, in_)
        return True

    def run(self, passes: int | None) -> None:
        done = 0
        while passes is None or done < passes:
            moved = False
            under = sorted((b for b in range(len(self.bins)) if 0 < self.fill[b] < self.capacity), key=lambda b: (-self.fill[b], b))
            for a in under:
                while 0 < self.fill[a] < self.capacity and self._improve(a):
                    moved = True
            if not moved:
                return
            done += 1


def pack(sizes: list[int], capacity: int = CAPACITY, passes: int | None = PASSES) -> list[int]:
    """The container number of each item; sizes are 0 to ``capacity``. Containers are numbered from 0 without gaps."""
    bins = best_fit(sizes, capacity)
    search = _Search(sizes, bins, capacity)
    search.run(passes)
    place = [0] * len(sizes)
    number, empty = 0, []
    for b in search.bins:
        if not b:
            continue
        if not any(sizes[i] for i in b):
            empty += b  # items of size 0 whose container lost the others
            continue
        for i in b:
            place[i] = number
        number += 1
    for i in empty:
        place[i] = 0
    return place


def containers(df: DataFrame, key: str, text: str, capacity: int = CAPACITY, vocabulary: str = VOCABULARY, group_items: int = GROUP_ITEMS, passes: int | None = PASSES) -> DataFrame:
    """Every item's container: key, part, tokens, container (group-number).

    A text of at most ``capacity`` tokens is one item, never split. A longer one gives full parts, each a container of its own,
    and its rest is an item. A null or empty text is an item of 0 tokens in a container of its group. Equal rows of key and
    text are one text; differing texts of one key, or of a null key, are texts of their own, each with its parts from 0. An empty
    table gives an empty result. Other columns are not read.
    """
    s = Scratch(df.sparkSession)
    texts = df.select(F.struct(F.col(f"`{key}`").alias("key"), F.sha2(F.col(f"`{text}`"), 256).alias("sha")).alias("id"), F.col(f"`{text}`").alias("text"))
    counted = count_tokens(texts, "id", "text", vocabulary).groupBy("id.key", "id.sha").agg(F.max("tokens").alias("tokens"))
    with small_batches(df.sparkSession):
        sized = s.save(counted, "sizes")
    n = sized.count()
    groups = max(1, -(-n // group_items))
    full = F.when(F.col("tokens") > capacity, F.floor(F.col("tokens") / capacity)).otherwise(0).cast("int")
    rest = F.col("tokens") - F.col("full") * capacity
    split = sized.withColumn("full", full)
    parts = split.where("full > 0").select("key", "sha", F.explode(F.sequence(F.lit(0), F.col("full") - 1)).alias("part"), F.lit(capacity).alias("tokens"))
    whole = parts.withColumn("container", F.concat_ws("-", F.lit("full"), F.coalesce(F.col("key").cast("string"), F.lit("null")), "sha", "part"))
    items = split.where((rest > 0) | (F.col("full") == 0)).select(
        "key", "sha", F.col("full").alias("part"), rest.cast("int").alias("tokens"), F.pmod(F.xxhash64("key", "sha"), F.lit(groups)).cast("int").alias("group")
    )

    def packed(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["tokens", "key", "sha", "part"], na_position="first")  # the result does not depend on the order of arrival
        g = pdf["group"].iloc[0]
        return pd.DataFrame({"key": pdf["key"], "part": pdf["part"], "tokens": pdf["tokens"], "container": [f"{g}-{c}" for c in pack(pdf["tokens"].tolist(), capacity, passes)]})

    schema = f"key {sized.schema['key'].dataType.simpleString()}, part int, tokens int, container string"
    filled = items.repartition(groups, "group").groupBy("group").applyInPandas(packed, schema)
    return whole.select("key", "part", "tokens", "container").unionByName(filled).withColumnRenamed("key", key)
