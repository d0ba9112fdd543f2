"""Top N items within every group by simultaneous bisection.

Every item has a code: its score, then its identifiers, as words of order-preserving integers. All groups bisect at once for
the code above which they hold exactly N items: a round counts, for every group, the items between the ``FAN`` - 1 midpoints
that ten bisections in a row would test, keeps what lies above the cut, drops what lies below, and goes on with the items in
the one interval that holds the cut. A round leaves about 1/FAN of a large group, so only the first one reads all rows.

A round works on one word of each group: the first in which its lowest and highest open items differ. Of texts that is a window
of seven bytes behind the prefix that the group's open items share, so long identifiers cost no more than short ones.
"""

from __future__ import annotations

from collections.abc import Callable
from itertools import count
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from faultweave.sources.tables import Scratch

#: Intervals a round counts; 1024 is ten bisections.
FAN = 1024
#: Cuts of at most so many groups are broadcast (some 10 MB): of all, if there are no more groups, else of those with more than
#: 1/HOT of the rows. No other group holds more than that share; their cuts are joined by shuffle.
HOT = 65_536
_CHUNK = 7  # bytes of a text in one word
_LOWEST = -(1 << 40)


class _Word(NamedTuple):
    """One word of the code: the order column, its value's word, and whether that is a window of a text behind a prefix."""

    field: str
    of: Callable[[Column, Column], Column]
    text: bool = False


def _halves(x: Column) -> list[Column]:
    """Two words of a 64-bit number; null is lowest."""
    return [F.coalesce(F.shiftright(x, 32), F.lit(_LOWEST)), F.coalesce(x.bitwiseAND(F.lit((1 << 32) - 1)), F.lit(0))]


def _double_words(x: Column) -> list[Column]:
    """By the bits: those of negative numbers are turned round. -0.0 equals 0.0; NaN is highest, as Spark sorts it."""
    bits = F.java_method(F.lit("java.lang.Double"), F.lit("doubleToLongBits"), F.coalesce(x, F.lit(0.0)) + F.lit(0.0)).cast("long")
    code = F.when(x.isNotNull(), F.when(bits >= 0, bits).otherwise(bits.bitwiseXOR(F.lit((1 << 63) - 1))))
    return _halves(code)


def _numbers(c: Column, kind: T.DataType) -> list[Column]:
    """Order-preserving words (bigint) of a value that is no text; null is lowest."""
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return _halves(F.unix_micros(c.cast("timestamp")))
    if isinstance(kind, T.DateType):
        return [F.coalesce(F.unix_date(c).cast("long"), F.lit(_LOWEST))]
    if isinstance(kind, T.BooleanType):
        return [F.coalesce(c.cast("long"), F.lit(-1))]
    if isinstance(kind, T.IntegralType):
        return _halves(c.cast("long"))
    if isinstance(kind, T.DecimalType) and kind.precision <= 18:
        return _halves((c * F.lit(10**kind.scale).cast(T.DecimalType(19, 0))).cast("long"))
    if isinstance(kind, T.DecimalType):  # of the whole part and of the fraction: the nearest double, then what it leaves, twice
        wide, words = T.DecimalType(38, 0), []
        for part, of in ((F.floor(c).cast(wide), wide), (F.pmod(c, F.lit(1).cast(T.DecimalType(1, 0))), T.DecimalType(38, kind.scale))):
            for _ in range(3):
                near = part.cast("double")
                words += _double_words(near)
                part = F.coalesce(F.try_subtract(part, near.try_cast(of)), F.lit(0).cast(of))
        return words
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return _double_words(c.cast("double"))
    raise TypeError(f"no order-preserving code for {kind.simpleString()}")


def _bytes(c: Column, kind: T.DataType) -> Column:
    return c if isinstance(kind, T.BinaryType) else F.encode(c, "utf-8")


def _window(raw: Column, prefix: Column) -> Column:
    """The word of a text's bytes behind a prefix: seven bytes and how many of them there are, so that "a" stands before "a" and a zero byte."""
    hexed = F.rpad(F.hex(F.substring(raw, prefix + 1, F.lit(_CHUNK))), 2 * _CHUNK, "0")
    held = F.least(F.greatest(F.octet_length(raw) - prefix, F.lit(0)), F.lit(_CHUNK))
    return F.coalesce(F.conv(hexed, 16, 10).cast("long") * 8 + held, F.lit(-1))


def _shared(a: Column, b: Column) -> Column:
    """How many bytes two texts share at their start, by bisection; null shares none."""
    least = F.coalesce(F.octet_length(a), F.lit(0))
    least = F.least(least, F.coalesce(F.octet_length(b), F.lit(0)))

    def step(done: Column, more: Column) -> Column:
        upto = done + more
        return F.when((upto <= least) & (F.substring(a, F.lit(1), upto) == F.substring(b, F.lit(1), upto)), upto).otherwise(done)

    return F.aggregate(F.array(*(F.lit(1 << i) for i in range(30, -1, -1))), F.lit(0), step)


def _code(fields: list[str], kinds: dict[str, T.DataType]) -> list[_Word]:
    out: list[_Word] = []
    for f in fields:
        kind = kinds[f]
        if isinstance(kind, (T.StringType, T.BinaryType)):
            out.append(_Word(f, lambda c, prefix, kind=kind: _window(_bytes(c, kind), prefix), True))
        else:
            out += [_Word(f, lambda c, prefix, kind=kind, i=i: _numbers(c, kind)[i]) for i in range(len(_numbers(F.lit(None), kind)))]
    return out


def attach(rows: DataFrame, info: DataFrame, groups: list[str], total: int, number: int, hot: int = HOT, how: str = "inner") -> DataFrame:
    """``rows`` with their group's ``info`` (which has ``size``, the group's rows, and ``number`` rows in all): by broadcast for at most
    ``hot`` groups, the others by shuffle. There are fewer than ``hot`` groups with more than 1/hot of ``total`` rows, so the
    broadcast has a fixed bound, and no group that is shuffled holds more than that share. ``how``: inner or left."""
    extra = [c for c in info.columns if c not in groups]

    def joined(left: DataFrame, right: DataFrame, how: str) -> DataFrame:
        r = right.select(*(F.col(g).alias(f"__{g}") for g in groups), *extra)
        on = [F.col(g).eqNullSafe(F.col(f"__{g}")) for g in groups]
        return left.join(r, on, how).drop(*(f"__{g}" for g in groups))

    if number <= hot:
        return joined(rows, F.broadcast(info), how)
    is_hot = F.col("size") * hot > total
    marked = joined(rows, F.broadcast(info.where(is_hot)), "left")
    warm = marked.where(F.col("size").isNotNull())
    cold = joined(marked.where(F.col("size").isNull()).drop(*extra), info.where(~is_hot).hint("merge"), how)  # grows with the groups: never broadcast
    return warm.unionByName(cold)


def top_n(df: DataFrame, group: list[str], order: list[str], n: int, unique: bool = False, hot: int = HOT) -> DataFrame:
    """The ``n`` greatest items of every group: the ``group`` and ``order`` columns of the items kept.

    ``order`` is the score and then the identifiers, each descending (texts by their bytes, false before true, NaN above all
    numbers), so that ties are always decided; they may be numbers, decimals, booleans, dates, times, texts or bytes, else a
    TypeError says so. Null groups are groups; an item whose score is null does not compete; a null identifier is lowest. Rows
    equal in group and order are one item; ``unique`` says that there are none, and a ValueError that there are some after all
    where a cut falls among them. Groups with fewer than ``n`` items are kept whole; an empty table or ``n`` < 1 gives an empty
    result. Other columns are not read. Columns may have any names. The two sets of columns are written once at the start.
    """
    spark, s = df.sparkSession, Scratch(df.sparkSession)
    gs, os_ = [f"g{i}" for i in range(len(group))], [f"o{i}" for i in range(len(order))]
    rows = df.select(*(F.col(f"`{c}`").alias(g) for c, g in zip(group, gs)), *(F.col(f"`{c}`").alias(o) for c, o in zip(order, os_))).where(F.col("o0").isNotNull() & F.lit(n > 0))
    kinds = {f.name: f.dataType for f in rows.schema.fields}
    code = _code(os_, kinds)
    rows = s.save(rows if unique else rows.distinct(), "items").withColumn("need", F.lit(n).cast("long"))
    kept: list[str] = []
    for round_ in count():
        # the first round looks at the score alone, without sorting the rows for it
        fields, words = (os_, code) if round_ else (["o0"], [w for w in code if w.field == "o0"])
        least, most = (F.min(F.struct(*os_)), F.max(F.struct(*os_))) if round_ else (F.struct(F.min("o0").alias("o0")), F.struct(F.max("o0").alias("o0")))
        stats = rows.groupBy(*gs).agg(F.count(F.lit(1)).alias("size"), F.first("need").alias("need"), least.alias("least"), most.alias("most"))
        shared = {f: _shared(_bytes(F.col(f"least.{f}"), kinds[f]), _bytes(F.col(f"most.{f}"), kinds[f])) for f in fields if any(w.text and w.field == f for w in words)}
        stats = stats.withColumns({f"prefix_{f}": x for f, x in shared.items()})
        prefix = lambda w: F.col(f"prefix_{w.field}") if w.text else F.lit(0)
        stats = stats.withColumns({f"{end}{i}": w.of(F.col(f"{row}.{w.field}"), prefix(w)) for i, w in enumerate(words) for end, row in (("lo", "least"), ("hi", "most"))})
        level = F.coalesce(*(F.when(F.col(f"lo{i}") < F.col(f"hi{i}"), i) for i in range(len(words))))
        pick = lambda what, at: F.coalesce(*(F.when(F.col("level") == i, at(i, w)) for i, w in enumerate(words)), F.lit(what))
        made = stats.withColumn("level", level).select(
            *gs, "size", "need", "level", pick(0, lambda i, w: prefix(w)).cast("int").alias("prefix"), pick(0, lambda i, w: F.col(f"lo{i}")).alias("lo"), pick(0, lambda i, w: F.col(f"hi{i}")).alias("hi")
        )
        info = s.save(made, f"stats{round_}")
        all_ = info.agg(F.sum("size").alias("total"), F.count(F.lit(1)).alias("number"), F.count_if(F.col("level").isNull() & (F.col("size") > F.col("need"))).alias("stuck")).first()
        if not all_.total:
            break
        if round_ and all_.stuck:
            raise ValueError(f"{all_.stuck} groups have items that equal each other in group and order: call top_n without unique=True")
        info = info.withColumn("width", F.floor((F.col("hi") - F.col("lo")) / FAN) + 1).drop("hi", "need")
        x = F.coalesce(*(F.when(F.col("level") == i, w.of(F.col(w.field), F.col("prefix"))) for i, w in enumerate(words)), F.lit(0))
        bucket = F.floor((x - F.col("lo")) / F.col("width"))
        counts = attach(rows, info, gs, all_.total, all_.number, hot).withColumn("bucket", bucket).groupBy(*gs, "bucket").agg(
            F.count(F.lit(1)).alias("c"), *(F.first(c).alias(c) for c in ("need", "size", "level", "prefix", "lo", "width"))
        )
        above = F.sum("c").over(Window.partitionBy(*gs).orderBy(F.desc("bucket")).rowsBetween(Window.unboundedPreceding, 0))  # at most FAN + 1 rows a group
        cut = counts.withColumn("cum", above).where((F.col("size") <= F.col("need")) | (F.col("cum") >= F.col("need")) & (F.col("cum") - F.col("c") < F.col("need")))
        whole = F.col("size") <= F.col("need")
        cuts = cut.groupBy(*gs).agg(
            *(F.first(c).alias(c) for c in ("size", "level", "prefix", "lo", "width")), F.min(F.when(~whole, F.col("bucket"))).alias("cut"),
            F.min(F.when(~whole, F.col("need") - F.col("cum") + F.col("c"))).alias("left"), F.min("c").alias("c"),
        )
        tagged = attach(rows, s.save(cuts, f"cuts{round_}"), gs, all_.total, all_.number, hot).withColumn("bucket", bucket)
        state = F.when(F.col("cut").isNull() | (F.col("bucket") > F.col("cut")) | ((F.col("bucket") == F.col("cut")) & (F.col("c") == F.col("left"))), "kept").when(F.col("bucket") == F.col("cut"), "open")
        s.save(tagged.withColumn("state", state).where(F.col("state").isNotNull()).select(*gs, *os_, F.col("left").alias("need"), "state"), f"out{round_}", "state")
        kept += [s.at(f"out{round_}/state=kept")] if s.exists(f"out{round_}/state=kept") else []
        for name in (f"stats{round_}", f"cuts{round_}", f"out{round_ - 1}/state=open" if round_ else "items"):
            s.drop(name)
        if not s.exists(f"out{round_}/state=open"):
            break
        rows = spark.read.schema(rows.schema).parquet(s.at(f"out{round_}/state=open"))
    fields_ = T.StructType([*(T.StructField(f, kinds[f]) for f in (*gs, *os_))])
    result = spark.read.schema(fields_).parquet(*kept) if kept else spark.createDataFrame([], fields_)
    return result.select(*(F.col(g).alias(c) for c, g in zip(group, gs)), *(F.col(o).alias(c) for c, o in zip(order, os_)))
