import random
from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest

from faultweave.llm import topn

T0 = datetime(2026, 1, 1)


def brute(rows, n, groups=1):
    """Rows are group columns and then the order columns; nulls are lowest, a null score does not compete."""
    by = {}
    for r in set(rows):
        if r[groups] is not None:
            by.setdefault(r[:groups], []).append(r)
    out = []
    for rs in by.values():
        out += sorted(rs, key=lambda r: [(v is not None, v.encode() if isinstance(v, str) else v if v is not None else 0) for v in r[groups:]], reverse=True)[:n]
    return sorted(map(repr, out))


def shown(df):
    return sorted(map(repr, map(tuple, df.collect())))


@pytest.mark.parametrize("n", [1, 3, 50])
def test_hot_group_and_ties(spark, n):
    r = random.Random(n)
    rows = [("hot" if r.random() < 0.6 else r.choice(["a", "b", None]), T0 + timedelta(seconds=r.choice([0, 1, 5, 10**6])), f"r{r.randrange(60):02d}", r.randrange(40)) for _ in range(3000)]
    rows += [("one", T0, "x", 1), ("none", None, "x", 1), ("two", T0, None, None), ("two", T0, "", None), ("two", T0, "é", -5), ("two", T0, "e", 5), ("two", T0, "ee", 5)]
    df = spark.createDataFrame(rows, "size string, need timestamp, bucket string, state int")
    assert shown(topn.top_n(df, ["size"], ["need", "bucket", "state"], n)) == brute(rows, n)


def test_kinds_of_scores(spark):
    r = random.Random(4)
    big = [-(2**63), 2**63 - 1, 0, -1, 1, 2**40, -(2**40)]
    rows = [(r.randrange(3), r.choice(big), date(2026, 1, 1) + timedelta(days=r.randrange(5)), i) for i in range(400)]
    df = spark.createDataFrame(rows, "g int, s long, d date, i long")
    assert shown(topn.top_n(df, ["g"], ["s", "d", "i"], 4)) == brute(rows, 4)
    words = [(1, "z" * k + s, k) for k in range(0, 40, 3) for s in ("", "a", "\x7f", "ß", "zz")]
    df = spark.createDataFrame(words, "g int, s string, i int")
    assert shown(topn.top_n(df, ["g"], ["s", "i"], 7)) == brute(words, 7)


def test_two_group_columns_with_nulls(spark):
    r = random.Random(9)
    rows = [(r.choice(["a", None]), r.choice(["x", None]), r.randrange(9), r.randrange(9)) for _ in range(500)]
    df = spark.createDataFrame(rows, "a string, b string, s int, i int")
    assert shown(topn.top_n(df, ["a", "b"], ["s", "i"], 5)) == brute(rows, 5, 2)


def test_empty_and_zero(spark):
    df = spark.createDataFrame([], "g string, s int")
    assert topn.top_n(df, ["g"], ["s"], 3).count() == 0
    assert topn.top_n(spark.createDataFrame([("a", 1)], "g string, s int"), ["g"], ["s"], 0).count() == 0
    assert topn.top_n(spark.createDataFrame([("a", None)], "g string, s int"), ["g"], ["s"], 3).count() == 0


def test_unsupported_score(spark):
    with pytest.raises(TypeError):
        topn.top_n(spark.createDataFrame([("a", [1])], "g string, s array<int>"), ["g"], ["s"], 1)


def sorted_by_spark(spark, df, group, order, n):
    """The same by Spark's own order, in a window."""
    from pyspark.sql import Window
    from pyspark.sql import functions as F

    w = Window.partitionBy(*group).orderBy(*(F.desc_nulls_last(o) for o in order))
    return shown(df.where(F.col(order[0]).isNotNull()).distinct().withColumn("n", F.row_number().over(w)).where(F.col("n") <= n).select(*group, *order))


def test_doubles_decimals_booleans_bytes(spark):
    r = random.Random(6)
    doubles = [0.0, -0.0, 1.5, -1.5, 5e-324, -5e-324, 1.7e308, -1.7e308, float("inf"), float("-inf"), float("nan"), 1 + 2**-52, 1.0, None, 3.25, -2.0**-1074]
    big = [Decimal(x) for x in ("99999999999999999999999999.123456789012", "99999999999999999999999999.123456789011", "-99999999999999999999999999.123456789012", "0.000000000001", "-0.000000000001", "0", "12345678901234567890.5")]
    rows = [(r.randrange(4), r.choice(doubles), r.choice([0.5, None, -3.0]), r.choice([*big, None]), Decimal(r.randrange(-500, 500)) / 100, r.choice([True, False, None]), r.choice([b"", b"a", b"a\x00", b"a\x00\x01", None]), i) for i in range(800)]
    df = spark.createDataFrame(rows, "g int, d double, f float, x decimal(38,12), y decimal(9,2), b boolean, z binary, i int")
    for order, ns in ((["d", "i"], (1, 30)), (["f", "x", "i"], (4,)), (["x", "d", "i"], (4,)), (["b", "z", "y", "i"], (1, 30))):
        for n in ns:
            assert shown(topn.top_n(df, ["g"], order, n)) == sorted_by_spark(spark, df, ["g"], order, n), (order, n)


def test_long_texts_with_a_long_shared_prefix(spark):
    rows = [(i % 3, 1, "p" * 200_000 + str(i * 7919 % 1000).zfill(4 + i % 2) + "\0" * (i % 4)) for i in range(300)]
    df = spark.createDataFrame(rows, "g int, s int, t string")
    assert shown(topn.top_n(df, ["g"], ["s", "t"], 5)) == brute(rows, 5)


def test_more_groups_than_are_broadcast(spark):
    r = random.Random(2)
    rows = [(r.choice(["hot", "hot", "warm", *map(str, range(60))]), r.randrange(50), i) for i in range(4000)]
    df = spark.createDataFrame(rows, "g string, s int, i int")
    assert shown(topn.top_n(df, ["g"], ["s", "i"], 6, hot=5)) == brute(rows, 6)


def test_unfounded_uniqueness_is_an_error(spark):
    df = spark.createDataFrame([("a", 1)] * 5 + [("a", 2)], "g string, s int")
    with pytest.raises(ValueError, match="unique"):
        topn.top_n(df, ["g"], ["s"], 3, unique=True)
    assert topn.top_n(df, ["g"], ["s"], 3).count() == 2
    assert topn.top_n(df, ["g"], ["s"], 6, unique=True).count() == 6
