import math

import pytest
from pyspark.sql import functions as F

from shelfline.functions import scoring


def column(spark, values, kind="string"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")


def evaluate(df, expr):
    return [r[0] for r in df.orderBy("i").select(expr).collect()]


def wilson(pos, neg, z=1.96):
    n = pos + neg
    if n == 0:
        return 0.0
    p = pos / n
    return (p + z * z / (2 * n) - z * math.sqrt((p * (1 - p) + z * z / (4 * n)) / n)) / (1 + z * z / n)


def test_wilson_bounds_and_values(spark):
    pairs = [(p, n) for p in (0, 1, 2, 7, 50, 999, 2_000_000_000) for n in (0, 1, 3, 40, 1000, 2_000_000_000)]
    df = spark.createDataFrame(pairs, "pos int, neg int")
    rows = df.select(
        "pos", "neg",
        scoring.wilson_lower_bound(F.col("pos"), F.col("neg")).alias("w"),
        scoring.approval_pct(F.col("pos"), F.col("neg")).alias("a"),
        scoring.total_reviews(F.col("pos"), F.col("neg")).alias("n"),
    ).collect()
    for r in rows:
        assert r.n == r.pos + r.neg  # widened: no int overflow
        assert r.w == pytest.approx(wilson(r.pos, r.neg), abs=5.1e-5)
        assert 0 <= r.w <= r.a / 100 + 1e-3
        assert math.copysign(1, r.w) == 1  # never -0.0


def test_scores_of_null_counts(spark):
    df = spark.createDataFrame([(None, 3), (3, None)], "pos int, neg int")
    pos, neg = F.col("pos"), F.col("neg")
    rows = df.select(
        scoring.wilson_lower_bound(pos, neg), scoring.approval_pct(pos, neg), scoring.approval_ratio(pos, neg)
    ).collect()
    assert [tuple(r) for r in rows] == [(0.0, 0.0, None)] * 2


def test_int_or_zero(spark):
    values = ["0", "1999", "12.5", "", "99999999999", None, " 7", "-3", "+4", "abc", "2147483647"]
    got = evaluate(column(spark, values), scoring.int_or_zero(F.col("v")))
    assert got == [0, 1999, 0, 0, 0, None, 0, -3, 4, 0, 2147483647]


def test_range_text(spark):
    values = ["0 .. 20,000", "20,000 .. 50,000", "1,000,000 .. 2,000,000", "1,500 .. 2,500,000", "junk", None]
    df = column(spark, values)
    assert evaluate(df, scoring.range_low(F.col("v"))) == [0, 20000, 1000000, 1500, None, None]
    assert evaluate(df, scoring.range_high(F.col("v"))) == [20000, 50000, 2000000, 2500000, None, None]
    assert evaluate(df, scoring.range_label(F.col("v"))) == ["0–20k", "20k–50k", "1M–2M", "1k–2M", None, None]


def test_price_bands(spark):
    df = column(spark, [0.0, 0.01, 4.99, 5.0, 14.99, 15.0, 29.99, 30.0, None], "double")
    assert evaluate(df, scoring.price_bucket(F.col("v"))) == [
        "Free", "Under $5", "Under $5", "$5–$15", "$5–$15", "$15–$30", "$15–$30", "$30+", None,
    ]


def test_bucketize_without_zero_label(spark):
    df = column(spark, [0.0, 1.0, 2.0, None], "double")
    assert evaluate(df, scoring.bucketize(F.col("v"), [1.0, 2.0], ["a", "b", "c"])) == ["a", "b", "c", None]
    with pytest.raises(ValueError):
        scoring.bucketize(F.col("v"), [1.0], ["a"])
