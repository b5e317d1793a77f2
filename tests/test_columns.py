import math

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from harborline.functions import columns as c


def one(df):
    return [r[0] for r in df.collect()]


def test_lenient_double_like_pandas(spark):
    texts = ["", "abc", "1.0d", " 12 ", "inf", "-inf", "0x10", "1e3", "1.", ".5", "-3.25", "n/a", "12f", "+7", None, "1,5"]
    got = one(spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").orderBy("i").select(c.lenient_double(F.col("t"))))
    want = pd.to_numeric(pd.Series(texts, dtype=object), errors="coerce")
    assert [None if math.isnan(w) else w for w in want] == got


def test_strict_int_raises(spark):
    df = spark.createDataFrame([("2010",), ("20x0",)], "t string")
    with pytest.raises(PySparkException):
        df.select(c.strict_int(F.col("t"))).collect()


def test_whole_number_truncates(spark):
    df = spark.createDataFrame([(2.9,), (-2.9,), (None,)], "v double")
    assert one(df.select(c.whole_number(F.col("v")))) == [2, -2, None]


def test_nan_to_null(spark):
    df = spark.createDataFrame([(1.5, "x"), (float("nan"), "y"), (None, None)], "v double, s string")
    assert one(c.nan_to_null(df).select("v")) == [1.5, None, None]


def test_flag_is_never_null(spark):
    df = spark.createDataFrame([("Aggregates",), ("Europe",), (None,)], "r string")
    assert one(df.select(c.equals_or_false(F.col("r"), "Aggregates"))) == [True, False, False]


def test_month_start_rejects_bad_month(spark):
    df = spark.createDataFrame([(2020, 13)], "y int, m int")
    with pytest.raises(PySparkException):
        df.select(c.first_of_month(F.col("y"), F.col("m"))).collect()


@settings(max_examples=15, deadline=None)
@given(st.lists(st.floats(-1e6, 1e6), min_size=1, max_size=30))
def test_round_half_even_like_numpy(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double").orderBy("i")
    assert one(df.select(c.round_half_even(F.col("v"), 4))) == pytest.approx(list(np.round(values, 4)), abs=0)


def test_growth_undefined_is_null(spark):
    pairs = [(200, 100), (0, 100), (100, 0), (0, 0), (-5, 10), (None, 5), (5, None)]
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(pairs)], "i int, a bigint, b bigint").orderBy("i")
    got = one(df.select(c.growth_rate(F.col("a"), F.col("b"), 9)))
    assert got == [0.0801, -1.0, None, None, None, None, None]


@settings(max_examples=15, deadline=None)
@given(st.lists(st.integers(-(10**15), 10**15), min_size=1, max_size=20))
def test_rounded_mean_is_half_away_from_zero(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v bigint")
    got = df.agg(c.exact_sum(F.col("v")).alias("t"), F.count("v").alias("n")).select(c.rounded_mean(F.col("t"), F.col("n"))).first()[0]
    total, n = sum(values), len(values)
    magnitude = (2 * abs(total) + n) // (2 * n)
    assert got == (magnitude if total >= 0 else -magnitude)


def test_rounded_mean_does_not_round_twice(spark):
    df = spark.range(25_000).select((F.col("id") < 12_499).cast("bigint").alias("v"))
    sums = df.agg(c.exact_sum(F.col("v")).alias("t"), F.count("v").alias("n"))
    assert sums.select(c.rounded_mean(F.col("t"), F.col("n"))).first()[0] == 0


def test_exact_sum_survives_large_parts(spark):
    big = 2**63 - 1
    df = spark.createDataFrame([(big,), (big,), (-big,)], "v bigint")
    assert int(df.agg(c.exact_sum(F.col("v"))).first()[0]) == big


def test_qualified_name(spark):
    df = spark.createDataFrame([("port_raw.country_dim",)], "k string")
    assert tuple(df.select(c.schema_of(F.col("k")), c.table_of(F.col("k"))).first()) == ("port_raw", "country_dim")
