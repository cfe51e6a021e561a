import datetime
import math

import pytest
from pyspark.sql import functions as F

from odpanel.functions import exact_mean
from odpanel.operators.profile import (describe_column, profile, profile_distinct,
                                       profile_numeric)


def test_mode_ties_and_nulls(spark):
    df = spark.createDataFrame([(1.0,), (1.0,), (2.0,), (2.0,)], "x double")
    assert describe_column(df, "x").first().mode == 1.0
    df = spark.createDataFrame([(None,), (None,), (1.0,)], "x double")
    assert describe_column(df, "x").first().mode is None


def test_median_is_an_element(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (4.0,)], "x double")
    r = describe_column(df, "x").first()
    assert r.median == 2.0 and r.mean == 2.5


def test_profile_any_types(spark):
    df = spark.createDataFrame(
        [(1, 1.5, datetime.date(2020, 1, 1), "a"), (None, None, None, ".."), (1, 2.5, None, "")],
        "i int, d double, t date, s string")
    p = {r.column_name: r for r in profile(df).collect()}
    assert p["i"].n_null == 1 and p["s"].n_null == 2 and p["t"].n_null == 2
    assert p["i"].n_distinct == 2  # 1 and NULL
    assert p["d"].min_v == 1.5 and p["d"].max_v == 2.5
    assert p["s"].min_v is None
    nd = {r.column_name: r.n_distinct for r in profile_distinct({"": df}).collect()}
    assert nd == {"i": 2, "d": 3, "t": 2, "s": 3}


@pytest.mark.parametrize("values, mean", [
    ([1e20, 1.0], 5e19), ([1e-12, 3e-12], 2e-12), ([1e17, None, 3.0], (1e17 + 3) / 2),
    ([0.1] * 10, 0.1), ([-2.5, 2.5], 0.0),
    ([1.5, float("nan")], math.nan), ([1.5, float("inf")], math.inf), ([None, None], None)])
def test_means_of_any_doubles(spark, values, mean):
    """No value is left out or rounded; every public function agrees."""
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = [df.agg(exact_mean("x")).first()[0],
           describe_column(df, "x").first().mean,
           profile(df).first().avg_v, profile_numeric({"": df}, {"": ["x"]}).first().avg_v]
    for m in got:
        assert (m is None) == (mean is None)
        assert mean is None or m == pytest.approx(mean, rel=1e-12, abs=1e-30, nan_ok=True)


def test_a_value_counted_many_times(spark):
    """Weights beyond ten digits, as a frequent value of a large table has."""
    df = spark.createDataFrame([(1.5, 2 * 10 ** 10), (4.5, 10 ** 10), (None, 7)],
                               "v double, n long")
    assert df.agg(exact_mean("v", "n")).first()[0] == pytest.approx(2.5, rel=1e-15)
    assert df.agg(exact_mean("v", F.col("n") / 10 ** 9)).first()[0] == pytest.approx(2.5)


def test_mean_does_not_hang_on_the_order(spark):
    rows = [(k * 10 ** (k % 9) / 100,) for k in range(2000)]   # decimals of two places
    means = {spark.createDataFrame(r, "x double").repartition(n).agg(exact_mean("x")).first()[0]
             for r, n in ((rows, 1), (rows[::-1], 3), (sorted(rows, key=str), 7))}
    assert len(means) == 1
