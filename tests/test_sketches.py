"""Stored sketches: merges over any groups stay within the stated bounds."""

import random
from bisect import bisect_left, bisect_right

import pytest
from pyspark.sql import functions as F

from odpanel.operators import sketches


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(4)
    return [(2000 + rng.randrange(5), rng.gauss(0, 1) * 10 ** rng.randrange(3),
             rng.randrange(30_000)) for _ in range(60_000)]


@pytest.fixture(scope="module")
def frame(spark, rows):
    return spark.createDataFrame(rows, "year int, v double, c int").repartition(7).cache()


def test_quantiles_of_any_range_of_years(spark, frame, rows, tmp_path):
    stored = sketches.quantile_sketches(frame, ["year"], "v", str(tmp_path / "q"))
    again = spark.read.parquet(str(tmp_path / "q"))           # answers come from the files
    assert again.count() == stored.count() == 5
    for first, last in ((2000, 2000), (2001, 2003), (2000, 2004)):
        values = sorted(v for y, v, _ in rows if first <= y <= last)
        got = sketches.merged_quantiles(again.filter(F.col("year").between(first, last)),
                                        [0.0, 0.01, 0.5, 0.9, 1.0]).collect()
        assert len(got) == 5
        for r in got:
            assert r.n == len(values)
            low = bisect_left(values, r.quantile) / len(values)
            high = bisect_right(values, r.quantile) / len(values)
            assert low - sketches.rank_error() <= r.p <= high + sketches.rank_error()


def test_small_and_null_groups(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("a", None), ("b", None), (None, 2.0)],
                               "k string, v double")
    got = sketches.merged_quantiles(sketches.quantile_sketches(df, ["k"], "v"), [0.5], ["k"])
    assert {(r.k, r.n, r.quantile) for r in got.collect()} == {("a", 2, 1.0), (None, 1, 2.0)}
    empty = sketches.quantile_sketches(df.limit(0), ["k"], "v")
    assert sketches.merged_quantiles(empty, [0.5]).collect() == []


def test_distinct_counts_merge(frame, rows):
    stored = sketches.distinct_sketches(frame, ["year"], "c")
    each = {r.year: r for r in sketches.merged_distinct(stored, ["year"]).collect()}
    for y in range(2000, 2005):
        exact = len({c for yy, _, c in rows if yy == y})
        assert abs(each[y].n_hll - exact) <= sketches.hll_error() * exact
        assert abs(each[y].n_theta - exact) <= sketches.theta_error() * exact
    whole = sketches.merged_distinct(stored).first()
    exact = len({c for _, _, c in rows})
    assert exact > 1 << sketches.THETA_LG_K             # beyond where Theta is exact
    assert abs(whole.n_hll - exact) <= sketches.hll_error() * exact
    assert abs(whole.n_theta - exact) <= sketches.theta_error() * exact


def test_overlaps(frame, rows):
    stored = sketches.distinct_sketches(frame, ["year"], "c")
    sets = {y: {c for yy, _, c in rows if yy == y} for y in range(2000, 2005)}
    got = sketches.overlaps(stored, "year").collect()
    assert {(r.a, r.b) for r in got} == {(a, b) for a in sets for b in sets if a < b}
    for r in got:
        either = len(sets[r.a] | sets[r.b])
        assert abs(r.n_both - len(sets[r.a] & sets[r.b])) <= sketches.theta_error() * either
        assert abs(r.n_either - either) <= sketches.theta_error() * either


def test_empty_distinct(spark):
    df = spark.createDataFrame([], "k int, c int")
    stored = sketches.distinct_sketches(df, ["k"], "c")
    assert sketches.merged_distinct(stored, ["k"]).collect() == []
    assert sketches.merged_distinct(stored).collect() == []
    assert sketches.overlaps(stored, "k").collect() == []


def test_bounds_grow_with_smaller_sketches():
    assert sketches.rank_error(200) > sketches.rank_error(800) > 0
    assert sketches.hll_error(10) == pytest.approx(4 * 1.04 / 32)
    assert sketches.theta_error(14) == pytest.approx(4 / 128)
