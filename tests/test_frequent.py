"""Misra-Gries summaries and the exact top values against a plain count."""

import random
from collections import Counter

import pyarrow as pa
import pytest

from odpanel.operators import frequent


def zipf(n=20_000, seed=1):
    rng = random.Random(seed)
    return [int(rng.paretovariate(0.9)) % 5000 for _ in range(n)] + [None] * 700


def top(values, k):
    c = Counter(values)
    return sorted(((v, n) for v, n in c.items()),
                  key=lambda x: (-x[1], x[0] is None, x[0] if x[0] is not None else 0))[:k]


def got(df):
    return [(r.value, r.n) for r in df.collect()]


@pytest.mark.parametrize("k", [1, 3, 20])
def test_top_of_a_skewed_column(spark, k):
    values = zipf()
    df = spark.createDataFrame([(v, "x") for v in values], "a int, n string").repartition(6)
    assert got(frequent.top_values(df, "a", k, counters=64)) == top(values, k)


def test_flat_and_small_columns(spark):
    flat = [i % 4000 for i in range(8000)]
    df = spark.createDataFrame([(v,) for v in flat], "a long").repartition(5)
    assert got(frequent.top_values(df, "a", 5, counters=16)) == top(flat, 5)
    few = spark.createDataFrame([("b",), ("a",), (None,), ("b",), (None,)], "a string")
    assert got(frequent.top_values(few, "a", 9)) == [("b", 2), (None, 2), ("a", 1)]
    assert got(frequent.mode(few, "a")) == [("b", 2)]
    assert got(frequent.top_values(few.limit(0), "a", 3)) == []
    with pytest.raises(ValueError):
        frequent.top_values(few, "a", 0)


def test_beyond_the_largest_summary_all_values_are_counted(spark, monkeypatch):
    monkeypatch.setattr(frequent, "MOST_COUNTERS", 32)
    values = [i % 900 for i in range(3000)] + [5] * 10
    df = spark.createDataFrame([(v,) for v in values], "a int").repartition(4)
    assert got(frequent.top_values(df, "a", 2, counters=8)) == top(values, 2)


def test_a_summary_is_bounded_and_its_error_holds(spark):
    values = zipf(30_000, 3)
    df = spark.createDataFrame([(v,) for v in values], "a int").repartition(4)
    rows = frequent.summaries(df, "a", 50).collect()
    lost = sum(r.lost for r in rows if r.lost is not None)
    kept = [r for r in rows if r.lost is None]
    assert len(kept) <= 4 * 50 and lost <= len(values) / 50
    sums = Counter()
    for r in kept:
        sums[r.value] += r.n
    for v, n in Counter(values).items():
        assert sums[v] <= n <= sums[v] + lost


def test_cut_takes_what_the_first_beyond_holds():
    t = pa.table({"value": ["a", "b", "c", "d"], "n": [9, 5, 4, 1]})
    left, lost = frequent._cut(t, 2)
    assert lost == 4 and sorted(zip(left["value"].to_pylist(), left["n"].to_pylist())) == [
        ("a", 5), ("b", 1)]
    assert frequent._cut(t, 4) == (t, 0)


def test_one_value_on_a_third_of_all_rows_shuffles_few(spark):
    """The stored summary of a hot column has no more rows than its counters."""
    values = [7 if i % 3 == 0 else i for i in range(30_000)]
    df = spark.createDataFrame([(v,) for v in values], "a int").repartition(8)
    assert frequent.summaries(df, "a", 100).count() <= 8 * 101
    assert got(frequent.mode(df, "a", counters=100)) == [(7, 10_001)]
