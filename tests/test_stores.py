"""Counts taken while writing, bucketed joins, re-runs of a period, bitmaps."""

import os
import random

from pyspark.sql import functions as F

from odpanel.operators.bitmaps import distinct_counts, value_bitmaps
from odpanel.plans.catalog import _order_lines
from odpanel.session import shared_dir
from odpanel.sources.stores import (read_periods, replace_periods, save_bucketed, write_counted)


def jobs(spark, group, work):
    spark.sparkContext.setJobGroup(group, group)
    try:
        got = work()
    finally:
        spark.sparkContext.setJobGroup("", "")
    return got, len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))


def test_counts_come_from_the_writing_job(spark, tmp_path):
    raw = spark.range(1000).withColumn("v", F.col("id") % 10)
    got, n = jobs(spark, "counted", lambda: write_counted(
        raw, lambda df: df.filter("v > 2"), str(tmp_path / "t")))
    assert got == {"raw": 1000, "clean": 700} and n == 1
    assert spark.read.parquet(str(tmp_path / "t")).count() == 700
    assert write_counted(raw, lambda df: df.filter("v > 99"), str(tmp_path / "t")) == {
        "raw": 1000, "clean": 0}
    assert write_counted(raw.limit(0), lambda df: df, str(tmp_path / "t")) == {
        "raw": 0, "clean": 0}


def test_bucketed_tables_join_without_an_exchange(spark):
    rng = random.Random(5)
    lines = [(rng.randrange(400) if rng.random() < 0.7 else 7, float(rng.randrange(9)))
             for _ in range(3000)]                             # a third on one key
    orders = [(k, f"p{k % 3}") for k in range(500)]
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name, rows, schema, key in (
                ("b_lines", lines, "l_orderkey int, l_quantity double", "l_orderkey"),
                ("b_orders", orders, "o_orderkey int, o_orderpriority string", "o_orderkey")):
            save_bucketed(spark.createDataFrame(rows, schema), name, [key], 5,
                          shared_dir(spark, name))
        out = _order_lines(spark.table("b_lines"), spark.table("b_orders"))
        got = {r.o_orderkey: (r.n_lines, r.qty) for r in out.collect()}
        plan = out._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    want = {}
    for k, q in lines:
        n, s = want.get(k, (0, 0.0))
        want[k] = (n + 1, s + q)
    assert got == want


def files(path):
    return {f"{os.path.basename(d)}/{f}": os.stat(f"{d}/{f}").st_mtime_ns
            for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


def test_a_period_is_replaced_alone_and_again(spark, tmp_path):
    df = spark.createDataFrame([(y, k, float(y + k)) for y in (1, 2, 3) for k in range(4)],
                               "year int, k int, v double")
    path = str(tmp_path / "t")
    replace_periods(df, path, ["year"])
    before = files(path)
    again = df.filter("year = 2").withColumn("v", F.col("v") + 100)
    for _ in range(2):
        replace_periods(again, path, ["year"])
        got = sorted(tuple(r) for r in read_periods(spark, path, df).collect())
        assert got == sorted((y, k, y + k + (100.0 if y == 2 else 0)) for y in (1, 2, 3)
                             for k in range(4))
    after = files(path)
    for year in (1, 3):
        part = f"year={year}/"
        assert {f: t for f, t in before.items() if f.startswith(part)} == {
            f: t for f, t in after.items() if f.startswith(part)}
    assert not {f for f in before if f.startswith("year=2/")} & set(after)


def test_bitmaps_count_exactly(spark, tmp_path):
    rng = random.Random(6)
    rows = [(rng.randrange(3), rng.randrange(-40_000, 90_000), rng.choice([None, 1, 5]))
            for _ in range(20_000)]
    df = spark.createDataFrame(rows, "y int, a long, b int").repartition(5)
    stored = value_bitmaps(df, ["a", "b"], ["y"], str(tmp_path / "bits"))
    whole = {r.column_name: r.n_distinct for r in distinct_counts(stored).collect()}
    assert whole == {"a": len({r[1] for r in rows}), "b": 2}
    two = distinct_counts(stored.filter("y < 2")).filter("column_name = 'a'").first().n_distinct
    assert two == len({r[1] for r in rows if r[0] < 2})
    each = {(r.y, r.column_name): r.n_distinct for r in distinct_counts(stored, ["y"]).collect()}
    assert each == {(y, c): len({r[i] for r in rows if r[0] == y} - {None})
                    for y in range(3) for i, c in ((1, "a"), (2, "b"))}
    empty = value_bitmaps(df.limit(0), ["a"], ["y"])
    assert distinct_counts(empty).collect() == []
