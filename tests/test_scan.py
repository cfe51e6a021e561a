"""Carry-forward by a two-level scan against a plain loop and a SQL window."""

import random

import pytest

from odpanel.operators.scan import BLOCK, carry_forward, key_blocks

SCHEMA = "k string, t int, i int, v double, extra string"


def loop(rows):
    out, last = {}, {}
    for k, t, i, v, _ in sorted(rows, key=lambda r: (r[0] or "", r[0] is not None,
                                                     r[1] is not None, r[1] or 0, r[2])):
        if v is not None:
            last[k] = v
        out[i] = last.get(k)
    return out


def frame(n=4000, hot=0.4, known=0.02):
    rng = random.Random(2)
    rows = []
    for i in range(n):
        k = "hot" if rng.random() < hot else rng.choice(["a", "b", None, *map(str, range(30))])
        rows.append((k, rng.choice([None, *range(500)]), i,
                     round(rng.random(), 3) if rng.random() < known else None, "x"))
    return rows


@pytest.mark.parametrize("blocks", [1, 7, 40])
def test_equals_a_loop(spark, blocks):
    rows = frame()
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = carry_forward(df, ["k"], ["t", "i"], "v", "last_v", blocks)
    assert got.columns == [*df.columns, "last_v"]
    assert {r.i: r.last_v for r in got.collect()} == loop(rows)


def test_fills_in_place_and_empty(spark):
    rows = frame(300)
    got = carry_forward(spark.createDataFrame(rows, SCHEMA), ["k"], ["t", "i"], "v")
    assert got.columns == ["k", "t", "i", "v", "extra"]
    assert {r.i: r.v for r in got.collect()} == loop(rows)
    assert carry_forward(spark.createDataFrame([], SCHEMA), ["k"], ["t"], "v").collect() == []


def test_two_keys_and_a_nested_value(spark):
    df = spark.createDataFrame([(1, "a", 1, ("x", 1)), (1, "a", 2, None), (1, "b", 3, None),
                                (2, "a", 1, None), (1, "a", 9, ("y", 2)), (1, "a", 10, None)],
                               "k int, j string, t int, v struct<s:string,n:int>")
    got = {(r.k, r.j, r.t): r.v and tuple(r.v) for r in
           carry_forward(df, ["k", "j"], ["t"], "v", blocks=6).collect()}
    assert got == {(1, "a", 1): ("x", 1), (1, "a", 2): ("x", 1), (1, "b", 3): None,
                   (2, "a", 1): None, (1, "a", 9): ("y", 2), (1, "a", 10): ("y", 2)}


def test_a_hot_key_spreads_over_many_blocks(spark):
    """One key holds a third of all rows: no block holds more than its share."""
    rows = [("hot" if i % 3 == 0 else str(i % 100), i, i, None, "x") for i in range(12_000)]
    stored = key_blocks(spark.createDataFrame(rows, SCHEMA).repartition(6), ["k"], ["t", "i"], 24)
    per = {r[BLOCK]: r["count"] for r in stored.filter("k = 'hot'").groupBy(BLOCK).count().collect()}
    assert sum(per.values()) == 4000
    assert len(per) >= 6 and max(per.values()) <= 1500
    plan = carry_forward(stored.drop(BLOCK), ["k"], ["t", "i"], "v", "w", 24) \
        ._jdf.queryExecution().executedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window" in line and "last(v" in line]
    assert windows and all(BLOCK in line for line in windows)  # no window over a key's rows alone
