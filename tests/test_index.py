import datetime

import pytest

from odpanel.operators.index import cost_per_unit, margin_index, rebase_cost, rebase_price
from odpanel.schemas import COST, COST_MEASURES

PRICE = "year int, quarter string, distance_band string, price_index double"


def cost_frame(spark, periods, null_one=False, base_ok=True):
    rows = []
    for i, p in enumerate(periods):
        vals = {c: 1.0 + i for c in COST_MEASURES}
        vals["km_anual"] = 10.0
        if null_one and i == 0:
            vals["peajes_eur"] = None
        rows.append((p, "x", *[vals[c] for c in COST_MEASURES]))
    return spark.createDataFrame(rows, COST)


def test_cost_null_strict(spark):
    df = cost_frame(spark, [datetime.date(1995, 1, 1)], null_one=True)
    assert cost_per_unit(df).first().cost_per_km is None


def test_index_gap_kept_or_dropped(spark):
    cost = cost_frame(spark, [datetime.date(1995, 1, 1), datetime.date(1995, 4, 1)])
    price = spark.createDataFrame(
        [(1995, q, b, 100.0 + i) for i, q in enumerate(["Q1", "Q2", "Q3"]) for b in ["x", "y"]],
        PRICE)
    keep = margin_index(price, cost).collect()
    assert len(keep) == 6
    gaps = [r for r in keep if r.quarter == "Q3"]
    assert len(gaps) == 2 and all(r.cost_idx is None and r.mpi is None for r in gaps)
    drop = margin_index(price, cost, gaps="drop").collect()
    assert len(drop) == 4 and all(r.mpi is not None for r in drop)


def test_rebase_means_are_100(spark):
    cost = cost_frame(spark, [datetime.date(1995, m, 1) for m in (1, 4, 7, 10)])
    idx = [r.cost_idx for r in rebase_cost(cost, 1995).collect()]
    assert sum(idx) / len(idx) == pytest.approx(100.0)
    price = spark.createDataFrame([(1995, "Q1", "x", 2.0), (1995, "Q2", "x", 4.0),
                                   (1996, "Q1", "x", 6.0)], PRICE)
    got = {(r.year, r.quarter): r.price_idx for r in rebase_price(price, 1995).collect()}
    assert got[(1995, "Q1")] + got[(1995, "Q2")] == pytest.approx(200.0)


def test_band_without_base_is_dropped(spark):
    price = spark.createDataFrame([(1995, "Q1", "x", 2.0), (1996, "Q1", "y", 4.0)], PRICE)
    assert {r.distance_band for r in rebase_price(price, 1995).collect()} == {"x"}


def test_no_cost_base_gives_null_index(spark):
    cost = cost_frame(spark, [datetime.date(1996, 1, 1)])
    assert rebase_cost(cost, 1995).first().cost_idx is None
