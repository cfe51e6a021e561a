import pytest

from odpanel.operators.flows import cargo_shares, hhi_by_origin, pair_metrics
from odpanel.operators.normalize import composite, min_max, z_score
from odpanel.plans.ranking import corridor_ranking

SCHEMA = "year int, origin_region string, destination_region string, metric string, value double"


def panel(spark, recs):
    out = []
    for y, o, d, tot, emp, ton in recs:
        for m, v in [("transport_operations_total", tot), ("transport_operations_empty", emp),
                     ("tonnes_thousands", ton)]:
            if v is not None or m == "tonnes_thousands":
                out.append((y, o, d, m, None if v is None else float(v)))
    return spark.createDataFrame(out, SCHEMA)


def metrics(spark, recs):
    return {(r.origin, r.destination): r for r in pair_metrics(panel(spark, recs)).collect()}


def test_asymmetry_both_ways(spark):
    m = metrics(spark, [(2020, "A", "B", 10, 1, 30.0), (2020, "B", "A", 10, 1, 10.0)])
    assert m[("A", "B")].asymmetry == pytest.approx(0.5)
    assert m[("B", "A")].asymmetry == pytest.approx(0.5)


def test_missing_reverse_counts_zero(spark):
    m = metrics(spark, [(2020, "A", "B", 10, 1, 30.0)])
    assert m[("A", "B")].asymmetry == 1.0


def test_missing_forward_tonnes(spark):
    m = metrics(spark, [(2020, "A", "B", 10, 1, None), (2020, "B", "A", 10, 1, 10.0)])
    assert m[("A", "B")].asymmetry is None
    assert m[("B", "A")].asymmetry == 1.0


def test_zero_flow_both_ways(spark):
    m = metrics(spark, [(2020, "A", "B", 10, 1, 0.0), (2020, "B", "A", 10, 1, 0.0)])
    assert m[("A", "B")].asymmetry is None


def test_empty_rate(spark):
    assert metrics(spark, [(2020, "A", "B", 0, 0, 1.0)])[("A", "B")].empty_rate is None
    assert metrics(spark, [(2020, "A", "B", 4, 1, 1.0)])[("A", "B")].empty_rate == 0.25


def test_instability(spark):
    assert metrics(spark, [(2020, "A", "B", 1, 0, 10.0)])[("A", "B")].instability is None
    m = metrics(spark, [(2020, "A", "B", 1, 0, 10.0), (2021, "A", "B", 1, 0, 20.0)])
    assert m[("A", "B")].instability == pytest.approx(0.471405, abs=1e-6)


CARGO = "year int, region string, direction string, cargo_class string, metric string, value double"


def test_hhi(spark):
    df = spark.createDataFrame([
        (2020, "A", "expedido", "x", "tonnes_thousands", 5.0),
        (2020, "A", "expedido", "y", "tonnes_thousands", 5.0),
        (2020, "B", "expedido", "x", "tonnes_thousands", 7.0),
        (2020, "B", "expedido", "z", "tonnes_thousands", 0.0),
        (2020, "B", "recibido", "y", "tonnes_thousands", 9.0)], CARGO)
    h = {r.region: r.concentration for r in hhi_by_origin(df).collect()}
    assert h == {"A": pytest.approx(0.5), "B": pytest.approx(1.0)}
    s = {(r.region, r.cargo_class): r.share for r in cargo_shares(df).collect()}
    assert s == {("A", "x"): 0.5, ("A", "y"): 0.5, ("B", "x"): 1.0}
    for v in h.values():
        assert 0 < v <= 1


def norm(spark, vals):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "k int, x double")
    return [r.x_n for r in min_max(df, ["x"]).orderBy("k").collect()]


def test_min_max(spark):
    assert norm(spark, [1.0, 3.0, None]) == [0.0, 1.0, None]
    assert norm(spark, [2.0, 2.0, None]) == [0.0, 0.0, 0.0]
    assert norm(spark, [None, None]) == [0.0, 0.0]


def test_z_score(spark):
    df = spark.createDataFrame([(1.0,), (3.0,)], "x double")
    got = sorted(r.x_z for r in z_score(df, ["x"]).collect())
    assert got == [pytest.approx(-0.7071068), pytest.approx(0.7071068)]


def test_composite(spark):
    df = spark.createDataFrame([(1.0, None, 0.5, 0.0)], "a double, b double, c double, d double")
    assert df.select(composite(["a", "b", "c", "d"])).first()[0] == 1.5


def test_ranking_bounds_and_order(spark):
    recs = [(2020, "A", "B", 10, 2, 30.0), (2020, "B", "A", 10, 5, 10.0),
            (2021, "A", "B", 12, 2, 35.0), (2020, "A", "C", 8, 1, 12.0),
            (2021, "C", "A", 9, 3, 20.0)]
    cargo = spark.createDataFrame([(2020, "A", "expedido", "x", "tonnes_thousands", 5.0),
                                   (2020, "A", "expedido", "y", "tonnes_thousands", 15.0),
                                   (2020, "B", "expedido", "x", "tonnes_thousands", 5.0)], CARGO)
    r = corridor_ranking(panel(spark, recs), cargo).collect()
    comps = [x.composite for x in r]
    assert comps == sorted(comps, reverse=True)
    for x in r:
        assert 0.0 <= x.composite <= 4.0
        for m in ("asymmetry_n", "empty_rate_n", "instability_n", "concentration_n"):
            v = getattr(x, m)
            assert v is None or 0.0 <= v <= 1.0


def test_canonical_pair_variant_equals_window_form(spark):
    from odpanel.operators.flows import wide_flows, yearly_flows, yearly_flows_canonical
    from odpanel.sources.panels import PanelSource
    c = PanelSource(spark, "/root/testdata/sf0.001").clean("corridors")
    a = yearly_flows(wide_flows(c))
    b = yearly_flows_canonical(c)
    key = lambda r: (r.year, r.origin, r.destination)
    ra, rb = sorted(a.collect(), key=key), sorted(b.collect(), key=key)
    assert len(ra) == len(rb) > 0
    for x, y in zip(ra, rb):
        assert key(x) == key(y)
        for f in ("ops_total", "ops_empty", "tonnes", "tonnes_rev", "asym_year", "empty_year"):
            assert x[f] == pytest.approx(y[f]) if x[f] is not None else y[f] is None

    def exchanges(df):
        return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")
    assert exchanges(b) < exchanges(a)
