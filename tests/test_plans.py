import __spark_entry__ as E
from odpanel.plans.catalog import QUERIES
from odpanel.plans.oracle_catalog import ORACLE

SF = "/root/testdata/sf0.001"


def test_catalog_and_oracle_keys():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert set(QUERIES) == set(ORACLE)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns[:2] == ["origin", "destination"] and df.columns[-1] == "composite"
    assert df.count() > 0


def _plan(df):
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_python_udf_in_plans(spark):
    for key in ["corridor_ranking", "margin_index", "profile_summary", "block_extract",
                "obs_extract", "price_from_grid"]:
        plan = _plan(E.queries()[key](spark, SF))
        assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan, key


def test_margin_index_broadcasts_cost_side(spark):
    plan = _plan(E.queries()["margin_index"](spark, SF))
    assert "BroadcastHashJoin" in plan


def test_scan_prunes_columns(spark):
    from odpanel.sources.panels import cost_cube
    df = cost_cube(spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "l_orderkey" not in plan and "l_shipdate" in plan


def test_margin_index_shape(spark):
    rows = E.queries()["margin_index"](spark, SF).collect()
    assert len(rows) == 144 and not [r for r in rows if r.cost_idx is None]


def test_large_join_is_not_forced(spark):
    """No hint: with hash joins out of bounds the plan is a merge join."""
    from odpanel.sources.panels import flow_cube
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "0"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        plan = _plan(flow_cube(spark, SF))
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert "ShuffledHashJoin" not in plan and "SortMergeJoin" in plan


def test_asymmetry_symmetric_when_both_directions_observed(spark):
    from odpanel.operators.flows import yearly_flows_canonical
    from odpanel.sources.panels import PanelSource
    y = yearly_flows_canonical(PanelSource(spark, SF).clean("corridors")).collect()
    by = {(r.year, r.origin, r.destination): r for r in y}
    checked = 0
    for (yr, o, d), r in by.items():
        back = by.get((yr, d, o))
        if back is not None and r.tonnes is not None and back.tonnes is not None:
            assert r.asym_year == back.asym_year
            assert r.tonnes_rev == back.tonnes
            checked += 1
    assert checked > 0


def test_clean_year_window_reaches_the_scans(spark):
    from odpanel.sources.panels import cost_cube, flow_cube
    for build, col in ((flow_cube, "o_orderdate"), (cost_cube, "l_shipdate")):
        plan = build(spark, SF, years=(1995, 2000))._jdf.queryExecution().executedPlan().toString()
        pushed = [ln for ln in plan.split("\n") if "PushedFilters" in ln and col in ln]
        assert pushed and "GreaterThanOrEqual(" + col in pushed[0] and "LessThan(" + col in pushed[0]


def test_flow_cube_choice(spark):
    from odpanel.plans.ranking import corridor_ranking
    from odpanel.sources.panels import PanelSource
    src = PanelSource(spark, SF)
    src.clean("corridors")
    assert [k for k in src._cubes if k[0] == "flow"] == [("flow", (1995, 2000), False)]
    both = PanelSource(spark, SF)
    both.typed_flows = True
    corridor_ranking(both.clean("corridors"), both.clean("cargo"))
    assert [k for k in both._cubes if k[0] == "flow"] == [("flow", (1995, 2000), True)]


def _jobs_before_an_action(spark, key):
    spark.sparkContext.setJobGroup(f"jobs-{key}", key)
    try:
        E.queries()[key](spark, SF)
    finally:
        spark.sparkContext.setJobGroup("none", "")
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"jobs-{key}"))


def test_schema_listing_runs_no_job(spark):
    assert _jobs_before_an_action(spark, "describe_table") == 0


def test_spot_filters_reach_the_scans(spark):
    from odpanel.sources.panels import flow_cube
    df = flow_cube(spark, SF, years=(2000, 2000), typed=False, pair=("NATION_1", "NATION_2"))
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LeftSemi") == 2
    assert {(r.o_name, r.d_name) for r in df.collect()} <= {("NATION_1", "NATION_2")}
