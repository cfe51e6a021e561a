"""More nations, years, size bands and part types than the test tables have:
the grid queries must return the whole panels, and sums stay exact."""

import duckdb
import pytest

import __spark_entry__ as E
from odpanel.sources.panels import PanelSource, cost_cube, write_panels
from tests.test_oracle import compare

SF = "/root/testdata/sf0.001"
GRID = ["clean_cells", "normalize_labels", "od_matrix_long", "price_from_grid",
        "regional_from_grid", "bands_from_grid", "block_detect", "block_extract",
        "unpivot_labels", "table_summary", "obs_extract", "obs_quality"]


@pytest.fixture(scope="module")
def wide(tmp_path_factory):
    """1,200 nations with gaps among their keys, ship and order years up to
    2011, sizes up to 60, a seventh part type."""
    out = tmp_path_factory.mktemp("wide")
    con = duckdb.connect()
    tables = {
        "nation": """SELECT CAST(i + (i // 900) * 40 AS INTEGER) AS n_nationkey,
            'NATION_' || (i + (i // 900) * 40) AS n_name, CAST(i % 5 AS INTEGER) AS n_regionkey
            FROM range(1200) t(i)""",
        "customer": """SELECT c_custkey, c_name, CAST((c_custkey * 7) % 1200
            + (((c_custkey * 7) % 1200) // 900) * 40 AS INTEGER) AS c_nationkey, c_acctbal,
            c_mktsegment FROM src""",
        "supplier": """SELECT s_suppkey, s_name, CAST((s_suppkey * 131) % 1200
            + (((s_suppkey * 131) % 1200) // 900) * 40 AS INTEGER) AS s_nationkey, s_acctbal
            FROM src""",
        "part": """SELECT p_partkey, p_name, p_brand, CASE WHEN p_partkey % 11 = 0 THEN 'XTRA'
            ELSE p_type END AS p_type, CAST(CASE WHEN p_partkey % 6 = 0 THEN 58 ELSE p_size END
            AS INTEGER) AS p_size, p_retailprice FROM src""",
        "orders": """SELECT * REPLACE (CASE WHEN o_orderkey % 5 = 0 THEN o_orderdate
            + INTERVAL 10 YEAR ELSE o_orderdate END AS o_orderdate) FROM src""",
        "lineitem": """SELECT * REPLACE (CASE WHEN l_orderkey % 5 = 0 THEN l_shipdate
            + INTERVAL 10 YEAR ELSE l_shipdate END AS l_shipdate) FROM src""",
        "region": "SELECT * FROM src",
    }
    for name, body in tables.items():
        con.execute(f"CREATE OR REPLACE VIEW src AS SELECT * FROM '{SF}/{name}.parquet'")
        con.execute(f"COPY ({body}) TO '{out}/{name}.parquet' (FORMAT parquet)")
    return str(out)


@pytest.mark.parametrize("key", GRID)
def test_grid_queries_return_the_whole_panel(spark, wide, key):
    compare(spark, key, wide)


def test_sums_beyond_long_are_exact(spark, tmp_path):
    n, price, rate = 60_000, 90_000_000_000.99, 5000.0
    rows = spark.range(n).selectExpr(
        "id AS l_orderkey", "id AS l_partkey", "id AS l_suppkey", "1 AS l_linenumber",
        "1D AS l_quantity", f"CAST({price} AS DOUBLE) AS l_extendedprice",
        f"CAST({rate} AS DOUBLE) AS l_discount", "0D AS l_tax", "'A' AS l_returnflag",
        "'F' AS l_linestatus", "TIMESTAMP_NTZ'1996-01-01 00:00:00' AS l_shipdate")
    rows.write.parquet(f"{tmp_path}/lineitem.parquet")
    got = cost_cube(spark, str(tmp_path)).first()
    want = n * round(price * 100) * round(rate * 100)
    assert want > 2 ** 63
    assert got.combustible_eur == want / 1_000_000.0
    assert got.personal_conduccion_eur == want / 10_000.0
    assert got.fuel_consumption_coeff == rate


def test_stored_panels_give_the_same_without_a_scan(spark, tmp_path):
    from odpanel.operators import index
    from odpanel.plans import ranking
    write_panels(PanelSource(spark, SF), str(tmp_path))
    stored = PanelSource(spark, SF, location=str(tmp_path))
    direct = PanelSource(spark, SF)
    direct.typed_flows = True

    def both(make):
        a, b = make(stored), make(direct)
        plan = a._jdf.queryExecution().executedPlan().toString()
        assert "lineitem" not in plan
        round6 = [tuple(round(x, 6) if isinstance(x, float) else x for x in r)
                  for r in a.collect()]
        assert sorted(map(repr, round6)) == sorted(repr(tuple(
            round(x, 6) if isinstance(x, float) else x for x in r)) for r in b.collect())

    both(lambda s: ranking.corridor_ranking(s.clean("corridors"), s.clean("cargo"),
                                            materialize=False))
    both(lambda s: index.margin_index(s.clean("price_index"), s.clean("cost")))


def test_cheap_keys_prune(spark):
    plan = E.queries()["dq_spot"](spark, SF)
    assert plan.count() <= 1
    src = PanelSource(spark, SF, materialize=False)
    src.clean("corridors")
    assert src._cubes and not any(df.isStreaming for df in src._cubes.values())
