"""Every catalogued query against its DuckDB oracle on sf0.001."""

import datetime
import math
import os

import duckdb
import pytest

import __spark_entry__ as E
from odpanel.plans.oracle_catalog import ORACLE
from odpanel.sources.tables import TABLES

SF = "/root/testdata/sf0.001"


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6) + 0.0
    if isinstance(v, (datetime.date, datetime.datetime)):
        return v.isoformat()
    return v


def _bag(rows):
    return sorted((tuple(_norm(x) for x in r) for r in rows), key=repr)


def compare(spark, key: str, sf_dir: str) -> None:
    """The query's rows equal its SQL's over the same folder."""
    con = duckdb.connect()
    for t in TABLES:
        if os.path.exists(f"{sf_dir}/{t}.parquet"):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    sdf = E.queries()[key](spark, sf_dir)
    rel = con.sql(E.oracle_sql()[key])
    assert sorted(sdf.columns) == sorted(rel.columns)
    order = [rel.columns.index(c) for c in sdf.columns]
    orows = [tuple(r[i] for i in order) for r in rel.fetchall()]
    assert _bag(tuple(r) for r in sdf.collect()) == _bag(orows)


@pytest.mark.parametrize("key", sorted(ORACLE))
def test_matches_oracle(spark, key):
    compare(spark, key, SF)
