import duckdb
import pytest

from odpanel.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    want = con.execute(ORACLE[name]).df()
    got = QUERIES[name](spark, SF).toPandas()
    cols = sorted(want.columns)
    assert cols == sorted(got.columns)

    def rows(df):
        return sorted(map(repr, df[cols].astype(object).where(df[cols].notna(), None)
                          .map(lambda x: float(x) if isinstance(x, (int, float))
                               and not isinstance(x, bool) else x)
                          .itertuples(index=False, name=None)))

    assert rows(got) == rows(want)
