from odpanel.operators.profile import describe_table
from odpanel.sources.files import create_database, list_tables, read_csv, save_table, write_csv
from odpanel.schemas import PRICE_INDEX
from odpanel.session import shared_dir


def _price(spark):
    return spark.createDataFrame([(2020, "Q1", "Total", 101.5), (2020, "Q2", "Total", None)],
                                 PRICE_INDEX)


def test_catalog_database_table_describe(spark):
    create_database(spark, "odp_test")
    df = _price(spark)
    save_table(df, "odp_test.price_index")
    save_table(df, "odp_test.price_index")   # overwrite: idempotent re-run
    names = [r.tableName for r in list_tables(spark, "odp_test").collect()]
    assert names == ["price_index"]
    assert spark.table("odp_test.price_index").count() == 2
    desc = [(r.col_name, r.data_type) for r in describe_table(spark, spark.table("odp_test.price_index")).collect()]
    assert desc == [("year", "int"), ("quarter", "string"), ("distance_band", "string"),
                    ("price_index", "double")]


def test_csv_overwrite_single_file_and_schema(spark):
    path = shared_dir(spark, "csv_test")
    df = _price(spark)
    write_csv(df, path, single_file=True)
    write_csv(df, path, single_file=True)
    back = read_csv(spark, path, PRICE_INDEX)
    assert sorted(back.collect(), key=str) == sorted(df.collect(), key=str)
    assert back.schema == PRICE_INDEX


def test_catalog_scan_and_conf_path(spark, tmp_path):
    from odpanel.operators.cleaning import sort_dimensions
    from odpanel.sources.tables import conf_or_default, scan_table
    df = spark.createDataFrame([(2, "b", 1.0), (1, "c", 2.0), (1, "a", 3.0)],
                               "year int, region string, value double")
    spark.sql("CREATE DATABASE IF NOT EXISTS scans")
    df.write.mode("overwrite").saveAsTable("scans.panel")
    df.write.parquet(f"{tmp_path}/panel")
    spark.conf.set("odpanel.panel", f"{tmp_path}/panel")
    for name in ("scans.panel", conf_or_default(spark, "odpanel.panel", "none"),
                 conf_or_default(spark, "odpanel.absent", "scans.panel")):
        got = sort_dimensions(scan_table(spark, name)).collect()
        assert [(r.year, r.region) for r in got] == [(1, "a"), (1, "c"), (2, "b")]
    spark.sql("DROP DATABASE scans CASCADE")
