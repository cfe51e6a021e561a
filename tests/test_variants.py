"""Types and fields of JSON text; CSV lines that do not fit the schema."""

from pyspark.sql.types import DoubleType, IntegerType, StringType, StructField, StructType

from odpanel.operators.variants import found_types, typed_fields
from odpanel.sources.files import BAD_LINE, line_quality, read_csv_checked

TEXTS = ['{"k": 1}', '{"k": "seven", "m": {"n": [1, 2]}}', '{"k": 2.5}', "[1, 2]", "3", "null",
         '"text"', "{bad", "", None, '{"k": null}', '{"k": true}']


def test_fields_types_and_bad_text(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "i int, t string")
    got = {r.i: r for r in typed_fields(df, "t", {
        "k": ("$.k", "int"), "s": ("$.k", "string"), "n": ("$.m.n[1]", "long")}).collect()}
    assert [i for i in got if got[i].bad_text] == [7, 8]
    assert got[0].k == 1 and got[1].k is None and got[1].s == "seven" and got[1].n == 2
    assert all(got[i].k is None for i in (3, 4, 5, 6, 7, 8, 9, 10))
    one = found_types(df, "t").first()
    assert (one.n_rows, one.n_null, one.n_bad) == (12, 1, 2) and one.found == "VARIANT"


def test_types_by_key(spark):
    rows = [("a", '{"x": 1}'), ("a", '{"y": "s"}'), ("b", "1"), ("b", "2.5"), ("c", "{"),
            ("d", None)]
    df = spark.createDataFrame(rows, "k string, t string")
    got = {r.k: (r.n_bad, r.n_null, r.found) for r in found_types(df, "t", ["k"]).collect()}
    assert got["a"] == (0, 0, "OBJECT<x: BIGINT, y: STRING>")
    assert got["b"][2].startswith("DECIMAL") and got["c"] == (1, 0, None)
    assert got["d"] == (0, 1, None)
    assert found_types(df.limit(0), "t", ["k"]).collect() == []


SCHEMA = StructType([StructField("a", IntegerType()), StructField("b", DoubleType()),
                     StructField("c", StringType())])


def test_bad_lines_are_kept_with_their_file(spark, tmp_path):
    (tmp_path / "one.csv").write_text("a,b,c\n1,1.5,x\nbad,2.5,y\n3,4.5\n\n")
    (tmp_path / "two.csv").write_text('a,b,c\n4,,"q, r"\n5,6.5,z,more\n')
    df = read_csv_checked(spark, str(tmp_path), SCHEMA)
    bad = sorted(r[BAD_LINE] for r in df.filter(f"{BAD_LINE} IS NOT NULL").collect())
    assert bad == ["3,4.5", "5,6.5,z,more", "bad,2.5,y"]
    quality = {r.file.rsplit("/", 1)[1]: (r.n_lines, r.n_bad) for r in line_quality(df).collect()}
    assert quality == {"one.csv": (3, 2), "two.csv": (2, 1)}
    kept = {r.c: (r.a, r.b) for r in df.collect()}
    assert kept["x"] == (1, 1.5) and kept["q, r"] == (4, None) and kept["y"] == (None, 2.5)
    assert df.select("c").filter("c = 'y'").count() == 1
    assert df.count() == 5
