import datetime

import pytest
from pyspark.sql import functions as F

from odpanel.functions import (blank_or_null, clean_cell, literal_bool, literal_date,
                               literal_number,
                               literal_text, normalize_label, null_strict_sum, safe_div)
from odpanel.operators.records import extract_records
from tests.conftest import rows


def test_sentinel_cells(spark):
    df = spark.createDataFrame(
        [(None, ""), (None, ".."), (None, "."), (None, "-"), (None, " 12.5 "), (None, "abc"),
         (3.0, None)], "num double, text string")
    got = [r[0] for r in df.select(clean_cell("num", "text")).collect()]
    assert got == [None, None, None, None, 12.5, None, 3.0]


def test_label_rules(spark):
    df = spark.createDataFrame([("Castilla-La Mancha",), ("Castilla y León",), ("País Vasco",),
                                ("Balears, Illes",), ("TOTAL",), ("Elsewhere",)], "t string")
    got = [r[0] for r in df.select(normalize_label("t")).collect()]
    assert got == ["Castilla-La Mancha", "Castilla y Leon", "Pais Vasco", "Baleares", None,
                   "Elsewhere"]


def test_typed_literals(spark):
    df = spark.createDataFrame([('"Artículo"', "120000", "0.385", "#2020-01-31#")],
                               "a string, b string, c string, d string")
    r = df.select(literal_text("a"), literal_number("b"), literal_number("c"),
                  literal_date("d")).first()
    assert tuple(r) == ("Artículo", 120000.0, 0.385, datetime.date(2020, 1, 31))


def test_safe_div_and_null_strict_sum(spark):
    df = spark.createDataFrame([(1.0, 0.0, None), (4.0, 2.0, 1.0)], "a double, b double, c double")
    got = rows(df.select(safe_div("a", "b").alias("q"),
                         null_strict_sum(["a", "b", "c"]).alias("s")))
    assert got == [(None, None), (2.0, 7.0)]


def test_blank_or_null_is_ansi_safe(spark):
    df = spark.createDataFrame([(1, 1.5, datetime.date(2020, 1, 1), ".."), (None, None, None, " ")],
                               "i int, d double, t date, s string")
    exprs = [F.count_if(blank_or_null(f.name, f.dataType)).alias(f.name) for f in df.schema.fields]
    assert tuple(df.agg(*exprs).first()) == (1, 1, 1, 2)


def test_latin1_record_and_short_record(spark):
    lines = ["0"] * 256
    lines[128] = '"Artículo"'
    lines[134] = "120000"
    lines[135] = "50"
    lines[205] = "0.385"
    lines[206] = "0.3"
    lines[255] = "#2020-01-31#"
    good = "\r\n".join(lines).encode("latin-1")
    short = "\n".join(lines[:255]).encode("latin-1")
    df = spark.createDataFrame([("a.obs", bytearray(good)), ("b.obs", bytearray(short))],
                               "path string, content binary")
    out = extract_records(df).collect()
    assert len(out) == 1
    r = out[0]
    assert r.vehicle_type == "Artículo" and r.km_anual == 120000.0
    assert r.period == datetime.date(2020, 1, 31)
    assert r.km_en_carga == pytest.approx(60000.0)
    assert r.combustible_eur == pytest.approx(0.385 * 0.3 * 120000)


def test_boolean_literals(spark):
    df = spark.createDataFrame([("#TRUE#",), ("#FALSE#",), ("TRUE",), ('"x"',)], "s string")
    assert [r[0] for r in df.select(literal_bool("s")).collect()] == [True, False, None, None]


def test_record_parse_failures_are_counted(spark):
    from odpanel.operators.records import record_quality
    lines = ["0"] * 256
    lines[134] = "abc"          # km: not a number -> NULL, counted
    lines[255] = "#2020-01-31#"
    df = spark.createDataFrame(
        [("a.obs", bytearray("\n".join(lines).encode("latin-1"))),
         ("b.obs", bytearray("\n".join(lines[:10]).encode("latin-1")))],
        "path string, content binary")
    out = extract_records(df).collect()
    assert len(out) == 1 and out[0].km_anual is None
    m = record_quality(df).first()
    assert (m.files, m.short_records, m.bad_fields) == (2, 1, 1)


def test_rule_table_matches_case_rules(spark):
    from odpanel.functions.labels import REGION_PREFIXES, normalize_with_rule_table
    labels = ["Castilla-La Mancha", "Castilla y León", "País Vasco", "Balears, Illes", "TOTAL",
              "Elsewhere", " Madrid ", "", "Pa"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(labels)] + [(99, None)],
                               "k int, t string")
    rules = spark.createDataFrame(list(REGION_PREFIXES.items()), "prefix string, canon string")
    a = {r.k: r.label for r in normalize_with_rule_table(df, "t", rules).collect()}
    b = {r.k: r.label for r in df.select("k", normalize_label("t").alias("label")).collect()}
    assert a == b
    # longest prefix wins when rules overlap
    rules2 = spark.createDataFrame([("Castilla", "C"), ("Castilla y", "CyL")],
                                   "prefix string, canon string")
    c = {r.k: r.label for r in normalize_with_rule_table(df, "t", rules2).collect()}
    assert c[0] == "C" and c[1] == "CyL"


def test_final_line_ending_is_no_line(spark):
    from odpanel.operators.records import record_quality
    text = "\n".join(["0"] * 255)
    files = spark.createDataFrame([(str(i), bytearray(t.encode())) for i, t in enumerate(
        [text + "\n", text + "\n1", text + "\n1\n", text + "\r\n1\r\n"])],
        "path string, content binary")
    assert record_quality(files).first().short_records == 1
    assert extract_records(files).count() == 3


def test_labels_meet_every_rule_and_none(spark):
    from odpanel.functions import normalize_label
    from odpanel.functions.labels import REGION_PREFIXES
    labels = [p + "x y" for p in REGION_PREFIXES] + ["TOTAL\n", "\tMadrid\x1f", "Elsewhere ", ""]
    want = [*REGION_PREFIXES.values(), None, "Madrid", "Elsewhere", ""]
    df = spark.createDataFrame(list(enumerate(labels)), "i int, raw string")
    got = df.select("i", normalize_label("raw").alias("label")).orderBy("i").collect()
    assert [r.label for r in got] == want
    rules = {"A": "short", "Ab": "long"}
    one = spark.createDataFrame([("Abc",)], "raw string")
    assert one.select(normalize_label("raw", rules).alias("x")).first().x == "long"


def test_cells_of_every_kind(spark):
    from odpanel.functions.columns import SENTINELS
    texts = [*SENTINELS, "\t..\n", " 12.5 ", "\x0b7", "1e3", "abc", "1,5", None]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string") \
        .withColumn("num", F.lit(None).cast("double"))
    got = [r.v for r in df.select("i", clean_cell().alias("v")).orderBy("i").collect()]
    assert got == [None] * (len(SENTINELS) + 1) + [12.5, 7.0, 1000.0, None, None, None]


def test_odd_years_and_sheets_do_not_fail(spark):
    from odpanel.operators.grid import block_table, find_blocks, header_year
    df = spark.createDataFrame([(1e18, None), (None, "99999999999"), (None, " 1999\n")],
                               "num double, text string")
    assert [r.y for r in df.select(header_year().alias("y")).collect()] == [None, None, 1999]
    cells = spark.createDataFrame(
        [("f_2020", "plain", 20, 0, None, "Madrid"),
         ("f_2020", "plain", 21, 0, None, "Total transportado"),
         ("f_2020", "plain", 27, 2, 4.0, None)],
        "file string, sheet string, row int, col int, num double, text string")
    out = block_table(cells, find_blocks(cells), {"expedido": 7}, {2: "A"}, {0: "B"}, {"x": "m"})
    assert [(r.year, r.value, r.metric) for r in out.collect()] == [(2020, 4.0, None)]
