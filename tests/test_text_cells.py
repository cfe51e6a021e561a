import pytest

from odpanel.operators.grid import cell_values, find_blocks
from odpanel.operators.records import record_quality
from odpanel.sources.text_cells import line_cells, text_records
from tests.test_oracle import compare

TEXTS = [(1, "a | 2.5 | ..\n\n \t\n 7|x", "s"), (2, None, "s"), (3, "", "s"),
         (4, "Madrid (x)\nMIT License\nTOTAL\nBSD License\n(note)\nLicense", None),
         (None, "Top\nLicense", "s"), (5, "Intro\n\nLicense", "s"), (5, "Intro\n\nLicense", "s")]


@pytest.fixture(scope="module")
def texts(spark):
    return spark.createDataFrame(TEXTS, "doc_id long, text string, source string")


def test_cells_by_line_and_separator(texts):
    got = sorted((r.row, r.col, r.value) for r in cell_values(line_cells(
        texts, "doc_id", "source", "text", r"\|")).where("file = '1'").collect())
    assert [(r, c) for r, c, _ in got] == [(0, 0), (0, 1), (0, 2), (3, 0), (3, 1)]
    assert [v for *_, v in got] == [None, 2.5, None, 7.0, None]
    assert line_cells(texts, "doc_id", "source", "text").where("file in ('2', '3')").count() == 0
    assert line_cells(texts.limit(0), "doc_id", "source", "text").count() == 0


def test_blocks_need_the_very_next_line(spark):
    df = spark.createDataFrame([(i, t, s or "-") for i, t, s in TEXTS],
                               "doc_id long, text string, source string")
    got = sorted((r.file, r.row, r.region or "") for r in find_blocks(
        line_cells(df, "doc_id", "source", "text"), 0, "License").collect())
    assert got == [("4", 0, "Madrid"), ("4", 2, "")]


def test_records_of_texts(spark):
    df = spark.createDataFrame([(1, "1.5\n#2019-01-02#\nx"), (2, '"q"\nno date\n3\n'), (3, "1"),
                                (4, None), (5, "—\né\r\nz")], "id long, text string")
    r = record_quality(text_records(df, "id", "text"), {"km_anual": 1, "period": 2}, 3).first()
    assert (r.files, r.short_records, r.bad_fields) == (5, 2, 4)


@pytest.mark.parametrize("key", ["document_cells", "document_blocks", "document_records"])
@pytest.mark.parametrize("sf", ["0.001", "0.01"])
def test_queries_equal_their_sql(spark, key, sf):
    compare(spark, key, f"/root/testdata/sf{sf}")
