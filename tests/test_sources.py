import datetime
import os

from odpanel.operators.grid import labeled_rows, od_long, od_matrix, sectioned_rows
from odpanel.operators.records import extract_records
from odpanel.session import shared_dir
from odpanel.sources.files import read_records

CELLS = "file string, sheet string, row int, col int, num double, text string"


def _record(period, km, short=False):
    lines = ["0"] * 256
    lines[128] = '"Artículo General"'
    lines[134] = str(km)
    lines[135] = "50"
    lines[205] = "1.25"
    lines[206] = "0.3"
    lines[255] = f"#{period}#"
    if short:
        lines = lines[:200]
    return "\r\n".join(lines).encode("latin-1")


def test_record_files_from_folders(spark):
    root = shared_dir(spark, "records_test")
    for folder, period, km, short in [("2020-01", "2020-01-31", 1000, False),
                                      ("2020-04", "2020-04-30", 2000, False),
                                      ("2020-07", "2020-07-31", 3000, True)]:
        os.makedirs(os.path.join(root.replace("file:", ""), folder), exist_ok=True)
        with open(os.path.join(root.replace("file:", ""), folder, "Articulado Carga General.obs"),
                  "wb") as f:
            f.write(_record(period, km, short))
    with open(os.path.join(root.replace("file:", ""), "2020-01", "Furgoneta.obs"), "wb") as f:
        f.write(_record("2020-01-31", 7, False))   # another vehicle's record
    with open(os.path.join(root.replace("file:", ""), "notes.txt"), "wb") as f:
        f.write(b"not a record")
    out = extract_records(read_records(spark, root)).collect()
    assert [(r.period, r.km_anual, r.vehicle_type) for r in out] == [
        (datetime.date(2020, 1, 31), 1000.0, "Artículo General"),
        (datetime.date(2020, 4, 30), 2000.0, "Artículo General")]


def test_matrix_halves_sentinels_diagonal_exclusion(spark):
    # 3 regions: left sheet holds destinations 0-1 (cols 1, 2), right sheet destination 2 (col 0)
    cells = spark.createDataFrame([
        ("f_2020", "M", 17, 1, 5.0, None), ("f_2020", "M", 17, 2, 7.0, None),
        ("f_2020", "Ms", 17, 0, None, ".."),
        ("f_2020", "M", 18, 1, 3.0, None), ("f_2020", "Ms", 18, 0, 9.0, None),
        ("f_2020", "M", 19, 2, None, " 4 "), ("f_2020", "Ms", 19, 0, 1.0, None)], CELLS)
    m = od_matrix(cells, {"M": ("Ms", "tonnes")}, 17, 3, range(1, 3), range(1))
    labels = spark.createDataFrame([(0, "A"), (1, "B"), (2, "C")], "idx int, name string")
    got = sorted(tuple(r) for r in od_long(m, labels, excluded=["C"]).collect())
    assert got == [(2020, "A", "B", "tonnes", 7.0), (2020, "B", "A", "tonnes", 3.0)]
    got_all = sorted(tuple(r) for r in od_long(m, labels).collect())
    assert got_all == [(2020, "A", "B", "tonnes", 7.0), (2020, "B", "A", "tonnes", 3.0),
                       (2020, "B", "C", "tonnes", 9.0), (2020, "C", "B", "tonnes", 4.0)]


def test_labeled_rows_skip_total_and_blank(spark):
    cells = spark.createDataFrame([
        ("r_2021", "6.1", 17, 0, None, "Madrid"), ("r_2021", "6.1", 17, 1, 10.0, None),
        ("r_2021", "6.1", 17, 5, None, "-"),
        ("r_2021", "6.1", 18, 0, None, "TOTAL"), ("r_2021", "6.1", 18, 1, 99.0, None)], CELLS)
    out = labeled_rows(cells, {"6.1": "operations_total"}, 17, 19,
                       {1: "intrarregional_total", 5: "interregional_recibido"}).collect()
    assert [tuple(r) for r in out] == [(2021, "Madrid", "intrarregional_total",
                                        "operations_total", 10.0)]


def test_sectioned_rows_need_numeric_year(spark):
    cells = spark.createDataFrame([
        ("b", "4.9", 14, 0, None, "Total"),
        ("b", "4.9", 15, 0, 2019.0, None), ("b", "4.9", 15, 1, 8.0, None),
        ("b", "4.9", 16, 0, None, "2020"), ("b", "4.9", 16, 1, 9.0, None),
        ("b", "4.9", 25, 0, 2019.0, None), ("b", "4.9", 25, 2, 2.0, None)], CELLS)
    out = sorted(tuple(r) for r in sectioned_rows(
        cells, {"4.9": "operations_total"}, {"total": (15, 22), "cuenta_ajena": (25, 32)},
        {1: "Total", 2: "near"}, 2018, 2024).collect())
    assert out == [(2019, "Total", "total", "operations_total", 8.0),
                   (2019, "near", "cuenta_ajena", "operations_total", 2.0)]
