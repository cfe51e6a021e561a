from odpanel.operators.grid import find_blocks, quarterly_panel

CELLS = "file string, sheet string, row int, col int, num double, text string"


def test_carry_forward_year(spark):
    cells = spark.createDataFrame([
        ("f", "2.9", 23, 0, 2019.0, None),
        ("f", "2.9", 24, 1, None, "1T"), ("f", "2.9", 24, 2, 10.0, None),
        ("f", "2.9", 25, 1, None, "2T"), ("f", "2.9", 25, 2, None, ".."),
        ("f", "2.9", 26, 0, None, "2020"),
        ("f", "2.9", 27, 1, None, "1T"), ("f", "2.9", 27, 2, 12.0, None)], CELLS)
    out = quarterly_panel(cells, "2.9", 23, {"1T": "Q1", "2T": "Q2"}, {2: "Total"}, 2019, 2020)
    got = sorted((r.year, r.quarter, r.price_index) for r in out.collect())
    assert got == [(2019, "Q1", 10.0), (2020, "Q1", 12.0)]


def test_block_detection(spark):
    cells = spark.createDataFrame([
        ("f", "p1", 20, 0, None, "Madrid"), ("f", "p1", 21, 0, None, "Total transportado"),
        ("f", "p1", 30, 0, None, "(note)"), ("f", "p1", 31, 0, None, "Total transportado"),
        ("f", "p1", 40, 0, None, "Fuente: x"), ("f", "p1", 41, 0, None, "Total transportado"),
        ("f", "p1", 50, 0, None, "Gap"), ("f", "p1", 52, 0, None, "Total transportado")], CELLS)
    got = [(r.row, r.region) for r in find_blocks(cells).collect()]
    assert got == [(20, "Madrid")]
