"""Extraction of long tables from spreadsheet cell grids.

Input is a ``cells`` table (file, sheet, row, col, num, text): one row per
non-empty cell, numeric cells in ``num``, text cells in ``text``. Every
operator is a set of DataFrame joins / windows keyed by (file, sheet, row),
so many workbooks are processed in parallel. The only ordered step, the
carry-forward of year headers, is a window per (file, sheet): a sheet is
bounded by the spreadsheet format (65,536 rows in .xls), never by the
number of files.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from odpanel.functions import clean_cell, normalize_label, trim_blanks


def _map(d: dict) -> Column:
    """Literal lookup map (codegen'd ``element_at``), for small fixed lists."""
    kv = []
    for k, v in d.items():
        kv += [F.lit(k), F.lit(v)]
    return F.create_map(*kv)


def _year_from(file_col: str, pattern: str) -> Column:
    return F.regexp_extract(F.col(file_col), pattern, 1).try_cast("int")


def cell_values(cells: DataFrame) -> DataFrame:
    """(file, sheet, row, col, value): the cleaned numeric value of each cell."""
    return cells.select("file", "sheet", "row", "col", clean_cell("num", "text").alias("value"))


def header_year(num: str = "num", text: str = "text") -> Column:
    """Year of a header cell: a numeric cell, or digit-only text."""
    t = trim_blanks(text)
    return F.coalesce(F.col(num).try_cast("int"),
                      F.when(t.rlike("^[0-9]+$"), t.try_cast("int")))


def carry_forward(rows: DataFrame, value: str, out: str) -> DataFrame:
    """Last non-NULL ``value`` at or above each row, per (file, sheet)."""
    w = (Window.partitionBy("file", "sheet").orderBy("row")
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return rows.withColumn(out, F.last(value, ignorenulls=True).over(w))


def unpivot_labeled(df: DataFrame, ids, columns: dict, key: str, value: str) -> DataFrame:
    """Wide -> long over ``columns`` (column -> label); NULL values give no row."""
    long = df.unpivot(ids, list(columns), "_col", value)
    return long.where(F.col(value).isNotNull()).select(
        *ids, _map(columns)[F.col("_col")].alias(key), value)


def quarterly_panel(cells: DataFrame, sheet: str, start_row: int, quarter_labels: dict,
                    value_cols: dict, y_min: int, y_max: int, year_col: int = 0,
                    label_col: int = 1, band: str = "distance_band",
                    value: str = "price_index") -> DataFrame:
    """Quarter rows of a sheet whose year appears only on header rows.

    Year headers (col ``year_col``, numeric or digit text) carry forward to
    the rows below; rows whose ``label_col`` text is a quarter label give one
    value per ``value_cols`` column (column -> band). Only years in
    [y_min, y_max] are kept; empty and sentinel cells give no row.
    """
    c = cells.where((F.col("sheet") == sheet) & (F.col("row") >= start_row))
    rows = c.where(F.col("col").isin(year_col, label_col)).groupBy("file", "sheet", "row").agg(
        F.max(F.when(F.col("col") == year_col, header_year())).alias("year_hdr"),
        F.max(F.when(F.col("col") == label_col, trim_blanks("text"))).alias("label"))
    rows = carry_forward(rows, "year_hdr", "year")
    qmap = _map(quarter_labels)
    rows = rows.where(qmap[F.col("label")].isNotNull() & F.col("year").between(y_min, y_max))
    vals = cell_values(c.where(F.col("col").isin(*value_cols)))
    return vals.join(rows, ["file", "sheet", "row"]).where(F.col("value").isNotNull()).select(
        "year", qmap[F.col("label")].alias("quarter"),
        _map(value_cols)[F.col("col")].alias(band), F.col("value").alias(value))


def od_matrix(cells: DataFrame, sheets: dict, first_row: int, n_rows: int,
              left_cols: range, right_cols: range) -> DataFrame:
    """(file, metric, row_idx, col_idx, value) of square matrices stored in
    two sheet halves: the right half's columns continue after the left's.

    ``sheets`` maps left sheet -> (right sheet, metric). One pass over the
    cells of all sheets; no union of halves needed.
    """
    right_sheets = [r for r, _ in sheets.values()]
    metric = {**{l: m for l, (_, m) in sheets.items()}, **{r: m for r, m in sheets.values()}}
    is_left = F.col("sheet").isin(*sheets)

    def index(cols: range, first: int) -> Column:
        return F.when((F.col("col") >= cols.start) & (F.col("col") < cols.stop),
                      F.col("col") - cols.start + first)

    col_idx = F.when(is_left, index(left_cols, 0)).otherwise(index(right_cols, len(left_cols)))
    c = cells.where((is_left | F.col("sheet").isin(*right_sheets))
                    & F.col("row").between(first_row, first_row + n_rows - 1))
    return c.select("file", _map(metric)[F.col("sheet")].alias("metric"),
                    (F.col("row") - first_row).alias("row_idx"), col_idx.alias("col_idx"),
                    clean_cell("num", "text").alias("value")).where(
        F.col("col_idx").isNotNull() & F.col("value").isNotNull())


def od_long(matrix: DataFrame, labels: DataFrame, excluded=(), year_pattern: str = r"(\d{4})",
            origin: str = "origin_region", dest: str = "destination_region") -> DataFrame:
    """Matrix cells -> (year, origin, destination, metric, value).

    ``labels`` is (idx, name) for both axes. Cells are looked up through two
    equi-joins with the label table (only cells that exist produce rows);
    the diagonal and excluded labels on either end are dropped.
    """
    o = labels.select(F.col("idx").alias("row_idx"), F.col("name").alias(origin))
    d = labels.select(F.col("idx").alias("col_idx"), F.col("name").alias(dest))
    x = matrix.where(F.col("row_idx") != F.col("col_idx")).join(o, "row_idx").join(d, "col_idx")
    if excluded:
        x = x.where(~F.col(origin).isin(*excluded) & ~F.col(dest).isin(*excluded))
    return x.select(_year_from("file", year_pattern).alias("year"), origin, dest, "metric", "value")


def find_blocks(cells: DataFrame, start_row: int = 16, marker: str = "Total transportado",
                skip_prefixes=("(", "Fuente"), label_col: int = 0, sheets=None) -> DataFrame:
    """Block headers: a label row whose next row's label contains ``marker``.

    The next row is found by a self-join on row + 1 (true row numbers: an
    empty row in between breaks the pair). Labels starting with a skip
    prefix are notes, not blocks. Output (file, sheet, row, region) with the
    label normalized (TOTAL -> NULL).
    """
    lab = cells.where((F.col("col") == label_col) & F.col("text").isNotNull())
    if sheets is not None:
        lab = lab.where(F.col("sheet").isin(*sheets))
    lab = lab.select("file", "sheet", "row", trim_blanks("text").alias("label"))
    nxt = lab.select("file", "sheet", (F.col("row") - 1).alias("row"),
                     F.col("label").alias("next_label"))
    ok = (F.col("row") >= start_row) & (F.col("label") != "")
    for p in skip_prefixes:
        ok = ok & ~F.col("label").startswith(p)
    return lab.join(nxt, ["file", "sheet", "row"]).where(
        ok & F.col("next_label").contains(marker)).select(
        "file", "sheet", "row", normalize_label(F.col("label")).alias("region"))


def _next_page(sheet: Column) -> Column:
    """``<prefix>p<i>`` -> ``<prefix>p<i+1>``."""
    return F.concat(F.regexp_extract(sheet, r"^(.*p)(\d+)$", 1),
                    (F.regexp_extract(sheet, r"^(.*p)(\d+)$", 2).try_cast("int") + 1).cast("string"))


def block_table(cells: DataFrame, blocks: DataFrame, offsets: dict, left_classes: dict,
                right_classes: dict, metrics: dict, year_pattern: str = r"(\d{4})",
                class_col: str = "cargo_class") -> DataFrame:
    """Values below each block header: row header + offset (per direction),
    classes from the header's page (``left_classes``: col -> class) and the
    following page (``right_classes``). ``metrics`` maps sheet prefix
    (text before ``p``) -> metric. One join of the wanted (file, sheet, row)
    positions with the cells.
    """
    dirs = F.array(*[F.struct(F.lit(k).alias("direction"), F.lit(v).alias("off"))
                     for k, v in offsets.items()])
    sides = F.array(F.struct(F.col("sheet").alias("sheet"), F.lit("L").alias("side")),
                    F.struct(_next_page(F.col("sheet")).alias("sheet"), F.lit("R").alias("side")))
    want = (blocks.select("file", "sheet", "row", "region", F.explode(dirs).alias("d"))
            .select("file", "sheet", "region", F.col("d.direction").alias("direction"),
                    (F.col("row") + F.col("d.off")).alias("row"))
            .select("file", "region", "direction", "row", F.explode(sides).alias("s"))
            .select("file", F.col("s.sheet").alias("sheet"), "row", "region", "direction",
                    F.col("s.side").alias("side")))
    cls = F.when(F.col("side") == "L", _map(left_classes)[F.col("col")]).otherwise(
        _map(right_classes)[F.col("col")])
    prefix = F.regexp_extract(F.col("sheet"), r"^(.*)p\d+$", 1)
    return (cell_values(cells).join(want, ["file", "sheet", "row"])
            .select(_year_from("file", year_pattern).alias("year"), "region", "direction",
                    cls.alias(class_col), _map(metrics)[prefix].alias("metric"), "value")
            .where(F.col(class_col).isNotNull() & F.col("value").isNotNull()))


def labeled_rows(cells: DataFrame, sheets: dict, first_row: int, end_row: int,
                 value_cols: dict, year_pattern: str = r"(\d{4})", label_col: int = 0,
                 label: str = "region", key: str = "displacement_type") -> DataFrame:
    """Rows [first_row, end_row) of the given sheets (sheet -> metric): the
    row label (normalized; TOTAL rows skipped) and one value per
    ``value_cols`` column (column -> key label)."""
    c = cells.where(F.col("sheet").isin(*sheets) & (F.col("row") >= first_row)
                    & (F.col("row") < end_row))
    labels = c.where((F.col("col") == label_col) & F.col("text").isNotNull()).select(
        "file", "sheet", "row", normalize_label(F.col("text")).alias(label)).where(
        F.col(label).isNotNull())
    vals = cell_values(c.where(F.col("col").isin(*value_cols)))
    return vals.join(labels, ["file", "sheet", "row"]).where(F.col("value").isNotNull()).select(
        _year_from("file", year_pattern).alias("year"), label,
        _map(value_cols)[F.col("col")].alias(key), _map(sheets)[F.col("sheet")].alias("metric"),
        "value")


def sectioned_rows(cells: DataFrame, sheets: dict, sections: dict, band_cols: dict,
                   y_min: int, y_max: int, year_col: int = 0) -> DataFrame:
    """Rows grouped in sections (name -> [start, end) rows) with a numeric
    year in ``year_col`` and one value per band column."""
    sec = None
    for name, (a, b) in sections.items():
        cond = (F.col("row") >= a) & (F.col("row") < b)
        sec = F.when(cond, F.lit(name)) if sec is None else sec.when(cond, F.lit(name))
    c = cells.where(F.col("sheet").isin(*sheets)).withColumn("section", sec).where(
        F.col("section").isNotNull())
    years = c.where((F.col("col") == year_col) & F.col("num").isNotNull()).select(
        "file", "sheet", "row", F.col("num").try_cast("int").alias("year")).where(
        F.col("year").between(y_min, y_max))
    vals = c.where(F.col("col").isin(*band_cols)).select(
        "file", "sheet", "row", "col", "section", clean_cell("num", "text").alias("value"))
    return vals.join(years, ["file", "sheet", "row"]).where(F.col("value").isNotNull()).select(
        "year", _map(band_cols)[F.col("col")].alias("distance_band"),
        F.col("section").alias("service_type"), _map(sheets)[F.col("sheet")].alias("metric"),
        "value")
