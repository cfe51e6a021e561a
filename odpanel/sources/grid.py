"""Cell grids written from the derived panels (test input for extraction).

Each builder lays a long panel out the way the source workbooks do (sheet
codes, header rows, split matrices, blocks, sections), with ``..`` for
suppressed values and a few note rows, so that the grid extractors must
recover the panel exactly. Positions are arithmetic on keys (no global
ordering step), so the builders are plain projections, distincts and unions.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from odpanel.operators.grid import _map

# Sheet codes and layout of the source workbooks.
CORRIDOR_SHEETS = {"transport_operations_total": "6.5", "transport_operations_empty": "6.6",
                   "tonnes_thousands": "6.7", "tonne_km_millions": "6.8"}
REGIONAL_SHEETS = {"operations_total": "6.1", "operations_empty": "6.2",
                   "tonnes_thousands": "6.3", "tonne_km_millions": "6.4"}
BAND_SHEETS = {"operations_total": "4.9", "operations_loaded": "4.10",
               "tonnes_thousands": "4.11", "tonne_km_millions": "4.12"}
CARGO_PREFIXES = {"operations": "7.4", "tonnes_thousands": "7.5"}
PRICE_SHEET = "2.9"
QUARTER_LABELS = {"1T": "Q1", "2T": "Q2", "3T": "Q3", "4T": "Q4"}
DISPLACEMENT_COLS = {"intrarregional_total": 1, "intramunicipal": 2,
                     "intermunicipal_intrarregional": 3, "interregional_recibido": 5,
                     "interregional_expedido": 6, "internacional_recibido": 8,
                     "internacional_expedido": 9}
SECTION_NAMES = ["total", "cuenta_ajena", "cuenta_propia"]
SECTION_FIRST_ROW, SECTION_GAP = 15, 3
MATRIX_FIRST_ROW = 17
REGIONAL_FIRST_ROW = 17
PRICE_FIRST_ROW = 23
BLOCK_FIRST_ROW = 16
BLOCK_OFFSETS = {"expedido": 7, "recibido": 8}
BLOCK_MARKER = "Total transportado"

# Parameters of the derived layout.
CARGO_LEFT_COL, CARGO_RIGHT_COL = 2, 0   # first class column of the two pages
PAGE_PAIRS = 4
BLOCK_SPACING = 10
EXCLUDED_REGIONS = ["NATION_24"]


def bands_of(panel: DataFrame) -> list[str]:
    """The distance bands of a panel: ``Total``, then by number. A sheet has a
    column for each, so their number is that of the size classes."""
    found = [r[0] for r in panel.select("distance_band").distinct().collect()]
    return sorted((b for b in found if b), key=lambda b: (b != "Total", len(b), b))


def classes_of(panel: DataFrame) -> tuple[dict, dict]:
    """Cargo class -> column on the header page and on the page after it."""
    names = sorted(r[0] for r in panel.select("cargo_class").distinct().collect() if r[0])
    half = (len(names) + 1) // 2
    return ({c: CARGO_LEFT_COL + i for i, c in enumerate(names[:half])},
            {c: CARGO_RIGHT_COL + i for i, c in enumerate(names[half:])})


def years_of(panel: DataFrame) -> tuple[int, int]:
    """First and last year of a panel; (1, 0) if it has no rows."""
    lo, hi = panel.agg(F.min("year"), F.max("year")).first()
    return (1, 0) if lo is None else (lo, hi)


def sections_of(years: tuple[int, int]) -> dict:
    """Section -> [first, end) rows: one row a year, three between sections."""
    span = years[1] - years[0] + 1
    first = [SECTION_FIRST_ROW + i * (span + SECTION_GAP) for i in range(len(SECTION_NAMES))]
    return {s: (a, a + span) for s, a in zip(SECTION_NAMES, first, strict=True)}


def editions_of(years: tuple[int, int]) -> list[tuple]:
    """(file, first year, last year, header kind) of two overlapping price
    editions that cover all years together."""
    middle = (years[0] + years[1]) // 2
    return [("prices_a", years[0], middle + 1, "num"), ("prices_b", middle, years[1], "text")]


def _cells(file, sheet, row, col, num=None, text=None):
    return [file.alias("file"), sheet.alias("sheet"), row.cast("int").alias("row"),
            col.cast("int").alias("col"),
            (num if num is not None else F.lit(None)).cast("double").alias("num"),
            (text if text is not None else F.lit(None)).cast("string").alias("text")]


def _union(frames):
    return reduce(DataFrame.unionByName, frames)


def _keys(src, name_col, key_col):
    return src.nations().select(F.col("n_name").alias(name_col), F.col("n_nationkey").alias(key_col))


def _suppressed(value):
    return F.when(F.col(value).isNull(), F.lit(".."))


def matrix_split(n: int) -> int:
    return (n + 1) // 2


def corridor_cells(src, n: int) -> DataFrame:
    """Corridor matrices per (year, metric): origins down rows 17.., the
    first half of destinations in the left sheet (cols 1..), the rest in the
    ``s`` sheet (cols 0..); origin labels in col 0."""
    split = matrix_split(n)
    x = (src.raw("corridors").join(_keys(src, "origin_region", "o_nk"), "origin_region")
         .join(_keys(src, "destination_region", "d_nk"), "destination_region"))
    left = F.col("d_nk") < split
    file = F.concat(F.lit("flows_"), F.col("year").cast("string"))
    code = _map(CORRIDOR_SHEETS)[F.col("metric")]
    vals = x.select(*_cells(file, F.concat(code, F.when(left, F.lit("")).otherwise(F.lit("s"))),
                            MATRIX_FIRST_ROW + F.col("o_nk"),
                            F.when(left, F.col("d_nk") + 1).otherwise(F.col("d_nk") - split),
                            F.col("value"), _suppressed("value")))
    labels = x.select(*_cells(file, code, MATRIX_FIRST_ROW + F.col("o_nk"), F.lit(0),
                              text=F.col("origin_region"))).distinct()
    return vals.unionByName(labels)


def price_cells(raw: DataFrame, bands: list[str], editions: list[tuple]) -> DataFrame:
    """Two editions of the price sheet: a year header row then four quarter
    rows (``1T``..``4T`` in col 1, bands from col 2 on). Edition A writes
    numeric year headers, edition B digit text; the editions overlap."""
    frames = []
    for file, base, hi, kind in editions:
        p = raw.where(F.col("year").between(base, hi))
        f, sh = F.lit(file), F.lit(PRICE_SHEET)
        hdr_row = PRICE_FIRST_ROW + (F.col("year") - base) * 5
        qn = F.substring("quarter", 2, 1).cast("int")
        hdr = p.select(*_cells(f, sh, hdr_row, F.lit(0),
                               F.col("year") if kind == "num" else None,
                               F.col("year").cast("string") if kind == "text" else None)).distinct()
        qlab = p.select(*_cells(f, sh, hdr_row + qn, F.lit(1),
                                text=F.concat(qn.cast("string"), F.lit("T")))).distinct()
        vals = p.select(*_cells(f, sh, hdr_row + qn,
                                _map({b: i + 2 for i, b in enumerate(bands)})[F.col("distance_band")],
                                F.col("price_index"), _suppressed("price_index")))
        title = hdr.select(*_cells(F.col("file"), F.col("sheet"), F.lit(0), F.lit(0),
                                   text=F.lit("Indice de precios del transporte"))).distinct()
        frames += [hdr, qlab, vals, title]
    return _union(frames)


def cargo_cells(src, n: int, left: dict, right: dict) -> DataFrame:
    """Cargo blocks: a region label, ``Total transportado`` below it, the
    expedido row at +7 and recibido at +8; the first classes on the block's
    page, the rest on the next page. TOTAL rows form one more block. Note
    rows that look like blocks but start with ``(`` or ``Fuente`` are added."""
    raw = src.raw("cargo")
    x = raw.join(_keys(src, "region", "nk"), "region", "left")
    total_rank = (n + PAGE_PAIRS - 1) // PAGE_PAIRS
    k = F.coalesce(F.col("nk") % PAGE_PAIRS, F.lit(0))
    rank = F.coalesce(F.floor(F.col("nk") / PAGE_PAIRS).cast("int"), F.lit(total_rank))
    hr = BLOCK_FIRST_ROW + BLOCK_SPACING * rank
    prefix = _map(CARGO_PREFIXES)[F.col("metric")]
    odd = F.concat(prefix, F.lit("p"), (2 * k + 1).cast("string"))
    even = F.concat(prefix, F.lit("p"), (2 * k + 2).cast("string"))
    file = F.concat(F.lit("cargo_"), F.col("year").cast("string"))
    is_left = F.col("cargo_class").isin(*left)
    both = _map({**left, **right})
    col = both[F.col("cargo_class")]
    off = _map(BLOCK_OFFSETS)[F.col("direction")]
    vals = x.select(*_cells(file, F.when(is_left, odd).otherwise(even), hr + off, col,
                            F.col("value"), _suppressed("value")))
    blocks = x.select(file.alias("f"), odd.alias("s"), hr.alias("r"),
                      F.coalesce("region", F.lit("TOTAL")).alias("label")).distinct()
    lab = [blocks.select(*_cells(F.col("f"), F.col("s"), F.col("r") + dr, F.lit(0), text=t))
           for dr, t in [(0, F.col("label")), (1, F.lit(BLOCK_MARKER)),
                         (7, F.lit("Expedido")), (8, F.lit("Recibido"))]]
    pages = blocks.select("f", "s").distinct()
    last = BLOCK_FIRST_ROW + BLOCK_SPACING * (total_rank + 1)
    notes = [pages.select(*_cells(F.col("f"), F.col("s"), F.lit(last + dr), F.lit(0), text=F.lit(t)))
             for dr, t in [(0, "Fuente: elaboracion propia"), (1, BLOCK_MARKER + " (todas)"),
                           (4, "(1) Nota metodologica"), (5, BLOCK_MARKER)]]
    return _union([vals, *lab, *notes])


def cargo_block_sheets() -> list[str]:
    return [f"{p}p{2 * k + 1}" for p in CARGO_PREFIXES.values() for k in range(PAGE_PAIRS)]


def regional_cells(src, n: int) -> DataFrame:
    """Regional sheets: one row per region (label in col 0) with the
    displacement columns, plus a TOTAL row (sum over regions) at the end."""
    raw = src.raw("regional")
    x = raw.join(_keys(src, "region", "nk"), "region")
    file = F.concat(F.lit("regional_"), F.col("year").cast("string"))
    sheet = _map(REGIONAL_SHEETS)[F.col("metric")]
    col = _map(DISPLACEMENT_COLS)[F.col("displacement_type")]
    row = REGIONAL_FIRST_ROW + F.col("nk")
    vals = x.select(*_cells(file, sheet, row, col, F.col("value"), _suppressed("value")))
    labels = x.select(*_cells(file, sheet, row, F.lit(0), text=F.col("region"))).distinct()
    tot = raw.groupBy("year", "metric", "displacement_type").agg(F.sum("value").alias("value"))
    total_row = F.lit(REGIONAL_FIRST_ROW + n)
    tvals = tot.select(*_cells(file, sheet, total_row, col, F.col("value"), _suppressed("value")))
    tlab = tot.select(*_cells(file, sheet, total_row, F.lit(0), text=F.lit("TOTAL"))).distinct()
    return _union([vals, labels, tvals, tlab])


def bands_cells(raw: DataFrame, bands: list[str], sections: dict, base_year: int) -> DataFrame:
    """Band sheets: three sections (total, cuenta ajena, cuenta propia), one
    row per year with the year number in col 0 and the bands from col 1 on,
    a section title above each."""
    start = _map({k: v[0] for k, v in sections.items()})[F.col("service_type")]
    f = F.lit("bands")
    sheet = _map(BAND_SHEETS)[F.col("metric")]
    row = start + F.col("year") - base_year
    vals = raw.select(*_cells(f, sheet, row, _map({b: i + 1 for i, b in enumerate(bands)})[F.col("distance_band")],
                              F.col("value"), _suppressed("value")))
    years = raw.select(*_cells(f, sheet, row, F.lit(0), F.col("year"))).distinct()
    titles = raw.select(*_cells(f, sheet, start - 1, F.lit(0),
                                text=F.col("service_type"))).distinct()
    return _union([vals, years, titles])
