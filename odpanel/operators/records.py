"""Fixed-line text records: one value per line, identified by line number.

Each record file is decoded (Latin-1), split into lines and the wanted lines
are picked by position, all in built-in expressions over the binary column;
records are independent, so the work is split across files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from odpanel.functions import literal_date, literal_number, literal_text
from odpanel.schemas import COST

# 1-based line number of each field in a cost-model record.
RECORD_LINES = {
    "vehicle_type": 129,
    "km_anual": 135,
    "pct_carga": 136,
    "horas_anuales": 137,
    "personal_conduccion_eur": 177,
    "dietas_conductor_eur": 182,
    "seguros_eur": 192,
    "costes_fiscales_eur": 202,
    "fuel_price_per_litre": 206,
    "fuel_consumption_coeff": 207,
    "peajes_eur": 229,
    "urea_eur": 235,
    "costes_indirectos_eur": 240,
    "period": 256,
    # inputs of the vehicle financing formulas
    "vehicle_price_eur": 142,
    "semitrailer_price_eur": 159,
    "interest_rate_pct": 148,
}
MIN_LINES = 256
TEXT_FIELDS = {"vehicle_type"}
DATE_FIELDS = {"period"}
OUTPUT_ORDER = COST.fieldNames()


def _field_parser(lines: dict):
    def raw_line(name):
        return F.try_element_at(F.col("lines"), F.lit(lines[name]))

    def field(name, raw=False):
        r = raw_line(name)
        if raw or name in TEXT_FIELDS:
            return r if raw else literal_text(r)
        if name in DATE_FIELDS:
            return literal_date(r)
        return literal_number(r)
    return field


def record_quality(files: DataFrame, lines: dict | None = None,
                   min_lines: int = MIN_LINES) -> DataFrame:
    """One row: ``files`` read, ``short_records`` dropped for having fewer
    than ``min_lines`` lines, and ``bad_fields``: numeric or date lines of
    complete records that are present but do not parse (NULL in the
    extraction instead of failing the job). One global aggregate."""
    lines = lines or RECORD_LINES
    field = _field_parser(lines)
    complete = F.size("lines") >= min_lines
    bad = F.lit(0)
    for n in lines:
        if n not in TEXT_FIELDS:
            bad = bad + (complete & field(n, raw=True).isNotNull() & field(n).isNull()).cast("int")
    return record_lines(files).agg(
        F.count(F.lit(1)).alias("files"), F.count_if(~complete).alias("short_records"),
        F.coalesce(F.sum(bad), F.lit(0)).cast("long").alias("bad_fields"))


def record_lines(df: DataFrame, content: str = "content", charset: str = "ISO-8859-1") -> DataFrame:
    """Add ``lines``: the decoded content split on any line ending; a final
    line ending does not begin one more line."""
    lines = F.split(F.decode(F.col(content), charset), r"\r\n|\n|\r")
    return df.withColumn("lines", lines).withColumn("lines", F.when(
        F.element_at("lines", -1) == "", F.slice("lines", 1, F.size("lines") - 1))
        .otherwise(F.col("lines")))


def extract_records(files: DataFrame, lines: dict | None = None,
                    min_lines: int = MIN_LINES) -> DataFrame:
    """(path, content) record files -> one typed row per complete record.

    Records shorter than ``min_lines`` are dropped. Text fields lose their
    quotes, ``#date#`` fields become dates, the rest are parsed as doubles
    (NULL when they do not parse). Derived measures: km in load =
    km * load% / 100 and fuel cost = price per litre * coefficient * km.
    Sorted by period. Fields that do not parse are NULL here and counted by
    ``record_quality``.
    """
    lines = lines or RECORD_LINES
    field = _field_parser(lines)
    x = record_lines(files).where(F.size("lines") >= min_lines)

    rec = x.select(*[field(n).alias(n) for n in lines])
    rec = rec.withColumns({
        "km_en_carga": F.col("km_anual") * F.col("pct_carga") / 100.0,
        "combustible_eur": F.col("fuel_price_per_litre") * F.col("fuel_consumption_coeff")
        * F.col("km_anual"),
    })
    return rec.select(*OUTPUT_ORDER).orderBy("period")
