"""Cells and records of texts as they are given: lines are rows, and the parts
of a line between separators are its columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from odpanel.functions import trim_blanks


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def line_cells(df: DataFrame, file: str | Column, sheet: str | Column, text: str | Column,
               separator: str | None = None) -> DataFrame:
    """(file, sheet, row, col, num, text): a row per non-blank cell of each
    text, rows and columns from 0, the text trimmed, ``num`` NULL.

    ``separator`` is a pattern; without one a line is a single cell. A null or
    blank text has no cells, and a repeated row of ``df`` gives its cells
    again. Row by row: nothing is shuffled."""
    line = F.col("line")
    parts = F.array(line) if separator is None else F.split(line, separator)
    lines = df.select(_c(file).cast("string").alias("file"), _c(sheet).cast("string").alias("sheet"),
                      F.posexplode(F.split(_c(text), "\n")).alias("row", "line"))
    cells = lines.select("file", "sheet", "row", F.posexplode(parts).alias("col", "part"))
    return cells.select("file", "sheet", "row", "col", F.lit(None).cast("double").alias("num"),
                        trim_blanks("part").alias("text")).where(F.col("text") != "")


def text_records(df: DataFrame, path: str | Column, text: str | Column) -> DataFrame:
    """(path, content): each text as a record file of its own, in Latin-1
    (a character that has no place in it becomes ``?``, a null text empty)."""
    known = F.regexp_replace(F.coalesce(_c(text), F.lit("")), "[^\\x00-\\xff]", "?")
    return df.select(_c(path).cast("string").alias("path"),
                     F.encode(known, "ISO-8859-1").alias("content"))
