"""Scans of the driver's parquet tables (catalog-table scan re-aimed).

Only the listed columns are read: the projection reaches the parquet scan's
``ReadSchema``; filters written later on these frames are pushed into it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations"]


def read_table(spark: SparkSession, sf_dir: str, name: str, columns=None) -> DataFrame:
    """Parquet scan of a source table; known tables are read with their
    declared schema (no inference job), others with the footer schema."""
    from odpanel.schemas import SOURCE_TABLES
    r = spark.read
    if name in SOURCE_TABLES:
        r = r.schema(SOURCE_TABLES[name])
    df = r.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.select(*columns) if columns else df


def scan_table(spark: SparkSession, name_or_path: str) -> DataFrame:
    """``spark.table`` for catalog names, parquet for paths."""
    if "/" in name_or_path:
        return spark.read.parquet(name_or_path)
    return spark.table(name_or_path)


def conf_or_default(spark: SparkSession, key: str, default: str) -> str:
    """A source location taken from the session conf, with a default."""
    return spark.conf.get(key, default)


def checked_broadcast(df: DataFrame, max_rows: int) -> tuple[DataFrame, int]:
    """(frame, rows seen): broadcast hint only after checking the row count
    against a bound.

    The check is a bounded job (``limit(max_rows + 1).count()``); beyond the
    bound the frame is returned unhinted and the join shuffles (or AQE still
    broadcasts it if its materialized size turns out small).
    """
    n = df.limit(max_rows + 1).count()
    return (F.broadcast(df) if n <= max_rows else df), n


def broadcast_if_small(df: DataFrame, max_rows: int) -> DataFrame:
    return checked_broadcast(df, max_rows)[0]
