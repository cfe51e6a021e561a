"""Shared helpers: stored tables, Arrow batch slicing, salted ordinals."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from odpanel.session import shared_dir

SLICE_BYTES = 4 << 20  # texts handled at once inside a task


def stored(spark: SparkSession, df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` to a fresh Parquet table in the shared folder and read it
    back: the lineage ends there and every later use reads the same rows."""
    path = shared_dir(spark, tag)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def byte_slices(batch: pa.RecordBatch, column: str,
                limit: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Cut an Arrow batch into runs of rows with about ``limit`` bytes in
    ``column`` (one row at least); yields the run and its column as bytes
    (null: None)."""
    col = batch.column(batch.schema.get_field_index(column)).cast(pa.large_binary())
    begin, held = 0, 0
    values: list[bytes] = []
    for i in range(len(col)):
        v = col[i].as_py()
        values.append(v)
        held += len(v or b"") + 64
        if held >= limit:
            yield batch.slice(begin, i + 1 - begin), values
            begin, held, values = i + 1, 0, []
    if values:
        yield batch.slice(begin), values


def ordinals(df: DataFrame, key: str, order: list[Column], salt_on: Column, salts: int,
             name: str) -> DataFrame:
    """Add a gapless number from 0 within each ``key``.

    A key's rows are split by ``salts`` hash salts and numbered inside each
    (key, salt) by ``order``; the salts' counts, summed before the shuffle,
    give each salt its offset. No task holds a whole key."""
    s, off = f"{name}__salt", f"{name}__off"
    df = df.withColumn(s, F.pmod(salt_on, F.lit(salts)).cast("int"))
    counts = df.groupBy(key, s).agg(F.count(F.lit(1)).alias(off))
    w = Window.partitionBy(key).orderBy(s)
    offsets = counts.withColumn(off, F.sum(off).over(w) - F.col(off))
    numbered = df.withColumn(
        name, F.row_number().over(Window.partitionBy(key, s).orderBy(*order)) - 1)
    return (numbered.join(offsets, [key, s])
            .withColumn(name, (F.col(name) + F.col(off)).cast("long"))
            .drop(s, off))


def salts_for(rows: int, per_task: int = 100_000, least: int = 16) -> int:
    """Salts so that a (key, salt) holds about ``per_task`` rows even where
    one key holds all of them."""
    return max(least, -(-rows // per_task))
