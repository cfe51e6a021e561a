"""Stored tables that later jobs read without repeating work: counts taken
while writing, bucketed tables that join without an exchange, and re-runs of
single periods."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def write_counted(raw: DataFrame, clean: Callable[[DataFrame], DataFrame],
                  path: str) -> dict[str, int]:
    """Write ``clean(raw)`` as Parquet to ``path`` (overwritten) and return
    {"raw": rows read, "clean": rows written}, counted by the job that writes:
    one scan, no further job."""
    before, after = Observation("raw"), Observation("clean")
    n = F.count(F.lit(1)).alias("n")
    clean(raw.observe(before, n)).observe(after, n).write.mode("overwrite").parquet(path)
    return {"raw": before.get["n"], "clean": after.get["n"]}


def save_bucketed(df: DataFrame, name: str, keys, buckets: int, path: str) -> None:
    """Save a table of the session's catalog, its files at ``path``, bucketed
    and sorted by ``keys``. Tables of equal keys and ``buckets`` join and group
    on them without an exchange. Rows are dealt to the buckets first, so each
    bucket is one sorted file."""
    keys = list(keys)
    (df.repartition(buckets, *keys).write.mode("overwrite").format("parquet")
     .option("path", path).bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(name))


def replace_periods(df: DataFrame, path: str, by) -> None:
    """Write ``df`` partitioned by ``by`` into ``path``: the partitions that it
    holds are replaced, the files of all others stay as they are. The same
    frame again gives the same table."""
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*by).parquet(path))


def read_periods(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    """The whole partitioned table, with the columns of ``like``."""
    return spark.read.schema(like.schema).parquet(path).select(*like.columns)
