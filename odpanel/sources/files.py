"""File sources and sinks: CSV with explicit schema, per-year file
catalogues, parquet tables, binary record files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType


def write_csv(df: DataFrame, path: str, single_file: bool = False) -> None:
    """Overwrite ``path`` with header CSV, one file per partition.

    ``single_file=True`` coalesces to one task first: only for small results
    (it removes all write parallelism).
    """
    (df.coalesce(1) if single_file else df).write.mode("overwrite").option(
        "header", True).csv(path)


def read_csv(spark: SparkSession, path, schema: StructType | None = None,
             infer: bool = False) -> DataFrame:
    """Header CSV with an explicit schema (no inference job; unparsable
    fields become NULL). ``infer=True`` keeps the inference path as opt-in."""
    r = spark.read.option("header", True)
    if schema is not None:
        r = r.schema(schema)
    elif infer:
        r = r.option("inferSchema", True)
    return r.csv(path)


BAD_LINE = "_bad_line"


def read_csv_checked(spark: SparkSession, path, schema: StructType) -> DataFrame:
    """Header CSV with an explicit schema that keeps what does not fit: the
    schema's columns (NULL where a field does not parse), ``BAD_LINE`` (the
    whole line, if any of its fields does not parse or their number is wrong,
    else NULL) and ``file`` (its path). Every column is parsed, whichever are
    read, so a line is bad or not for all queries alike."""
    kept = StructType([*schema.fields, StructField(BAD_LINE, StringType())])
    # always true; Spark rejects queries that read the bad lines and no other column
    any_row = F.hash(*schema.names) >= F.lit(-(1 << 31))
    return (spark.read.option("header", True).option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", BAD_LINE).option("columnPruning", False)
            .schema(kept).csv(path)
            .select(*schema.names, F.when(any_row, F.col(BAD_LINE)).alias(BAD_LINE),
                    F.col("_metadata.file_path").alias("file")))


def line_quality(checked: DataFrame, by=("file",)) -> DataFrame:
    """(by, n_lines, n_bad) of a ``read_csv_checked`` frame."""
    return checked.groupBy(*by).agg(F.count(F.lit(1)).alias("n_lines"),
                                    F.count(BAD_LINE).alias("n_bad"))


def write_parquet(df: DataFrame, path: str, partition_by=None) -> None:
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def save_table(df: DataFrame, name: str) -> None:
    """Managed-table overwrite (needs a catalog with a warehouse)."""
    df.write.mode("overwrite").saveAsTable(name)


def create_database(spark: SparkSession, name: str, location: str | None = None) -> None:
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}{loc}")


def list_tables(spark: SparkSession, database: str) -> DataFrame:
    return spark.sql(f"SHOW TABLES IN {database}")


def read_by_year(spark: SparkSession, paths, schema: StructType, pattern: str,
                 year_col: str = "year") -> DataFrame:
    """Read many CSV files at once and take the year from each file's path.

    ``pattern`` is a regex whose first group is the year. One scan over all
    paths (a file catalogue instead of a loop of reads); partition discovery
    is off so directory names never become columns.
    """
    df = (spark.read.option("header", True).option("recursiveFileLookup", True)
          .schema(schema).csv(paths if isinstance(paths, list) else [paths]))
    year = F.regexp_extract(F.col("_metadata.file_path"), pattern, 1).try_cast("int")
    return df.select(year.alias(year_col), *df.columns)


# Fixed value: the name of the record file in each period's folder.
RECORD_FILE = "Articulado Carga General.obs"


def read_records(spark: SparkSession, root: str, glob: str = RECORD_FILE) -> DataFrame:
    """Binary record files of one name under ``root`` (any depth): (path,
    content)."""
    return (spark.read.format("binaryFile").option("recursiveFileLookup", True)
            .option("pathGlobFilter", glob).load(root).select("path", "content"))
