"""Dataset profiling in few passes.

The per-column statistics are computed on a "long" view of the table: each
row is exploded in-task into one (column, value) record per profiled column,
then grouped by column. The partial aggregate leaves at most one record per
column per task before the shuffle, so a table of any size (or any skew)
profiles with one small shuffle instead of one job per column and statistic.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from odpanel.functions import blank_or_null, exact_mean


def present(df: DataFrame, cols) -> list:
    """The listed columns that the frame actually has (optional columns)."""
    return [c for c in cols if c in df.columns]


def long_view(df: DataFrame, cols=None, blanks=("", "..")) -> DataFrame:
    """(column_name, value_text, value_num, blank) per row and column;
    ``blanks`` are the texts that count as blank in string columns."""
    cols = present(df, cols) if cols else df.columns
    types = {f.name: f.dataType for f in df.schema.fields}
    recs = [F.struct(
        F.lit(c).alias("column_name"),
        F.col(c).cast("string").alias("value_text"),
        (F.col(c).cast("double") if isinstance(types[c], NumericType)
         else F.lit(None).cast("double")).alias("value_num"),
        blank_or_null(c, types[c], blanks).alias("blank")) for c in cols]
    return df.select(F.inline(F.array(*recs)))


def long_views(tables: dict, cols: dict | None = None, blanks: dict | None = None) -> DataFrame:
    """Long views of several tables in one frame, with a ``dataset`` column:
    profiling many tables then costs one shuffle per statistic, not one per
    table. ``blanks`` maps dataset -> blank texts (default ``""``, ``".."``)."""
    cols, blanks = cols or {}, blanks or {}
    return union_all(long_view(df, cols.get(name), blanks.get(name, ("", "..")))
                     .select(F.lit(name).alias("dataset"), "*")
                     for name, df in tables.items())


KEYS = ["dataset", "column_name"]


def profile_tables(tables: dict, cols: dict | None = None,
                   blanks: dict | None = None) -> DataFrame:
    """Column profile of several tables at once: (dataset, column_name,
    n_rows, n_null, n_distinct, min_v, max_v, avg_v).

    One long view, aggregated to its different values with their counts and
    those to the columns: NULL counts as one more value, and the mean is that
    of the values weighted by their counts."""
    values = long_views(tables, cols, blanks).groupBy(*KEYS, "value_text").agg(
        F.count(F.lit(1)).alias("n"), F.max("blank").alias("blank"),
        F.max("value_num").alias("v"))
    return values.groupBy(*KEYS).agg(
        F.sum("n").alias("n_rows"),
        F.sum(F.when(F.col("blank"), F.col("n")).otherwise(0)).alias("n_null"),
        F.count(F.lit(1)).alias("n_distinct"), F.min("v").alias("min_v"),
        F.max("v").alias("max_v"),
        exact_mean("v", "n").alias("avg_v"))


def profile(df: DataFrame, cols=None) -> DataFrame:
    """``profile_tables`` of one table."""
    return profile_tables({"": df}, {"": cols}).drop("dataset")


def describe_values(values: DataFrame, keys, value: str = "v", accuracy: int = 10000) -> DataFrame:
    """Mean, approximate median and mode of ``value`` per key group.

    Mean and median come from one aggregate (the median is a quantile
    sketch, so a large group never sits in one task's memory); the mode from
    counts per (key, value), combined map-side, then ``min_by`` over
    (-count, is-null, value): the most frequent value, ties to the
    smallest, NULL last.
    """
    keys = list(keys)
    mm = values.groupBy(*keys).agg(
        exact_mean(value).alias("mean"),
        F.percentile_approx(value, 0.5, accuracy).cast("double").alias("median"))
    counts = values.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("n"))
    mode = counts.groupBy(*keys).agg(
        F.min_by(value, F.struct(-F.col("n"), F.col(value).isNull(), F.col(value)))
        .cast("double").alias("mode"))
    return mm.join(mode, keys).select(*keys, "mean", "median", "mode")


def value_counts(tables: dict, columns) -> DataFrame:
    """Frequencies (dataset, column_name, value, count) of the listed
    (dataset, column) pairs, in one aggregate; sorted by dataset, count
    descending, value."""
    vals = union_all(tables[ds].select(F.lit(ds).alias("dataset"),
                                       F.lit(c).alias("column_name"),
                                       F.col(c).cast("string").alias("value"))
                     for ds, c in columns)
    return vals.groupBy(*KEYS, "value").agg(F.count(F.lit(1)).alias("count")).orderBy(
        "dataset", F.desc("count"), F.asc_nulls_last("value"))


def year_counts(df: DataFrame, col: str = "period") -> DataFrame:
    """Row count per 4-character year prefix, sorted by the prefix."""
    return (df.groupBy(F.substring(F.col(col).cast("string"), 1, 4).alias("year"))
            .agg(F.count(F.lit(1)).alias("count")).orderBy("year"))


def distinct_values(tables: dict, cols: dict) -> DataFrame:
    """(dataset, column_name, value) distinct pairs of several columns in one
    shuffle, values as text, NULL kept as a value."""
    return long_views(tables, cols).select(
        *KEYS, F.col("value_text").alias("value")).distinct()


def profile_nulls(tables: dict, cols: dict | None = None,
                  blanks: dict | None = None) -> DataFrame:
    """(dataset, column_name, n_null): NULL, or a blank text for strings."""
    return long_views(tables, cols, blanks).groupBy(*KEYS).agg(
        F.count_if("blank").alias("n_null"))


def profile_distinct(tables: dict, cols: dict | None = None, approx: bool = False) -> DataFrame:
    """(dataset, column_name, n_distinct) with NULL counted as one more value.

    Exact: distinct (column, value) pairs, then a count per column (both
    steps aggregate map-side). ``approx=True`` uses HyperLogLog++ sketches,
    one aggregate, for very wide or very large tables.
    """
    lv = long_views(tables, cols)
    if approx:
        return lv.groupBy(*KEYS).agg(
            (F.approx_count_distinct("value_text")
             + F.max(F.col("value_text").isNull().cast("int"))).alias("n_distinct"))
    return (lv.select(*KEYS, "value_text").distinct()
            .groupBy(*KEYS).agg(F.count(F.lit(1)).alias("n_distinct")))


def profile_numeric(tables: dict, cols: dict) -> DataFrame:
    """(dataset, column_name, min_v, max_v, avg_v) of numeric columns."""
    return long_views(tables, cols).groupBy(*KEYS).agg(
        F.min("value_num").alias("min_v"), F.max("value_num").alias("max_v"),
        exact_mean("value_num").alias("avg_v"))


def describe_column(df: DataFrame, col: str, accuracy: int = 10000) -> DataFrame:
    """One row: mean, approximate median and mode of a numeric column.

    Median: ``percentile_approx`` (a sketch; returns an actual element, e.g.
    2.0 for 1,2,3,4). Mode: the most frequent value, ties to the smallest,
    NULL allowed to win; counts are map-side combined and only one row per
    distinct value reaches the final ``min_by``.
    """
    counts = df.groupBy(F.col(col).alias("v")).agg(F.count(F.lit(1)).alias("n"))
    mode = counts.select(F.min_by("v", F.struct(-F.col("n"), F.col("v").isNull(),
                                               F.col("v"))).cast("double")).scalar()
    return df.agg(exact_mean(col).alias("mean"),
                  F.percentile_approx(col, 0.5, accuracy).cast("double").alias("median")
                  ).select("mean", "median", mode.alias("mode"))


def describe_table(spark: SparkSession, df: DataFrame) -> DataFrame:
    """(col_name, data_type, comment) of a query's output schema."""
    return spark.sql("DESCRIBE QUERY SELECT * FROM {t}", t=df)


def union_all(frames) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)
