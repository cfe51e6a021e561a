"""Data-quality checks on the panels, as Spark aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from odpanel.functions import safe_div


def taxonomy_check(df: DataFrame, expected, key: str = "year",
                   col: str = "cargo_class") -> DataFrame:
    """Per key: number of distinct classes and whether the set equals
    ``expected`` (counted, not collected: a group of any size is fine)."""
    exp = sorted(set(expected))
    return df.groupBy(key).agg(
        F.count_distinct(col).alias("n_classes"),
        F.count_distinct(F.when(F.col(col).isin(*exp), F.col(col))).alias("_n_in")).select(
        key, "n_classes",
        ((F.col("n_classes") == len(exp)) & (F.col("_n_in") == len(exp))).alias("match"))


def band_share(df: DataFrame, metric: str = "operations_total", service: str = "total",
               total_label: str = "Total") -> DataFrame:
    """Each band's share (percent) of the year's ``Total`` band.

    The totals are filtered out and joined back on year through a salted
    lookup join (a hot year is spread over many tasks; AQE still broadcasts
    small totals) instead of a window over whole years.
    """
    from odpanel.operators.flows import salted_lookup
    x = df.where((F.col("metric") == metric) & (F.col("service_type") == service))
    tot = x.where(F.col("distance_band") == total_label).select(
        "year", F.col("value").alias("total"))
    parts = x.where(F.col("distance_band") != total_label)
    return salted_lookup(parts, tot, ["year"]).select(
        "year", "distance_band", (safe_div(F.col("value"), F.col("total")) * 100).alias("share_pct"))


def density(df: DataFrame, dataset: str, key: str = "year", per: str | None = None) -> DataFrame:
    """Rows per key value (and per ``per`` value), integer division; 0 if empty."""
    n_per = F.count_distinct(per) if per else F.lit(1)
    den = F.count_distinct(key) * n_per
    n = F.count(F.lit(1))
    return df.agg(F.when(den > 0, (n - F.pmod(n, den)) / den)
                  .otherwise(F.lit(0)).cast("long").alias("density")).select(
        F.lit(dataset).alias("dataset"), "density")


def spot(df: DataFrame, **keys) -> DataFrame:
    """Rows matching all the given column values."""
    cond = None
    for k, v in keys.items():
        c = F.col(k) == F.lit(v)
        cond = c if cond is None else cond & c
    return df.where(cond)


def trend(df: DataFrame, measure: str, order: str = "period") -> DataFrame:
    """Ordered listing of one measure with the covered range (first, last)."""
    first = df.select(F.min(order)).scalar()
    last = df.select(F.max(order)).scalar()
    return df.select(order, measure, first.alias("first_" + order),
                     last.alias("last_" + order)).orderBy(order)
