"""Row filters that define the analytical universe of each panel.

Each cleaner is one predicate (Catalyst merges chained filters anyway), so it
is pushed down as far as the optimizer allows: into the parquet scan for
stored tables, below the unpivot and aggregates for derived panels.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from odpanel.functions import year_prefix
from odpanel.schemas import COST_DROPPED

# Default analysis window and base year of the derived panels.
YEAR_MIN, YEAR_MAX = 1995, 2000


def not_null(*cols: str) -> Column:
    return reduce(and_, [F.col(c).isNotNull() for c in cols])


def in_years(col: str = "year", lo: int = YEAR_MIN, hi: int = YEAR_MAX) -> Column:
    """Inclusive year window; NULL years fail it."""
    return F.col(col).between(lo, hi)


def corridors_ok(lo: int = YEAR_MIN, hi: int = YEAR_MAX, origin: str = "origin_region",
                 dest: str = "destination_region") -> Column:
    """Value and both endpoints present, no self-loop, year in window."""
    return (not_null("value", origin, dest) & (F.col(origin) != F.col(dest))
            & in_years("year", lo, hi))


def regional_ok(lo: int = YEAR_MIN, hi: int = YEAR_MAX) -> Column:
    return not_null("value", "region") & in_years("year", lo, hi)


def cargo_ok(lo: int = YEAR_MIN, hi: int = YEAR_MAX) -> Column:
    """Strictly positive value, region and class present (drops the TOTAL
    rows, whose region is NULL), year in window."""
    return (not_null("value", "region", "cargo_class") & (F.col("value") > 0)
            & in_years("year", lo, hi))


def price_ok(lo: int = YEAR_MIN, hi: int = YEAR_MAX) -> Column:
    return not_null("price_index") & in_years("year", lo, hi)


def bands_ok() -> Column:
    """Strictly positive value and band present. No year filter."""
    return not_null("value", "distance_band") & (F.col("value") > 0)


def cost_ok(lo: int = YEAR_MIN, hi: int = YEAR_MAX, period: str = "period") -> Column:
    """Period present and its year prefix in the window."""
    return year_prefix(period).between(lo, hi) & F.col(period).isNotNull()


def clean_corridors(df: DataFrame, lo: int = YEAR_MIN, hi: int = YEAR_MAX,
                    origin: str = "origin_region", dest: str = "destination_region") -> DataFrame:
    """Zero values stay."""
    return df.where(corridors_ok(lo, hi, origin, dest))


def clean_regional(df: DataFrame, lo: int = YEAR_MIN, hi: int = YEAR_MAX) -> DataFrame:
    """Zero values stay."""
    return df.where(regional_ok(lo, hi))


def clean_cargo(df: DataFrame, lo: int = YEAR_MIN, hi: int = YEAR_MAX) -> DataFrame:
    return df.where(cargo_ok(lo, hi))


def clean_price(df: DataFrame, lo: int = YEAR_MIN, hi: int = YEAR_MAX) -> DataFrame:
    return df.where(price_ok(lo, hi))


def clean_bands(df: DataFrame) -> DataFrame:
    return df.where(bands_ok())


def clean_cost(df: DataFrame, lo: int = YEAR_MIN, hi: int = YEAR_MAX,
               period: str = "period") -> DataFrame:
    """Drop the non-cost columns and keep periods in the window."""
    keep = [c for c in df.columns if c not in COST_DROPPED]
    return df.select(*keep).where(cost_ok(lo, hi, period))


CLEANERS = {
    "corridors": clean_corridors, "regional": clean_regional, "cargo": clean_cargo,
    "price_index": clean_price, "distance_bands": clean_bands, "cost": clean_cost,
}
PREDICATES = {
    "corridors": corridors_ok, "regional": regional_ok, "cargo": cargo_ok,
    "price_index": price_ok, "distance_bands": bands_ok, "cost": cost_ok,
}


def sort_dimensions(df: DataFrame, measures=("value", "price_index")) -> DataFrame:
    """A long table sorted on all its dimensions, in column order. Opt-in: a
    global sort is a shuffle that most consumers do not need."""
    return df.orderBy(*[c for c in df.columns if c not in measures])


def table_summary(raws: dict[str, DataFrame]) -> DataFrame:
    """Raw rows, cleaned rows and cleaned column count per dataset.

    Cleaned rows are counted as raw rows passing the cleaner's predicate, so
    all datasets are counted in one pass and one aggregate (partial counts
    per task, one row per dataset shuffled).
    """
    ncols = {name: len(CLEANERS[name](df).columns) for name, df in raws.items()}
    flags = reduce(DataFrame.unionByName, [
        df.select(F.lit(name).alias("dataset"), PREDICATES[name]().alias("ok"))
        for name, df in raws.items()])
    n = F.create_map(*[x for k, v in ncols.items() for x in (F.lit(k), F.lit(v))])
    return flags.groupBy("dataset").agg(
        F.count(F.lit(1)).alias("raw_rows"), F.count_if("ok").alias("clean_rows")).select(
        "dataset", "raw_rows", "clean_rows", n[F.col("dataset")].alias("n_columns"))
