"""Quarterly index numbers: cost per unit, rebasing, margin pressure.

Base values are computed inside the plan (scalar subquery or grouped base
joined back); a period without a base gives NULL indices instead of an
error.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from odpanel.functions import null_strict_sum, safe_div
from odpanel.operators.cleaning import YEAR_MAX, YEAR_MIN
from odpanel.schemas import COST_COLUMNS

BASE_YEAR = YEAR_MIN
# Fuel price above which a quarter is flagged as a fuel shock (derived panel).
SHOCK_THRESHOLD = 0.0401


def quarter_label(d) -> "F.Column":
    """``Qn`` of a date/timestamp column."""
    return F.concat(F.lit("Q"), F.quarter(d).cast("string"))


def period_split(df: DataFrame, period: str = "period") -> DataFrame:
    """Add integer ``year`` and ``Qn`` ``quarter`` derived from the period."""
    return df.withColumns({"year": F.year(period), "quarter": quarter_label(F.col(period))})


def cost_per_unit(cost: DataFrame, cost_cols=COST_COLUMNS, unit: str = "km_anual",
                  period: str = "period") -> DataFrame:
    """(year, quarter, total_cost_eur, km_anual, cost_per_km).

    The total is null-strict: one missing cost column makes it NULL. A zero
    unit count gives a NULL ratio.
    """
    return cost.select(
        F.year(period).alias("year"), quarter_label(F.col(period)).alias("quarter"),
        null_strict_sum(cost_cols).alias("total_cost_eur"), F.col(unit).alias(unit),
        safe_div(null_strict_sum(cost_cols), F.col(unit)).alias("cost_per_km"))


def derived_cost(cost: DataFrame) -> DataFrame:
    """Derived record measures: km in load = km * load% / 100, fuel cost =
    price per litre * consumption coefficient * km."""
    return cost.select(
        "period",
        (F.col("km_anual") * F.col("pct_carga") / 100).alias("km_en_carga"),
        (F.col("fuel_price_per_litre") * F.col("fuel_consumption_coeff") * F.col("km_anual"))
        .alias("combustible_eur"))


def rebase_cost(cost: DataFrame, base_year: int = BASE_YEAR) -> DataFrame:
    """(year, quarter, cost_per_km, cost_idx): cost per km over the mean of
    the base year's quarterly values, times 100 (NULL when there is none)."""
    c = cost_per_unit(cost)
    base = c.select(F.avg(F.when(F.col("year") == base_year, F.col("cost_per_km")))).scalar()
    return c.select("year", "quarter", "cost_per_km",
                    (safe_div(F.col("cost_per_km"), base) * 100).alias("cost_idx"))


def rebase_price(price: DataFrame, base_year: int = BASE_YEAR, band: str = "distance_band",
                 value: str = "price_index") -> DataFrame:
    """(year, quarter, band, price_idx): each band over its base-year mean.

    Bands without base-year values are dropped (inner join). The base table
    has one row per band; AQE broadcasts it once its size is known.
    """
    base = (price.where(F.col("year") == base_year).groupBy(band)
            .agg(F.avg(value).alias("price_base")))
    return price.join(base, band).select(
        "year", "quarter", band, (safe_div(F.col(value), F.col("price_base")) * 100)
        .alias("price_idx"))


def margin_index(price: DataFrame, cost: DataFrame, base_year: int = BASE_YEAR,
                 lo: int = YEAR_MIN, hi: int = YEAR_MAX, gaps: str = "keep") -> DataFrame:
    """Margin pressure index per (year, quarter, band) = price_idx / cost_idx * 100.

    ``gaps="keep"``: left join, a quarter without cost stays with NULL
    cost_idx and mpi. ``gaps="drop"``: inner join and NULL mpi removed.
    The cost side has one row per quarter; AQE turns the join into a
    broadcast hash join from the measured size, so the price side is never
    shuffled for it.
    """
    p = rebase_price(price, base_year)
    c = rebase_cost(cost, base_year).select("year", "quarter", "cost_idx")
    how = "left" if gaps == "keep" else "inner"
    m = p.join(c, ["year", "quarter"], how).withColumn(
        "mpi", safe_div(F.col("price_idx"), F.col("cost_idx")) * 100)
    if gaps != "keep":
        m = m.where(F.col("mpi").isNotNull())
    return (m.where(F.col("year").between(lo, hi))
            .select("year", "quarter", "distance_band", "price_idx", "cost_idx", "mpi")
            .orderBy("distance_band", "year", "quarter"))


def margin_summary(mpi: DataFrame, digits: int = 2) -> DataFrame:
    """Per band: rounded mean, min and max of the index, sorted by the mean."""
    return (mpi.groupBy("distance_band").agg(
        F.round(F.avg("mpi"), digits).alias("avg_mpi"),
        F.round(F.min("mpi"), digits).alias("min_mpi"),
        F.round(F.max("mpi"), digits).alias("max_mpi"))
        .orderBy("avg_mpi", "distance_band"))


def shock_flag(cost: DataFrame, threshold: float = SHOCK_THRESHOLD,
               col: str = "fuel_price_per_litre") -> DataFrame:
    """Cost rows with year, quarter and a boolean ``fuel_shock`` (> threshold)."""
    return period_split(cost).withColumn("fuel_shock", F.col(col) > F.lit(threshold))


def shock_counts(enriched: DataFrame) -> DataFrame:
    return enriched.groupBy("fuel_shock").agg(F.count(F.lit(1)).alias("count"))
