"""Column normalization with bounds computed inside the plan.

Bounds are scalar subqueries: Catalyst merges the subqueries over the same
input into a single global aggregate (partial per task, one row shuffled) and
feeds its result to the projection; nothing goes through the driver and no
join is needed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def min_max(df: DataFrame, cols, suffix: str = "_n") -> DataFrame:
    """Add ``c + suffix`` = (c - min) / (max - min) for each column.

    A NULL bound counts as 0; a zero range gives 0.0 for every row (NULL
    values included); otherwise a NULL value stays NULL.
    """
    aggs = []
    for i, c in enumerate(cols):
        aggs += [F.min(F.col(c)).cast("double").alias(f"mn{i}"),
                 F.max(F.col(c)).cast("double").alias(f"mx{i}")]
    b = df.select(F.struct(*aggs)).scalar()   # all bounds: one aggregate, one subquery
    out = {}
    for i, c in enumerate(cols):
        mn = F.coalesce(b.getField(f"mn{i}"), F.lit(0.0))
        mx = F.coalesce(b.getField(f"mx{i}"), F.lit(0.0))
        rng = mx - mn
        out[c + suffix] = F.when(rng == 0, F.lit(0.0)).otherwise(
            F.try_divide(F.col(c) - mn, rng))
    return df.withColumns(out)


def z_score(df: DataFrame, cols, suffix: str = "_z") -> DataFrame:
    """Add ``c + suffix`` = (c - mean) / sample stddev; NULL when the stddev
    is 0 or undefined."""
    aggs = []
    for i, c in enumerate(cols):
        aggs += [F.avg(F.col(c)).alias(f"mu{i}"), F.stddev_samp(F.col(c)).alias(f"sd{i}")]
    b = df.select(F.struct(*aggs)).scalar()
    out = {}
    for i, c in enumerate(cols):
        out[c + suffix] = F.try_divide(F.col(c) - b.getField(f"mu{i}"), b.getField(f"sd{i}"))
    return df.withColumns(out)


def composite(cols) -> "F.Column":
    """Equal-weight sum of components, a NULL component counting 0."""
    expr = None
    for c in cols:
        term = F.coalesce(F.col(c), F.lit(0.0))
        expr = term if expr is None else expr + term
    return expr
