"""Directed-flow metrics of an origin-destination panel.

Input: a long panel (year, origin, destination, metric, value). All
operators are generic over the column names; defaults follow the corridors
table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from odpanel.functions import safe_div

# Metric names of the corridors panel used by the flow metrics.
OPS_TOTAL = "transport_operations_total"
OPS_EMPTY = "transport_operations_empty"
TONNES = "tonnes_thousands"


def wide_flows(df: DataFrame, year: str = "year", origin: str = "origin_region",
               dest: str = "destination_region", metric: str = "metric", value: str = "value",
               metrics: dict | None = None) -> DataFrame:
    """Long -> wide: one row per (year, origin, destination) with one column
    per listed metric; other metrics are ignored (a key having only those
    still yields an all-NULL row).

    Conditional ``max`` per metric with an explicit value list: one
    partially-aggregated shuffle, no distinct-values job, order independent
    even on duplicate keys.
    """
    metrics = metrics or {"ops_total": OPS_TOTAL, "ops_empty": OPS_EMPTY, "tonnes": TONNES}
    return df.groupBy(F.col(year).alias("year"), F.col(origin).alias("origin"),
                      F.col(dest).alias("destination")).agg(
        *[F.max(F.when(F.col(metric) == m, F.col(value))).alias(out)
          for out, m in metrics.items()])


def with_reverse(wide: DataFrame, col: str = "tonnes", out: str = "tonnes_rev") -> DataFrame:
    """Attach the value of the opposite direction (same year) to each row.

    Instead of a self-join, rows are grouped by the unordered pair
    (year, least, greatest): each window partition holds at most the two
    directions, so it cannot skew, and the whole step is one shuffle of the
    wide table. A missing opposite row gives NULL.
    """
    lo, hi = F.least("origin", "destination"), F.greatest("origin", "destination")
    w = Window.partitionBy("year", lo, hi)
    from_lo = F.max(F.when(F.col("origin") == lo, F.col(col))).over(w)
    from_hi = F.max(F.when(F.col("origin") == hi, F.col(col))).over(w)
    has_lo = F.max(F.when(F.col("origin") == lo, F.lit(1))).over(w)
    has_hi = F.max(F.when(F.col("origin") == hi, F.lit(1))).over(w)
    rev = F.when(F.col("origin") == lo, F.when(has_hi == 1, from_hi)).otherwise(
        F.when(has_lo == 1, from_lo))
    return wide.withColumn(out, rev)


def yearly_flows(wide: DataFrame) -> DataFrame:
    """Per (year, origin, destination): asymmetry and empty rate of the year.

    asym_year = |ab - ba| / (ab + ba) with a missing reverse flow counted as
    0 and a non-positive sum giving NULL; empty_year = empty / total, NULL
    when total <= 0.
    """
    y = with_reverse(wide).withColumn("tonnes_rev", F.coalesce("tonnes_rev", F.lit(0.0)))
    both = F.col("tonnes") + F.col("tonnes_rev")
    return y.select(
        "year", "origin", "destination", "ops_total", "ops_empty", "tonnes", "tonnes_rev",
        F.when(both > 0, safe_div(F.abs(F.col("tonnes") - F.col("tonnes_rev")), both))
         .alias("asym_year"),
        safe_div("ops_empty", "ops_total", positive_only=True).alias("empty_year"))


def yearly_flows_canonical(df: DataFrame, year: str = "year", origin: str = "origin_region",
                           dest: str = "destination_region", metric: str = "metric",
                           value: str = "value") -> DataFrame:
    """``yearly_flows(wide_flows(df))`` in one shuffle.

    Rows are grouped by the unordered pair (year, least, greatest); one
    partially-aggregated pass pivots the metrics of both directions, then
    each existing direction is emitted as a row carrying the other
    direction's tonnes. A self-loop is emitted once, as its own reverse.
    """
    o, d = F.col(origin), F.col(dest)
    lo, hi = F.least(o, d), F.greatest(o, d)
    names = {"ops_total": OPS_TOTAL, "ops_empty": OPS_EMPTY, "tonnes": TONNES}

    def pick(side, m):
        return F.max(F.when(side & (F.col(metric) == m), F.col(value)))
    fwd, rev = o == lo, o == hi
    g = df.groupBy(F.col(year).alias("year"), lo.alias("_lo"), hi.alias("_hi")).agg(
        *[pick(fwd, m).alias(f"f_{k}") for k, m in names.items()],
        *[pick(rev, m).alias(f"r_{k}") for k, m in names.items()],
        F.max(F.when(fwd, F.lit(1))).alias("has_f"), F.max(F.when(rev, F.lit(1))).alias("has_r"))

    def side(a, b, mine, other, keep):
        return F.struct(F.col(a).alias("origin"), F.col(b).alias("destination"),
                        *[F.col(f"{mine}_{k}").alias(k) for k in names],
                        F.col(f"{other}_tonnes").alias("tonnes_rev"), keep.alias("keep"))
    rows = F.array(side("_lo", "_hi", "f", "r", F.col("has_f") == 1),
                   side("_hi", "_lo", "r", "f", (F.col("has_r") == 1) & (F.col("_lo") != F.col("_hi"))))
    y = (g.select("year", F.inline(rows)).where("keep")
         .withColumn("tonnes_rev", F.coalesce("tonnes_rev", F.lit(0.0))))
    both = F.col("tonnes") + F.col("tonnes_rev")
    return y.select(
        "year", "origin", "destination", "ops_total", "ops_empty", "tonnes", "tonnes_rev",
        F.when(both > 0, safe_div(F.abs(F.col("tonnes") - F.col("tonnes_rev")), both))
         .alias("asym_year"),
        safe_div("ops_empty", "ops_total", positive_only=True).alias("empty_year"))


def pair_metrics(corridors: DataFrame, **cols) -> DataFrame:
    """(origin, destination, asymmetry, empty_rate, instability).

    Means of the yearly ratios (NULL years skipped) and the coefficient of
    variation of yearly tonnes (sample stddev; one year gives NULL), in one
    aggregate over the one-shuffle canonical-pair yearly rows: two shuffles
    in all, both partially aggregated.
    """
    y = yearly_flows_canonical(corridors, **cols)
    return y.groupBy("origin", "destination").agg(
        F.avg("asym_year").alias("asymmetry"),
        F.avg("empty_year").alias("empty_rate"),
        safe_div(F.stddev_samp("tonnes"), F.avg("tonnes")).alias("instability"))


def positive_flows(cargo: DataFrame, direction: str = "expedido",
                   metric: str = "tonnes_thousands") -> DataFrame:
    """(year, region, cargo_class, tonnes) of one direction, value > 0."""
    return cargo.where((F.col("direction") == direction) & (F.col("metric") == metric)
                       & (F.col("value") > 0)).select(
        "year", "region", "cargo_class", F.col("value").alias("tonnes"))


def salts_of(spark) -> int:
    """As many salts as the session has shuffle partitions."""
    return max(2, int(spark.conf.get("spark.sql.shuffle.partitions")))


def with_group_total(df: DataFrame, keys, value: str, out: str = "total",
                     salts: int | None = None) -> DataFrame:
    """Attach the per-key total of ``value`` to every row, skew-safe.

    The totals are a partially-aggregated group-by (one row per key). Joining
    them back is salted (see ``salted_lookup``) and the totals are replicated once per salt, so a
    key holding a third of all rows is spread over ``salts`` join tasks.
    Every row matches exactly one replica, so the result is the same whatever
    the salt (also on task retries). AQE still broadcasts small totals. AQE's
    own skew split cannot help here: it only splits joins whose inputs are
    both plain shuffles, and the totals side is an aggregate.
    """
    keys = list(keys)
    tot = df.groupBy(*keys).agg(F.sum(value).alias(out))
    return salted_lookup(df, tot, keys, salts=salts)


def salted_lookup(detail: DataFrame, lookup: DataFrame, keys, how: str = "inner",
                  salts: int | None = None) -> DataFrame:
    """Join a detail table to a lookup with (at most) one row per key,
    spreading each key's detail rows over ``salts`` join tasks.

    Detail rows get a salt from the number of their partition and a hash of
    the row, so equal rows of different partitions part as well, and a task
    that runs again deals its rows out as before (a row counter would not,
    after a shuffle). The lookup is replicated once per salt (default: one
    for each shuffle partition). Each detail row meets exactly one
    replica, so inner and left joins return exactly the unsalted result.
    """
    keys = list(keys)
    salts = salts or salts_of(detail.sparkSession)
    rep = lookup.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    salted = detail.withColumn(
        "_salt", F.pmod(
            F.xxhash64(F.spark_partition_id(), *detail.columns), F.lit(salts)).cast("int"))
    return salted.join(rep, keys + ["_salt"], how).drop("_salt")


def cargo_shares(cargo: DataFrame, direction: str = "expedido",
                 metric: str = "tonnes_thousands") -> DataFrame:
    """Each class's share of its (year, region) total (salted join back to
    the totals, see ``with_group_total``)."""
    t = positive_flows(cargo, direction, metric)
    return with_group_total(t, ["year", "region"], "tonnes").select(
        "year", "region", "cargo_class", "tonnes", "total",
        safe_div("tonnes", "total").alias("share"))


def hhi_by_origin(cargo: DataFrame, direction: str = "expedido",
                  metric: str = "tonnes_thousands") -> DataFrame:
    """Herfindahl-Hirschman index of each region's class mix, averaged over
    years: (region, concentration).

    HHI = sum(share^2) = sum(v^2) / sum(v)^2, so each (year, region) needs one
    pass and no join back to its total.
    """
    t = positive_flows(cargo, direction, metric)
    per_year = t.groupBy("year", "region").agg(
        safe_div(F.sum(F.col("tonnes") * F.col("tonnes")),
                 F.pow(F.sum("tonnes"), 2)).alias("hhi_year"))
    return per_year.groupBy("region").agg(F.avg("hhi_year").alias("concentration"))


def corridor_scores(corridors: DataFrame, cargo: DataFrame) -> DataFrame:
    """Pair metrics with the origin's concentration (left join on origin)."""
    pm = pair_metrics(corridors)
    h = hhi_by_origin(cargo)
    return pm.join(h, pm.origin == h.region, "left").drop("region")
