"""Stored sketches: built once per group, merged over any set of groups.

Quantiles are KLL sketches, distinct counts HyperLogLog and Theta sketches
(set operations). A sketch has a fixed size, so a group of any size shuffles
one per task, and a stored table answers later questions without the data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from odpanel.session import shared_dir

KLL_K = 800          # rank error of one quantile: about 0.42 % at 99 % confidence
HLL_LG_K = 14        # 2^14 registers
THETA_LG_K = 14      # 2^14 entries, exact below
SIGMAS = 4           # of the standard error that a bound allows


def rank_error(k: int = KLL_K) -> float:
    """Normalized rank error of a KLL quantile at 99 % confidence: the
    published fit of the sketch library, 2.296 / k^0.9021."""
    return 2.296 / k ** 0.9021


def hll_error(lg_k: int = HLL_LG_K) -> float:
    """Relative error bound of an HLL estimate, at ``SIGMAS`` standard errors
    of 1.04 / sqrt(2^lg_k)."""
    return SIGMAS * 1.04 / 2 ** (lg_k / 2)


def theta_error(lg_k: int = THETA_LG_K) -> float:
    """Relative error bound of a Theta union estimate, at ``SIGMAS`` standard
    errors of 1 / sqrt(2^lg_k); an intersection is off by that share of the
    union at most."""
    return SIGMAS / 2 ** (lg_k / 2)


def _store(df: DataFrame, path: str | None, tag: str) -> DataFrame:
    path = path or shared_dir(df.sparkSession, tag)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def quantile_sketches(df: DataFrame, keys, value: str, path: str | None = None,
                      k: int = KLL_K) -> DataFrame:
    """Store (keys, sketch, n): a KLL sketch of the non-null values (as
    doubles) of each group that has any, at ``path`` (a fresh shared folder by
    default)."""
    v = F.col(value).cast("double")
    return _store(df.filter(v.isNotNull()).groupBy(*keys).agg(
        F.kll_sketch_agg_double(v, k).alias("sketch"), F.count(v).alias("n")), path, "kll")


def merged_quantiles(sketches: DataFrame, probabilities, keys=()) -> DataFrame:
    """(keys, n, p, quantile): quantiles over the union of the stored groups
    of ``sketches`` (filter it to the groups wanted), for each of ``keys`` if
    given. Without a stored group: no row."""
    one = sketches.groupBy(*keys).agg(F.kll_merge_agg_double("sketch").alias("sketch"),
                                      F.sum("n").alias("n")).filter(F.col("n") > 0)
    # the probability of a sketch's quantile has to be a literal
    got = F.array(*[F.struct(F.lit(float(p)).alias("p"), F.kll_sketch_get_quantile_double(
        "sketch", F.lit(float(p))).alias("quantile")) for p in probabilities])
    return one.select(*keys, "n", F.inline(got))


def distinct_sketches(df: DataFrame, keys, column: str, path: str | None = None,
                      lg_k: int = HLL_LG_K, theta_lg_k: int = THETA_LG_K) -> DataFrame:
    """Store (keys, hll, theta): both sketches of the non-null values of each
    group that has any."""
    c = F.col(column)
    return _store(df.filter(c.isNotNull()).groupBy(*keys).agg(
        F.hll_sketch_agg(c, lg_k).alias("hll"), F.theta_sketch_agg(c, theta_lg_k).alias("theta")),
        path, "distinct")


def merged_distinct(sketches: DataFrame, keys=()) -> DataFrame:
    """(keys, n_hll, n_theta): estimates of the distinct values over the union
    of the stored groups, by both sketches."""
    got = sketches.groupBy(*keys).agg(
        F.hll_sketch_estimate(F.hll_union_agg("hll")).alias("n_hll"),
        F.theta_sketch_estimate(F.theta_union_agg("theta", THETA_LG_K)).alias("n_theta"),
        F.count(F.lit(1)).alias("_groups"))
    return got.filter(F.col("_groups") > 0).drop("_groups")


def overlaps(sketches: DataFrame, key: str) -> DataFrame:
    """(a, b, n_both, n_either): estimated distinct values that two stored
    groups share, and that either holds, for each pair a < b of groups. The
    pairs are made from the list of groups (years, regions), not from data."""
    names = sketches.agg(F.sort_array(F.collect_set(key)).alias("g"))
    pairs = (names.select("g", F.explode("g").alias("a"))
             .select("a", F.explode(F.filter("g", lambda x: x > F.col("a"))).alias("b")))
    left = sketches.select(F.col(key).alias("a"), F.col("theta").alias("_a"))
    right = sketches.select(F.col(key).alias("b"), F.col("theta").alias("_b"))
    return pairs.join(left, "a").join(right, "b").select(
        "a", "b", F.theta_sketch_estimate(F.theta_intersection("_a", "_b")).alias("n_both"),
        F.theta_sketch_estimate(F.theta_union("_a", "_b", THETA_LG_K)).alias("n_either"))


def within(estimate, exact, share) -> Column:
    """Whether an estimate is within a share of the exact count (half a unit
    for rounding)."""
    exact = F.col(exact) if isinstance(exact, str) else exact
    return F.abs(F.col(estimate) - exact) <= F.lit(share) * exact + F.lit(0.5)
