"""Corridor inefficiency ranking.

Four structural metrics per directed pair, each min-max normalized, summed
into a composite in [0, 4] (a NULL component counts 0), sorted descending
with (origin, destination) as tie-break.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from odpanel.operators.flows import corridor_scores
from odpanel.operators.normalize import composite, min_max

METRICS = ["asymmetry", "empty_rate", "instability", "concentration"]
RANKING_COLUMNS = ["origin", "destination", *METRICS, *[m + "_n" for m in METRICS], "composite"]


def corridor_ranking(corridors: DataFrame, cargo: DataFrame, materialize: bool = True) -> DataFrame:
    """``materialize``: checkpoint the per-pair scores (one row per directed
    pair, bounded by regions squared) so the bounds aggregate and the final
    projection read them instead of recomputing the pair metrics."""
    scored = corridor_scores(corridors, cargo)
    if materialize:
        from odpanel.session import ensure_checkpoint_dir
        ensure_checkpoint_dir(scored.sparkSession)
        scored = scored.checkpoint(eager=True)
    normed = min_max(scored, METRICS)
    return (normed.withColumn("composite", composite([m + "_n" for m in METRICS]))
            .select(*RANKING_COLUMNS)
            .orderBy(F.desc("composite"), "origin", "destination"))


TOP_SQL = ("SELECT origin, destination, round(composite, 3) AS score FROM {ranking} "
           "ORDER BY composite DESC, origin, destination LIMIT {k}")


def top_corridors(spark: SparkSession, ranking: DataFrame, k: int = 20) -> DataFrame:
    """The top-k report, as SQL over the ranking (a DataFrame parameter)."""
    return spark.sql(TOP_SQL.format(ranking="{ranking}", k=int(k)), ranking=ranking)
