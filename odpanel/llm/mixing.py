"""Mixing sources to target weights by iterative proportional fitting.

The corpus becomes a contingency table of token counts over (source,
language, topic). Raking scales the cells in turn to the target share of
each marginal until all three hold to ``TOLERANCE``, in at most ``SWEEPS``
rounds; the ratio of fitted to present tokens, scaled to the token budget and
held at 1 at most, is the sampling probability of every document of a cell. A
document is kept when a number in [0, 1) derived from its id lies below that
probability.

Targets are stated per marginal (``targets``) or, for a marginal that is not
stated, the present shares to a power (``powers``). Targets that cannot hold
together, or name values the corpus lacks, are missed by some share:
``mix_report`` gives every marginal's target, fitted and expected share, and
a miss above ``MISS`` raises a ``MixWarning``.

Counting is one partial aggregation; only the contingency table, whose size
is that of the combinations of marginal values, reaches the driver. A table
of more than ``MAX_CELLS`` cells is raked by the same sweeps as Spark
aggregations, each written to the shared folder.
"""

from __future__ import annotations

import warnings
from collections.abc import Callable
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from odpanel.llm.common import stored

DIMENSIONS = ("source", "lang", "topic")
SWEEPS = 25
TOLERANCE = 1e-12             # largest difference of a marginal share that ends the sweeps
MISS = 1e-3                   # largest difference that passes without a warning
MAX_SCALE = 40                # the scale of the budget is at most 2 to this power
MAX_CELLS = 100_000           # cells on the driver and in a broadcast: under 10 MB
BUDGET = 0.5                  # share of the tokens to keep
# a marginal's target share is its present token share to this power, rescaled
POWERS = {"source": 0.7, "lang": 0.7, "topic": 0.9}
SEED = "mix"
NONE = ""                     # the value that stands for null in a marginal


class MixWarning(UserWarning):
    """The fitted marginals miss their targets."""


def tokens(text: Column) -> Column:
    """Words between ASCII white space; null: 0."""
    return F.coalesce(F.size(F.regexp_extract_all(text, F.lit("[^\\x20\\x09-\\x0D]+"), F.lit(0))),
                      F.lit(0)).cast("long")


def topic(text: Column) -> Column:
    """The kind of text, from whole-text character counts: `table` (a bar in
    every 40 characters), `loud` (a capital A-Z in every 4), `lines` (a line
    end in every 60), else `prose`; null or empty: `none`."""
    size = F.length(text)

    def count(char: str) -> Column:
        return size - F.length(F.replace(text, F.lit(char), F.lit("")))

    capitals = F.length(F.regexp_replace(text, "[^A-Z]+", ""))
    return (F.when(F.coalesce(size, F.lit(0)) == 0, "none")
            .when(count("|") * 40 >= size, "table")
            .when(capitals * 4 >= size, "loud")
            .when(count("\n") * 60 >= size, "lines")
            .otherwise("prose"))


def draw(doc_id: Column, seed: str = SEED) -> Column:
    """A number in [0, 1) fixed by the id (null: the empty id) and seed: the
    first 8 hex digits of an MD5 over 2^32."""
    key = F.concat(F.lit(seed + ":"), F.coalesce(doc_id.cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(key.cast("binary")), 1, 8), 16, 10).cast("double") / 2.0 ** 32


def power_targets(cells: pd.DataFrame, powers: dict[str, float] = POWERS
                  ) -> dict[str, dict[str, float]]:
    """Target shares from the present shares, flattened by a power each."""
    out = {}
    for dim, a in powers.items():
        share = cells.groupby(dim)["tokens"].sum()
        share = share[share > 0] ** a
        out[dim] = (share / share.sum()).to_dict()
    return out


def checked(targets: dict[str, dict[str, float]] | None) -> dict[str, dict[str, float]]:
    """Stated targets as shares that sum to 1 for each marginal."""
    out = {}
    for dim, shares in (targets or {}).items():
        if dim not in DIMENSIONS:
            raise ValueError(f"{dim!r} is none of {DIMENSIONS}")
        whole = float(sum(shares.values()))
        if not 0 < whole < float("inf") or min(shares.values()) < 0:
            raise ValueError(f"the weights of {dim!r} must be 0 or more and have a finite sum "
                             "above 0")
        out[dim] = {NONE if v is None else str(v): w / whole for v, w in shares.items()}
    return out


def rake(cells: pd.DataFrame, targets: dict[str, dict[str, float]],
         sweeps: int | None = None) -> np.ndarray:
    """Fitted shares of the cells after at most ``sweeps`` (default
    ``SWEEPS``) rounds over the marginals. Values without a target get none;
    targets of absent values are left out and the rest rescaled."""
    w = cells["tokens"].to_numpy(np.float64)
    w = w / max(w.sum(), 1)
    index = {}
    for dim, shares in targets.items():
        codes, names = pd.factorize(cells[dim])
        want = np.array([shares.get(v, 0.0) for v in names])
        present = np.bincount(codes, weights=w, minlength=len(names)) > 0
        want = np.where(present, want, 0)
        index[dim] = codes, want / max(want.sum(), 1e-300)
    for _ in range(SWEEPS if sweeps is None else sweeps):
        for codes, want in index.values():
            have = np.bincount(codes, weights=w, minlength=len(want))
            w = w * np.divide(want, have, out=np.zeros_like(want), where=have > 0)[codes]
        if all(np.abs(np.bincount(codes, weights=w, minlength=len(want)) - want).max(initial=0)
               <= TOLERANCE for codes, want in index.values()):
            break
    return w


def probabilities(base: np.ndarray, fitted: np.ndarray, budget: float) -> np.ndarray:
    """min(1, s * fitted / base) with the scale s at which the expected
    tokens meet the budget (a share of all tokens), found by halving; 1
    wherever fitted tokens exist if the budget cannot be met."""
    base = np.asarray(base, np.float64)
    total = base.sum()
    if total <= 0:
        return np.zeros(len(base))
    ratio = np.divide(fitted, base / total, out=np.zeros(len(base)), where=base > 0)
    goal = budget * total
    lo, hi = 0.0, 1.0
    while (np.minimum(1, hi * ratio) * base).sum() < goal and hi < 2.0 ** MAX_SCALE:
        hi *= 2
    for _ in range(60):
        mid = (lo + hi) / 2
        if (np.minimum(1, mid * ratio) * base).sum() < goal:
            lo = mid
        else:
            hi = mid
    return np.minimum(1, hi * ratio)


def rake_large(cells: DataFrame, targets: dict[str, DataFrame],
               sweeps: int | None = None) -> DataFrame:
    """``rake`` as Spark jobs for tables too large for the driver: ``cells``
    (source, lang, topic, tokens) and per dimension a frame (value, share)
    whose shares sum to 1 over the present values; adds ``fitted``. Every
    sweep is a stored table."""
    spark = cells.sparkSession
    total = cells.agg(F.sum("tokens")).first()[0] or 1
    now = cells.withColumn("fitted", F.col("tokens") / F.lit(float(total)))

    def held(dim: str, frame: DataFrame) -> DataFrame:
        have = frame.groupBy(dim).agg(F.sum("fitted").alias("__have"))
        return have.join(targets[dim].withColumnRenamed("value", dim), dim, "left").select(
            dim, "__have", F.coalesce("share", F.lit(0.0)).alias("__want"))

    for _ in range(SWEEPS if sweeps is None else sweeps):
        for dim in targets:
            scale = held(dim, now).select(dim, F.when(
                F.col("__have") > 0, F.col("__want") / F.col("__have")).otherwise(0.0)
                .alias("__scale"))
            now = now.join(scale, dim).withColumn("fitted", F.col("fitted") * F.col("__scale")) \
                .drop("__scale")
        now = stored(spark, now, "rake")
        off = [held(dim, now).select(F.abs(F.col("__have") - F.col("__want")).alias("off"))
               for dim in targets]
        worst = reduce(DataFrame.union, off).agg(F.max("off")).first()[0] if off else 0.0
        if (worst or 0.0) <= TOLERANCE:
            break
    return now


def _large_targets(cells: DataFrame, stated: dict[str, dict[str, float]],
                   powers: dict[str, float]) -> dict[str, DataFrame]:
    """(value, share) of each marginal over the values that have tokens."""
    out = {}
    for dim in [d for d in DIMENSIONS if d in stated or d in powers]:
        share = cells.groupBy(F.col(dim).alias("value")).agg(
            F.sum("tokens").cast("double").alias("p")).filter("p > 0")
        if dim in stated:
            given = cells.sparkSession.createDataFrame(
                list(stated[dim].items()), "value string, p double")
            share = given.join(share.select("value"), "value", "left_semi")
        else:
            share = share.withColumn("p", F.pow("p", F.lit(float(powers[dim]))))
        whole = share.agg(F.sum("p")).scalar()
        out[dim] = stored(cells.sparkSession, share.select(
            "value", F.when(whole > 0, F.col("p") / whole).otherwise(0.0).alias("share")),
            "targets")
    return out


def _fit_large(cells: DataFrame, stated: dict[str, dict[str, float]],
               powers: dict[str, float], budget: float) -> DataFrame:
    fitted = rake_large(cells, _large_targets(cells, stated, powers))
    total = fitted.agg(F.sum("tokens")).first()[0] or 1
    goal = budget * total
    ratio = F.when(F.col("tokens") > 0, F.col("fitted") * F.lit(float(total)) / F.col("tokens")) \
        .otherwise(0.0)
    fitted = fitted.withColumn("ratio", ratio)

    def short(scales: list[float]) -> int:
        """How many of the rising scales stay below the budget."""
        sums = fitted.agg(*[F.sum(F.least(F.lit(1.0), F.col("ratio") * float(s)) * F.col("tokens"))
                            for s in scales]).first()
        return sum((x or 0) < goal for x in sums)

    powers_of_two = [2.0 ** k for k in range(MAX_SCALE + 1)]
    lo, hi = 0.0, powers_of_two[min(short(powers_of_two), MAX_SCALE)]
    for _ in range(15):   # 16 trial scales a pass, each pass narrows the range 17 times
        grid = np.linspace(lo, hi, 18).tolist()
        k = short(grid[1:-1])
        lo, hi = grid[k], grid[k + 1]
    return fitted.select(*DIMENSIONS, "tokens", "fitted", F.round(
        F.least(F.lit(1.0), F.col("ratio") * F.lit(hi)), 6).alias("prob"))


TopicOf = Callable[[Column], Column] | str


def _keys(topic_of: TopicOf) -> dict[str, Column]:
    """The marginal values of a row; ``topic_of`` is a function of the text or
    the name of a column."""
    topics = F.coalesce(F.col(topic_of).cast("string"), F.lit(NONE)) \
        if isinstance(topic_of, str) else topic_of(F.col("text").cast("string"))
    return {"source": F.coalesce(F.col("source").cast("string"), F.lit(NONE)),
            "lang": F.coalesce(F.col("lang").cast("string"), F.lit(NONE)),
            "topic": topics}


def fit(valued: DataFrame, budget: float = BUDGET, powers: dict[str, float] = POWERS,
        targets: dict[str, dict[str, float]] | None = None,
        max_cells: int = MAX_CELLS) -> DataFrame:
    """(source, lang, topic, tokens, fitted, prob) for the cells of ``valued``
    (the three and tokens): fitted is the raked share of the tokens, prob the
    sampling probability. Up to ``max_cells`` cells the frame is marked for
    broadcast: its size is checked here."""
    spark = valued.sparkSession
    stated = checked(targets)
    powers = {d: a for d, a in powers.items() if d not in stated}
    cells = stored(spark, valued.groupBy(*DIMENSIONS).agg(F.sum("tokens").alias("tokens")),
                   "cells")
    if cells.count() > max_cells:
        out = _fit_large(cells, stated, powers, budget)
        return stored(spark, out, "fitted")
    head = cells.toPandas().sort_values(list(DIMENSIONS)).reset_index(drop=True)
    wanted = {**power_targets(head, powers), **stated}
    wanted = {d: wanted[d] for d in DIMENSIONS if d in wanted}
    head["fitted"] = rake(head, wanted) if len(head) else np.zeros(0)
    head["prob"] = probabilities(head["tokens"].to_numpy(np.float64),
                                 head["fitted"].to_numpy(np.float64), budget).round(6)
    return spark.createDataFrame(
        list(head[[*DIMENSIONS, "tokens", "fitted", "prob"]].itertuples(index=False, name=None)),
        "source string, lang string, topic string, tokens long, fitted double, prob double") \
        .hint("broadcast")


def marginals(fitted: DataFrame, powers: dict[str, float] = POWERS,
              targets: dict[str, dict[str, float]] | None = None) -> DataFrame:
    """(dimension, value, tokens, target, fitted, expected) of the cells of
    ``fit``: target and fitted shares, and the share of the expected sample.
    A stated value that the corpus lacks has 0 tokens; a marginal without
    target has null targets."""
    spark = fitted.sparkSession
    stated = checked(targets)
    out = None
    for dim in DIMENSIONS:
        part = fitted.groupBy(F.col(dim).alias("value")).agg(
            F.sum("tokens").alias("tokens"), F.sum("fitted").alias("fitted"),
            F.sum(F.col("prob") * F.col("tokens")).alias("kept"))
        if dim in stated:
            goal = spark.createDataFrame(list(stated[dim].items()), "value string, target double")
            part = part.join(goal, "value", "full")
            target = F.coalesce("target", F.lit(0.0))
        elif dim in powers:
            power = F.when(F.col("tokens") > 0, F.pow(F.col("tokens").cast("double"),
                                                      F.lit(float(powers[dim])))).otherwise(0.0)
            whole = part.agg(F.sum(power)).scalar()
            target = F.when(whole > 0, power / whole).otherwise(0.0)
        else:
            target = F.lit(None).cast("double")
        kept = part.agg(F.sum("kept")).scalar()
        part = part.select(
            F.lit(dim).alias("dimension"), "value",
            F.coalesce("tokens", F.lit(0)).alias("tokens"), target.alias("target"),
            F.coalesce("fitted", F.lit(0.0)).alias("fitted"),
            F.when(kept > 0, F.coalesce("kept", F.lit(0.0)) / kept).otherwise(0.0)
            .alias("expected"))
        out = part if out is None else out.union(part)
    return out


def cell_probabilities(valued: DataFrame, budget: float = BUDGET,
                       powers: dict[str, float] = POWERS,
                       targets: dict[str, dict[str, float]] | None = None,
                       max_cells: int = MAX_CELLS) -> DataFrame:
    """(source, lang, topic, prob) of ``fit``; warns of missed targets."""
    fitted = fit(valued, budget, powers, targets, max_cells)
    if targets:
        worst = marginals(fitted, powers, targets).filter("tokens > 0 or target > 0").agg(
            F.max_by(F.struct("*"), F.abs(F.col("fitted") - F.col("target")))).first()[0]
        if worst is not None and abs(worst["fitted"] - worst["target"]) > MISS:
            warnings.warn(f"{worst['dimension']} {worst['value']!r} gets {worst['fitted']:.4f} "
                          f"of the tokens, not {worst['target']:.4f}: the targets do not hold "
                          "together in this corpus", MixWarning, stacklevel=3)
    return fitted.select(*DIMENSIONS, "prob")


def sample_mix(docs: DataFrame, budget: float = BUDGET, powers: dict[str, float] = POWERS,
               seed: str = SEED, topic_of: TopicOf = topic,
               targets: dict[str, dict[str, float]] | None = None,
               max_cells: int = MAX_CELLS) -> DataFrame:
    """(doc_id, source, lang, topic, tokens, prob, sampled), one row per
    input row. ``targets`` states weights per marginal, ``{"source": {"web":
    2, "books": 1}}``; a marginal that is not stated follows ``powers``, one in
    neither is left free. ``topic_of`` is a function of the text or the name
    of a topic column (null: ``""``). Null source or lang counts as the value ``""``; null and empty
    texts have no tokens, probability 0 and are not sampled; repeated ids
    share one draw; an empty table gives an empty result. Other columns are
    not read."""
    keys = _keys(topic_of)
    valued = stored(docs.sparkSession, docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), *[c.alias(d) for d, c in keys.items()],
        tokens(F.col("text").cast("string")).alias("tokens")), "mix")
    prob = cell_probabilities(valued, budget, powers, targets, max_cells)
    return (valued.join(prob, list(DIMENSIONS))
            .select("doc_id", *DIMENSIONS, "tokens", "prob",
                    (draw(F.col("doc_id"), seed) < F.col("prob")).alias("sampled")))


def mix_report(docs: DataFrame, budget: float = BUDGET, powers: dict[str, float] = POWERS,
               topic_of: TopicOf = topic, targets: dict[str, dict[str, float]] | None = None,
               max_cells: int = MAX_CELLS) -> DataFrame:
    """(dimension, value, tokens, target, fitted, expected): how far the
    marginals of ``docs`` meet their targets. An empty table gives the stated
    values alone, with 0 tokens."""
    valued = docs.select(*[c.alias(d) for d, c in _keys(topic_of).items()],
                         tokens(F.col("text").cast("string")).alias("tokens"))
    return marginals(fit(valued, budget, powers, targets, max_cells), powers, targets)


def keep_mix(docs: DataFrame, budget: float = BUDGET, powers: dict[str, float] = POWERS,
             seed: str = SEED, topic_of: TopicOf = topic,
             targets: dict[str, dict[str, float]] | None = None,
             max_cells: int = MAX_CELLS) -> DataFrame:
    """The sampled rows of ``docs`` with all their columns. The probability
    comes from the row's own cell, so nothing is joined by document; repeated
    rows stay or go together."""
    keys = _keys(topic_of)
    valued = docs.select(*[c.alias(d) for d, c in keys.items()],
                         tokens(F.col("text").cast("string")).alias("tokens"))
    prob = cell_probabilities(valued, budget, powers, targets, max_cells)
    for d in (*DIMENSIONS, "prob"):
        prob = prob.withColumnRenamed(d, f"__{d}")
    keyed = docs.withColumns({f"__{d}": c for d, c in keys.items()})
    return (keyed.join(prob, [f"__{d}" for d in DIMENSIONS])
            .filter(draw(F.col("doc_id").cast("long"), seed) < F.col("__prob"))
            .select(*[F.col(c) for c in docs.columns]))
