"""Exact most frequent values from mergeable summaries.

Counting every value to find the top few shuffles a row per different value
and task. A Misra-Gries summary holds ``counters`` of them a task: when there
are more, all counts fall by that of the first beyond and the rest go. A value
has then lost at most the task's ``lost``, and one that is in no summary
occurs at most sum(lost) times in all. The summaries name the candidates, a
second scan counts those exactly, and the top is proven when its last count
exceeds sum(lost). If it does not, the summaries grow as far as that count asks
for; beyond ``MOST_COUNTERS`` (a flat distribution) all values are counted.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from odpanel.session import shared_dir

COUNTERS = 1 << 10        # counters of a task's first summary
MOST_COUNTERS = 1 << 18   # beyond, every value is counted


def _merged(parts: list[pa.Table]) -> pa.Table:
    """Counts of each value, over several (value, n) tables."""
    t = pa.concat_tables(parts).group_by("value").aggregate([("n", "sum")])
    return t.rename_columns(["value", "n"])


def _cut(t: pa.Table, counters: int) -> tuple[pa.Table, int]:
    """At most ``counters`` values, less the count of the first beyond."""
    if t.num_rows <= counters:
        return t, 0
    down = pc.sort_indices(t["n"], sort_keys=[("", "descending")])
    lost = t["n"][down[counters].as_py()].as_py()
    t = t.set_column(t.schema.get_field_index("n"), "n", pc.subtract(t["n"], lost))
    return t.filter(pc.greater(t["n"], 0)), lost


def summaries(df: DataFrame, column: str, counters: int = COUNTERS) -> DataFrame:
    """(value, n, lost): each task's summary of ``column`` (NULL is a value),
    and one row per task with ``lost`` set, n null."""
    kind = df.schema[column].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[pa.Table] = []
        held, lost = 0, 0
        like = None
        for batch in batches:
            like = batch.column(0).type
            one = pa.table({"value": batch.column(0),
                            "n": pa.array([1] * batch.num_rows, pa.int64())})
            parts.append(_merged([one]))
            held += parts[-1].num_rows
            if held > 8 * counters:
                t, cut = _cut(_merged(parts), counters)
                parts, held, lost = [t], t.num_rows, lost + cut
        if like is None:
            return
        t, cut = _cut(_merged(parts), counters)
        for b in t.select(["value", "n"]).combine_chunks().to_batches():
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.nulls(b.num_rows, pa.int64())],
                ["value", "n", "lost"])
        yield pa.RecordBatch.from_arrays(
            [pa.nulls(1, like), pa.nulls(1, pa.int64()), pa.array([lost + cut], pa.int64())],
            ["value", "n", "lost"])

    return df.select(column).mapInArrow(run, f"value {kind.simpleString()}, n long, lost long")


def _top(counts: DataFrame, k: int) -> DataFrame:
    return counts.orderBy(F.desc("n"), F.asc_nulls_last("value")).limit(k)


def _stored(df: DataFrame) -> DataFrame:
    path = shared_dir(df.sparkSession, "frequent")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _counted(df: DataFrame, column: str, candidates: DataFrame | None = None) -> DataFrame:
    values = df.select(F.col(column).alias("value"))
    if candidates is not None:
        values = values.join(candidates.select(F.col("value").alias("_c")),
                             F.col("value").eqNullSafe(F.col("_c")), "left_semi")
    return values.groupBy("value").agg(F.count(F.lit(1)).alias("n"))


def top_values(df: DataFrame, column: str, k: int, counters: int = COUNTERS) -> DataFrame:
    """(value, n): the ``k`` most frequent values of ``column`` with their exact
    counts; ties go to the smaller value, NULL (a value like any other) last.
    Fewer rows if there are fewer values; none for an empty table.

    Each round shuffles at most ``counters`` rows a task and counts only the
    values that can still be among the top."""
    if k < 1:
        raise ValueError("k must be at least 1")
    counters = max(counters, 2 * k)
    while counters <= MOST_COUNTERS:
        got = _stored(summaries(df, column, counters))
        merged = got.filter(F.col("lost").isNull()).groupBy("value").agg(F.sum("n").alias("n"))
        lost = got.agg(F.sum("lost")).first()[0]
        if lost is None:
            return _top(_counted(df, column), k)    # no task had a row
        floor = _top(merged, k).agg(F.min("n"), F.count(F.lit(1))).first()
        least = floor[0] if floor[1] == k else 0
        # true counts lie in n .. n + lost, so what cannot reach the k-th is out
        counts = _stored(_counted(df, column, merged.filter(F.col("n") + lost >= (least or 0))))
        last = _top(counts, k).agg(F.min("n"), F.count(F.lit(1))).first()
        if lost == 0 or (last[1] == k and last[0] > lost):
            return _top(counts, k)
        # lost is at most the rows by the counters: this many would prove the count
        counters *= max(2, -(-2 * lost // max(1, last[0] or 1)))
    return _top(_counted(df, column), k)


def mode(df: DataFrame, column: str, counters: int = COUNTERS) -> DataFrame:
    """(value, n) of the most frequent value; ties to the smallest, NULL last."""
    return top_values(df, column, 1, counters)


def placed(top: DataFrame, column_name: str) -> DataFrame:
    """(column_name, place, value, n) of the few rows of ``top_values``, the
    value as text."""
    w = Window.orderBy(F.desc("n"), F.asc_nulls_last("value"))
    return top.select(F.lit(column_name).alias("column_name"),
                      F.row_number().over(w).cast("int").alias("place"),
                      F.col("value").cast("string").alias("value"), "n")
