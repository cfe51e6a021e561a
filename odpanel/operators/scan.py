"""Carry-forward of the last known value, without one task per key.

A window over a key puts all of its rows in one task. Here the rows are
dealt by ranges of (key, order) to blocks, so a key of any size stands in as
many blocks as its share of the rows asks for. A segmented scan in two levels
does the rest: the last value of each block, a scan over the blocks of a key
(one row a block), and the value carried in handed to the block's first rows.
"""

from __future__ import annotations

import operator
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from odpanel.session import shared_dir

BLOCK = "_block"


def key_blocks(df: DataFrame, keys, order, blocks: int | None = None) -> DataFrame:
    """``df`` with a block number that rises with (keys, order), stored: blocks
    are ranges of about equal numbers of rows, so a task's share at most.

    The table is written and read back, because a second evaluation could
    draw other bounds. Rows that are equal in keys and order share a block;
    ``order`` should tell rows apart. ``blocks``: the number of ranges, the
    shuffle partitions by default."""
    spark = df.sparkSession
    n = blocks or int(spark.conf.get("spark.sql.shuffle.partitions"))
    cols = [F.col(c).asc_nulls_first() for c in [*keys, *order]]
    path = shared_dir(spark, "blocks")
    dealt = df.repartitionByRange(n, *cols).withColumn(BLOCK, F.spark_partition_id())
    dealt.write.parquet(path)
    return spark.read.schema(dealt.schema).parquet(path)


def carry_forward(df: DataFrame, keys, order, value: str, out: str | None = None,
                  blocks: int | None = None) -> DataFrame:
    """Add ``out`` (default: ``value`` itself, filled): the last non-null
    ``value`` of the row's key up to and with the row, by ``order`` (nulls
    first); null before the first one. A null key is a key like any other. An
    empty table gives an empty result."""
    keys, order, out = list(keys), list(order), out or value
    rows = key_blocks(df, keys, order, blocks)
    by = [F.col(c).asc_nulls_first() for c in order]
    inner = Window.partitionBy(*keys, BLOCK).orderBy(*by).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    known = F.col(value).isNotNull()
    # one row for each block of a key that has a value: combined in the tasks
    last = rows.filter(known).groupBy(*keys, BLOCK).agg(
        F.max_by(F.struct(value), F.struct(*[F.struct(F.col(c).isNotNull(), c) for c in order]))
        .alias("_last"))
    # and for each block of a key at all, the last value of the blocks before
    spans = rows.select(*keys, BLOCK).distinct()
    same = reduce(operator.and_, [spans[k].eqNullSafe(last[k]) for k in [*keys, BLOCK]])
    before = Window.partitionBy(*keys).orderBy(BLOCK).rowsBetween(
        Window.unboundedPreceding, -1)
    carried = (spans.join(last, same, "left")
               .select(*[spans[k] for k in [*keys, BLOCK]], "_last")
               .withColumn("_carry", F.last("_last", ignorenulls=True).over(before))
               .select(*[F.col(k).alias(f"_{k}_") for k in [*keys, BLOCK]],
                       F.col("_carry")[value].alias("_carry"))
               .filter(F.col("_carry").isNotNull()))
    filled = rows.withColumn("_own", F.last(value, ignorenulls=True).over(inner))
    meet = reduce(operator.and_, [filled[k].eqNullSafe(carried[f"_{k}_"])
                                  for k in [*keys, BLOCK]])
    return (filled.join(carried, meet, "left")
            .withColumn(out, F.coalesce("_own", "_carry"))
            .select(*df.columns, *([out] if out not in df.columns else [])))
