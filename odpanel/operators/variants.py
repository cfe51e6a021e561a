"""Values of any type: JSON text as VARIANT, its types found, its fields
extracted, bad text NULL and counted."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def typed_fields(df: DataFrame, column: str, fields: dict[str, tuple[str, str]]) -> DataFrame:
    """``df`` with a column for each of ``fields`` (name -> (path, type)), and
    ``bad_text``: whether the text is set but no JSON. A path that is absent or
    whose value has no such type gives NULL."""
    v = F.try_parse_json(F.col(column))
    bad = F.col(column).isNotNull() & F.col("_v").isNull()
    return (df.withColumn("_v", v).withColumn("bad_text", bad)
            .withColumns({name: F.try_variant_get("_v", path, kind)
                          for name, (path, kind) in fields.items()}).drop("_v"))


def found_types(df: DataFrame, column: str, keys=()) -> DataFrame:
    """(keys, n_rows, n_null, n_bad, found): rows, null texts, texts that are
    no JSON, and the common type of the others (NULL without any)."""
    v = F.try_parse_json(F.col(column))
    t = df.select(*keys, F.col(column).alias("_t"), v.alias("_v"))
    some = F.count("_v") > 0
    got = t.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("_t").isNull()).alias("n_null"),
        F.count_if(F.col("_t").isNotNull() & F.col("_v").isNull()).alias("n_bad"),
        F.when(some, F.schema_of_variant_agg("_v")).alias("found"))
    return got
