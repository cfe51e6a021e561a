"""A hot key (most rows on one key) must give whole, correct results; the
join back to the totals is salted, so the hot key's rows spread over many
join tasks (no cap, no sample)."""

from collections import defaultdict

import pytest

from odpanel.operators.flows import cargo_shares

CARGO = "year int, region string, direction string, cargo_class string, metric string, value double"

SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


@pytest.fixture
def skew_conf(spark):
    old = {k: spark.conf.get(k, None) for k in SKEW_CONF}
    for k, v in SKEW_CONF.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def test_hot_region_shares_are_whole(spark, skew_conf):
    rows = [(2020, "HOT", "expedido", f"c{i}", "tonnes_thousands", float(i % 7 + 1))
            for i in range(3000)]
    rows += [(2020, f"R{j}", "expedido", f"c{i}", "tonnes_thousands", 1.0)
             for j in range(20) for i in range(5)]
    df = spark.createDataFrame(rows, CARGO).repartition(8)
    out = cargo_shares(df)
    got = out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "_salt" in plan   # the hot key's join work is spread over the salts
    tot = defaultdict(float)
    for y, r, _, c, _, v in rows:
        tot[(y, r)] += v
    assert len(got) == len(rows)
    for r in got:
        assert r.share == pytest.approx(r.tonnes / tot[(r.year, r.region)])
    assert sum(r.share for r in got if r.region == "HOT") == pytest.approx(1.0)


def test_salted_join_spreads_hot_key(spark, skew_conf):
    from pyspark.sql import functions as F

    from odpanel.operators.flows import salted_lookup, with_group_total
    rows = [(1, float(i)) for i in range(4000)] + [(k, 1.0) for k in range(2, 50)]
    df = spark.createDataFrame(rows, "k int, v double")
    out = with_group_total(df, ["k"], "v")
    per_task = (out.where(F.col("k") == 1).groupBy(F.spark_partition_id().alias("p"))
                .count().collect())
    assert len(per_task) > 1 and max(r["count"] for r in per_task) < 4000
    assert out.count() == len(rows)
    assert {r.total for r in out.where(F.col("k") == 1).collect()} == {sum(range(4000)) * 1.0}
    equal = spark.createDataFrame([(1,)] * 4000, "k int").repartition(8)
    one = spark.createDataFrame([(1, "x")], "k int, name string")
    spread = (salted_lookup(equal, one, ["k"], salts=16)
              .groupBy(F.spark_partition_id().alias("p")).count().collect())
    assert len(spread) > 1 and sum(r["count"] for r in spread) == 4000
