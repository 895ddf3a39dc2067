"""A key that owns a third of the rows must be split, whichever side of an outer join it is on."""

import pytest
from pyspark.sql import functions as F

from conftest import rows
from stationcast.operators.joins import outer_chain, outer_on

SETTINGS = {
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512KB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "512KB",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.shuffle.partitions": "16",
}


@pytest.fixture
def small_partitions(spark):
    old = {k: spark.conf.get(k, None) for k in SETTINGS}
    for k, x in SETTINGS.items():
        spark.conf.set(k, x)
    yield
    for k, x in old.items():
        spark.conf.unset(k) if x is None else spark.conf.set(k, x)


def sides(spark):
    k = F.when(F.col("id") % 3 == 0, F.lit("HOT")).otherwise(F.concat(F.lit("k"), F.col("id") % 5000))
    big = spark.range(0, 400000, 1, 16).select(k.alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("p"))
    small = spark.range(5000).select(F.concat(F.lit("k"), F.col("id")).alias("k"), F.col("id").alias("y"))
    return big, small.unionByName(spark.createDataFrame([("HOT", -1), ("only", -2)], "k string, y long"))


def split_joins(df):
    kept = df.cache()
    n = kept.count()
    plan = kept._jdf.queryExecution().executedPlan().toString()
    kept.unpersist()
    return n, plan.count("skew=true")


@pytest.mark.parametrize("hot_first", [True, False])
def test_outer_chain_splits_either_side(spark, small_partitions, hot_first):
    big, small = sides(spark)
    n, split = split_joins(outer_chain([big, small] if hot_first else [small, big], ["k"]))
    assert n == 400001 and split >= 1


def test_outer_on_splits(spark, small_partitions):
    big, small = sides(spark)
    n, split = split_joins(outer_on(small, big.withColumnRenamed("k", "j"), F.trim("k"), F.trim("j")))
    assert n == 400001 and split >= 1


def test_outer_chain_shuffles_no_product(spark, small_partitions):
    """Three frames of many rows a key: what is shuffled are their rows, not those of the first two joined."""
    frames = [spark.range(3000).select((F.col("id") % (20 + i)).alias("k"), F.col("id").alias(f"v{i}")) for i in range(3)]
    got = outer_chain(frames, ["k"]).cache()
    native = frames[0].join(frames[1], "k", "outer").join(frames[2], "k", "outer")
    assert got.count() == native.count() > 2_000_000
    assert rows(got.groupBy("k").agg(F.count("*"), F.sum("v0"), F.sum("v1"), F.sum("v2"))) == rows(
        native.groupBy("k").agg(F.count("*"), F.sum("v0"), F.sum("v1"), F.sum("v2")))
    plan = got._jdf.queryExecution().executedPlan().toString()
    got.unpersist()
    assert "FullOuter" not in plan
