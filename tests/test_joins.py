"""A left join whose hot key is on the right."""

from pyspark.sql import functions as F

from tallyframe.operators.joins import left_join_many
from tallyframe.plans.inspect import plan_text


def test_equals_the_plain_left_join(spark):
    left = spark.createDataFrame([(1, "a"), (2, "b"), (2, "b"), (3, "c"), (None, "n")], "k int, l string")
    right = spark.createDataFrame(
        [(2, i) for i in range(300)] + [(1, 5), (9, 9), (None, 0)], "k int, r int"
    )
    want = left.join(right, "k", "left")
    got = left_join_many(left, right, "k")
    assert got.columns == want.columns
    key = lambda r: tuple(str(v) for v in r)
    assert sorted(map(key, got.collect())) == sorted(map(key, want.collect()))


SKEW = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "4k",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "32k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    # Shuffle sizes are seen per map task: more of them, finer splits.
    "spark.sql.leafNodeDefaultParallelism": "16",
}


def final_plan(spark, df):
    for key, value in SKEW.items():
        spark.conf.set(key, value)
    try:
        df.collect()
        return plan_text(df, "simple").split("Initial Plan")[0]
    finally:
        for key in SKEW:
            spark.conf.unset(key)


def test_hot_right_key_is_split(spark):
    right = spark.range(0, 60_000, numPartitions=16).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 500).alias("k"),
        F.sha2(F.col("id").cast("string"), 256).alias("r"),
    )
    left = spark.range(1000).withColumnRenamed("id", "k")
    assert "skew=true" in final_plan(spark, left_join_many(left, right, "k"))
    assert "skew=true" not in final_plan(spark, left.join(right, "k", "left"))
