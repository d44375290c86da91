"""A key holding a third of the rows: results stay exact and AQE splits the skewed joins."""

import contextlib

from pyspark.sql import functions as F

from parcelflow.operators import dedup, joins


@contextlib.contextmanager
def conf(spark, **kv):
    old = {k: spark.conf.get(k, None) for k in kv}
    for k, v in kv.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


SKEW = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",                       # force sort-merge joins
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.shuffle.partitions": "8",
}


def test_unpack_with_a_giant_container_and_a_hot_item(spark):
    n = 3000
    items = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("B0"))                      # a third of the items: one container
         .otherwise(F.concat(F.lit("I"), F.col("id").cast("string"))).alias("item"),
        F.col("id").alias("scan_id"))
    boxes = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("B0"))                      # a third of the bindings: that container
         .otherwise(F.concat(F.lit("B"), (F.col("id") % 50 + 1).cast("string"))).alias("task_number"),
        F.concat(F.lit("W"), F.col("id").cast("string")).alias("waybill_number"))
    with conf(spark, **SKEW):
        out = joins.unpack_containers(items, "item", boxes)
        got = out.groupBy().agg(F.count("*").alias("n"), F.count_distinct("item").alias("d")).collect()[0]
        out.collect()
        plan = out._jdf.queryExecution().executedPlan().toString()
    hot_items = len(range(0, n, 3))
    hot_contents = len(range(0, n, 3))
    assert got.n == hot_items * hot_contents + (n - hot_items)          # every pair, nothing capped
    assert got.d == hot_contents + (n - hot_items)
    assert "SortMergeJoin(skew=true)" in plan                           # AQE split the giant container


def test_latest_per_key_with_a_hot_key(spark):
    n = 6000
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"),
        F.col("id").alias("t"))
    with conf(spark, **SKEW):
        out = dedup.latest_per_key(df, ["k"], ["t"], [])
        rows = {r.k: r.t for r in out.collect()}
    assert rows[0] == max(i for i in range(0, n, 3))
    assert len(rows) == 1 + len([i for i in range(n) if i % 3])


def test_anti_join_with_a_hot_key_on_both_sides(spark):
    n = 3000
    left = spark.range(n).select(F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"))
    right = spark.range(n).select(F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") * 2).alias("k"))
    with conf(spark, **SKEW):
        anti = joins.without(left, right, ["k"]).count()
        semi = joins.within(left, right, ["k"]).count()
    right_keys = {0} | {i * 2 for i in range(n) if i % 3}
    left_keys = [0 if i % 3 == 0 else i for i in range(n)]
    assert semi == sum(1 for k in left_keys if k in right_keys)
    assert anti + semi == n
