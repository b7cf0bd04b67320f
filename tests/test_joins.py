from pyspark.sql import functions as F

from reptally.functions.joins import attach, hot_keys, key_weights, spread_join

from sorted_rows import rows


def skewed(spark):
    # key 0 holds a third of all rows, nulls another part
    return spark.range(9000).select(
        F.when(F.col("id") % 3 == 0, 0).when(F.col("id") % 10 == 1, None).otherwise(F.col("id") % 700 + 1).alias("k"),
        F.col("id").alias("v"),
    )


def dim(spark):
    return spark.range(0, 600).select(F.col("id").cast("int").alias("k"), (F.col("id") * 2).alias("w"))


def test_hot_keys_are_bounded_and_found(spark):
    weights = key_weights(skewed(spark).dropna(), ["k"])
    for pieces in (4, 50):
        hot = hot_keys(weights, ["k"], pieces).collect()
        assert len(hot) <= pieces
        assert hot[0]["k"] == 0 and hot[0]["_parts"] >= pieces // 3


def test_spread_join_equals_plain_join(spark, no_broadcast):
    fact, keys = skewed(spark), dim(spark)
    for how in ("left", "inner", "left_semi", "left_anti"):
        plain, spread = fact.join(keys, ["k"], how), spread_join(fact, keys, ["k"], how, by=["v"])
        columns = [F.coalesce(F.col(c), F.lit(-1)) for c in plain.columns]
        assert rows(spread, *columns) == rows(plain, *columns), how


def test_hot_key_goes_to_several_tasks(spark, no_broadcast):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = spread_join(skewed(spark), dim(spark), ["k"], by=["v"]).filter("k = 0")
        tasks = joined.groupBy(F.spark_partition_id().alias("p")).count().collect()
        assert len(tasks) > 1 and sum(t["count"] for t in tasks) == 3000
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_attach_counted_column_is_dropped(spark, no_broadcast):
    fact = skewed(spark).dropna()
    totals = fact.groupBy("k").agg(F.sum("v").alias("t"), F.count(F.lit(1)).alias("n_rows"))
    got = attach(fact, totals, ["k"], by=["v"], counted="n_rows")
    assert got.columns == ["k", "v", "t"]
    assert got.count() == fact.count()
    assert got.filter("t is null").count() == 0


def test_small_side_is_broadcast_without_a_shuffle_of_the_large(spark):
    plan = attach(skewed(spark), dim(spark), ["k"])._jdf.queryExecution().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
