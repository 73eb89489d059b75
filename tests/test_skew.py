"""A key holding a third of the rows is split, and results stay exact."""

from pyspark.sql import Window, functions as F

from clickfeat.operators.indexing import rank_within
from clickfeat.operators.lookup import salted_left_join


def skewed_clicks(spark, n=30000):
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise((F.col("id") % 1000) + 100).alias("device_ip"),
        F.col("id").alias("session_id"), (F.col("id") % 2).cast("int").alias("clicked"))
    return df


def test_salted_join_spreads_hot_key(spark):
    keys = {"spark.sql.autoBroadcastJoinThreshold": "-1",                # force the shuffle join
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.coalescePartitions.enabled": "false",    # tiny data: keep partitions
            "spark.sql.shuffle.partitions": "32"}
    old = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    try:
        big = skewed_clicks(spark)
        small = big.groupBy("device_ip").agg(F.count(F.lit(1)).alias("imps"), F.sum("clicked").alias("clk"))
        j = salted_left_join(big, small, ["device_ip"], max_hot_keys=100, salts=16)
        parts = (j.where("device_ip = 7").select(F.spark_partition_id().alias("p")).distinct().count())
        assert parts >= 8                                 # the hot key is processed by many tasks
        plain = big.join(small, "device_ip", "left")
        a = sorted(map(tuple, j.select(*plain.columns).collect()))
        b = sorted(map(tuple, plain.collect()))
        assert a == b
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_rank_within_hot_group_matches_row_number(spark):
    df = spark.range(5000).select((F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50)).alias("g"),
                                  (F.col("id") * 7 % 5003).alias("pos"))
    got = rank_within(df, ["g"], ["pos"], "r", chunk_width=64)
    want = df.withColumn("r", F.row_number().over(Window.partitionBy("g").orderBy("pos")) - 1)
    assert sorted(map(tuple, got.select("g", "pos", "r").collect())) == \
        sorted(map(tuple, want.select("g", "pos", "r").collect()))


def test_prefix_sum_hot_group_matches_window(spark):
    from clickfeat.operators.intervals import prefix_sum
    df = spark.range(4000).select((F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 40)).alias("g"),
                                  F.col("id").alias("pos"), (F.col("id") % 7).cast("double").alias("w"))
    got = prefix_sum(df, ["g"], "pos", "w", "cum", chunk_width=50)
    want = df.withColumn("cum", F.sum("w").over(Window.partitionBy("g").orderBy("pos")
                                                .rowsBetween(Window.unboundedPreceding, 0)))
    assert sorted(map(tuple, got.select("g", "pos", "cum").collect())) == \
        sorted(map(tuple, want.select("g", "pos", "cum").collect()))


def test_lookup_join_size_check_picks_salted_beyond_limit(spark, tmp_dir):
    from clickfeat.operators.lookup import lookup_join
    big = skewed_clicks(spark, 6000)
    small_path = f"{tmp_dir}/small"
    big.groupBy("device_ip").agg(F.count(F.lit(1)).alias("imps")).write.parquet(small_path)
    small = spark.read.parquet(small_path)                       # measured size from the files
    plain = sorted(map(tuple, big.join(small, "device_ip", "left").collect()))
    for limit in (1, 1 << 30):                                  # salted path, broadcast path
        j = lookup_join(big, small, ["device_ip"], max_hot_keys=50, salts=8, limit=limit)
        plan = spark.sparkContext._jvm.PythonSQLUtils.explainString(j._jdf.queryExecution(), "simple")
        assert ("_salt" in plan) == (limit == 1)
        assert sorted(map(tuple, j.select(*big.columns, "imps").collect())) == plain


def test_joins_back_to_an_aggregate_are_split(spark):
    """A third of the rows on one key, no broadcast: no task holds the key."""
    from clickfeat.operators.lookup import split_join
    old = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.autoBroadcastJoinThreshold", "spark.sql.adaptive.coalescePartitions.enabled", "spark.sql.shuffle.partitions")}
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "32")
    try:
        big = skewed_clicks(spark, 300000)
        total = big.groupBy("device_ip").agg(F.sum("clicked").alias("clk"))
        j = split_join(big, total, ["device_ip"], limit=0)
        sizes = j.groupBy(F.spark_partition_id().alias("p")).count()
        assert sizes.agg(F.max("count")).first()[0] < 50000
        assert sorted(map(tuple, j.select("device_ip", "session_id", "clk").collect())) == \
            sorted(map(tuple, big.join(total, "device_ip").select("device_ip", "session_id", "clk").collect()))
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_equal_vectors_emit_k_rows_per_query_and_block(spark):
    import pandas as pd

    from clickfeat.operators.neighbours import _block_topk
    q = pd.DataFrame({"qid": range(1000), "qvec": [[1.0, 2.0]] * 1000})
    c = pd.DataFrame({"cid": range(1000), "cvec": [[1.0, 2.0]] * 1000})
    out = _block_topk(5)(q, c)
    assert len(out) == 5000 and out[out.qid == 3].cid.tolist() == [0, 1, 2, 4, 5]


def test_one_interval_with_a_third_of_all_probes(spark):
    """No broadcast: the probes of a full bin are dealt over tasks."""
    from clickfeat.operators.intervals import interval_lookup
    old = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.autoBroadcastJoinThreshold", "spark.sql.adaptive.coalescePartitions.enabled", "spark.sql.shuffle.partitions")}
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "32")
    try:
        iv = spark.range(100).select(F.floor(F.col("id") / 10).alias("g"), F.col("id").alias("item"), (F.col("id") % 10 / 10.0).alias("lo"), ((F.col("id") % 10 + 1) / 10.0).alias("hi"),
                                     F.lit(1.0).alias("total"), F.lit(10).cast("bigint").alias("nbins"))
        one = spark.createDataFrame([(-1, -1, 0.0, 1.0, 1.0, 1)], "g bigint, item bigint, lo double, hi double, total double, nbins bigint")
        iv = iv.unionByName(one)
        probes = spark.range(90_000).select(F.col("id"), F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id") % 10).alias("g"),
                                            ((F.col("id") * 7919 % 1000 + 1) / 1000.0).alias("x"))
        probes = probes.withColumn("total", F.lit(1.0)).withColumn("nbins", F.when(F.col("g") < 0, 1).otherwise(10).cast("bigint"))
        got = interval_lookup(probes, iv, ["g"], "x", limit=0, hot_rows=3000)
        sizes = got.groupBy(F.spark_partition_id().alias("p")).count()
        assert sizes.agg(F.max("count")).first()[0] < 15_000
        want = interval_lookup(probes, iv, ["g"], "x")
        assert got.count() == 90_000
        assert sorted(map(tuple, got.select("id", "item").collect())) == sorted(map(tuple, want.select("id", "item").collect()))
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_sized_join_splits_beyond_the_limit(spark):
    from clickfeat.operators.lookup import sized_join
    big = skewed_clicks(spark, 60_000)
    total = big.groupBy("device_ip").agg(F.sum("clicked").alias("clk"))
    want = sorted(map(tuple, big.join(total, "device_ip").select("session_id", "clk").collect()))
    for limit in (0, None):
        got = sized_join(big, total, ["device_ip"], limit=limit)
        assert sorted(map(tuple, got.select("session_id", "clk").collect())) == want


def test_rows_with_null_keys_are_spread(spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.autoBroadcastJoinThreshold", "spark.sql.adaptive.coalescePartitions.enabled", "spark.sql.shuffle.partitions")}
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        big = spark.range(32_000).select(F.when(F.col("id") % 2 == 0, None).otherwise(F.col("id") % 100).alias("k"), "id")
        small = spark.range(100).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
        j = salted_left_join(big, small, ["k"], max_hot_keys=10)
        assert j.count() == 32_000 and j.where("v is null").count() == 16_000
        assert j.where("k is null").groupBy(F.spark_partition_id().alias("p")).count().agg(F.max("count")).first()[0] < 6000
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
