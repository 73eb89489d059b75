"""Training vectors: one shuffle of the log for both query kinds, and counts without the row's own fold."""

from collections import Counter

from pyspark.sql import functions as F

from clickfeat.functions.random import hash_uniform, pick_index
from clickfeat.operators.counters import KIND_KEYS, all_counters
from clickfeat.operators.enrichment import out_of_fold_vectors, training_vectors
from clickfeat.operators.star import ClickStar
from clickfeat.plans.registry import QUERIES, load_all
from clickfeat.schemas import CLICK_COLUMNS
from clickfeat.sources.fixtures import click_view
from conftest import SF_SMALL

KEY = ["session_id", "device_id", "ad_id"]
load_all()


def plan_of(spark, df):
    return spark.sparkContext._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "simple")


def test_the_log_is_shuffled_once_for_both_query_kinds(spark, tmp_dir):
    old = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")}
    click_view(spark, SF_SMALL).write.parquet(f"{tmp_dir}/log")
    log = spark.read.parquet(f"{tmp_dir}/log").withColumn("session_id", F.col("session_id") + 0)
    want = sorted(map(tuple, training_vectors(log).collect()))
    for k in old:
        spark.conf.set(k, "-1")
    try:
        counters = all_counters(log)
        v = training_vectors(log, counters, salts=4, max_hot_keys=20)
        lines = plan_of(spark, v).splitlines()
        # the log crosses the network once for ads and both query kinds, once for device ips and once for device ids
        of_log = [x for x in lines if "Exchange hashpartitioning" in x and "coalesce(query" in x and "_salt" in x]
        assert len(of_log) == 1, lines
        assert sum("SortMergeJoin" in x or "ShuffledHashJoin" in x for x in lines) == 3
        assert sorted(map(tuple, v.collect())) == want
        hot = log.withColumn("query", F.when(F.col("session_id") % 3 == 0, "hot").when(F.col("session_id") % 7 == 0, None).otherwise(F.col("query")))
        a, b = (sorted(map(str, training_vectors(hot, salted=how, max_hot_keys=20, salts=4).collect())) for how in (True, False))
        assert a == b
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_lattice_equals_the_other_methods(spark):
    clicks = click_view(spark, SF_SMALL)
    clicks = clicks.withColumn("query", F.when(F.col("ad_id") % 11 == 0, None).otherwise(F.col("query"))).withColumn("device_ip", F.when(F.col("device_ip") == 3, None).otherwise(F.col("device_ip")))
    got = [Counter(map(tuple, all_counters(clicks, m).select("kind", "device_ip", "device_id", "query", "campaign_id", "ad_id", "clicks", "impressions").collect()))
           for m in ("lattice", "grouping_sets", "union")]
    assert got[0] == got[1] == got[2] and set(k[0] for k in got[0]) == set(KIND_KEYS)


def test_only_three_sets_are_expanded_from_raw_rows(spark):
    log = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").limit(0)
    assert not log.isStreaming
    from clickfeat.operators import counters
    assert len(counters.BASE_SETS) == 3 and set(counters.LATTICE_KINDS) | {"device_ip", "device_id"} == set(KIND_KEYS)


def test_out_of_fold_counts_leave_out_the_rows_own_fold(spark):
    clicks = click_view(spark, SF_SMALL)
    rows = [r.asDict() for r in clicks.withColumn("fold", pick_index(hash_uniform(42, F.lit("fold"), *KEY), F.lit(5)).cast("int")).collect()]
    keys = {"ip": ["device_ip"], "device": ["device_id"], "ad": ["ad_id"], "qc": ["query", "campaign_id"], "qa": ["query", "ad_id"]}
    total, own = Counter(), Counter()
    for r in rows:
        for p, k in keys.items():
            key = (p, *[r[c] for c in k])
            for m, n in (("clicks", r["clicked"]), ("impressions", 1)):
                total[key, m] += n
                own[key, m, r["fold"]] += n
    for mode in (True, "always"):
        got = out_of_fold_vectors(clicks, KEY, salted=mode, max_hot_keys=50, salts=3).collect()
        assert len(got) == len(rows) and len({g.fold for g in got}) == 5
        for g in got:
            for p, k in keys.items():
                key = (p, *[g[c] for c in k])
                for m in ("clicks", "impressions"):
                    assert g[f"{p}_{m}"] == total[key, m] - own[key, m, g.fold]


def _odd_star(spark):
    """A star with repeated and null keys, a hot device, a hot ad and a hot session."""
    n = 3000
    facts = spark.range(n).select(
        F.when(F.col("id") % 50 == 0, None).when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 600).alias("session_id"),
        F.when(F.col("id") % 41 == 0, None).when(F.col("id") % 4 == 0, 5).otherwise(F.col("id") % 90).alias("ad_id"),
        (F.col("id") % 2).cast("int").alias("cat_match"), F.when(F.col("id") % 13 != 0, (F.col("id") % 5 == 0).cast("int")).alias("clicked"))
    sessions = spark.range(590).select(F.when(F.col("id") % 70 == 0, None).otherwise(F.col("id")).alias("session_id"),
                                       F.when(F.col("id") % 2 == 0, 3).otherwise(F.col("id") % 40).alias("device_id"))
    devices = spark.range(38).select(F.col("id").alias("device_id"), F.when(F.col("id") % 9 != 0, F.col("id") % 4).cast("int").alias("device_ip"))
    ads = spark.range(88).select(F.col("id").alias("ad_id"), F.when(F.col("id") % 8 != 0, F.concat(F.lit("q"), F.col("id") % 6)).alias("query"),
                                 F.when(F.col("id") % 10 != 0, F.concat(F.lit("c"), F.col("id") % 3)).alias("campaign_id"))
    twice = lambda d, k: d.unionByName(d.where(F.col(k) % 17 == 3))
    return ClickStar(facts, twice(sessions, "session_id"), twice(devices, "device_id"), twice(ads, "ad_id"))


def test_counters_joined_to_the_parts_of_the_log_give_the_same_vectors(spark):
    star = _odd_star(spark)
    old = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")}
    f, s, d, a = star
    log = f.join(s, "session_id").join(d, "device_id").join(a, "ad_id").select(*CLICK_COLUMNS)
    for vectors in (training_vectors, lambda x, **kw: out_of_fold_vectors(x, KEY, **kw)):
        want = Counter(map(str, vectors(log, salted=False).collect()))
        try:
            for limit in ("-1", "3000"):
                spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
                spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
                assert not star.small
                got = vectors(star, max_hot_keys=20, salts=4)
                assert Counter(map(str, got.collect())) == want and sum(want.values()) > 1000
        finally:
            for k, v in old.items():
                spark.conf.set(k, v)


def test_the_facts_cross_the_network_only_to_meet_sessions_and_ads(spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")}
    for k in old:
        spark.conf.set(k, "-1")
    try:
        for name in ("training_vectors", "training_vectors_out_of_fold"):
            plan = plan_of(spark, QUERIES[name](spark, SF_SMALL)).splitlines()
            depth = lambda x: len(x) - len(x.lstrip(" :+-*(0123456789)"))
            scan = next(i for i, x in enumerate(plan) if "lineitem" in x and "FileScan" in x)
            assert sum("lineitem" in x and "FileScan" in x for x in plan) == 1
            above, low = [], depth(plan[scan])
            for x in reversed(plan[:scan]):
                if depth(x) < low:
                    low = depth(x)
                    above.append(x)
            assert sum("Exchange hashpartitioning" in x for x in above) == 2, (name, above)
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
