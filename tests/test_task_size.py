"""The tasks of a large join follow its rows, not the session's shuffle partitions or AQE's bytes."""

import pytest
from pyspark.sql import functions as F

from clickfeat.operators import lookup
from clickfeat.operators.enrichment import training_vectors
from clickfeat.operators.star import ClickStar

N = 40_000


@pytest.fixture()
def few_partitions(spark, monkeypatch):
    """Two shuffle partitions, nothing broadcast, a task's share of 2,000 rows."""
    keys = {"spark.sql.shuffle.partitions": "2", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    old = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    monkeypatch.setattr(lookup, "TASK_ROWS", 2000, raising=False)
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def star(spark, hot=False):
    """A log of N rows; ``hot``: a third of them in one session and another third on one ad, with null and repeated keys besides."""
    i = F.col("id")
    session, ad = i % 10_000, i * 7919 % 300
    if hot:
        session = F.when(i % 3 == 0, 7).when(i % 101 == 0, None).otherwise(session)
        ad = F.when(i % 3 == 1, 11).when(i % 103 == 0, None).otherwise(ad)
    facts = spark.range(N).select(session.alias("session_id"), ad.alias("ad_id"), (i % 2).cast("int").alias("cat_match"), (i % 5 == 0).cast("int").alias("clicked"))
    sessions = spark.range(10_000).select(i.alias("session_id"), (i % 900).alias("device_id"))
    devices = spark.range(900).select(i.alias("device_id"), (i % 25).cast("int").alias("device_ip"))
    ads = spark.range(300).select(i.alias("ad_id"), F.concat(F.lit("q "), (i % 40).cast("string")).alias("query"), F.concat(F.lit("b"), (i % 9).cast("string")).alias("campaign_id"))
    if hot:
        again = spark.createDataFrame([(7, 3), (8, 4), (None, 5)], "session_id bigint, device_id bigint")
        sessions = sessions.where("session_id % 11 <> 5").unionByName(again)
        ads = ads.where("ad_id % 13 <> 4").unionByName(ads.where("ad_id = 11 or ad_id = 20"))
    return ClickStar(facts, sessions, devices, ads)


def plain(s):
    return s.facts.join(s.sessions, "session_id").join(s.devices, "device_id").join(s.ads, "ad_id")


def largest(df):
    return df.groupBy(F.spark_partition_id().alias("p")).count().agg(F.max("count")).first()[0]


def test_log_is_joined_in_tasks_of_bounded_rows(spark, few_partitions):
    s = star(spark)
    # sessions alone first: the log behind the second join is dealt by ad
    assert largest(lookup.dealt_join(s.facts, s.device_sessions(), "session_id")) < 5000
    log = s.rows()
    assert log.rdd.getNumPartitions() == 20
    assert sorted(map(tuple, log.collect())) == sorted(map(tuple, plain(s).select(*log.columns).collect()))


def test_hot_null_and_repeated_keys(spark, few_partitions):
    s = star(spark, hot=True)
    assert largest(lookup.dealt_join(s.facts, s.device_sessions(), "session_id")) < 14_000   # 13,334 lines in one session, and that session twice
    log = s.rows()
    assert largest(log) < 16_000                                                             # plain: every line of ad 11, in four copies some of them
    assert sorted(map(tuple, log.collect())) == sorted(map(tuple, plain(s).select(*log.columns).collect()))


def test_heavy_keys_are_those_beyond_a_tasks_share(spark, few_partitions):
    s = star(spark, hot=True)
    assert [r.session_id for r in lookup._heavy(s.facts, "session_id", 20).collect()] == [7]
    assert lookup._heavy(star(spark).facts, "session_id", 20).isEmpty()


def test_salted_join_in_tasks_of_bounded_rows(spark, few_partitions):
    big = spark.range(N).select((F.col("id") % 5000).alias("k"), "id")
    small = spark.range(5000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    j = lookup.salted_left_join(big, small, ["k"])
    assert largest(j) < 5000
    assert j.count() == N and j.where("v is null or v <> k * 2").count() == 0


def test_small_joins_are_left_to_aqe(spark):
    assert lookup.join_tasks(spark, lookup.TASK_ROWS) == 0
    assert lookup.join_tasks(spark, 100 * lookup.TASK_ROWS + 1) == 101


def test_vectors_of_a_dealt_log_are_the_same(spark, few_partitions):
    for hot in (False, True):
        s = star(spark, hot)
        got, want = training_vectors(s), training_vectors(plain(s).select(*s.rows().columns), salted=False)
        assert got.columns == want.columns
        assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
