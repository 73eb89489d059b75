"""Counters, feature store, enrichment."""

from pyspark.sql import functions as F

from clickfeat.operators.counters import all_counters
from clickfeat.operators.enrichment import training_vectors
from clickfeat.operators.feature_store import feature_store, upsert
from clickfeat.sources.fixtures import click_view
from conftest import SF_SMALL

CLICK_SCHEMA = ("device_ip string, device_id string, session_id bigint, query string, ad_id string, "
                "campaign_id string, cat_match int, clicked int")


def test_counter_properties(spark):
    clicks = click_view(spark, SF_SMALL)
    n = clicks.count()
    c = all_counters(clicks)
    assert c.where("clicks > impressions").count() == 0
    for r in c.groupBy("kind").agg(F.sum("impressions").alias("s")).collect():
        assert r.s == n


def test_grouping_sets_equals_five_aggregates(spark):
    clicks = click_view(spark, SF_SMALL)
    a = sorted(map(tuple, all_counters(clicks).collect()), key=repr)
    b = sorted(map(tuple, all_counters(clicks, method="union").collect()), key=repr)
    assert a == b


def test_apostrophe_and_comma_queries_counted(spark):
    rows = [("1", "d1", 1, "men's shoes", "7", "9", 1, 1), ("1", "d1", 2, "men's shoes", "7", "9", 1, 0),
            ("2", "d2", 3, "a, b", "8", "9", 0, 1)]
    clicks = spark.createDataFrame(rows, CLICK_SCHEMA)
    store = {r.feature_key: r.feature_value for r in feature_store(all_counters(clicks)).collect()}
    assert store["qaidi_men's_shoes_7"] == 2 and store["qaidc_men's_shoes_7"] == 1
    assert store["qcidc_a,_b_9"] == 1 and store["dipi_1"] == 2


def test_missing_counter_is_zero(spark):
    rows = [("1", "d1", 1, "q", "7", "9", 1, 1)]
    clicks = spark.createDataFrame(rows, CLICK_SCHEMA)
    other = spark.createDataFrame([("5", "d5", 1, "z", "1", "2", 0, 0)], CLICK_SCHEMA)
    tv = training_vectors(clicks, counters=all_counters(other)).first()
    assert (tv.ip_clicks, tv.ad_impressions, tv.qa_impressions, tv.match_feature, tv.label) == (0, 0, 0, 1000000, 1)


def test_salted_and_broadcast_joins_agree(spark):
    clicks = click_view(spark, SF_SMALL)
    a = sorted(map(tuple, training_vectors(clicks, salted=True).collect()), key=repr)
    b = sorted(map(tuple, training_vectors(clicks, salted="always", max_hot_keys=3, salts=4).collect()), key=repr)
    c = sorted(map(tuple, training_vectors(clicks, salted=False).collect()), key=repr)
    assert a == b == c


def test_upsert_last_write_wins(spark):
    old = spark.createDataFrame([("a", 1), ("b", 2)], "feature_key string, feature_value bigint")
    new = spark.createDataFrame([("b", 5), ("c", 6)], "feature_key string, feature_value bigint")
    assert sorted(map(tuple, upsert(old, new).collect())) == [("a", 1), ("b", 5), ("c", 6)]
