"""The stage plans run end to end over files."""

import os

from pyspark.sql import functions as F

from clickfeat.plans import stages
from clickfeat.sources.fixtures import ad_view, click_view
from clickfeat.sinks.files import read_feature_store
from conftest import SF_SMALL


def test_stages_end_to_end(spark, tmp_dir):
    ads = ad_view(spark, SF_SMALL)
    ads_path = os.path.join(tmp_dir, "ads_json")
    ads.select(F.col("ad_id").alias("adId"), F.col("campaign_id").alias("campaignId"), "query_group_id", "category",
               "query", "title", F.col("keywords").alias("keyWords")).coalesce(1).write.json(ads_path)
    clicks_path = os.path.join(tmp_dir, "clicks_csv")
    click_view(spark, SF_SMALL).write.csv(clicks_path)
    out = os.path.join(tmp_dir, "out")
    # campaign ids of the fixture are strings: read them with a string schema
    from clickfeat.plans.queries_catalogue import AD_FIXTURE_SCHEMA
    res = stages.run(spark, out, ads_path, clicks_path, gbt_iterations=3, ad_schema=AD_FIXTURE_SCHEMA)
    assert 0.0 <= res["lr_test_error"] <= 1.0 and res["n_test"] > 0
    assert spark.read.parquet(os.path.join(out, "ad_weights")).count() == ads.count()
    assert spark.read.json(os.path.join(out, "synonyms")).count() > 0
    assert spark.read.json(os.path.join(out, "rewrites")).count() == ads.select("query").distinct().count()
    n = click_view(spark, SF_SMALL).count()
    assert spark.read.parquet(os.path.join(out, "clicks_rejected")).count() == 0
    assert spark.read.parquet(os.path.join(out, "training_vectors")).count() == n
    store = read_feature_store(spark, os.path.join(out, "feature_store"))
    assert store.where("feature_key LIKE 'dipi_%'").agg(F.sum("feature_value")).first()[0] == n
    w = spark.read.json(os.path.join(out, "lr_weights_json")).first()
    assert len(w.weights) == 11 and w.bias == 0.0
    stages.run(spark, out, stages=["samples", "budgets"])
    b = spark.read.json(os.path.join(out, "budgets"))
    assert b.count() == ads.select("campaign_id").distinct().count()
    assert b.where("budget < 100 OR budget > 2000").count() == 0
    pos = spark.read.parquet(os.path.join(out, "positive_samples"))
    neg = spark.read.parquet(os.path.join(out, "negative_samples"))
    assert pos.where("clicked = 1").count() == pos.count() > 0
    assert neg.where("clicked = 0").count() == neg.count() > 0
