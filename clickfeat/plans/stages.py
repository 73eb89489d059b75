"""End-to-end stage plans over files (the published order of stages).

    catalogue  ads JSON lines -> weights, ordered maps (parquet + JSON-lines maps)
    corpus     ads -> sentence text
    embeddings sentences -> Word2Vec model, vectors, top-5 synonyms (JSON lines)
    rewrites   synonyms + ad queries -> rewrites (JSON lines of at most 10,000)
    counters   click log -> ten counters (one pass) -> published feature store (keyed upsert);
               unparseable lines -> clicks_rejected
    training   click log + counters -> training vectors (parquet)
    models     training vectors -> LR (+ JSON weights) and GBT, test errors
    samples    (optional) catalogue -> seeded positive draws and negatives (parquet)
    budgets    (optional) catalogue campaigns -> seeded budgets (JSON lines)

Every stage reads what the previous one wrote (parquet / text in ``out_dir``),
so a stage can be re-run alone; nothing passes through the driver.

usage: python -m clickfeat.plans.stages --dir OUT --ads ADS.jsonl [--clicks CLICKS_CSV] [--stages ...]
"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession, functions as F

from clickfeat.operators import catalogue as cat
from clickfeat.operators import models as ml
from clickfeat.operators import text as tx
from clickfeat.operators.counters import all_counters
from clickfeat.operators.enrichment import training_vectors
from clickfeat.operators.feature_store import feature_store
from clickfeat.operators.neighbours import word_neighbours
from clickfeat.operators.rewrites import rewrite_lines, rewrite_rows
from clickfeat.operators.word2vec import fit_word2vec, word_vectors
from clickfeat.schemas import AD, AD_REQUIRED_SENTENCES, AD_REQUIRED_WEIGHTS
from clickfeat.sinks import files as sinks
from clickfeat.sources import files as src

STAGES = ["catalogue", "corpus", "embeddings", "rewrites", "counters", "training", "models"]
OPTIONAL_STAGES = ["samples", "budgets"]
KEY = ["session_id", "device_id", "ad_id"]


def _p(out_dir: str, name: str) -> str:
    return f"{out_dir.rstrip('/')}/{name}"


def stage_catalogue(spark: SparkSession, ads_path: str, out_dir: str, ad_schema=AD) -> None:
    ads = cat.normalise(src.read_ads(spark, ads_path, ad_schema, AD_REQUIRED_WEIGHTS))
    ads = cat.dedupe_last(ads, [cat.G, cat.C, cat.A])      # an ad keeps its membership in every group and campaign
    sinks.write_parquet(ads, _p(out_dir, "ads"))
    ads = spark.read.parquet(_p(out_dir, "ads"))
    sinks.write_parquet(cat.quarantined(ads), _p(out_dir, "ads_quarantined"))
    sinks.write_parquet(cat.ad_weights(ads), _p(out_dir, "ad_weights"))
    sinks.write_parquet(cat.campaign_weights(ads), _p(out_dir, "campaign_weights"))
    sinks.write_parquet(cat.campaign_weight_last(ads), _p(out_dir, "campaign_weight_last"))
    sinks.write_parquet(cat.campaign_category(ads), _p(out_dir, "campaign_category"))
    sinks.write_parquet(cat.group_queries(ads), _p(out_dir, "group_queries"))
    # the six map documents
    sinks.write_nested_map(cat.group_campaign_ads(ads), _p(out_dir, "group_campaign_ads_map"))
    last = cat.dedupe_last(cat.ad_weights(ads).select(cat.A, "pos", "weight"))
    for lines, name in ((sinks.flat_map_lines(cat.campaign_weight_last(ads), cat.C, "weight"), "campaign_weight_map"),
                        (sinks.flat_map_lines(last, cat.A, "weight"), "ad_weight_map"),
                        (sinks.set_map_lines(cat.group_queries_dropfirst(ads)), "group_query_map"),
                        (sinks.flat_map_lines(cat.campaign_category(ads), cat.C, "category"), "campaign_category_map"),
                        (sinks.list_map_lines(cat.campaign_ads_reset(ads)), "campaign_ads_map")):
        sinks.write_lines(lines, _p(out_dir, name))
    sinks.write_parquet(cat.campaign_ads(ads), _p(out_dir, "campaign_ads"))
    sinks.write_parquet(cat.campaign_ads_reset(ads), _p(out_dir, "campaign_ads_reset"))


def stage_corpus(spark: SparkSession, ads_path: str, out_dir: str, ad_schema=AD) -> None:
    ads = src.read_ads(spark, ads_path, ad_schema, AD_REQUIRED_SENTENCES)
    sinks.write_sentences(tx.sentences(ads), _p(out_dir, "sentences"))


def stage_embeddings(spark: SparkSession, out_dir: str, num_partitions: int | None = None) -> None:
    words = tx.sentence_words(spark.read.text(_p(out_dir, "sentences")).withColumnRenamed("value", "sentence"))
    model = fit_word2vec(words, num_partitions=num_partitions)
    model.write().overwrite().save(_p(out_dir, "word2vec_model"))
    vec = word_vectors(model)
    sinks.write_parquet(vec, _p(out_dir, "word_vectors"))
    nb = word_neighbours(spark.read.parquet(_p(out_dir, "word_vectors")), k=5)
    syn = nb.groupBy("word").agg(F.array_sort(F.collect_list(F.struct("rank", "synonym"))).alias("_s"))
    syn = syn.select("word", F.transform("_s", lambda s: s["synonym"]).alias("synonyms"))   # <= 5 per word
    sinks.write_jsonl(syn, _p(out_dir, "synonyms"))


def stage_rewrites(spark: SparkSession, ads_path: str, out_dir: str, lowercase: bool = False,
                   ad_schema=AD) -> None:
    syn = src.parse_synonyms(src.read_lines(spark, _p(out_dir, "synonyms"), positions=True))
    ads = src.read_ads(spark, ads_path, ad_schema, ["query"])
    sinks.write_jsonl(rewrite_lines(rewrite_rows(ads, syn, lowercase=lowercase)), _p(out_dir, "rewrites"))


def stage_samples(spark: SparkSession, out_dir: str, n_draws: int = 49, seed: int = 42) -> None:
    """Seeded training samples from the catalogue written by ``stage_catalogue``:
    weighted positive draws per group and one negative per ad (type mix)."""
    from clickfeat.operators import sampling as smp

    ads = spark.read.parquet(_p(out_dir, "ads"))
    sinks.write_parquet(smp.positive_draws(ads, n_draws, seed), _p(out_dir, "positive_samples"))
    sinks.write_parquet(smp.negative_rows(ads, seed=seed), _p(out_dir, "negative_samples"))


def stage_budgets(spark: SparkSession, out_dir: str, seed: int = 42) -> None:
    """Seeded budget per catalogue campaign, JSON lines {campaignId, budget}."""
    from clickfeat.operators import sampling as smp

    b = smp.campaign_budgets(spark.read.parquet(_p(out_dir, "ads")), seed)
    sinks.write_jsonl(b.select(F.col("campaign_id").alias("campaignId"), "budget"), _p(out_dir, "budgets"))


def _clicks(spark: SparkSession, clicks_path: str):
    """Typed click rows from CSV lines (quoted fields allowed)."""
    return src.parse_clicks(spark.read.text(clicks_path))


def stage_counters(spark: SparkSession, clicks_path: str, out_dir: str) -> None:
    # lines that do not parse to 8 typed fields are kept aside, not silently dropped
    sinks.write_parquet(src.rejected_clicks(spark.read.text(clicks_path)), _p(out_dir, "clicks_rejected"))
    sinks.write_parquet(_clicks(spark, clicks_path), _p(out_dir, "clicks"))       # parsed once; the training stage reads it too
    clicks = spark.read.parquet(_p(out_dir, "clicks"))
    # partitioned by kind: each enrichment lookup reads (and is sized by) one kind
    all_counters(clicks).write.mode("overwrite").partitionBy("kind").parquet(_p(out_dir, "counters"))
    store = feature_store(spark.read.parquet(_p(out_dir, "counters")))
    sinks.publish_feature_store(spark, store, _p(out_dir, "feature_store"))
    sinks.write_jsonl(store, _p(out_dir, "feature_pairs"))


def stage_training(spark: SparkSession, clicks_path: str, out_dir: str) -> None:
    clicks = spark.read.parquet(_p(out_dir, "clicks"))
    counters = spark.read.parquet(_p(out_dir, "counters"))
    sinks.write_parquet(training_vectors(clicks, counters=counters), _p(out_dir, "training_vectors"))


def stage_models(spark: SparkSession, out_dir: str, gbt_iterations: int = ml.GBT_MAX_ITER) -> dict:
    tv = spark.read.parquet(_p(out_dir, "training_vectors"))
    train, test = ml.materialised_split(tv, KEY)
    lr = ml.fit_lr(train)
    lr.write().overwrite().save(_p(out_dir, "lr_model"))
    sinks.write_lr_model_json(ml.lr_model_row(spark, lr), _p(out_dir, "lr_weights_json"))
    gbt = ml.fit_gbt(train, gbt_iterations)
    gbt.write().overwrite().save(_p(out_dir, "gbt_model"))
    lr_err = ml.test_error(lr.transform(test)).first()
    gbt_err = ml.test_error(gbt.transform(test)).first()
    return {"lr_test_error": lr_err.test_error, "gbt_test_error": gbt_err.test_error, "n_test": lr_err.n_test}


def run(spark: SparkSession, out_dir: str, ads_path: str | None = None, clicks_path: str | None = None,
        stages: list[str] | None = None, gbt_iterations: int = ml.GBT_MAX_ITER, ad_schema=AD) -> dict:
    result: dict = {}
    for st in stages or STAGES:
        if st == "catalogue":
            stage_catalogue(spark, ads_path, out_dir, ad_schema)
        elif st == "corpus":
            stage_corpus(spark, ads_path, out_dir, ad_schema)
        elif st == "embeddings":
            stage_embeddings(spark, out_dir)
        elif st == "rewrites":
            stage_rewrites(spark, ads_path, out_dir, ad_schema=ad_schema)
        elif st == "counters":
            stage_counters(spark, clicks_path, out_dir)
        elif st == "training":
            stage_training(spark, clicks_path, out_dir)
        elif st == "models":
            result.update(stage_models(spark, out_dir, gbt_iterations))
        elif st == "samples":
            stage_samples(spark, out_dir)
        elif st == "budgets":
            stage_budgets(spark, out_dir)
        else:
            raise ValueError(f"unknown stage {st}")
    return result


def main(argv: list[str] | None = None) -> None:
    from clickfeat.session import get_session

    ap = argparse.ArgumentParser(description="clickfeat stage plans")
    ap.add_argument("--dir", required=True, help="output folder (any Hadoop filesystem path)")
    ap.add_argument("--ads", help="ad catalogue, JSON lines")
    ap.add_argument("--clicks", help="click log, CSV without header")
    ap.add_argument("--stages", nargs="*", default=STAGES, choices=STAGES + OPTIONAL_STAGES)
    ap.add_argument("--gbt-iterations", type=int, default=ml.GBT_MAX_ITER)
    a = ap.parse_args(argv)
    spark = get_session()
    print(json.dumps(run(spark, a.dir, a.ads, a.clicks, a.stages, a.gbt_iterations)))


if __name__ == "__main__":
    main()
