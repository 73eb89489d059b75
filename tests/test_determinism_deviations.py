"""Same answers with 1, 8 and 200 shuffle partitions; deviations D4, D10, D14."""

import pytest
from clickfeat.operators import sampling as smp
from clickfeat.operators import text as tx
from clickfeat.operators.rewrites import rewrite_lines, rewrite_rows
from clickfeat.plans.registry import QUERIES, load_all
from conftest import SF_SMALL, ads_df

load_all()
NAMES = ["all_counters", "training_vectors", "negative_rows", "query_rewrites", "cosine_top5",
         "group_campaign_ads", "user_cohorts", "neg_campaign"]


def rows(spark, name):
    return sorted((tuple(r) for r in QUERIES[name](spark, SF_SMALL).collect()), key=repr)


@pytest.mark.parametrize("name", NAMES)
def test_partition_count_does_not_change_results(spark, name):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    outs = []
    try:
        for n in (1, 8, 200):
            spark.conf.set("spark.sql.shuffle.partitions", str(n))
            outs.append(rows(spark, name))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert outs[0] == outs[1] == outs[2]


def test_zero_weight_group_draws_nothing(spark):
    # group 1: no ad matches its keywords -> all weights 0 -> no draws (D4); group 2 draws
    df = ads_df(spark, [(1, "c", 1, "q", "x", ["z"], 0), (2, "d", 1, "q", "x", ["y"], 1),
                        (3, "e", 2, "q", "x", ["q"], 2)])
    d = smp.campaign_draws(df, 10, 42)
    assert {r.query_group_id for r in d.collect()} == {2}
    assert smp.positive_draws(df, 10, 42).where("query_group_id = 1").count() == 0


def test_rewrites_lowercase_flag(spark):
    q = spark.createDataFrame([("Nike Shoes",)], "query string")
    syn = spark.createDataFrame([("nike", ["adidas", "nike"])], "word string, synonyms array<string>")
    assert rewrite_lines(rewrite_rows(q, syn)).first().rewrites == ["Nike_Shoes"]                         # as given (D10)
    assert rewrite_lines(rewrite_rows(q, syn, lowercase=True)).first().rewrites == ["adidas_shoes", "nike_shoes"]


def test_empty_cleaned_query_and_empty_tokens(spark):
    ads = spark.createDataFrame([(1, "42 a", "Red Shoes 9")], "ad_id bigint, query string, title string")
    s = tx.sentences(ads, keep=["ad_id"]).first().sentence
    assert s == " red shoes"                       # the separator stays, as written (D14)
    w = tx.sentence_words(tx.sentences(ads)).first().words
    assert w == ["red", "shoes"]                   # but no empty token enters the corpus
    v = tx.vocabulary(spark.createDataFrame([(["a"] * 5 + ["b"] * 4,)], "words array<string>"), 5)
    assert [(r.word, r.n) for r in v.collect()] == [("a", 5)]


def test_only_empty_queries_are_rejected(spark):
    from clickfeat.operators import sampling as smp
    rows = [(i, "c", 1, "" if i % 2 else " ", "x", ["q"], i) for i in range(40)]
    got = {r.src_ad_id for r in smp.negative_rows(ads_df(spark, rows), seed=42).collect()}
    empty = {i for i in range(40) if i % 2}
    assert got and not (got & empty)          # exactly-empty queries never emit; " " does
