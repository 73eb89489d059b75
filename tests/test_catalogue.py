"""Hand goldens for relevance, weights and the order-dependent maps."""

import pytest
from pyspark.sql import functions as F

from clickfeat.operators import catalogue as cat
from conftest import ads_df


def rel(spark, query, keywords):
    df = ads_df(spark, [(1, "c", 1, query, "x", keywords, 0)])
    return cat.with_relevance(df).select("relevance").first()[0]


def test_relevance_counts_repeated_tokens(spark):
    assert rel(spark, "shoes shoes", ["shoes"]) == 2.0


def test_relevance_keywords_case_sensitive(spark):
    assert rel(spark, "nike", ["Nike"]) == 0.0


def test_relevance_distinct_keywords(spark):
    assert rel(spark, "a", ["a", "a", "b"]) == 0.5


def test_empty_keywords_quarantined(spark):
    df = ads_df(spark, [(1, "c", 1, "a", "x", [], 0), (2, "c", 1, "a", "x", ["a"], 1)])
    assert [r.ad_id for r in cat.quarantined(df).collect()] == [1]
    assert [r.ad_id for r in cat.scored(df).collect()] == [2]


def test_zero_total_campaign_keeps_zero_weights(spark):
    df = ads_df(spark, [(1, "c", 1, "q", "x", ["z"], 0), (2, "c", 1, "q", "x", ["y"], 1),
                        (3, "d", 1, "q", "x", ["q"], 2)])
    aw = {r.ad_id: r.weight for r in cat.ad_weights(df).collect()}
    assert aw[1] == 0.0 and aw[2] == 0.0 and aw[3] == 1.0
    cw = {r.campaign_id: r.weight for r in cat.campaign_weights(df).collect()}
    assert cw == {"c": 0.0, "d": 1.0}


def test_weights_sum_to_one_per_group(spark):
    from conftest import SF_CHECK
    from clickfeat.sources.fixtures import ad_view
    ads = ad_view(spark, SF_CHECK)
    cw = cat.campaign_weights(ads)
    sums = cw.groupBy("query_group_id").agg(F.sum("weight").alias("s"), F.sum("campaign_total").alias("t"))
    for r in sums.collect():
        if r.t > 0:
            assert r.s == pytest.approx(1.0, abs=1e-9)
    aw = cat.ad_weights(ads).groupBy("query_group_id", "campaign_id").agg(F.sum("weight").alias("s"),
                                                                          F.sum("relevance").alias("t"))
    for r in aw.collect():
        if r.t > 0:
            assert r.s == pytest.approx(1.0, abs=1e-9)


def test_campaign_in_two_groups_reset_and_clean(spark):
    df = ads_df(spark, [(1, "c", 1, "q", "x", ["q"], 0), (2, "c", 2, "q", "x", ["q"], 1),
                        (3, "c", 1, "q", "x", ["q"], 2)])
    assert sorted(r.ad_id for r in cat.campaign_ads_reset(df).collect()) == [2, 3]
    assert sorted(r.ad_id for r in cat.campaign_ads(df).collect()) == [1, 2, 3]


def test_campaign_weight_last_group_wins(spark):
    df = ads_df(spark, [(1, "c", 1, "q", "x", ["q"], 0), (2, "d", 1, "q", "x", ["q", "r"], 1),
                        (3, "c", 2, "q", "x", ["q"], 2)])
    last = {r.campaign_id: r.weight for r in cat.campaign_weight_last(df).collect()}
    assert last["c"] == 1.0   # group 2 (appeared last) has c alone


def test_campaign_weight_last_follows_the_groups_first_appearance(spark):
    # c enters group 2 before group 1, but group 1 appears first in the file: group 2's weight stays
    df = ads_df(spark, [(1, "d", 1, "q", "x", ["q"], 0), (2, "c", 2, "q", "x", ["q"], 1), (3, "e", 2, "q", "x", ["q"], 2),
                        (4, "e", 2, "q", "x", ["q"], 3), (5, "e", 2, "q", "x", ["q"], 4), (6, "c", 1, "q", "x", ["q", "r"], 5)])
    last = {r.campaign_id: r.weight for r in cat.campaign_weight_last(df).collect()}
    assert last["c"] == pytest.approx(0.25)


def test_lowest_weight_looks_at_all_ads_of_the_campaign(spark):
    # c is the lowest campaign of group 1 with one ad there, but owns two more in group 2
    df = ads_df(spark, [(1, "c", 1, "q", "x", ["q", "r", "s"], 0), (2, "d", 1, "q", "x", ["q"], 1), (3, "c", 2, "q", "x", ["q"], 2),
                        (4, "c", 2, "q", "x", ["q", "r"], 3)])
    got = {r.query_group_id: (r.campaign_id, r.ad_id) for r in cat.lowest_weight_ad(df).collect()}
    assert got == {1: ("c", 4)}


def test_memberships_are_kept(spark):
    df = ads_df(spark, [(1, "c", 1, "q", "x", ["q"], 0), (1, "c", 2, "q", "x", ["q"], 1), (1, "c", 1, "r", "x", ["q"], 2)])
    got = sorted((r.query_group_id, r.query) for r in cat.dedupe_last(df, [cat.G, cat.C, cat.A]).collect())
    assert got == [(1, "r"), (2, "q")]


def test_first_query_of_group_dropped(spark):
    df = ads_df(spark, [(1, "c", 1, "q1", "x", ["q1"], 0), (2, "c", 1, "q2", "x", ["q2"], 1),
                        (3, "c", 1, "q1", "x", ["q1"], 2)])
    assert sorted(r.query for r in cat.group_queries_dropfirst(df).collect()) == ["q1", "q2"]
    df2 = ads_df(spark, [(1, "c", 1, "q1", "x", ["q1"], 0), (2, "c", 1, "q2", "x", ["q2"], 1)])
    assert [r.query for r in cat.group_queries_dropfirst(df2).collect()] == ["q2"]
    assert sorted(r.query for r in cat.group_queries(df2).collect()) == ["q1", "q2"]


def test_last_category_and_score(spark):
    df = ads_df(spark, [(1, "c", 1, "q", "Shoes", ["q"], 0), (2, "c", 1, "q", "bags", ["z"], 1)])
    assert cat.campaign_category(df).first().category == "bags"


def test_dedupe_last_wins(spark):
    df = ads_df(spark, [(1, "c", 1, "first", "x", ["q"], 0), (1, "c", 1, "second", "x", ["q"], 5)])
    assert cat.dedupe_last(df).first().query == "second"


def test_lowest_weight_ties_first_in_order(spark):
    # group 1: campaigns c (weight 0.5) and d (0.5) tie -> c (first); inside c ads 1, 2 tie -> 1
    df = ads_df(spark, [(1, "c", 1, "q", "x", ["q"], 0), (2, "c", 1, "q", "x", ["q"], 1),
                        (3, "d", 1, "q", "x", ["q"], 2), (4, "d", 1, "q", "x", ["q"], 3)])
    r = cat.lowest_weight_ad(df).collect()
    assert [(x.campaign_id, x.ad_id) for x in r] == [("c", 1)]


def test_lowest_weight_needs_two_ads(spark):
    df = ads_df(spark, [(1, "c", 1, "q", "x", ["q"], 0), (3, "d", 1, "q", "x", ["q", "z"], 2),
                        (4, "d", 1, "q", "x", ["q"], 3)])
    # c has weight 1/2.5 ... lowest is c (0.4 < 0.6) but c owns one ad -> nothing
    assert cat.lowest_weight_ad(df).count() == 0
