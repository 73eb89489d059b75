"""Samplers: closed buckets, cycles, candidates and brute-force checks."""

import itertools

import pytest
from pyspark.sql import functions as F

from clickfeat.operators import sampling as smp
from clickfeat.operators.users import user_cohorts
from clickfeat.sources.fixtures import ad_view
from conftest import SF_SMALL, ads_df


def draw(spark, weights, u):
    items = spark.createDataFrame([(1, k, i, w) for i, (k, w) in enumerate(weights)],
                                  "g bigint, item string, pos bigint, w double")
    b = smp.weighted_buckets(items, ["g"], "pos", "w")
    probes = spark.createDataFrame([(1, float(x)) for x in u], "g bigint, u double").withColumn(
        "probe", F.monotonically_increasing_id())
    return {r.u: r.item for r in smp.weighted_draw(probes, b, ["g"], "u").collect()}


def test_second_cycle_when_weights_sum_below_one(spark):
    assert draw(spark, [("a", 0.3), ("b", 0.3)], [0.7])[0.7] == "a"
    assert draw(spark, [("a", 0.3), ("b", 0.3)], [0.5])[0.5] == "b"


def test_bucket_edges_and_zero_weights(spark):
    got = draw(spark, [("a", 0.25), ("z", 0.0), ("b", 0.75)], [0.0, 0.25, 0.2500001, 1.0])
    assert got == {0.0: "a", 0.25: "a", 0.2500001: "b", 1.0: "b"}


def test_every_draw_hits_exactly_one_bucket(spark):
    ads = ad_view(spark, SF_SMALL)
    d = smp.campaign_draws(ads, 49, 42)
    groups = smp.campaign_buckets(ads).select("query_group_id").distinct().count()
    assert d.count() == groups * 49
    assert d.groupBy("query_group_id", "draw").count().where("count <> 1").count() == 0


def test_buckets_tile_with_chunking(spark):
    ads = ad_view(spark, SF_SMALL)
    from clickfeat.operators import catalogue as cat
    cw = cat.campaign_weights(ads).select("query_group_id", "campaign_id", "first_pos", "weight")
    a = {(r.query_group_id, r.campaign_id): (r.lo, r.hi)
         for r in smp.weighted_buckets(cw, ["query_group_id"], "first_pos", "weight", chunk_width=7).collect()}
    b = {(r.query_group_id, r.campaign_id): (r.lo, r.hi)
         for r in smp.weighted_buckets(cw, ["query_group_id"], "first_pos", "weight").collect()}
    assert a.keys() == b.keys()
    for k in a:
        assert a[k][0] == pytest.approx(b[k][0], abs=1e-12) and a[k][1] == pytest.approx(b[k][1], abs=1e-12)
    # adjacent buckets share the boundary exactly
    by_g = {}
    for (g, _), (lo, hi) in a.items():
        by_g.setdefault(g, []).append((lo, hi))
    for g, iv in by_g.items():
        iv.sort()
        assert iv[0][0] == 0.0
        for x, y in zip(iv, iv[1:]):
            assert x[1] == y[0]


def brute_category(ads_rows, seed_u):
    """Python brute force of the type-0 negative over a tiny catalogue."""
    camps = {}
    for a, c, g, q, k, kw, p in sorted(ads_rows, key=lambda r: r[6]):
        camps.setdefault(c, {"cfp": p})
        camps[c]["cat"] = k
    group_camps = {}
    for a, c, g, *_ in ads_rows:
        group_camps.setdefault(g, set()).add(c)
    out = {}
    for a, c, g, q, k, kw, p in ads_rows:
        cand = sorted((v["cat"], v["cfp"], cc) for cc, v in camps.items()
                      if v["cat"] != k and cc not in group_camps[g])
        if not cand:
            continue
        j = min(int(seed_u[a] * len(cand)), len(cand) - 1)
        out[a] = cand[j][2]
    return out


def test_neg_category_matches_brute_force(spark):
    rows = []
    pos = 0
    for g, c, k in itertools.product([1, 2, 3], ["c1", "c2", "c3", "c4", "c5"], ["x", "y"]):
        if (g + ord(c[1]) + ord(k)) % 3 == 0:
            continue
        rows.append((pos, c, g, f"q{pos}", k, ["q"], pos))
        pos += 1
    ads = ads_df(spark, rows)
    got = {r.src_ad_id: r.campaign_id for r in smp.neg_category(ads, ads, 42).collect()}
    from clickfeat.functions.random import hash_uniform
    us = {r.ad_id: r.u for r in ads.select("ad_id", hash_uniform(42, F.lit("cat"), "ad_id").alias("u")).collect()}
    assert got == brute_category(rows, us)
    # the picked campaign never belongs to the source's group and has another category
    camp_cat = {r.campaign_id: r.category for r in ads.groupBy("campaign_id").agg(
        F.max_by("category", "pos").alias("category")).collect()}
    groups = {}
    for a, c, g, *_ in rows:
        groups.setdefault(g, set()).add(c)
    src = {a: (g, k) for a, c, g, q, k, kw, p in rows}
    for a, c in got.items():
        assert c not in groups[src[a][0]] and camp_cat[c] != src[a][1]


def test_neg_campaign_properties(spark):
    ads = ad_view(spark, SF_SMALL)
    n = smp.neg_campaign(ads, ads, 42)
    joined = n.join(ads.select(F.col("ad_id").alias("src_ad_id"), F.col("query_group_id").alias("g"),
                               F.col("campaign_id").alias("own")), "src_ad_id")
    gc = ads.select(F.col("query_group_id").alias("g"), F.col("campaign_id")).distinct()
    same = joined.where("cat_match = 1")
    assert same.where("campaign_id = own").count() == 0
    assert same.join(gc, ["g", "campaign_id"], "left_anti").count() == 0
    other = joined.where("cat_match = 0")
    # the pick is a pair of another group: the campaign appears in some other group
    other_groups = gc.withColumnRenamed("g", "g2")
    assert other.join(other_groups, "campaign_id").where("g2 <> g").select("src_ad_id").distinct().count() \
        == other.count()


def test_negative_mix_and_guard(spark):
    ads = ad_view(spark, SF_SMALL)
    neg = smp.negative_rows(ads, seed=42)
    assert neg.where("clicked <> 0").count() == 0
    singles = ads.groupBy("campaign_id").count().where("count = 1").select("campaign_id")
    src_camp = ads.select(F.col("ad_id").alias("src_ad_id"), F.col("campaign_id").alias("sc"))
    assert neg.join(src_camp, "src_ad_id").join(singles.withColumnRenamed("campaign_id", "sc"), "sc").count() == 0


def test_cohort_sizes(spark):
    users = spark.createDataFrame([(str(i), i) for i in range(20)], "ip string, pos bigint")
    sizes = {r.level: r["count"] for r in user_cohorts(users).groupBy("level").count().collect()}
    assert sizes == {0: 2, 1: 5, 2: 6, 3: 7}


@pytest.mark.parametrize("parts", [1, 200])
def test_draws_independent_of_partitioning(spark, parts):
    ads = ad_view(spark, SF_SMALL)
    base = sorted(tuple(r) for r in smp.positive_draws(ads, 5, 42).collect())
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    try:
        again = sorted(tuple(r) for r in smp.positive_draws(ads.repartition(3), 5, 42).collect())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert base == again
