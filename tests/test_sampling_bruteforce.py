"""Randomised catalogues checked against plain Python implementations of the
sequential samplers (the semantics the published loops have)."""

import random

from pyspark.sql import functions as F

from clickfeat.functions.random import hash_uniform
from clickfeat.operators import sampling as smp
from conftest import ads_df


def sequential_pick(weights, u):
    """Walk the items in order, cycling, until the running weight reaches u."""
    if sum(w for _, w in weights) <= 0:
        return None
    cum = 0.0
    while True:
        for k, w in weights:
            cum += w
            if u <= cum:
                return k


def test_weighted_draw_matches_sequential_walk(spark):
    rnd = random.Random(11)
    rows, probes, want = [], [], {}
    for g in range(30):
        n = rnd.randint(1, 6)
        ws = [(f"i{j}", rnd.choice([0.0, rnd.random() * rnd.choice([0.2, 1.0, 3.0])])) for j in range(n)]
        rows += [(g, k, j, w) for j, (k, w) in enumerate(ws)]
        for d in range(5):
            u = rnd.random()
            probes.append((g, d, u))
            pick = sequential_pick(ws, u)
            if pick is not None:
                want[(g, d)] = pick
    items = spark.createDataFrame(rows, "g bigint, item string, pos bigint, w double")
    b = smp.weighted_buckets(items, ["g"], "pos", "w")
    p = spark.createDataFrame(probes, "g bigint, d int, u double")
    got = {(r.g, r.d): r.item for r in smp.weighted_draw(p, b, ["g"], "u").collect()}
    assert got == want


def random_catalogue(seed):
    rnd = random.Random(seed)
    rows, pos = [], 0
    for _ in range(60):
        g = rnd.randint(1, 5)
        c = f"c{rnd.randint(1, 9)}"
        k = rnd.choice(["x", "y", "z"])
        rows.append((pos, c, g, f"q{pos}", k, ["q"], pos))
        pos += 1
    return rows


def test_neg_campaign_matches_brute_force(spark):
    for seed in (1, 2, 3):
        rows = random_catalogue(seed)
        ads = ads_df(spark, rows)
        u = {r.ad_id: (r.coin, r.camp) for r in ads.select(
            "ad_id", hash_uniform(42, F.lit("coin"), "ad_id").alias("coin"),
            hash_uniform(42, F.lit("camp"), "ad_id").alias("camp")).collect()}
        first = {}
        for a, c, g, *_rest in sorted(rows, key=lambda r: r[6]):
            first.setdefault((g, c), a)
        gfirst = {}
        for (g, c), p in first.items():
            gfirst[g] = min(gfirst.get(g, p), p)
        want = {}
        for a, c, g, *_ in rows:
            coin, uu = u[a]
            if coin < 0.5:
                cand = sorted((p, cc) for (gg, cc), p in first.items() if gg == g and cc != c)
                match = 1
            else:
                cand = sorted((gfirst[gg], gg, p, cc) for (gg, cc), p in first.items() if gg != g)
                match = 0
            if cand:
                want[a] = (cand[min(int(uu * len(cand)), len(cand) - 1)][-1], match)
        got = {r.src_ad_id: (r.campaign_id, r.cat_match) for r in smp.neg_campaign(ads, ads, 42).collect()}
        assert got == want


def test_neg_category_random_catalogues(spark):
    from test_sampling import brute_category
    for seed in (4, 5, 6):
        rows = random_catalogue(seed)
        ads = ads_df(spark, rows)
        us = {r.ad_id: r.u for r in ads.select("ad_id", hash_uniform(42, F.lit("cat"), "ad_id").alias("u")).collect()}
        got = {r.src_ad_id: r.campaign_id for r in smp.neg_category(ads, ads, 42).collect()}
        assert got == brute_category(rows, us)
