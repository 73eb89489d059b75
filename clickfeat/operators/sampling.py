"""Repeatable samplers over the ad catalogue.

Every draw is a seeded uniform of its own key (functions/random.py), so a draw
never depends on partitioning, retries or row order.  Nothing explodes a
candidate list per draw:

* weighted draws: cumulative-weight buckets per group + interval lookup
  (operators/intervals.py); a group whose weights sum below 1 continues into a
  further cycle of the same buckets, as the sequential sampler does.
* uniform picks: candidates are numbered once; a draw computes an index and
  finds its candidate by an equi-join on (set, index).
* "any campaign of another group": pairs are numbered globally in (group,
  campaign) order; the own group's block is contiguous, so the index skips it
  arithmetically.
* "a campaign of another category outside my group": campaigns are numbered in
  (category, first appearance) order; the own category is one contiguous
  block, the own group's campaigns are a short sorted list of holes skipped by
  an interval lookup.

Columns: ads have ad_id, campaign_id, query_group_id, query, category, pos.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from clickfeat.functions.random import hash_uniform, pick_index
from clickfeat.operators import catalogue as cat
from clickfeat.operators.indexing import rank_within, with_global_index
from clickfeat.operators.intervals import interval_lookup
from clickfeat.operators.lookup import sized_join, split_join
from clickfeat.session import cut_lineage, materialize

G, C, A = "query_group_id", "campaign_id", "ad_id"

# Negative type mix (type: share) and the two branch shares.
NEGATIVE_TYPE_SHARES = [(0, 0.2), (1, 0.1), (2, 0.3), (3, 0.4)]
LEVEL1_POSITIVE_SHARE = 0.7
LEVEL2_POSITIVE_SHARE = 0.5
SAME_GROUP_SHARE = 0.5


# ------------------------------------------------------------------ weighted buckets
def weighted_buckets(items: DataFrame, keys: list[str], order_col: str, weight_col: str,
                     chunk_width: int = 100000) -> DataFrame:
    """(keys..., item columns..., lo, hi, total, nbins) for items of positive weight,
    buckets (lo, hi] tiling (0, total] exactly in ``order_col`` order.

    ``order_col`` is an integer position unique inside a group.  The running sum
    is chunked by floor(order / chunk_width) (at most chunk_width rows per
    window task, see intervals.prefix_sum); the first bucket of a chunk starts
    exactly at the last ``hi`` of the group's previous chunk."""
    pos = items.where(F.col(weight_col) > 0).withColumn("_ch", F.floor(F.col(order_col) / chunk_width))
    tot = pos.groupBy(*keys, "_ch").agg(F.sum(weight_col).alias("_ct"))
    wg = Window.partitionBy(*keys).orderBy("_ch")
    chunks = tot.select(*keys, "_ch",
                        F.coalesce(F.sum("_ct").over(wg.rowsBetween(Window.unboundedPreceding, -1)),
                                   F.lit(0.0)).alias("_cb"),
                        F.lag("_ch").over(wg).alias("_pch"))
    wc = Window.partitionBy(*keys, "_ch").orderBy(order_col)
    run = (pos.join(chunks, list(keys) + ["_ch"])
              .withColumn("hi", F.col("_cb") + F.sum(weight_col).over(wc.rowsBetween(Window.unboundedPreceding, 0))))
    run = run.withColumn("_prev", F.lag("hi").over(wc))
    last = run.groupBy(*keys, "_ch").agg(F.max("hi").alias("_lasthi")).withColumnRenamed("_ch", "_pch")
    b = (run.join(last, list(keys) + ["_pch"], "left")
            .withColumn("lo", F.coalesce("_prev", "_lasthi", F.lit(0.0))))
    summary = b.groupBy(*keys).agg(F.max("hi").alias("total"), F.count(F.lit(1)).alias("nbins"))
    return sized_join(b.drop("_ch", "_ct", "_cb", "_pch", "_prev", "_lasthi"), summary, list(keys), source=items)


def fold_cycles(u, total):
    """Position of u inside the cycle it falls in when walking the buckets
    repeatedly: (0, total]; u = 0 selects the first bucket."""
    k = F.ceil(u / total) - 1
    folded = F.when(u <= total, u).otherwise(u - total * k)
    return F.least(F.greatest(folded, F.lit(1e-300)), total)


def weighted_draw(probes: DataFrame, buckets: DataFrame, keys: list[str], u_col: str) -> DataFrame:
    """Each probe (keys, u) picks the bucket holding its (cycle-folded) u.
    Probes of groups without positive weight get no row."""
    summary = buckets.select(*keys, "total", "nbins").distinct()
    p = sized_join(probes, summary, list(keys), source=buckets).withColumn("_x", fold_cycles(F.col(u_col), F.col("total")))
    return interval_lookup(p, buckets, keys, "_x").drop("_x", "lo", "hi")


def campaign_buckets(ads: DataFrame) -> DataFrame:
    """Campaign buckets per group, campaigns in first-appearance order.  The
    weights and the buckets are catalogue-sized tables read by several
    branches: each is written once (parquet in the checkpoint folder)."""
    cw = materialize(cat.campaign_weights(ads).select(G, C, "first_pos", "weight"), "campaign_weights")
    return materialize(weighted_buckets(cw, [G], "first_pos", "weight"), "campaign_buckets")


def ad_buckets(ads: DataFrame) -> DataFrame:
    aw = materialize(cat.ad_weights(ads).select(G, C, A, "pos", "weight"), "ad_weights")
    return materialize(weighted_buckets(aw, [G, C], "pos", "weight"), "ad_buckets")


def cumulative_weights(ads: DataFrame) -> DataFrame:
    return campaign_buckets(ads).select(G, C, "lo", "hi")


def campaign_draws(ads: DataFrame, n_draws: int = 49, seed: int = 42) -> DataFrame:
    """``n_draws`` weighted campaign draws per group: (group, draw, campaign)."""
    cb = campaign_buckets(ads)
    groups = cb.select(G).distinct()
    probes = groups.select(G, F.explode(F.sequence(F.lit(1), F.lit(n_draws))).alias("draw"))
    probes = probes.withColumn("u", hash_uniform(seed, G, "draw"))
    return weighted_draw(probes, cb.select(G, C, "lo", "hi", "total", "nbins"), [G], "u").select(G, "draw", C)


def positive_draws(ads: DataFrame, n_draws: int = 49, seed: int = 42) -> DataFrame:
    """Two-stage draw per (group, draw): campaign by campaign weight, then ad by
    ad weight inside it; the row is the ad's query, shown and clicked."""
    cd = campaign_draws(ads, n_draws, seed)
    ab = ad_buckets(ads).select(G, C, A, "lo", "hi", "total", "nbins")
    probes = cd.withColumn("u", hash_uniform(seed, F.lit("ad"), G, "draw"))
    picked = weighted_draw(probes, ab, [G, C], "u").select(G, "draw", C, A)
    q = cat.dedupe_last(ads.select(A, "query", "pos")).select(A, "query")
    return (picked.join(q, A)
                  .where(F.col("query").isNotNull() & (F.col("query") != ""))
                  .select(G, "draw", "query", A, C, F.lit(1).alias("cat_match"), F.lit(1).alias("clicked")))


def draw_frequency(ads: DataFrame, n_draws: int = 1000, seed: int = 42) -> DataFrame:
    """Empirical share of each campaign among ``n_draws`` draws of its group."""
    d = campaign_draws(ads, n_draws, seed)
    return d.groupBy(G, C).agg((F.count(F.lit(1)) / F.lit(float(n_draws))).alias("share"))


def all_positives(ads: DataFrame) -> DataFrame:
    """Every (campaign, ad) of every group once, shown and clicked."""
    return ads.select(G, C, A, "query", F.lit(1).alias("cat_match"), F.lit(1).alias("clicked"))


# ------------------------------------------------------------------ uniform picks
def campaign_ad_index(ads: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(campaign, idx, ad) numbered by pos, and (campaign, n_ads)."""
    ca = cut_lineage(rank_within(ads.select(C, A, "pos"), [C], ["pos"], "idx").select(C, "idx", A))
    n = ca.groupBy(C).agg(F.count(F.lit(1)).alias("n_ads"))
    return ca, n


def pick_ad_of_campaign(picks: DataFrame, ads: DataFrame, u_col: str, campaign_col: str = "neg_campaign",
                        out_col: str = "neg_ad", index=None) -> DataFrame:
    """Uniform ad of the picked campaign (all its ads, file order).  ``index``:
    a precomputed campaign_ad_index(ads) to share between callers."""
    ca, n = index or campaign_ad_index(ads)
    p = (sized_join(picks, n.withColumnRenamed(C, campaign_col), [campaign_col], source=ca)
         .withColumn("_i", pick_index(F.col(u_col), F.col("n_ads"))).drop("n_ads"))
    ads_of = ca.select(F.col(C).alias(campaign_col), F.col("idx").alias("_i"), F.col(A).alias(out_col))
    return sized_join(p, ads_of, [campaign_col, "_i"]).drop("_i")


def uniform_pick(ads: DataFrame, seed: int = 42) -> DataFrame:
    """One uniformly chosen ad per campaign: (campaign_id, ad_id)."""
    camps = ads.select(F.col(C).alias("neg_campaign")).distinct()
    camps = camps.withColumn("u", hash_uniform(seed, F.lit("pick"), "neg_campaign"))
    out = pick_ad_of_campaign(camps, ads, "u")
    return out.select(F.col("neg_campaign").alias(C), F.col("neg_ad").alias(A))


# ------------------------------------------------------------------ candidate tables
def _group_campaigns(ads: DataFrame) -> DataFrame:
    """(group, campaign, first_pos of the pair, group first_pos)."""
    gc = ads.groupBy(G, C).agg(F.min("pos").alias("first_pos"))
    gf = gc.groupBy(G).agg(F.min("first_pos").alias("group_first_pos"))
    return split_join(gc, gf, [G])


def _campaigns(ads: DataFrame) -> DataFrame:
    """(campaign, last category, first appearance) over the whole catalogue."""
    return ads.groupBy(C).agg(F.max_by("category", "pos").alias("ccat"), F.min("pos").alias("cfp"))


def same_group_candidates(ads: DataFrame) -> DataFrame:
    """(group, campaign, n_candidates): other campaigns of the same group."""
    gc = _group_campaigns(ads)
    m = gc.groupBy(G).agg(F.count(F.lit(1)).alias("m"))
    return split_join(gc, m, [G]).select(G, C, (F.col("m") - 1).alias("n_candidates"))


def other_group_candidates(ads: DataFrame) -> DataFrame:
    """(group, n_candidates): (group, campaign) pairs of all other groups."""
    gc = _group_campaigns(ads)
    m = gc.groupBy(G).agg(F.count(F.lit(1)).alias("m"))
    tot = gc.agg(F.count(F.lit(1))).scalar()
    return m.select(G, (tot - F.col("m")).alias("n_candidates"))


def _category_layout(ads: DataFrame):
    camps = cut_lineage(with_global_index(_campaigns(ads), ["ccat", "cfp", C], "P"))
    stats = camps.groupBy("ccat").agg(F.min("P").alias("start_k"), F.count(F.lit(1)).alias("m_k"))
    return camps, stats


def _category_demand(sources: DataFrame, ads: DataFrame):
    """Per demanded (group, category): holes (own-group campaigns of another
    category) in the category-complement numbering, and the candidate count."""
    camps, stats = _category_layout(ads)
    n_camps = camps.count()  # camps is materialised: a metadata-sized count
    demand = sources.select(G, F.col("category").alias("k")).distinct()
    demand = (demand.join(stats.withColumnRenamed("ccat", "k"), "k", "left")
                    .fillna({"m_k": 0}))
    gc = ads.select(G, C).distinct().join(camps.select(C, "ccat", "P"), C)
    holes = (demand.join(gc, G).where(F.col("ccat") != F.col("k"))
                   .withColumn("h", F.when(F.col("start_k").isNull() | (F.col("P") < F.col("start_k")), F.col("P"))
                                     .otherwise(F.col("P") - F.col("m_k")))
                   .select(G, "k", "h"))
    nh = holes.groupBy(G, "k").agg(F.count(F.lit(1)).alias("nh"))
    demand = (demand.join(nh, [G, "k"], "left").fillna({"nh": 0})
                    .withColumn("n", F.lit(n_camps) - F.col("m_k") - F.col("nh")))
    return camps, cut_lineage(demand), cut_lineage(holes)


def category_candidates(ads: DataFrame) -> DataFrame:
    """(group, category, n_candidates) for every (group, category) of the ads."""
    _, demand, _ = _category_demand(ads, ads)
    return demand.select(G, F.col("k").alias("category"), F.col("n").alias("n_candidates"))


# ------------------------------------------------------------------ negatives
def neg_category(sources: DataFrame, ads: DataFrame, seed: int = 42, index=None) -> DataFrame:
    """Type 0: a campaign of another category that is not in the source's group
    (uniform, candidates in (category, first appearance) order), then a uniform
    ad of it; category match 0.  No candidate -> no row."""
    camps, demand, holes = _category_demand(sources, ads)
    # holes -> intervals of j (0-based candidate index) with constant skip count
    hr = rank_within(holes, [G, "k"], ["h"], "i").withColumn("v", F.col("h") - F.col("i"))
    nxt = hr.select(G, "k", (F.col("i") - 1).alias("i"), F.col("v").alias("v_next"))
    n_of = demand.select(G, "k", "n")
    iv = (hr.join(nxt, [G, "k", "i"], "left").join(n_of, [G, "k"])
            .select(G, "k", F.col("v").alias("a"), F.coalesce("v_next", "n").alias("b"),
                    (F.col("i") + 1).alias("skip")))
    first = (demand.join(hr.where(F.col("i") == 0).select(G, "k", "v"), [G, "k"], "left")
                   .select(G, "k", F.lit(0).cast("bigint").alias("a"), F.coalesce("v", "n").alias("b"),
                           F.lit(0).cast("bigint").alias("skip")))
    intervals = (iv.unionByName(first).where(F.col("b") > F.col("a"))
                   .join(demand.select(G, "k", "n"), [G, "k"])
                   .select(G, "k", F.col("a").cast("double").alias("lo"), F.col("b").cast("double").alias("hi"),
                           F.col("n").cast("double").alias("total"), "skip"))
    nb = intervals.groupBy(G, "k").agg(F.count(F.lit(1)).alias("nbins"))
    intervals = cut_lineage(intervals.join(nb, [G, "k"]))
    nb = intervals.select(G, "k", "nbins").distinct()
    src = sized_join(sources.select(F.col(A).alias("src_ad_id"), G, F.col("category").alias("k")),
                     demand.where(F.col("n") > 0).select(G, "k", "n", "start_k", "m_k"), [G, "k"], source=demand)
    src = (src.withColumn("j", pick_index(hash_uniform(seed, F.lit("cat"), "src_ad_id"), F.col("n")))
              .withColumn("_x", (F.col("j") + 1).cast("double")))
    src = sized_join(src, nb, [G, "k"], source=intervals).withColumn("total", F.col("n").cast("double"))
    hit = interval_lookup(src, intervals, [G, "k"], "_x")
    hit = hit.withColumn("p", F.col("j") + F.col("skip"))
    hit = hit.withColumn("P", F.when(F.col("start_k").isNull() | (F.col("p") < F.col("start_k")), F.col("p"))
                              .otherwise(F.col("p") + F.col("m_k")))
    picked = sized_join(hit, camps.select("P", F.col(C).alias("neg_campaign")), ["P"], source=camps).select("src_ad_id", "neg_campaign")
    picked = picked.withColumn("u_ad", hash_uniform(seed, F.lit("cat_ad"), "src_ad_id"))
    out = pick_ad_of_campaign(picked, ads, "u_ad", index=index)
    return out.select("src_ad_id", F.col("neg_ad").alias(A), F.col("neg_campaign").alias(C),
                      F.lit(0).alias("cat_match"))


def neg_campaign(sources: DataFrame, ads: DataFrame, seed: int = 42, index=None) -> DataFrame:
    """Type 1: a fair coin; heads -> another campaign of the same group (match 1),
    tails -> any (group, campaign) pair of another group (match 0), then a
    uniform ad of that campaign."""
    gc = _group_campaigns(ads)
    src = sources.select(F.col(A).alias("src_ad_id"), G, F.col(C).alias("own_c")).withColumn(
        "_coin", hash_uniform(seed, F.lit("coin"), "src_ad_id"))
    u = hash_uniform(seed, F.lit("camp"), "src_ad_id")

    # heads: same group, own campaign skipped by rank
    ranked = cut_lineage(rank_within(gc.select(G, C, "first_pos"), [G], ["first_pos"], "r"))
    m = ranked.groupBy(G).agg(F.count(F.lit(1)).alias("m"))
    heads = sized_join(src.where(F.col("_coin") < SAME_GROUP_SHARE), m, [G], source=ranked).where(F.col("m") > 1)
    heads = sized_join(heads, ranked.select(G, F.col(C).alias("own_c"), F.col("r").alias("own_r")), [G, "own_c"], source=ranked)
    heads = (heads.withColumn("j", pick_index(u, F.col("m") - 1))
                  .withColumn("r", F.when(F.col("j") < F.col("own_r"), F.col("j")).otherwise(F.col("j") + 1)))
    heads = (sized_join(heads, ranked.select(G, "r", F.col(C).alias("neg_campaign")), [G, "r"], source=ranked)
             .select("src_ad_id", "neg_campaign", F.lit(1).alias("cat_match")))

    # tails: other groups, own block skipped by index shift
    pairs = cut_lineage(with_global_index(gc.select(G, C, "first_pos", "group_first_pos"),
                                          ["group_first_pos", G, "first_pos", C], "i"))
    blocks = pairs.groupBy(G).agg(F.min("i").alias("s"), F.count(F.lit(1)).alias("mg"))
    tot = pairs.count()
    tails = sized_join(src.where(F.col("_coin") >= SAME_GROUP_SHARE), blocks, [G], source=pairs)
    tails = (tails.withColumn("n", tot - F.col("mg")).where(F.col("n") > 0)
                  .withColumn("j", pick_index(u, F.col("n")))
                  .withColumn("i", F.when(F.col("j") < F.col("s"), F.col("j")).otherwise(F.col("j") + F.col("mg"))))
    tails = (sized_join(tails, pairs.select("i", F.col(C).alias("neg_campaign")), ["i"], source=pairs)
             .select("src_ad_id", "neg_campaign", F.lit(0).alias("cat_match")))

    picked = heads.unionByName(tails).withColumn("u_ad", hash_uniform(seed, F.lit("camp_ad"), "src_ad_id"))
    out = pick_ad_of_campaign(picked, ads, "u_ad", index=index)
    return out.select("src_ad_id", F.col("neg_ad").alias(A), F.col("neg_campaign").alias(C), "cat_match")


def neg_lowest(sources: DataFrame, ads: DataFrame) -> DataFrame:
    """Type 2: the lowest-weight ad of the lowest-weight campaign of the group; match 1."""
    low = cat.lowest_weight_ad(ads).select(G, F.col(C).alias("neg_campaign"), F.col(A).alias("neg_ad"))
    return (split_join(sources.select(F.col(A).alias("src_ad_id"), G), low, [G])
                   .select("src_ad_id", F.col("neg_ad").alias(A), F.col("neg_campaign").alias(C),
                           F.lit(1).alias("cat_match")))


def neg_noclick(sources: DataFrame) -> DataFrame:
    """Type 3: the matching ad itself, shown and not clicked; match 1."""
    return sources.select(F.col(A).alias("src_ad_id"), A, C, F.lit(1).alias("cat_match"))


def negative_type(u) -> F.Column:
    """Ladder over the fixed type shares (cumulative, in type order)."""
    expr = None
    cum = 0.0
    for t, share in NEGATIVE_TYPE_SHARES[:-1]:
        cum += share
        expr = (F.when(u <= cum, F.lit(t)) if expr is None else expr.when(u <= cum, F.lit(t)))
    return expr.otherwise(F.lit(NEGATIVE_TYPE_SHARES[-1][0]))


def negative_rows(ads: DataFrame, sources: DataFrame | None = None, seed: int = 42) -> DataFrame:
    """One negative per source ad: type from the fixed mix, only for ads whose
    campaign owns more than one ad; query of the source ad, clicked 0."""
    ads = cut_lineage(ads)  # the catalogue feeds every branch: materialise it once
    sources = ads if sources is None else sources
    multi = ads.groupBy(C).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1).select(C)
    src = cut_lineage(sources.join(multi, C, "left_semi")
                             .withColumn("neg_type", negative_type(hash_uniform(seed, F.lit("type"), A))))
    index = campaign_ad_index(ads)
    parts = [
        neg_category(src.where(F.col("neg_type") == 0), ads, seed, index).withColumn("neg_type", F.lit(0)),
        neg_campaign(src.where(F.col("neg_type") == 1), ads, seed, index).withColumn("neg_type", F.lit(1)),
        neg_lowest(src.where(F.col("neg_type") == 2), ads).withColumn("neg_type", F.lit(2)),
        neg_noclick(src.where(F.col("neg_type") == 3)).withColumn("neg_type", F.lit(3)),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    q = src.select(F.col(A).alias("src_ad_id"), "query")
    return (out.join(q, "src_ad_id")
               .where(F.col("query").isNotNull() & (F.col("query") != "") & F.col(A).isNotNull()
                      & F.col(C).isNotNull())
               .select("src_ad_id", "neg_type", "query", A, C, "cat_match", F.lit(0).alias("clicked")))


def branch_choice(pairs: DataFrame, key_cols: list[str], seed: int = 42) -> DataFrame:
    """Per (device, group) decision: positive branch with 70 % (level 1) and
    50 % (level 2) probability."""
    u = hash_uniform(seed, F.lit("branch"), *key_cols)
    return pairs.select(*key_cols, (u < LEVEL1_POSITIVE_SHARE).cast("int").alias("positive_l1"),
                        (u < LEVEL2_POSITIVE_SHARE).cast("int").alias("positive_l2"))


# Budget range (inclusive) drawn per campaign.
BUDGET_MIN = 100
BUDGET_MAX = 2000


def campaign_budgets(ads: DataFrame, seed: int = 42) -> DataFrame:
    """A repeatable integer budget in [BUDGET_MIN, BUDGET_MAX] per catalogue
    campaign: (campaign_id, budget).  One partial aggregate (distinct)."""
    camps = ads.select(C).where(F.col(C).isNotNull()).distinct()
    u = hash_uniform(seed, F.lit("budget"), C)
    span = BUDGET_MAX - BUDGET_MIN + 1
    return camps.select(C, (F.lit(BUDGET_MIN) + pick_index(u, F.lit(span))).cast("int").alias("budget"))
