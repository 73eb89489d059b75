"""Ad catalogue: relevance, ad and campaign weights, ordered ad lists, maps.

Input: an ads DataFrame with columns ad_id, campaign_id, query_group_id,
query, category, title, keywords (array<string>) and pos (file position, the
order the published maps follow).

Per-group totals are partial aggregates joined back on the group key, never
windows: a window puts a whole (possibly huge) group in one task, while an
aggregate pre-combines map-side.  AQE does not split a join of rows to an aggregate on
the same key, so the joins back go through ``split_join``: a broadcast behind a size
check, beyond it salts for the frequent keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from clickfeat.functions.text import tokens
from clickfeat.operators.lookup import sized_join, split_join
from clickfeat.session import materialize

G, C, A = "query_group_id", "campaign_id", "ad_id"


def normalise(ads: DataFrame) -> DataFrame:
    """Lower-case query, category and title (keywords are used as given)."""
    out = ads
    for c in ("query", "category", "title"):
        if c in ads.columns:
            out = out.withColumn(c, F.lower(c))
    return out


def relevance_expr(query="query", keywords="keywords") -> F.Column:
    """(# query tokens found in the keyword set, with multiplicity) / (# distinct
    keywords).  Empty keyword list -> NULL (row is quarantined by callers)."""
    kw = F.col(keywords)
    matched = F.size(F.filter(tokens(query), lambda t: F.array_contains(kw, t)))
    n = F.size(F.array_distinct(kw))
    return F.when(n > 0, matched / n.cast("double"))


def with_relevance(ads: DataFrame) -> DataFrame:
    return ads.withColumn("relevance", relevance_expr())


def scored(ads: DataFrame) -> DataFrame:
    """Ads with a defined relevance (rows with empty keyword lists dropped)."""
    return with_relevance(ads).where(F.col("relevance").isNotNull())


def quarantined(ads: DataFrame) -> DataFrame:
    return with_relevance(ads).where(F.col("relevance").isNull())


def dedupe_last(ads: DataFrame, key: str | list[str] = A) -> DataFrame:
    """One row per ``key`` (an ad, or a list of columns), the last in file order wins (partial max_by aggregate)."""
    keys = [key] if isinstance(key, str) else key
    others = [c for c in ads.columns if c not in keys]
    agg = ads.groupBy(*keys).agg(F.max_by(F.struct(*others), F.col("pos")).alias("_r"))
    return agg.select(*keys, *[F.col("_r")[c].alias(c) for c in others])


def campaign_relevance(ads: DataFrame) -> DataFrame:
    """(group, campaign, total relevance, first_pos, n_ads)."""
    return scored(ads).groupBy(G, C).agg(
        F.sum("relevance").alias("campaign_total"),
        F.min("pos").alias("first_pos"),
        F.count(F.lit(1)).alias("n_ads"))


def group_relevance(ads: DataFrame) -> DataFrame:
    return campaign_relevance(ads).groupBy(G).agg(
        F.sum("campaign_total").alias("group_total"), F.count(F.lit(1)).alias("n_campaigns"),
        F.min("first_pos").alias("group_first_pos"))


def ad_weights(ads: DataFrame) -> DataFrame:
    """Each ad's share of its (group, campaign) relevance; a zero total leaves the
    raw score.  Columns: group, campaign, ad_id, pos, relevance, weight."""
    s = materialize(scored(ads).select(G, C, A, "pos", "relevance"), "scored")
    tot = s.groupBy(G, C).agg(F.sum("relevance").alias("_t"))
    return (sized_join(s, tot, [G, C], source=s)
             .withColumn("weight", F.when(F.col("_t") > 0, F.col("relevance") / F.col("_t"))
                                    .otherwise(F.col("relevance")))
             .drop("_t"))


def campaign_weights(ads: DataFrame) -> DataFrame:
    """Each campaign's share of its group's relevance; zero total leaves the raw
    campaign total.  Columns: group, campaign, first_pos, n_ads, campaign_total, weight."""
    camp = materialize(campaign_relevance(ads), "campaign_relevance")
    grp = camp.groupBy(G).agg(F.sum("campaign_total").alias("_gt"))
    return (sized_join(camp, grp, [G], source=camp)
                .withColumn("weight", F.when(F.col("_gt") > 0, F.col("campaign_total") / F.col("_gt"))
                                       .otherwise(F.col("campaign_total")))
                .drop("_gt"))


def campaign_weight_last(ads: DataFrame) -> DataFrame:
    """A campaign in several groups keeps the weight of the group that itself appeared last
    in the file -- the published single-key map, written group by group in that order."""
    w = campaign_weights(ads)
    first = ads.groupBy(G).agg(F.min("pos").alias("group_first_pos"))
    return split_join(w, first, [G]).groupBy(C).agg(F.max_by("weight", "group_first_pos").alias("weight"))


def group_campaign_ads(ads: DataFrame) -> DataFrame:
    """Normalised (group, campaign, ad, pos): ads of each pair, ordered by pos."""
    return ads.select(G, C, A, "pos")


def campaign_ads(ads: DataFrame) -> DataFrame:
    """All ads of each campaign, any group (clean form)."""
    return ads.select(C, A, "pos")


def campaign_ads_reset(ads: DataFrame) -> DataFrame:
    """Faithful form of the published campaign -> ads map: the list restarts each
    time the campaign first appears in another group, so only ads at or after
    the last such first appearance remain."""
    first = ads.groupBy(G, C).agg(F.min("pos").alias("_fp"))
    reset = first.groupBy(C).agg(F.max("_fp").alias("_reset"))
    return (split_join(ads.select(C, A, "pos"), reset, [C])
               .where(F.col("pos") >= F.col("_reset")).drop("_reset"))


def group_queries(ads: DataFrame) -> DataFrame:
    """Distinct (group, query) pairs."""
    return ads.select(G, "query").distinct()


def group_queries_dropfirst(ads: DataFrame) -> DataFrame:
    """Faithful form: the group's first ad only creates the group, its query is
    recorded only if it occurs again."""
    first = ads.groupBy(G).agg(F.min("pos").alias("_fp"))
    return (split_join(ads.select(G, "query", "pos"), first, [G])
               .where(F.col("pos") > F.col("_fp")).select(G, "query").distinct())


def campaign_category(ads: DataFrame) -> DataFrame:
    """Last category per campaign (file order)."""
    return ads.groupBy(C).agg(F.max_by("category", "pos").alias("category"))


def ad_last_score(ads: DataFrame) -> DataFrame:
    """Last raw relevance per ad id (file order)."""
    return scored(ads).groupBy(A).agg(F.max_by("relevance", "pos").alias("relevance"))


def distinct_queries(ads: DataFrame) -> DataFrame:
    return ads.select("query").where(F.col("query").isNotNull()).distinct()


def lowest_weight_ad(ads: DataFrame) -> DataFrame:
    """Per group with more than one campaign: the campaign of lowest weight
    (strictly below 1.0, ties -> first appearance), then, if that campaign owns more than
    one ad in all groups together, the ad of lowest weight (strictly below 1.0, ties -> file
    order) among all of them.  Every argmin is a partial aggregate of a min(struct)."""
    cw = campaign_weights(ads)
    best_c = cw.groupBy(G).agg(F.count(F.lit(1)).alias("_nc"), F.min(F.when(F.col("weight") < 1.0, F.struct(
        F.round("weight", 9).alias("w"), F.col("first_pos"), F.col(C)))).alias("_b"))
    best_c = best_c.where((F.col("_nc") > 1) & F.col("_b").isNotNull()).select(G, F.col(f"_b.{C}").alias(C))
    owns = ads.groupBy(C).agg(F.count(F.lit(1)).alias("_own")).where(F.col("_own") > 1).select(C)
    aw = ad_weights(ads).where(F.col("weight") < 1.0)
    best_a = aw.groupBy(C).agg(F.min(F.struct(F.round("weight", 9).alias("w"), F.col("pos"), F.col(A))).alias("_a"))
    return best_c.join(owns, C, "left_semi").join(best_a, C).select(G, C, F.col(f"_a.{A}").alias(A))
