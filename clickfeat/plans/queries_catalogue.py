"""Catalogue stage queries over the ad view."""

from __future__ import annotations

from pyspark.sql import functions as F, types as T

from clickfeat.operators import catalogue as cat
from clickfeat.operators.indexing import rank_within
from clickfeat.plans.registry import register, sql_with
from clickfeat.schemas import AD, AD_REQUIRED_WEIGHTS
from clickfeat.sinks.files import nested_map_lines
from clickfeat.sources.files import parse_ads, parse_nested_map
from clickfeat.sources.fixtures import ad_view

G, C, A = "query_group_id", "campaign_id", "ad_id"
R9 = lambda c: F.round(c, 9)  # noqa: E731  (report rounding; the library keeps full precision)

REL_SQL = ("CASE WHEN len(list_distinct(keywords)) > 0 THEN "
           "len(list_filter(string_split(query, ' '), lambda t: list_contains(keywords, t)))::DOUBLE "
           "/ len(list_distinct(keywords)) END")
SCORED = [f"scored AS (SELECT *, {REL_SQL} AS relevance FROM ad)",
          "s AS (SELECT * FROM scored WHERE relevance IS NOT NULL)"]
CAMP = SCORED + [
    "camp AS (SELECT query_group_id, campaign_id, sum(relevance) AS campaign_total, min(pos) AS first_pos, "
    "count(*) AS n_ads FROM s GROUP BY 1, 2)",
    "grp AS (SELECT query_group_id, sum(campaign_total) AS gt FROM camp GROUP BY 1)",
    "cw AS (SELECT camp.*, CASE WHEN gt > 0 THEN campaign_total / gt ELSE campaign_total END AS weight "
    "FROM camp JOIN grp USING (query_group_id))",
    "tot AS (SELECT query_group_id, campaign_id, sum(relevance) AS t FROM s GROUP BY 1, 2)",
    "aw AS (SELECT s.query_group_id, s.campaign_id, s.ad_id, s.pos, s.relevance, "
    "CASE WHEN t > 0 THEN relevance / t ELSE relevance END AS weight FROM s JOIN tot USING (query_group_id, campaign_id))",
]

# Fixture ids: campaign ids are brand strings, so the JSON schema says string.
AD_FIXTURE_SCHEMA = T.StructType([f if f.name != "campaignId" else T.StructField("campaignId", T.StringType())
                                  for f in AD.fields])


def _ads(spark, sf_dir):
    return ad_view(spark, sf_dir)


@register("scan_ads", sql_with(["ad"], f"SELECT ad_id, campaign_id, query_group_id, category, query, title, "
                                       f"array_to_string(keywords, ' ') AS keywords, pos FROM ad"))
def q_scan_ads(spark, sf_dir):
    ads = _ads(spark, sf_dir)
    lines = ads.select(F.to_json(F.struct(
        F.col(A).alias("adId"), F.col(C).alias("campaignId"), G, "category", "query", "title",
        F.col("keywords").alias("keyWords"))).alias("value"), "pos")
    p = parse_ads(lines, AD_FIXTURE_SCHEMA, AD_REQUIRED_WEIGHTS)
    return p.select(A, C, G, "category", "query", "title", F.array_join("keywords", " ").alias("keywords"), "pos")


@register("ads_normalised", sql_with(["ad"], "SELECT ad_id, lower(query) AS query, lower(category) AS category, "
                                             "lower(title) AS title FROM ad"))
def q_ads_normalised(spark, sf_dir):
    return cat.normalise(_ads(spark, sf_dir)).select(A, "query", "category", "title")


@register("relevance", sql_with(["ad"], f"SELECT ad_id, round({REL_SQL}, 9) AS relevance FROM ad"))
def q_relevance(spark, sf_dir):
    return cat.with_relevance(_ads(spark, sf_dir)).select(A, R9("relevance").alias("relevance"))


@register("ad_weight", sql_with(["ad"], "SELECT query_group_id, campaign_id, ad_id, round(relevance, 9) AS relevance, "
                                        "round(weight, 9) AS weight FROM aw", CAMP))
def q_ad_weight(spark, sf_dir):
    w = cat.ad_weights(_ads(spark, sf_dir))
    return w.select(G, C, A, R9("relevance").alias("relevance"), R9("weight").alias("weight"))


@register("campaign_weight", sql_with(["ad"], "SELECT query_group_id, campaign_id, round(weight, 9) AS weight FROM cw",
                                      CAMP))
def q_campaign_weight(spark, sf_dir):
    return cat.campaign_weights(_ads(spark, sf_dir)).select(G, C, R9("weight").alias("weight"))


@register("campaign_weight_last", sql_with(["ad"], "SELECT campaign_id, round(arg_max(weight, gfp), 9) AS weight FROM cw "
                                           "JOIN (SELECT query_group_id, min(pos) AS gfp FROM ad GROUP BY 1) USING (query_group_id) GROUP BY 1", CAMP))
def q_campaign_weight_last(spark, sf_dir):
    return cat.campaign_weight_last(_ads(spark, sf_dir)).select(C, R9("weight").alias("weight"))


@register("campaign_relevance", sql_with(["ad"], "SELECT query_group_id, campaign_id, round(campaign_total, 9) AS "
                                         "campaign_total, first_pos, n_ads FROM camp", CAMP))
def q_campaign_relevance(spark, sf_dir):
    return cat.campaign_relevance(_ads(spark, sf_dir)).select(
        G, C, R9("campaign_total").alias("campaign_total"), "first_pos", "n_ads")


@register("group_relevance", sql_with(["ad"], "SELECT query_group_id, round(sum(campaign_total), 9) AS group_total, "
                                      "count(*) AS n_campaigns, min(first_pos) AS group_first_pos FROM camp GROUP BY 1",
                                      CAMP))
def q_group_relevance(spark, sf_dir):
    return cat.group_relevance(_ads(spark, sf_dir)).select(
        G, R9("group_total").alias("group_total"), "n_campaigns", "group_first_pos")


@register("group_campaign_ads", sql_with(["ad"], "SELECT query_group_id, campaign_id, ad_id, pos, "
                                         "CAST(row_number() OVER (PARTITION BY query_group_id, campaign_id ORDER BY pos) - 1 "
                                         "AS BIGINT) AS ad_rank FROM ad"))
def q_group_campaign_ads(spark, sf_dir):
    return rank_within(cat.group_campaign_ads(_ads(spark, sf_dir)), [G, C], ["pos"], "ad_rank")


@register("campaign_ads", sql_with(["ad"], "SELECT campaign_id, ad_id, pos FROM ad"))
def q_campaign_ads(spark, sf_dir):
    return cat.campaign_ads(_ads(spark, sf_dir))


@register("campaign_ads_reset", sql_with(["ad"], """SELECT a.campaign_id, a.ad_id, a.pos FROM ad a
JOIN (SELECT campaign_id, max(fp) AS reset FROM
        (SELECT query_group_id, campaign_id, min(pos) AS fp FROM ad GROUP BY 1, 2) GROUP BY 1) r
  ON r.campaign_id = a.campaign_id
WHERE a.pos >= r.reset"""))
def q_campaign_ads_reset(spark, sf_dir):
    return cat.campaign_ads_reset(_ads(spark, sf_dir))


@register("group_queries", sql_with(["ad"], "SELECT DISTINCT query_group_id, query FROM ad"))
def q_group_queries(spark, sf_dir):
    return cat.group_queries(_ads(spark, sf_dir))


@register("group_queries_dropfirst", sql_with(["ad"], """SELECT DISTINCT a.query_group_id, a.query FROM ad a
JOIN (SELECT query_group_id, min(pos) AS fp FROM ad GROUP BY 1) f USING (query_group_id)
WHERE a.pos > f.fp"""))
def q_group_queries_dropfirst(spark, sf_dir):
    return cat.group_queries_dropfirst(_ads(spark, sf_dir))


@register("campaign_category", sql_with(["ad"], "SELECT campaign_id, arg_max(category, pos) AS category FROM ad GROUP BY 1"))
def q_campaign_category(spark, sf_dir):
    return cat.campaign_category(_ads(spark, sf_dir))


@register("ad_last_score", sql_with(["ad"], "SELECT ad_id, round(arg_max(relevance, pos), 9) AS relevance FROM s GROUP BY 1",
                                    SCORED))
def q_ad_last_score(spark, sf_dir):
    return cat.ad_last_score(_ads(spark, sf_dir)).select(A, R9("relevance").alias("relevance"))


@register("distinct_queries", sql_with(["ad"], "SELECT DISTINCT query FROM ad WHERE query IS NOT NULL"))
def q_distinct_queries(spark, sf_dir):
    return cat.distinct_queries(_ads(spark, sf_dir))


@register("lowest_weight_ad", sql_with(["ad"], """SELECT query_group_id, campaign_id, ad_id FROM bc JOIN (
  SELECT campaign_id, ad_id, row_number() OVER (PARTITION BY campaign_id ORDER BY round(weight, 9), pos) AS rn
  FROM aw WHERE weight < 1.0) USING (campaign_id)
WHERE rn = 1 AND campaign_id IN (SELECT campaign_id FROM ad GROUP BY 1 HAVING count(*) > 1)""", CAMP + [
    """bc AS (SELECT query_group_id, campaign_id FROM (
  SELECT cw.*, row_number() OVER (PARTITION BY query_group_id ORDER BY round(weight, 9), first_pos) AS rn FROM cw
  WHERE weight < 1.0 AND query_group_id IN (SELECT query_group_id FROM cw GROUP BY 1 HAVING count(*) > 1)) WHERE rn = 1)"""]))
def q_lowest_weight_ad(spark, sf_dir):
    return cat.lowest_weight_ad(_ads(spark, sf_dir))


@register("multi_ad_campaigns", sql_with(["ad"], """SELECT ad_id, campaign_id FROM ad
WHERE campaign_id IN (SELECT campaign_id FROM ad GROUP BY 1 HAVING count(*) > 1)"""))
def q_multi_ad_campaigns(spark, sf_dir):
    ads = _ads(spark, sf_dir)
    multi = ads.groupBy(C).count().where(F.col("count") > 1).select(C)
    return ads.join(multi, C, "left_semi").select(A, C)


@register("multi_campaign_groups", sql_with(["ad"], """SELECT query_group_id, count(DISTINCT campaign_id) AS n_campaigns
FROM ad GROUP BY 1 HAVING count(DISTINCT campaign_id) > 1"""))
def q_multi_campaign_groups(spark, sf_dir):
    ads = _ads(spark, sf_dir)
    return (ads.select(G, C).distinct().groupBy(G).agg(F.count(F.lit(1)).alias("n_campaigns"))
               .where(F.col("n_campaigns") > 1))


NESTED_SQL = """SELECT query_group_id, campaign_id, CAST(row_number() OVER (
    PARTITION BY query_group_id, campaign_id ORDER BY pos) - 1 AS INTEGER) AS idx, ad_id FROM ad"""
#: Positions per line, small enough that lists go over several lines.
MAP_CHUNK = 97


@register("export_group_map", sql_with(["ad"], f"""SELECT query_group_id, campaign_id, CAST(floor(pos / {MAP_CHUNK}) AS BIGINT) AS chunk,
  string_agg(CAST(ad_id AS VARCHAR), ' ' ORDER BY pos) AS ads FROM ad GROUP BY 1, 2, 3"""))
def q_export_group_map(spark, sf_dir):
    lines = nested_map_lines(cat.group_campaign_ads(_ads(spark, sf_dir)), chunk=MAP_CHUNK)
    j = lines.select(F.from_json("value", "chunk bigint, map map<string, map<string, array<bigint>>>").alias("j"))
    g = j.select("j.chunk", F.explode("j.map").alias(G, "c")).select("chunk", F.col(G).cast("bigint").alias(G), F.explode("c").alias(C, "a"))
    return g.select(G, C, "chunk", F.array_join(F.col("a").cast("array<string>"), " ").alias("ads"))


@register("scan_nested_map", sql_with(["ad"], NESTED_SQL))
def q_scan_nested_map(spark, sf_dir):
    lines = nested_map_lines(cat.group_campaign_ads(_ads(spark, sf_dir)), chunk=MAP_CHUNK)
    rows = parse_nested_map(lines)
    return rows.select(F.col(G).cast("bigint").alias(G), C, "idx", A)
