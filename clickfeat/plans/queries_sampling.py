"""Seeded draws, candidates, negatives, cohorts and the synthetic log union."""

from __future__ import annotations

from pyspark.sql import functions as F

from clickfeat.functions.random import hash_uniform
from clickfeat.operators.lookup import split_join
from clickfeat.operators import catalogue as cat
from clickfeat.operators import sampling as smp
from clickfeat.operators.users import user_cohorts
from clickfeat.plans.registry import register, sql_with
from clickfeat.sources.fixtures import ad_view, click_view, user_view

G, C, A = "query_group_id", "campaign_id", "ad_id"
R9 = lambda c: F.round(c, 9)


def U(*parts: str) -> str:
    """DuckDB form of hash_uniform(42, parts...)."""
    key = " || '|' || ".join(["'42'"] + [p if p.startswith("'") else f"CAST({p} AS VARCHAR)" for p in parts])
    return f"(('0x' || substr(md5({key}), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE)"


def PICK(u: str, n: str) -> str:
    return f"least(CAST(floor({u} * {n}) AS BIGINT), {n} - 1)"


REL = ("CASE WHEN len(list_distinct(keywords)) > 0 THEN "
       "len(list_filter(string_split(query, ' '), lambda t: list_contains(keywords, t)))::DOUBLE "
       "/ len(list_distinct(keywords)) END")
WEIGHTS = [
    f"s AS (SELECT * FROM (SELECT *, {REL} AS relevance FROM ad) WHERE relevance IS NOT NULL)",
    "camp AS (SELECT query_group_id, campaign_id, sum(relevance) AS ct, min(pos) AS first_pos, count(*) AS n_ads "
    "FROM s GROUP BY 1, 2)",
    "grp AS (SELECT query_group_id, sum(ct) AS gt FROM camp GROUP BY 1)",
    "cw AS (SELECT camp.*, CASE WHEN gt > 0 THEN ct / gt ELSE ct END AS weight FROM camp JOIN grp USING (query_group_id))",
    "tot AS (SELECT query_group_id, campaign_id, sum(relevance) AS t FROM s GROUP BY 1, 2)",
    "aw AS (SELECT s.query_group_id, s.campaign_id, s.ad_id, s.pos, CASE WHEN t > 0 THEN relevance / t ELSE relevance END "
    "AS weight FROM s JOIN tot USING (query_group_id, campaign_id))",
    # campaign buckets
    "cb0 AS (SELECT query_group_id, campaign_id, first_pos, weight, sum(weight) OVER (PARTITION BY query_group_id "
    "ORDER BY first_pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS hi FROM cw WHERE weight > 0)",
    "cb AS (SELECT *, coalesce(lag(hi) OVER (PARTITION BY query_group_id ORDER BY first_pos), 0.0) AS lo, "
    "max(hi) OVER (PARTITION BY query_group_id) AS total FROM cb0)",
    "ab0 AS (SELECT query_group_id, campaign_id, ad_id, pos, weight, sum(weight) OVER (PARTITION BY query_group_id, "
    "campaign_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS hi FROM aw WHERE weight > 0)",
    "ab AS (SELECT *, coalesce(lag(hi) OVER (PARTITION BY query_group_id, campaign_id ORDER BY pos), 0.0) AS lo, "
    "max(hi) OVER (PARTITION BY query_group_id, campaign_id) AS total FROM ab0)",
]


def FOLD(u: str, total: str) -> str:
    return (f"least(greatest(CASE WHEN {u} <= {total} THEN {u} ELSE {u} - {total} * (ceil({u} / {total}) - 1) END, "
            f"1e-300), {total})")


def _draws_cte(n: int) -> list[str]:
    return [
        f"probes AS (SELECT query_group_id, d AS draw, {U('query_group_id', 'd')} AS u "
        f"FROM (SELECT DISTINCT query_group_id FROM cb), LATERAL (SELECT unnest(range(1, {n + 1})) AS d))",
        "cdraw AS (SELECT p.query_group_id, p.draw, b.campaign_id FROM probes p "
        "JOIN (SELECT DISTINCT query_group_id, total FROM cb) t USING (query_group_id) "
        f"JOIN cb b ON b.query_group_id = p.query_group_id AND {FOLD('p.u', 't.total')} > b.lo "
        f"AND {FOLD('p.u', 't.total')} <= b.hi)",
    ]


def _ads(spark, sf_dir):
    return ad_view(spark, sf_dir)


@register("hash_uniform", sql_with(["ad"], f"SELECT ad_id, {U('ad_id')} AS u FROM ad"))
def q_hash_uniform(spark, sf_dir):
    return _ads(spark, sf_dir).select(A, hash_uniform(42, A).alias("u"))


@register("cumulative_weights", sql_with(["ad"], "SELECT query_group_id, campaign_id, round(lo, 9) AS lo, "
                                         "round(hi, 9) AS hi FROM cb", WEIGHTS))
def q_cumulative_weights(spark, sf_dir):
    return smp.cumulative_weights(_ads(spark, sf_dir)).select(G, C, R9("lo").alias("lo"), R9("hi").alias("hi"))


@register("weighted_draws", sql_with(["ad"], "SELECT query_group_id, CAST(draw AS INTEGER) AS draw, campaign_id "
                                     "FROM cdraw", WEIGHTS + _draws_cte(49)))
def q_weighted_draws(spark, sf_dir):
    return smp.campaign_draws(_ads(spark, sf_dir), 49, 42)


@register("draw_frequency", sql_with(["ad"], "SELECT query_group_id, campaign_id, count(*) / 1000.0 AS share "
                                     "FROM cdraw GROUP BY 1, 2", WEIGHTS + _draws_cte(1000)))
def q_draw_frequency(spark, sf_dir):
    return smp.draw_frequency(_ads(spark, sf_dir), 1000, 42)


POSITIVE_SQL = f"""SELECT c.query_group_id, CAST(c.draw AS INTEGER) AS draw, q.query, b.ad_id, c.campaign_id,
  1 AS cat_match, 1 AS clicked
FROM cdraw c
JOIN (SELECT DISTINCT query_group_id, campaign_id, total FROM ab) t USING (query_group_id, campaign_id)
JOIN ab b ON b.query_group_id = c.query_group_id AND b.campaign_id = c.campaign_id
  AND {FOLD(U("'ad'", 'c.query_group_id', 'c.draw'), 't.total')} > b.lo
  AND {FOLD(U("'ad'", 'c.query_group_id', 'c.draw'), 't.total')} <= b.hi
JOIN ad q ON q.ad_id = b.ad_id
WHERE q.query IS NOT NULL AND q.query <> ''"""


@register("positive_draws", sql_with(["ad"], POSITIVE_SQL, WEIGHTS + _draws_cte(49)))
def q_positive_draws(spark, sf_dir):
    return smp.positive_draws(_ads(spark, sf_dir), 49, 42)


@register("all_positives", sql_with(["ad"], "SELECT query_group_id, campaign_id, ad_id, query, 1 AS cat_match, "
                                    "1 AS clicked FROM ad"))
def q_all_positives(spark, sf_dir):
    return smp.all_positives(_ads(spark, sf_dir))


CA = ["ca AS (SELECT campaign_id, ad_id, row_number() OVER (PARTITION BY campaign_id ORDER BY pos) - 1 AS idx, "
      "count(*) OVER (PARTITION BY campaign_id) AS n_ads FROM ad)"]


@register("uniform_pick", sql_with(["ad"], f"""SELECT c.campaign_id, ca.ad_id FROM (SELECT DISTINCT campaign_id FROM ad) c
JOIN (SELECT DISTINCT campaign_id, n_ads FROM ca) n USING (campaign_id)
JOIN ca ON ca.campaign_id = c.campaign_id AND ca.idx = {PICK(U("'pick'", 'c.campaign_id'), 'n.n_ads')}""", CA))
def q_uniform_pick(spark, sf_dir):
    return smp.uniform_pick(_ads(spark, sf_dir), 42)


GC = ["gc AS (SELECT query_group_id, campaign_id, min(pos) AS first_pos FROM ad GROUP BY 1, 2)",
      "gcf AS (SELECT gc.*, min(first_pos) OVER (PARTITION BY query_group_id) AS group_first_pos FROM gc)",
      "camps AS (SELECT campaign_id, arg_max(category, pos) AS ccat, min(pos) AS cfp FROM ad GROUP BY 1)"]


@register("neg_same_group_candidates", sql_with(["ad"], """SELECT a.query_group_id, a.campaign_id, count(b.campaign_id) AS n_candidates
FROM gc a LEFT JOIN gc b ON a.query_group_id = b.query_group_id AND a.campaign_id <> b.campaign_id GROUP BY 1, 2""", GC))
def q_neg_same_group_candidates(spark, sf_dir):
    return smp.same_group_candidates(_ads(spark, sf_dir))


@register("neg_other_group_candidates", sql_with(["ad"], """SELECT a.query_group_id, count(*) AS n_candidates
FROM (SELECT DISTINCT query_group_id FROM gc) a JOIN gc b ON a.query_group_id <> b.query_group_id GROUP BY 1""", GC))
def q_neg_other_group_candidates(spark, sf_dir):
    return smp.other_group_candidates(_ads(spark, sf_dir))


@register("neg_category_candidates", sql_with(["ad"], """SELECT d.query_group_id, d.category, count(c.campaign_id) AS n_candidates
FROM (SELECT DISTINCT query_group_id, category FROM ad) d
LEFT JOIN camps c ON c.ccat <> d.category
  AND c.campaign_id NOT IN (SELECT campaign_id FROM gc WHERE gc.query_group_id = d.query_group_id)
GROUP BY 1, 2""", GC))
def q_neg_category_candidates(spark, sf_dir):
    return smp.category_candidates(_ads(spark, sf_dir))


NEG_CTES = GC + CA + [
    # type 0: other category, outside the group, ordered by (category, first appearance)
    """cat_c AS (SELECT a.ad_id AS src_ad_id, c.campaign_id,
  row_number() OVER (PARTITION BY a.ad_id ORDER BY c.ccat, c.cfp, c.campaign_id) - 1 AS idx,
  count(*) OVER (PARTITION BY a.ad_id) AS n
  FROM ad a JOIN camps c ON c.ccat <> a.category
  WHERE c.campaign_id NOT IN (SELECT campaign_id FROM gc WHERE gc.query_group_id = a.query_group_id))""",
    f"""neg0 AS (SELECT x.src_ad_id, ca.ad_id, x.campaign_id, 0 AS cat_match FROM cat_c x
  JOIN (SELECT DISTINCT campaign_id, n_ads FROM ca) nn ON nn.campaign_id = x.campaign_id
  JOIN ca ON ca.campaign_id = x.campaign_id AND ca.idx = {PICK(U("'cat_ad'", 'x.src_ad_id'), 'nn.n_ads')}
  WHERE x.idx = {PICK(U("'cat'", 'x.src_ad_id'), 'x.n')})""",
    # type 1: coin; same group (other campaign) or any pair of another group
    f"""same_c AS (SELECT a.ad_id AS src_ad_id, g.campaign_id, 1 AS cat_match,
  row_number() OVER (PARTITION BY a.ad_id ORDER BY g.first_pos, g.campaign_id) - 1 AS idx,
  count(*) OVER (PARTITION BY a.ad_id) AS n
  FROM ad a JOIN gc g ON g.query_group_id = a.query_group_id AND g.campaign_id <> a.campaign_id
  WHERE {U("'coin'", 'a.ad_id')} < 0.5)""",
    f"""other_c AS (SELECT a.ad_id AS src_ad_id, g.campaign_id, 0 AS cat_match,
  row_number() OVER (PARTITION BY a.ad_id ORDER BY g.group_first_pos, g.query_group_id, g.first_pos, g.campaign_id) - 1 AS idx,
  count(*) OVER (PARTITION BY a.ad_id) AS n
  FROM ad a JOIN gcf g ON g.query_group_id <> a.query_group_id
  WHERE {U("'coin'", 'a.ad_id')} >= 0.5)""",
    f"""neg1 AS (SELECT x.src_ad_id, ca.ad_id, x.campaign_id, x.cat_match FROM
  (SELECT * FROM same_c UNION ALL SELECT * FROM other_c) x
  JOIN (SELECT DISTINCT campaign_id, n_ads FROM ca) nn ON nn.campaign_id = x.campaign_id
  JOIN ca ON ca.campaign_id = x.campaign_id AND ca.idx = {PICK(U("'camp_ad'", 'x.src_ad_id'), 'nn.n_ads')}
  WHERE x.idx = {PICK(U("'camp'", 'x.src_ad_id'), 'x.n')})""",
    # type 2: lowest-weight ad of lowest-weight campaign of the group
    """bc AS (SELECT query_group_id, campaign_id FROM (
  SELECT cw.*, row_number() OVER (PARTITION BY query_group_id ORDER BY round(weight, 9), first_pos) AS rn FROM cw
  WHERE weight < 1.0 AND query_group_id IN (SELECT query_group_id FROM cw GROUP BY 1 HAVING count(*) > 1)) WHERE rn = 1)""",
    # the campaign's ads of all groups count
    """low AS (SELECT query_group_id, campaign_id, ad_id FROM bc JOIN (
  SELECT campaign_id, ad_id, row_number() OVER (PARTITION BY campaign_id ORDER BY round(weight, 9), pos) AS rn
  FROM aw WHERE weight < 1.0) USING (campaign_id)
  WHERE rn = 1 AND campaign_id IN (SELECT campaign_id FROM ad GROUP BY 1 HAVING count(*) > 1))""",
    "neg2 AS (SELECT a.ad_id AS src_ad_id, l.ad_id, l.campaign_id, 1 AS cat_match FROM ad a JOIN low l USING (query_group_id))",
    "neg3 AS (SELECT ad_id AS src_ad_id, ad_id, campaign_id, 1 AS cat_match FROM ad)",
]


@register("neg_category", sql_with(["ad"], "SELECT * FROM neg0", WEIGHTS + NEG_CTES))
def q_neg_category(spark, sf_dir):
    ads = _ads(spark, sf_dir)
    return smp.neg_category(ads, ads, 42)


@register("neg_campaign", sql_with(["ad"], "SELECT * FROM neg1", WEIGHTS + NEG_CTES))
def q_neg_campaign(spark, sf_dir):
    ads = _ads(spark, sf_dir)
    return smp.neg_campaign(ads, ads, 42)


@register("neg_lowest", sql_with(["ad"], "SELECT * FROM neg2", WEIGHTS + NEG_CTES))
def q_neg_lowest(spark, sf_dir):
    ads = _ads(spark, sf_dir)
    return smp.neg_lowest(ads, ads)


@register("neg_noclick", sql_with(["ad"], "SELECT * FROM neg3", WEIGHTS + NEG_CTES))
def q_neg_noclick(spark, sf_dir):
    return smp.neg_noclick(_ads(spark, sf_dir))


TYPE_SQL = (f"CASE WHEN {U(chr(39) + 'type' + chr(39), 'a.ad_id')} <= 0.2 THEN 0 "
            f"WHEN {U(chr(39) + 'type' + chr(39), 'a.ad_id')} <= 0.30000000000000004 THEN 1 "
            f"WHEN {U(chr(39) + 'type' + chr(39), 'a.ad_id')} <= 0.6000000000000001 THEN 2 ELSE 3 END")
NEGATIVE_ROWS_SQL = f"""SELECT x.src_ad_id, x.neg_type, a.query, x.ad_id, x.campaign_id, x.cat_match, 0 AS clicked
FROM (SELECT *, 0 AS neg_type FROM neg0 UNION ALL SELECT *, 1 FROM neg1 UNION ALL SELECT *, 2 FROM neg2
      UNION ALL SELECT *, 3 FROM neg3) x
JOIN ad a ON a.ad_id = x.src_ad_id
WHERE a.campaign_id IN (SELECT campaign_id FROM ad GROUP BY 1 HAVING count(*) > 1)
  AND x.neg_type = {TYPE_SQL}
  AND a.query IS NOT NULL AND a.query <> ''"""


@register("negative_rows", sql_with(["ad"], NEGATIVE_ROWS_SQL, WEIGHTS + NEG_CTES))
def q_negative_rows(spark, sf_dir):
    return smp.negative_rows(_ads(spark, sf_dir), seed=42)


@register("click_log_union", sql_with(["ad"], f"""SELECT query, ad_id, campaign_id, cat_match, clicked FROM ({POSITIVE_SQL})
UNION ALL SELECT query, ad_id, campaign_id, cat_match, clicked FROM ({NEGATIVE_ROWS_SQL})""",
                                      WEIGHTS + _draws_cte(49) + NEG_CTES))
def q_click_log_union(spark, sf_dir):
    ads = _ads(spark, sf_dir)
    cols = ["query", A, C, "cat_match", "clicked"]
    return smp.positive_draws(ads, 49, 42).select(*cols).unionByName(smp.negative_rows(ads, seed=42).select(*cols))


@register("branch_choice", sql_with(["ad", "click"], f"""SELECT device_id, query_group_id,
  CAST({U("'branch'", 'device_id', 'query_group_id')} < 0.7 AS INTEGER) AS positive_l1,
  CAST({U("'branch'", 'device_id', 'query_group_id')} < 0.5 AS INTEGER) AS positive_l2
FROM (SELECT DISTINCT c.device_id, a.query_group_id FROM click c JOIN ad a ON a.ad_id = c.ad_id)"""))
def q_branch_choice(spark, sf_dir):
    pairs = (click_view(spark, sf_dir).select("device_id", A)
             .join(_ads(spark, sf_dir).select(A, G), A).select("device_id", G).distinct())
    return smp.branch_choice(pairs, ["device_id", G], 42)


@register("user_cohorts", sql_with(["usr"], """SELECT ip, CAST(CASE WHEN i <= floor(n * 0.05) THEN 0
  WHEN i <= floor(n * 0.3) THEN 1 WHEN i <= floor(n * 0.6) THEN 2 ELSE 3 END AS INTEGER) AS level
FROM (SELECT ip, row_number() OVER (ORDER BY pos) - 1 AS i, count(*) OVER () AS n FROM usr)"""))
def q_user_cohorts(spark, sf_dir):
    return user_cohorts(user_view(spark, sf_dir)).select("ip", "level")


@register("ad_query_lookup", sql_with(["ad", "click"], """SELECT c.session_id, c.ad_id, a.query AS ad_query
FROM click c JOIN ad a ON a.ad_id = c.ad_id"""))
def q_ad_query_lookup(spark, sf_dir):
    ads = cat.dedupe_last(_ads(spark, sf_dir).select(A, "query", "pos")).select(A, F.col("query").alias("ad_query"))
    return split_join(click_view(spark, sf_dir).select("session_id", A), ads, [A]).select("session_id", A, "ad_query")


@register("group_weights", sql_with(["ad"], """SELECT aw.query_group_id, aw.campaign_id, aw.ad_id,
  round(cw.weight, 9) AS campaign_weight, round(aw.weight, 9) AS ad_weight
FROM aw JOIN cw USING (query_group_id, campaign_id)""", WEIGHTS))
def q_group_weights(spark, sf_dir):
    ads = _ads(spark, sf_dir)
    cw = cat.campaign_weights(ads).select(G, C, F.col("weight").alias("campaign_weight"))
    aw = cat.ad_weights(ads).select(G, C, A, F.col("weight").alias("ad_weight"))
    return split_join(aw, cw, [G, C]).select(G, C, A, R9("campaign_weight").alias("campaign_weight"),
                                      R9("ad_weight").alias("ad_weight"))


@register("ads_of_group", sql_with(["ad"], """SELECT g.query_group_id, a.ad_id FROM (SELECT DISTINCT query_group_id FROM ad) g
JOIN ad a ON a.query_group_id = g.query_group_id"""))
def q_ads_of_group(spark, sf_dir):
    ads = _ads(spark, sf_dir)
    groups = ads.select(G).distinct()
    return groups.join(ads.select(G, A), G)


@register("campaign_budgets", sql_with(["ad"], f"""SELECT campaign_id,
  CAST(100 + {PICK(U("'budget'", 'campaign_id'), '1901')} AS INTEGER) AS budget
FROM (SELECT DISTINCT campaign_id FROM ad WHERE campaign_id IS NOT NULL)"""))
def q_campaign_budgets(spark, sf_dir):
    return smp.campaign_budgets(_ads(spark, sf_dir), 42)


@register("export_budgets", sql_with(["ad"], f"""SELECT to_json({{'campaignId': campaign_id, 'budget':
  CAST(100 + {PICK(U("'budget'", 'campaign_id'), '1901')} AS INTEGER)}})::VARCHAR AS value
FROM (SELECT DISTINCT campaign_id FROM ad WHERE campaign_id IS NOT NULL)"""))
def q_export_budgets(spark, sf_dir):
    """Budget file lines as published: {"campaignId": ..., "budget": ...}."""
    b = smp.campaign_budgets(_ads(spark, sf_dir), 42)
    return b.select(F.to_json(F.struct(F.col("campaign_id").alias("campaignId"), "budget")).alias("value"))
