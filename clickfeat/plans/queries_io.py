"""Source/sink round trips over text columns (files are tested in pytest)."""

from __future__ import annotations

from pyspark.sql import functions as F

from clickfeat.operators import catalogue as cat
from clickfeat.operators.counters import all_counters
from clickfeat.operators.enrichment import training_vectors
from clickfeat.operators.feature_store import counter_pairs, feature_store
from clickfeat.plans import queries_catalogue  # noqa: F401  (its SQL is used below)
from clickfeat.plans.queries_counters import ALL_COUNTERS_SQL_BODY, TRAINING_SQL_BODY, _store_sql
from clickfeat.plans.registry import ORACLE, register, sql_with
from clickfeat.schemas import CLICK_COLUMNS, FEATURE_COLUMNS
from clickfeat.sinks import files as sinks
from clickfeat.sinks.files import clicks_csv_lines, training_tuple_lines, tuple_pair_lines
from clickfeat.sources.files import (blank, parse_clicks, parse_flat_map, parse_list_map, parse_set_map, parse_training_points,
                                     parse_tuple_pairs, parse_users, rejected_clicks, valid_click_lines)
from clickfeat.sources.fixtures import ad_view, click_star, click_view, user_view

CLICK_CSV_SQL = ("concat_ws(',', device_ip, device_id, session_id, query, ad_id, campaign_id, cat_match, clicked)")


@register("export_clicks_csv", sql_with(["click"], f"SELECT {CLICK_CSV_SQL} AS value FROM click"))
def q_export_clicks_csv(spark, sf_dir):
    return clicks_csv_lines(click_view(spark, sf_dir))


# Lines as they come: by the session's last digit a line lacks two fields (0), has a ninth (1: a comma in the
# query), a blank device (2), a session that is no number (3), a flag of 2 (4), or a blank query (5).
LAST = "session_id % 10"
MESSY_SQL = [f"""messy AS (SELECT *, {LAST} AS d, CASE {LAST}
  WHEN 0 THEN concat_ws(',', device_ip, device_id, session_id, query, ad_id, campaign_id)
  WHEN 1 THEN concat_ws(',', device_ip, device_id, session_id, query, 'more', ad_id, campaign_id, cat_match, clicked)
  WHEN 2 THEN concat_ws(',', device_ip, '', session_id, query, ad_id, campaign_id, cat_match, clicked)
  WHEN 3 THEN concat_ws(',', device_ip, device_id, 'x' || session_id, query, ad_id, campaign_id, cat_match, clicked)
  WHEN 4 THEN concat_ws(',', device_ip, device_id, session_id, query, ad_id, campaign_id, cat_match, 2)
  WHEN 5 THEN concat_ws(',', device_ip, device_id, session_id, '', ad_id, campaign_id, cat_match, clicked)
  ELSE {CLICK_CSV_SQL} END AS value FROM click)"""]


def messy_lines(clicks):
    """Click lines of which some are short, long, blank in places or not numbers (see MESSY_SQL)."""
    last = F.col("session_id") % 10
    text = {c: F.col(c).cast("string") for c in CLICK_COLUMNS}

    def line(**other):
        return F.concat_ws(",", *[F.lit(x) if isinstance(x := other.get(c, text[c]), str) else x for c in CLICK_COLUMNS])

    value = (F.when(last == 0, F.concat_ws(",", *[text[c] for c in CLICK_COLUMNS[:6]]))
             .when(last == 1, line(query=F.concat(text["query"], F.lit(",more"))))
             .when(last == 2, line(device_id="")).when(last == 3, line(session_id=F.concat(F.lit("x"), text["session_id"])))
             .when(last == 4, line(clicked="2")).when(last == 5, line(query="")).otherwise(line()))
    return clicks.select(value.alias("value"))


@register("scan_clicks", sql_with(["click"], """SELECT CAST(device_ip AS VARCHAR) AS device_ip,
CASE WHEN d = 2 THEN '' ELSE CAST(device_id AS VARCHAR) END AS device_id, session_id, CASE WHEN d = 5 THEN '' ELSE query END AS query,
CAST(ad_id AS VARCHAR) AS ad_id, CAST(campaign_id AS VARCHAR) AS campaign_id, cat_match, clicked
FROM messy WHERE d NOT IN (0, 1, 3, 4)""", MESSY_SQL))
def q_scan_clicks(spark, sf_dir):
    return parse_clicks(messy_lines(click_view(spark, sf_dir)))


@register("rejected_clicks", sql_with(["click"], "SELECT value, count(*) AS n_rejected FROM messy WHERE d IN (0, 1, 3, 4) GROUP BY 1", MESSY_SQL))
def q_rejected_clicks(spark, sf_dir):
    return rejected_clicks(messy_lines(click_view(spark, sf_dir))).groupBy("value").agg(F.count(F.lit(1)).alias("n_rejected"))


@register("valid_clicks", sql_with(["click"], "SELECT value FROM messy WHERE d <> 0", MESSY_SQL))
def q_valid_clicks(spark, sf_dir):
    return valid_click_lines(messy_lines(click_view(spark, sf_dir)))


def _blanked(spark, sf_dir):
    return click_view(spark, sf_dir).withColumn("query", F.when(F.col("session_id") % 10 == 5, F.lit("")).otherwise(F.col("query")))


@register("blank_guard", sql_with(["click"], f"SELECT * FROM click WHERE {LAST} <> 5"))
def q_blank_guard(spark, sf_dir):
    return _blanked(spark, sf_dir).where(~blank("query", "ad_id", "campaign_id"))


@register("blank_rejects", sql_with(["click"], f"SELECT session_id, ad_id, '' AS query FROM click WHERE {LAST} = 5"))
def q_blank_rejects(spark, sf_dir):
    return _blanked(spark, sf_dir).where(blank("query", "ad_id", "campaign_id")).select("session_id", "ad_id", "query")


@register("scan_users", sql_with(["usr"], """SELECT CAST(ip AS VARCHAR) AS ip, CAST(i - 1 AS INTEGER) AS idx,
CAST(devices[i] AS VARCHAR) AS device_id FROM usr, LATERAL (SELECT unnest(range(1, 6)) AS i)"""))
def q_scan_users(spark, sf_dir):
    u = user_view(spark, sf_dir)
    lines = u.select(F.concat_ws(",", F.col("ip").cast("string"),
                                 F.array_join(F.transform("devices", lambda d: d.cast("string")), ",")).alias("value"),
                     "pos")
    p = parse_users(lines)
    return p.select("ip", F.posexplode("devices").alias("idx", "device_id"))


@register("user_count", sql_with(["usr"], "SELECT count(*) AS n_users FROM usr"))
def q_user_count(spark, sf_dir):
    return user_view(spark, sf_dir).agg(F.count(F.lit(1)).alias("n_users"))


@register("scan_counters", sql_with(["click"], _store_sql("cnt"), [f"cnt AS ({ALL_COUNTERS_SQL_BODY})"]))
def q_scan_counters(spark, sf_dir):
    """Counters written as legacy tuple text per store prefix, read back and keyed."""
    pairs = counter_pairs(all_counters(click_view(spark, sf_dir)))
    parsed = parse_tuple_pairs(tuple_pair_lines(pairs, "key", "value", keep=["prefix"]))
    return parsed.select(F.concat_ws("_", "prefix", "key").alias("feature_key"),
                         F.col("value").alias("feature_value"))


@register("export_features_jsonl", sql_with(["click"], "SELECT to_json({'feature_key': feature_key, 'feature_value': "
                                            "feature_value})::VARCHAR AS value FROM st", [
                                                f"cnt AS ({ALL_COUNTERS_SQL_BODY})", f"st AS ({_store_sql('cnt')})"]))
def q_export_features_jsonl(spark, sf_dir):
    store = feature_store(all_counters(click_view(spark, sf_dir)))
    return store.select(F.to_json(F.struct("feature_key", "feature_value")).alias("value"))


TRAIN_POINTS_SQL = ("SELECT CAST(label AS DOUBLE) AS label, "
                    + ", ".join(f"CAST({c} AS DOUBLE) AS f{i}" for i, c in enumerate(FEATURE_COLUMNS)) + " FROM tv")


@register("scan_training", sql_with(["click"], TRAIN_POINTS_SQL, [f"tv AS ({TRAINING_SQL_BODY})"]))
def q_scan_training(spark, sf_dir):
    tv = training_vectors(click_star(spark, sf_dir))
    return parse_training_points(training_tuple_lines(tv, FEATURE_COLUMNS))


@register("parse_features", sql_with(["click"], "SELECT count(*) FILTER (ad_id % 97 <> 0) AS n_ok, "
                                     "CAST(count(*) FILTER (ad_id % 97 = 0) AS INTEGER) AS n_rejected FROM tv",
                                     [f"tv AS ({TRAINING_SQL_BODY})"]))
def q_parse_features(spark, sf_dir):
    """Training lines of which some (every ad whose id is a multiple of 97) hold a feature that is no number."""
    tv = training_vectors(click_star(spark, sf_dir))
    lines = training_tuple_lines(tv, FEATURE_COLUMNS, keep=["ad_id"])
    broken = F.regexp_replace("value", r"^\('[^,]*", "('n/a")
    lines = lines.withColumn("value", F.when(F.col("ad_id") % 97 == 0, broken).otherwise(F.col("value")))
    p = parse_training_points(lines)
    bad = F.lit(False)
    for c in ["label"] + [f"f{i}" for i in range(len(FEATURE_COLUMNS))]:
        bad = bad | F.col(c).isNull()
    return p.agg(F.sum((~bad).cast("int")).cast("bigint").alias("n_ok"),
                 F.sum(bad.cast("int")).cast("int").alias("n_rejected"))


# The five other map documents of the catalogue, each written as lines and read back.
@register("export_campaign_weight_map", ORACLE["campaign_weight_last"])
def q_campaign_weight_map(spark, sf_dir):
    w = cat.campaign_weight_last(ad_view(spark, sf_dir)).select("campaign_id", F.round("weight", 9).alias("weight"))
    return parse_flat_map(sinks.flat_map_lines(w, "campaign_id", "weight"), "campaign_id", "weight")


@register("export_ad_score_map", ORACLE["ad_last_score"])
def q_ad_score_map(spark, sf_dir):
    w = cat.ad_last_score(ad_view(spark, sf_dir)).select("ad_id", F.round("relevance", 9).alias("relevance"))
    return parse_flat_map(sinks.flat_map_lines(w, "ad_id", "relevance"), "ad_id", "relevance", key_type="bigint")


@register("export_category_map", ORACLE["campaign_category"])
def q_category_map(spark, sf_dir):
    c = cat.campaign_category(ad_view(spark, sf_dir))
    return parse_flat_map(sinks.flat_map_lines(c, "campaign_id", "category"), "campaign_id", "category", value_type="string")


@register("export_group_query_map", ORACLE["group_queries"])
def q_group_query_map(spark, sf_dir):
    return parse_set_map(sinks.set_map_lines(cat.group_queries(ad_view(spark, sf_dir)), chunk=16))


@register("export_campaign_ads_map", sql_with(["ad"], "SELECT campaign_id, ad_id, row_number() OVER (PARTITION BY campaign_id ORDER BY pos) - 1 AS idx FROM ad"))
def q_campaign_ads_map(spark, sf_dir):
    return parse_list_map(sinks.list_map_lines(cat.campaign_ads(ad_view(spark, sf_dir)), chunk=64))
