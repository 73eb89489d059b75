"""Counters, feature store, upsert and training vectors over the click view."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from clickfeat.operators.counters import KIND_KEYS, all_counters, counter
from clickfeat.operators.enrichment import out_of_fold_vectors, training_vectors
from clickfeat.operators.feature_store import feature_store
from clickfeat.plans.registry import register, sql_with
from clickfeat.session import checkpoint_dir
from clickfeat.sinks.delta_store import DeltaStore
from clickfeat.sources.fixtures import click_star, click_view

MEASURES_SQL = "CAST(sum(clicked) AS BIGINT) AS clicks, count(*) AS impressions"


def _by(kind: str, name: str):
    keys = KIND_KEYS[kind]
    sql = sql_with(["click"], f"SELECT {', '.join(keys)}, {MEASURES_SQL} FROM click GROUP BY {', '.join(keys)}")

    @register(name, sql)
    def q(spark, sf_dir):
        return counter(click_view(spark, sf_dir), kind)
    return q


_by("device_ip", "ctr_by_ip")
_by("device_id", "ctr_by_device")
_by("ad", "ctr_by_ad")
_by("query_campaign", "ctr_by_query_campaign")
_by("query_ad", "ctr_by_query_ad")

ALL_COUNTERS_SQL_BODY = f"""SELECT CASE WHEN grouping(device_ip) = 0 THEN 'device_ip'
            WHEN grouping(device_id) = 0 THEN 'device_id'
            WHEN grouping(campaign_id) = 0 THEN 'query_campaign'
            WHEN grouping(query) = 0 THEN 'query_ad' ELSE 'ad' END AS kind,
       device_ip, device_id, query, campaign_id, ad_id, {MEASURES_SQL}
FROM click
GROUP BY GROUPING SETS ((device_ip), (device_id), (ad_id), (query, campaign_id), (query, ad_id))"""


@register("all_counters", sql_with(["click"], ALL_COUNTERS_SQL_BODY))
def q_all_counters(spark, sf_dir):
    return all_counters(click_view(spark, sf_dir))


@register("all_counters_union", sql_with(["click"], ALL_COUNTERS_SQL_BODY))
def q_all_counters_union(spark, sf_dir):
    return all_counters(click_view(spark, sf_dir), method="union")


def _store_sql(src: str) -> str:
    """Feature-store rows from a tall counter CTE named ``src``."""
    key = {
        "device_ip": "CAST(device_ip AS VARCHAR)",
        "device_id": "CAST(device_id AS VARCHAR)",
        "ad": "CAST(ad_id AS VARCHAR)",
        "query_campaign": "replace(query, ' ', '_') || '_' || CAST(campaign_id AS VARCHAR)",
        "query_ad": "replace(query, ' ', '_') || '_' || CAST(ad_id AS VARCHAR)",
    }
    prefix = {"device_ip": ("dipc", "dipi"), "device_id": ("didc", "didi"), "ad": ("aidc", "aidi"),
              "query_campaign": ("qcidc", "qcidi"), "query_ad": ("qaidc", "qaidi")}
    parts = []
    for kind, k in key.items():
        pc, pi = prefix[kind]
        parts.append(f"SELECT '{pc}_' || {k} AS feature_key, clicks AS feature_value FROM {src} WHERE kind = '{kind}'")
        parts.append(f"SELECT '{pi}_' || {k} AS feature_key, impressions AS feature_value FROM {src} WHERE kind = '{kind}'")
    return "\nUNION ALL\n".join(parts)


@register("feature_store", sql_with(["click"], _store_sql("cnt"), [f"cnt AS ({ALL_COUNTERS_SQL_BODY})"]))
def q_feature_store(spark, sf_dir):
    return feature_store(all_counters(click_view(spark, sf_dir)))


# Two publishing runs: the first counts the rows with category match 1, the
# second the rows with category match 0; the store after both runs.
_UPSERT_CTES = [
    f"cnt_old AS ({ALL_COUNTERS_SQL_BODY.replace('FROM click', 'FROM click WHERE cat_match = 1')})",
    f"cnt_new AS ({ALL_COUNTERS_SQL_BODY.replace('FROM click', 'FROM click WHERE cat_match = 0')})",
    f"st_old AS ({_store_sql('cnt_old')})",
    f"st_new AS ({_store_sql('cnt_new')})",
]


@register("feature_upsert", sql_with(["click"], """SELECT feature_key, feature_value FROM st_old
WHERE feature_key NOT IN (SELECT feature_key FROM st_new)
UNION ALL SELECT feature_key, feature_value FROM st_new""", _UPSERT_CTES))
def q_feature_upsert(spark, sf_dir):
    clicks = click_view(spark, sf_dir)
    old = feature_store(all_counters(clicks.where(F.col("cat_match") == 1)))
    new = feature_store(all_counters(clicks.where(F.col("cat_match") == 0)))
    store = DeltaStore(spark, f"{checkpoint_dir(spark).rstrip('/')}/stores/{uuid.uuid4().hex}")
    store.publish(old)
    store.publish(new)
    return store.read()


TRAINING_SQL_BODY = """SELECT c.device_ip, c.device_id, c.session_id, c.query, c.ad_id, c.campaign_id, c.cat_match, c.clicked,
  coalesce(ip.clicks, 0) AS ip_clicks, coalesce(ip.imps, 0) AS ip_impressions,
  coalesce(dv.clicks, 0) AS device_clicks, coalesce(dv.imps, 0) AS device_impressions,
  coalesce(a.clicks, 0) AS ad_clicks, coalesce(a.imps, 0) AS ad_impressions,
  coalesce(qc.clicks, 0) AS qc_clicks, coalesce(qc.imps, 0) AS qc_impressions,
  coalesce(qa.clicks, 0) AS qa_clicks, coalesce(qa.imps, 0) AS qa_impressions,
  CAST(CASE WHEN c.cat_match = 1 THEN 1000000 ELSE 0 END AS BIGINT) AS match_feature,
  c.clicked AS label
FROM click c
LEFT JOIN (SELECT device_ip, CAST(sum(clicked) AS BIGINT) clicks, count(*) imps FROM click GROUP BY 1) ip USING (device_ip)
LEFT JOIN (SELECT device_id, CAST(sum(clicked) AS BIGINT) clicks, count(*) imps FROM click GROUP BY 1) dv USING (device_id)
LEFT JOIN (SELECT ad_id, CAST(sum(clicked) AS BIGINT) clicks, count(*) imps FROM click GROUP BY 1) a USING (ad_id)
LEFT JOIN (SELECT query, campaign_id, CAST(sum(clicked) AS BIGINT) clicks, count(*) imps FROM click GROUP BY 1, 2) qc
  ON qc.query = c.query AND qc.campaign_id = c.campaign_id
LEFT JOIN (SELECT query, ad_id, CAST(sum(clicked) AS BIGINT) clicks, count(*) imps FROM click GROUP BY 1, 2) qa
  ON qa.query = c.query AND qa.ad_id = c.ad_id"""


@register("training_vectors", sql_with(["click"], TRAINING_SQL_BODY))
def q_training_vectors(spark, sf_dir):
    return training_vectors(click_star(spark, sf_dir))


_KEYS = {"ip": "device_ip", "device": "device_id", "ad": "ad_id", "qc": "query, campaign_id", "qa": "query, ad_id"}
_REST = ",\n  ".join(f"CAST(sum({v}) OVER (PARTITION BY {k}) - sum({v}) OVER (PARTITION BY {k}, fold) AS BIGINT) AS {p}_{m}"
                     for p, k in _KEYS.items() for v, m in (("clicked", "clicks"), ("1", "impressions")))
_FOLD = "least(CAST(floor((('0x' || substr(md5('42|fold|' || CAST(session_id AS VARCHAR) || '|' || CAST(device_id AS VARCHAR) || '|' || " \
        "CAST(ad_id AS VARCHAR)), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE) * 5) AS INTEGER), 4)"


@register("training_vectors_out_of_fold", sql_with(["click"], f"""SELECT device_ip, device_id, session_id, query, ad_id, campaign_id, cat_match, clicked, fold,
  {_REST},
  CAST(CASE WHEN cat_match = 1 THEN 1000000 ELSE 0 END AS BIGINT) AS match_feature, clicked AS label
FROM folded""", [f"folded AS (SELECT *, {_FOLD} AS fold FROM click)"]))
def q_out_of_fold(spark, sf_dir):
    return out_of_fold_vectors(click_star(spark, sf_dir), ["session_id", "device_id", "ad_id"])
