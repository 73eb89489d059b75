"""Key-value feature store as a table.

The published store is (feature_key string, feature_value bigint), one row per
prefixed key, e.g. ``dipc_7`` -> clicks of device ip 7.  Publishing is a keyed
upsert: the new run's keys replace the old ones, keys only the old run has are
kept.  Lookups never go through string keys: the enrichment joins typed
columns (see enrichment.py).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from clickfeat.functions.keys import query_id_key
from clickfeat.schemas import STORE_PREFIX


def _key_expr() -> F.Column:
    k = F.col("kind")
    return (F.when(k == "device_ip", F.col("device_ip").cast("string"))
             .when(k == "device_id", F.col("device_id").cast("string"))
             .when(k == "ad", F.col("ad_id").cast("string"))
             .when(k == "query_campaign", query_id_key("query", "campaign_id"))
             .otherwise(query_id_key("query", "ad_id")))


def _prefix_map() -> F.Column:
    entries = []
    for (kind, measure), prefix in STORE_PREFIX.items():
        entries += [F.lit(f"{kind}|{measure}"), F.lit(prefix)]
    return F.create_map(*entries)


def counter_pairs(counters: DataFrame) -> DataFrame:
    """Tall counters -> (prefix, key, value): clicks and impressions become two
    rows each (stack), prefix per (kind, measure)."""
    s = counters.select(
        "kind", _key_expr().alias("key"),
        F.expr("stack(2, 'clicks', clicks, 'impressions', impressions) as (measure, value)"))
    prefix = F.element_at(_prefix_map(), F.concat_ws("|", "kind", "measure"))
    return s.select(prefix.alias("prefix"), "key", F.col("value").cast("bigint").alias("value"))


def feature_store(counters: DataFrame) -> DataFrame:
    """(feature_key = prefix_key, feature_value)."""
    p = counter_pairs(counters)
    return p.select(F.concat_ws("_", "prefix", "key").alias("feature_key"), F.col("value").alias("feature_value"))


def upsert(old: DataFrame, new: DataFrame, key: str = "feature_key") -> DataFrame:
    """Last write wins per key; keys of earlier runs stay.  A shuffle join on the
    key (or broadcast of the new keys when AQE measures them small)."""
    kept = old.join(new.select(key), key, "left_anti")
    return kept.unionByName(new)
