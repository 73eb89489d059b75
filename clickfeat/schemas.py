"""Fixed schemas for every data set that crosses a stage boundary."""

from pyspark.sql import types as T

# Ad catalogue, one JSON object per line.  Ids are numbers in the source files.
AD = T.StructType([
    T.StructField("adId", T.LongType()),
    T.StructField("campaignId", T.LongType()),
    T.StructField("query_group_id", T.LongType()),
    T.StructField("category", T.StringType()),
    T.StructField("query", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("keyWords", T.ArrayType(T.StringType())),
])

# Required fields per consumer of the catalogue.
AD_REQUIRED_WEIGHTS = ["category", "query", "campaignId", "query_group_id", "keyWords", "adId"]
AD_REQUIRED_SENTENCES = ["title", "adId", "query"]
AD_REQUIRED_QUERIES = ["query"]

# Click log, 8 positional columns, no header.
CLICK = T.StructType([
    T.StructField("device_ip", T.StringType()),
    T.StructField("device_id", T.StringType()),
    T.StructField("session_id", T.LongType()),
    T.StructField("query", T.StringType()),
    T.StructField("ad_id", T.StringType()),
    T.StructField("campaign_id", T.StringType()),
    T.StructField("cat_match", T.IntegerType()),
    T.StructField("clicked", T.IntegerType()),
])
CLICK_COLUMNS = [f.name for f in CLICK.fields]

# Tall counter table: one row per (kind, key).
COUNTER_KINDS = ["device_ip", "device_id", "ad", "query_campaign", "query_ad"]

SYNONYM = T.StructType([
    T.StructField("word", T.StringType()),
    T.StructField("synonyms", T.ArrayType(T.StringType())),
])

FEATURE_PAIR = T.StructType([
    T.StructField("feature_key", T.StringType()),
    T.StructField("feature_value", T.LongType()),
])

# Feature order of the training vector (fixed by the model contract).
FEATURE_COLUMNS = [
    "ip_clicks", "ip_impressions",
    "device_clicks", "device_impressions",
    "ad_clicks", "ad_impressions",
    "qc_clicks", "qc_impressions",
    "qa_clicks", "qa_impressions",
    "match_feature",
]

# Store-key prefixes per (counter kind, measure), as published.
STORE_PREFIX = {
    ("device_id", "clicks"): "didc",
    ("device_id", "impressions"): "didi",
    ("device_ip", "clicks"): "dipc",
    ("device_ip", "impressions"): "dipi",
    ("ad", "clicks"): "aidc",
    ("ad", "impressions"): "aidi",
    ("query_campaign", "clicks"): "qcidc",
    ("query_campaign", "impressions"): "qcidi",
    ("query_ad", "clicks"): "qaidc",
    ("query_ad", "impressions"): "qaidi",
}

# Fixed value: category-match indicator is scaled to this number in the vector.
MATCH_SCALE = 1000000
