"""Text queries: token cleaning, keys, windows, n-grams, sentences."""

from __future__ import annotations

from pyspark.sql import functions as F

from clickfeat.functions.keys import query_id_key
from clickfeat.functions.text import DIGITS_ONLY, clean_tokens, query_key
from clickfeat.operators import text as tx
from clickfeat.plans.registry import register, sql_with
from clickfeat.sinks.files import sentence_lines
from clickfeat.sources.files import parse_sentences
from clickfeat.sources.fixtures import ad_view, click_view, table

def clean_sql(x: str) -> str:
    return (f"array_to_string(list_filter(string_split({x}, ' '), "
            f"lambda t: NOT regexp_matches(t, '{DIGITS_ONLY}') AND length(t) > 1), ' ')")


SENT_SQL = f"{clean_sql('lower(query)')} || ' ' || {clean_sql('lower(title)')}"
WORDS_CTE = [f"sent AS (SELECT ad_id, {SENT_SQL} AS sentence FROM ad)",
             "words AS (SELECT ad_id, list_filter(string_split(sentence, ' '), lambda t: t <> '') AS w FROM sent)"]


@register("clean_tokens", f"SELECT doc_id, {clean_sql('text')} AS cleaned FROM documents")
def q_clean_tokens(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", clean_tokens("text").alias("cleaned"))


@register("query_keys", sql_with(["click"], "SELECT DISTINCT query, replace(query, ' ', '_') AS query_key FROM click"))
def q_query_keys(spark, sf_dir):
    return click_view(spark, sf_dir).select("query", query_key("query").alias("query_key")).distinct()


@register("composite_keys", sql_with(["click"], """SELECT DISTINCT query, campaign_id, ad_id,
  replace(query, ' ', '_') || '_' || CAST(campaign_id AS VARCHAR) AS query_campaign_key,
  replace(query, ' ', '_') || '_' || CAST(ad_id AS VARCHAR) AS query_ad_key FROM click"""))
def q_composite_keys(spark, sf_dir):
    c = click_view(spark, sf_dir).select("query", "campaign_id", "ad_id").distinct()
    return c.select("query", "campaign_id", "ad_id",
                    query_id_key("query", "campaign_id").alias("query_campaign_key"),
                    query_id_key("query", "ad_id").alias("query_ad_key"))


@register("export_sentences", sql_with(["ad"], f"SELECT ad_id, {SENT_SQL} AS sentence FROM ad"))
def q_export_sentences(spark, sf_dir):
    return tx.sentences(ad_view(spark, sf_dir), keep=["ad_id"])


@register("scan_sentences", sql_with(["ad"], """SELECT ad_id, CAST(i AS INTEGER) AS idx, w[i] AS word
FROM (SELECT ad_id, string_split(sentence, ' ') AS w FROM sent), LATERAL (SELECT unnest(range(1, len(w) + 1)) AS i)""",
                                     WORDS_CTE[:1]))
def q_scan_sentences(spark, sf_dir):
    # sentence lines as the sink writes them, parsed back by the reader
    lines = sentence_lines(tx.sentences(ad_view(spark, sf_dir), keep=["ad_id"]), keep=["ad_id"])
    words = parse_sentences(lines)
    return words.select("ad_id", F.posexplode("words").alias("idx", "word")).select(
        "ad_id", (F.col("idx") + 1).alias("idx"), "word")


@register("token_windows", sql_with(["ad"], """SELECT ad_id, CAST(i - 1 AS INTEGER) AS idx, t[i] || ' ' || t[i + 1] AS window
FROM (SELECT ad_id, string_split(lower(title), ' ') AS t FROM ad), LATERAL (SELECT unnest(range(1, len(t))) AS i)"""))
def q_token_windows(spark, sf_dir):
    ads = ad_view(spark, sf_dir).select("ad_id", F.split(F.lower("title"), " ", -1).alias("t"))
    w = tx.windows(ads, "t", 2, ["ad_id"])
    return w.select("ad_id", "idx", F.array_join("window", " ").alias("window"))


NGRAM_SQL = """SELECT ngram, count(*) AS n FROM (
  SELECT unnest(list_transform(range(1, len(w) + 1), lambda i: w[i])) AS ngram FROM words
  UNION ALL
  SELECT unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) FROM words
  UNION ALL
  SELECT unnest(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) FROM words
) GROUP BY 1"""


@register("ngram_counts", sql_with(["ad"], NGRAM_SQL, WORDS_CTE))
def q_ngram_counts(spark, sf_dir):
    words = tx.sentence_words(tx.sentences(ad_view(spark, sf_dir)))
    return tx.ngram_counts(words, 3)


@register("w2v_vocabulary", sql_with(["ad"], "SELECT word, count(*) AS n FROM (SELECT unnest(w) AS word FROM words) "
                                     "GROUP BY 1 HAVING count(*) >= 5", WORDS_CTE))
def q_w2v_vocabulary(spark, sf_dir):
    words = tx.sentence_words(tx.sentences(ad_view(spark, sf_dir)))
    return tx.vocabulary(words, 5)
