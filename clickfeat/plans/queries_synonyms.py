"""Embeddings, neighbours, synonym lists and query rewrites."""

from __future__ import annotations

from pyspark.sql import functions as F

from clickfeat.operators import text as tx
from clickfeat.operators.neighbours import top_k_cosine, word_neighbours
from clickfeat.operators.rewrites import rewrite_lines, rewrite_rows
from clickfeat.operators.word2vec import fit_word2vec, word_vectors
from clickfeat.plans.registry import register, sql_with
from clickfeat.sources.files import parse_synonyms
from clickfeat.sources.fixtures import ad_view, synonym_view, table

COSINE_SQL = """SELECT vec_id, rank, other_id, round(similarity, 6) AS similarity FROM (
  SELECT a.vec_id, b.vec_id AS other_id,
         list_cosine_similarity(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])) AS similarity,
         CAST(row_number() OVER (PARTITION BY a.vec_id ORDER BY
              list_cosine_similarity(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])) DESC, b.vec_id) AS BIGINT) AS rank
  FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id) WHERE rank <= 5"""


@register("cosine_top5", COSINE_SQL)
def q_cosine_top5(spark, sf_dir):
    nb = top_k_cosine(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", k=5)
    return nb.select("vec_id", "rank", "other_id", F.round("similarity", 6).alias("similarity"))


def _words(spark, sf_dir):
    return tx.sentence_words(tx.sentences(ad_view(spark, sf_dir)))


@register("w2v_vectors")
def q_w2v_vectors(spark, sf_dir):
    """Word vectors of the published settings (rows-only check; property tests)."""
    return word_vectors(fit_word2vec(_words(spark, sf_dir)))


@register("w2v_synonyms")
def q_w2v_synonyms(spark, sf_dir):
    """Top-5 neighbours of every vocabulary word in the fitted embedding."""
    return word_neighbours(word_vectors(fit_word2vec(_words(spark, sf_dir))), k=5)


SYN_CTES = ["synl AS (SELECT word, list_append(synonyms, word) AS synonyms FROM syn)"]


@register("scan_synonyms", sql_with(["syn"], """SELECT word, CAST(i - 1 AS INTEGER) AS idx, synonyms[i] AS synonym
FROM synl, LATERAL (SELECT unnest(range(1, len(synonyms) + 1)) AS i)""", SYN_CTES))
def q_scan_synonyms(spark, sf_dir):
    lines = synonym_view(spark, sf_dir).select(F.to_json(F.struct("word", "synonyms")).alias("value"))
    syn = parse_synonyms(lines)
    return syn.select("word", F.posexplode("synonyms").alias("idx", "synonym"))


REWRITE_CTES = SYN_CTES + [
    "q AS (SELECT min(query) AS query FROM ad WHERE query IS NOT NULL GROUP BY replace(query, ' ', '_'))",
    "terms AS (SELECT query, CAST(ti AS INTEGER) AS ti, string_split(query, ' ')[ti] AS term "
    "FROM q, LATERAL (SELECT unnest(range(1, len(string_split(query, ' ')) + 1)) AS ti))",
    "alts AS (SELECT t.query, t.ti, coalesce(s.synonyms, [t.term]) AS alts FROM terms t LEFT JOIN synl s ON s.word = t.term)",
    "items AS (SELECT query, ti, CAST(ai AS INTEGER) AS ai, alts[ai] AS item FROM alts, "
    "LATERAL (SELECT unnest(range(1, len(alts) + 1)) AS ai))",
    "nt AS (SELECT query, max(ti) AS n FROM terms GROUP BY 1)",
    """r AS (SELECT * FROM (WITH RECURSIVE rec(query, ti, s, ord) AS (
        SELECT query, ti, item, [ai] FROM items WHERE ti = 1
        UNION ALL
        SELECT rec.query, rec.ti + 1, rec.s || '_' || i.item, list_append(rec.ord, i.ai)
        FROM rec JOIN items i ON i.query = rec.query AND i.ti = rec.ti + 1)
      SELECT rec.query, s, ord FROM rec JOIN nt ON nt.query = rec.query AND rec.ti = nt.n))""",
    "firsts AS (SELECT query, s, min(ord) AS ord FROM r GROUP BY 1, 2)",
]


@register("query_rewrites", sql_with(["syn"], """SELECT replace(query, ' ', '_') AS query_key,
  CAST(row_number() OVER (PARTITION BY query ORDER BY ord) - 1 AS BIGINT) AS idx, s AS rewrite FROM firsts""",
                                     REWRITE_CTES))
def q_query_rewrites(spark, sf_dir):
    syn = synonym_view(spark, sf_dir).select("word", F.array_append("synonyms", F.col("word")).alias("synonyms"))
    return rewrite_rows(ad_view(spark, sf_dir), syn)


@register("export_rewrites", sql_with(["syn"], """SELECT query_key, chunk, string_agg(rewrite, ',' ORDER BY idx) AS rewrites FROM (
SELECT query_key, idx, CAST(floor(idx / 10000) AS BIGINT) AS chunk, rewrite FROM (
SELECT replace(query, ' ', '_') AS query_key, row_number() OVER (PARTITION BY query ORDER BY ord) - 1 AS idx, s AS rewrite
FROM firsts)) GROUP BY 1, 2""", REWRITE_CTES))
def q_export_rewrites(spark, sf_dir):
    syn = synonym_view(spark, sf_dir).select("word", F.array_append("synonyms", F.col("word")).alias("synonyms"))
    lines = rewrite_lines(rewrite_rows(ad_view(spark, sf_dir), syn))
    return lines.select("query_key", "chunk", F.array_join("rewrites", ",").alias("rewrites"))
