"""The queries that apply the operators of this subpackage to whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

import corpus_pipeline
from clickfeat.llm import bpe, common, exact_dedup, fingerprints, langid, license_scan, mixing, packing, periodic_runs, pii, prefix_trie, secret_scan, simhash, token_files

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql:
            ORACLE[name] = sql
        return f
    return add


@query("op1_license_scan")
def op1(spark, sf_dir):
    return license_scan.scan(common.documents(spark, sf_dir))


@query("op2_document_fingerprints")
def op2(spark, sf_dir):
    return fingerprints.compare_with_next(common.documents(spark, sf_dir))


@query("op3_byte_bpe")
def op3(spark, sf_dir):
    return bpe.digests(common.documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


@query("op4_pii")
def op4(spark, sf_dir):
    d = pii.sanitise(common.documents(spark, sf_dir))
    found = F.col("n_email") + F.col("n_ip") + F.col("n_card") + F.col("n_phone") + F.col("n_term")
    return d.select("doc_id", "n_email", "n_ip", "n_card", "n_phone", F.sha2("base", 256).alias("base_sha256"), "spans", "n_term", found.alias("n_found"),
                    F.sha2("sanitised", 256).alias("sanitised_sha256"))


@query("op5_mixing")
def op5(spark, sf_dir):
    return mixing.mix(common.documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken")


@query("op6_simhash_dedup")
def op6(spark, sf_dir):
    d = simhash.near_groups(common.documents(spark, sf_dir))
    return d.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


@query("op7_language_id")
def op7(spark, sf_dir):
    return langid.languages(common.documents(spark, sf_dir))


@query("op8_secret_scan")
def op8(spark, sf_dir):
    d = secret_scan.scan(common.documents(spark, sf_dir))
    return d.select("doc_id", "n_assign", "n_access", "n_hex", F.sha2("base", 256).alias("base_sha256"), "spans", "n_linked")


@query("op9_token_files")
def op9(spark, sf_dir):
    return token_files.round_trip(common.documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"), end_id=2)


@query("op10_exact_dedup", r"""
WITH n AS (
  SELECT doc_id, length(coalesce(text, '')) AS c, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g')) AS text_sha256
  FROM documents)
SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY text_sha256) AS group_size,
       row_number() OVER w = 1 AS kept, text_sha256
FROM n WINDOW w AS (PARTITION BY text_sha256 ORDER BY c DESC, doc_id)""")
def op10(spark, sf_dir):
    return exact_dedup.exact_groups(common.documents(spark, sf_dir)).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


@query("op11_periodic_runs")
def op11(spark, sf_dir):
    return periodic_runs.digests(common.documents(spark, sf_dir), periodic_runs.planted)


@query("op12_packing")
def op12(spark, sf_dir):
    return packing.pack(common.documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN, end_id=0)


@query("op13_prefix_trie")
def op13(spark, sf_dir):
    return prefix_trie.rebuilt_trie(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


@query("pipeline")
def pipeline(spark, sf_dir):
    return corpus_pipeline.run(spark, sf_dir)
