"""A training corpus from ``documents``: language ID, exact dedup, SimHash near-dedup, mixing, BPE.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes each result as
Parquet below ``spark.checkpoint.dir`` and reads it as the next stage's documents.  All stages
but the last return the columns of ``documents``:

* ``language_id`` keeps the documents whose language is known (a document without a letter, or
  one where no language has half of the probability, goes);
* ``exact_dedup`` keeps one row of each group of equal texts (white space aside);
* ``simhash_dedup`` keeps the document with the smallest doc_id of each near-duplicate group;
* ``mix_sources`` repeats or drops documents so that every source comes near its target;
* ``bpe_encode`` returns doc_id, n_tokens, ids_sha256 and decoded_sha256, one row per document of the mix.

SQL can express neither the trained classifier nor the encoder, so there is no oracle SQL; the
tests hold ``run`` against a brute-force version.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from clickfeat import session
from clickfeat.llm import bpe, common, exact_dedup, langid, mixing, simhash

TOKENIZER = "byte_bpe_50k.tiktoken"


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return langid.known_language(docs)


def drop_exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.keep_one(docs)


def drop_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_rows(docs)


def bpe_encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.digests(docs, public_tokenizers.path(TOKENIZER), public_tokenizers.PATTERN)


STAGES = [("language_id", language_id), ("exact_dedup", drop_exact), ("simhash_dedup", drop_near),
          ("mix_sources", mix_sources), ("bpe_encode", bpe_encode)]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = session.materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
