"""Sentence corpus, n-grams and vocabulary counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from clickfeat.functions.text import clean_tokens, ngrams, token_windows, tokens


def sentences(ads: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """One training sentence per ad: cleaned lower-case query, a space, cleaned
    lower-case title (an empty cleaned query still leaves the separator)."""
    s = F.concat(clean_tokens(F.lower("query")), F.lit(" "), clean_tokens(F.lower("title")))
    return ads.select(*(keep or []), s.alias("sentence"))


def sentence_words(sent: DataFrame, col: str = "sentence", drop_empty: bool = True) -> DataFrame:
    """Sentence -> words array (split on single spaces; empty tokens dropped by default)."""
    w = tokens(col)
    if drop_empty:
        w = F.filter(w, lambda t: t != "")
    return sent.withColumn("words", w)


def ngram_counts(words: DataFrame, size: int = 3, col: str = "words") -> DataFrame:
    """Corpus n-gram counts for n = 1..size (partial aggregate, one shuffle)."""
    return (words.select(F.explode(ngrams(F.col(col), size)).alias("ngram"))
                 .groupBy("ngram").agg(F.count(F.lit(1)).alias("n")))


def windows(df: DataFrame, col: str, n: int, keep: list[str]) -> DataFrame:
    """Sliding windows of width n, one row each with its start index."""
    return df.select(*keep, F.posexplode(token_windows(F.col(col), n)).alias("idx", "window"))


def vocabulary(words: DataFrame, min_count: int = 5, col: str = "words") -> DataFrame:
    """Words with at least ``min_count`` occurrences (the Word2Vec vocabulary)."""
    return (words.select(F.explode(col).alias("word")).groupBy("word")
                 .agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_count))
