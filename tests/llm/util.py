"""Small tables and brute-force helpers for these tests."""

import random
import re

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
SPACE = re.compile(r"[\x20\x09-\x0D]+")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def frame(spark, rows, extra=True):
    """rows: (doc_id, text[, lang, source]); extra columns have names that operators use inside."""
    full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "s", len(r[1] or "")) for r in rows]
    df = spark.createDataFrame(full, SCHEMA)
    if extra:
        from pyspark.sql import functions as F
        for name in ("key", "size", "place", "h", "n", "term", "spans", "bucket", "kept", "label", "w", "family", "score", "target", "fp", "t"):
            df = df.withColumn(name, F.lit("x"))
    return df


def edge_rows():
    """Nulls, empty and very long texts, ties and repeated rows."""
    rng = random.Random(3)
    long = " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 9))) for _ in range(30_000))
    return [
        (1, "The quick brown fox jumps over the lazy dog near the river bank today.", "en", "a"),
        (2, "The  quick brown fox\tjumps over the lazy dog near the river bank today.", "en", "a"),
        (2, "The  quick brown fox\tjumps over the lazy dog near the river bank today.", "en", "a"),
        (3, None, None, None), (4, "", "en", "b"), (5, " \n\t ", "de", "b"), (None, "text without an id", "en", "a"),
        (None, None, None, None), (7, long, "en", "c"), (8, long + "!", "en", "c"), (9, "x" * 70_000, "fr", None),
        (10, "9" * 30_000 + "@" + "a." * 20_000, "en", "a"), (11, "$$$ %%% 123", "en", "a"), (6, "tie one", "de", "b"), (6, "tie two", "de", "b"),
        (12, "naïve café – Ünïcode 字 \U0001F600 ok\x00end\x85x y", "fr", "a"), (-5, "+++" + "1 " * 20_000, "es", "a"),
        (9_007_199_254_740_993, "big id", "en", "a"), (9_007_199_254_740_992, "big id two", "en", "a"),
    ]


def rows_of(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.select(*cols).collect())


def nulls_last(x):
    return (x is None, x if x is not None else 0)
