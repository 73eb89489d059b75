"""Text helpers as Spark column expressions (no Python UDFs)."""

from __future__ import annotations

import sys
import unicodedata

from pyspark.sql import Column, functions as F


def _digit_class() -> str:
    r"""Regex class of the characters Python's str.isdigit() accepts: decimal
    digits (\p{Nd}) plus the other Numeric_Type=Digit characters (superscripts,
    subscripts, circled digits, ...), derived from the Unicode data by rule."""
    extra = [c for c in map(chr, range(sys.maxunicode + 1))
             if c.isdigit() and unicodedata.category(c) != "Nd"]
    return "[\\p{Nd}" + "".join(f"\\x{{{ord(c):X}}}" for c in extra) + "]"


# A token made only of digits ("42", "²") is dropped by the cleaner, as are
# tokens of one character or less.  Same pattern in Java regex and RE2.
DIGITS_ONLY = "^" + _digit_class() + "+$"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def tokens(col, sep: str = " ") -> Column:
    """Split on one literal separator, keeping empty tokens (like str.split(' '))."""
    return F.split(_c(col), sep if sep != " " else " ", -1)


def clean_token_array(col) -> Column:
    """Tokens of ``col`` without all-digit tokens and tokens of length <= 1."""
    return F.filter(tokens(col), lambda t: (~t.rlike(DIGITS_ONLY)) & (F.length(t) > 1))


def clean_tokens(col) -> Column:
    """Cleaned text: kept tokens re-joined by one space."""
    return F.array_join(clean_token_array(col), " ")


def query_key(col) -> Column:
    """Spaces become underscores: 'running shoes' -> 'running_shoes'."""
    return F.array_join(tokens(col), "_")


def token_windows(tokens_col, n: int) -> Column:
    """Sliding windows of width ``n`` over an array; shorter arrays give none."""
    t = _c(tokens_col)
    return F.when(F.size(t) >= n,
                  F.transform(F.sequence(F.lit(1), F.size(t) - n + 1), lambda i: F.slice(t, i, n))
                  ).otherwise(F.array().cast("array<array<string>>"))


def ngrams(tokens_col, size: int) -> Column:
    """All n-grams of sizes 1..size, each space-joined, shorter sizes first."""
    t = _c(tokens_col)
    parts = [F.transform(token_windows(t, n), lambda w: F.array_join(w, " ")) for n in range(1, size + 1)]
    return F.flatten(F.array(*parts)) if len(parts) > 1 else parts[0]
