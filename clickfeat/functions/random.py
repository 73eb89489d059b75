"""Seeded, partition-independent uniforms.

u(key) = first 13 hex digits of md5(key) / 2**52 (exact in a double), key = seed|part1|part2...
The same key gives the same number on any cluster layout and after task
retries, and the same expression is writable in plain SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

TWO_POW_52 = 4503599627370496.0


def seed_key(seed, *parts) -> Column:
    """``seed|part1|part2...``; a NULL part gives a NULL key (no draw) rather than
    silently merging with another key, as concat_ws would."""
    cols = [F.lit(str(seed))]
    for p in parts:
        cols += [F.lit("|"), (F.col(p) if isinstance(p, str) else p).cast("string")]
    return F.concat(*cols)


def uniform_of_key(key: Column) -> Column:
    return F.conv(F.substring(F.md5(key), 1, 13), 16, 10).cast("bigint") / F.lit(TWO_POW_52)


def hash_uniform(seed, *parts) -> Column:
    """Uniform in [0, 1) from a seed and key columns/literals."""
    return uniform_of_key(seed_key(seed, *parts))


def pick_index(u: Column, n: Column) -> Column:
    """Index in [0, n) for a uniform u (uniform 1-of-n pick)."""
    return F.least(F.floor(u * n).cast("bigint"), (n - 1).cast("bigint"))
