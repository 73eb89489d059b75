"""Registered queries: name -> (spark callable, oracle SQL or None).

Each callable takes (spark, sf_dir) and returns a DataFrame over the whole
test tables.  The SQL is the same question asked of DuckDB over the same
parquet files; the fixture views are inlined as CTEs.
"""

from __future__ import annotations

from collections.abc import Callable

QUERIES: dict[str, Callable] = {}
ORACLE: dict[str, str] = {}

# ---- fixture views as DuckDB CTEs (same definitions as sources/fixtures.py) ----
VIEW_SQL = {
    "ad": """ad AS (
  SELECT a.p_partkey AS ad_id, a.p_brand AS campaign_id, CAST(a.p_size AS BIGINT) AS query_group_id,
         lower(a.p_name) AS query, lower(a.p_type) AS category,
         concat(a.p_name, ' ', a.p_brand, ' ', CAST(a.p_size AS VARCHAR)) AS title,
         string_split(coalesce(b.p_name, a.p_name) || ' ' || lower(a.p_type), ' ') AS keywords,
         a.p_partkey AS pos
  FROM part a LEFT JOIN part b ON b.p_partkey = a.p_partkey + 1)""",
    "click": """click AS (
  SELECT c_nationkey AS device_ip, o_custkey AS device_id, l_orderkey AS session_id, p_name AS query,
         l_partkey AS ad_id, p_brand AS campaign_id,
         CAST(l_linestatus = 'F' AS INTEGER) AS cat_match, CAST(l_returnflag = 'R' AS INTEGER) AS clicked
  FROM lineitem JOIN orders ON o_orderkey = l_orderkey
       JOIN customer ON c_custkey = o_custkey JOIN part ON p_partkey = l_partkey)""",
    "usr": """usr AS (
  SELECT c_custkey AS ip, list_transform(range(0, 5), lambda i: CAST(5 * c_custkey + i AS BIGINT)) AS devices,
         c_custkey AS pos
  FROM customer)""",
}
# syn depends on ad
VIEW_SQL["syn"] = """syn_words AS (SELECT DISTINCT string_split(query, ' ')[1] AS word FROM ad),
syn AS (
  SELECT word, list_filter([lead(word, 1) OVER (ORDER BY word), lead(word, 2) OVER (ORDER BY word)],
                           lambda x: x IS NOT NULL) AS synonyms
  FROM syn_words)"""

_VIEW_DEPS = {"syn": ["ad"]}


def sql_with(views: list[str], body: str, ctes: list[str] | None = None) -> str:
    order: list[str] = []
    for v in views:
        for d in _VIEW_DEPS.get(v, []):
            if d not in order:
                order.append(d)
        if v not in order:
            order.append(v)
    parts = [VIEW_SQL[v] for v in order] + list(ctes or [])
    return ("WITH " + ",\n".join(parts) + "\n" + body) if parts else body


def register(name: str, sql: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def load_all() -> None:
    """Import every query module (each registers on import)."""
    from clickfeat.plans import (  # noqa: F401
        queries_counters, queries_catalogue, queries_text, queries_synonyms,
        queries_sampling, queries_models, queries_io,
    )
