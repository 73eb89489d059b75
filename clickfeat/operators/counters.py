"""Click / impression counters per device ip, device id, ad, query x campaign
and query x ad.

``all_counters`` reads the log once.  The three kinds that are part of (query, campaign, ad) are not
counted on raw rows: one GROUPING SETS aggregate counts device ips, device ids and
(query, campaign, ad) -- FileScan -> Expand(x3) -> partial HashAggregate -> Exchange -> final
HashAggregate; ad, query x campaign and query x ad are then added up by a second aggregate from
its (query, campaign, ad) rows, of which there are as many as different triples.  The partial
(map-side) aggregates emit at most one row per key per task, so a key holding a third of the
log is pre-aggregated before the shuffle and never lands whole in one task.

A stream keeps one aggregate (method "grouping_sets": all five sets at once, Expand x5).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

KEY_COLS = ["device_ip", "device_id", "query", "campaign_id", "ad_id"]

# kind -> grouping columns
KIND_KEYS = {
    "device_ip": ["device_ip"],
    "device_id": ["device_id"],
    "ad": ["ad_id"],
    "query_campaign": ["query", "campaign_id"],
    "query_ad": ["query", "ad_id"],
}


def _measures():
    return [F.sum("clicked").cast("bigint").alias("clicks"), F.count(F.lit(1)).alias("impressions")]


def counter(clicks: DataFrame, kind: str) -> DataFrame:
    """One kind: (key columns..., clicks, impressions)."""
    keys = KIND_KEYS[kind]
    return clicks.groupBy(*keys).agg(*_measures())


def _kind_expr() -> F.Column:
    g = F.grouping
    return (F.when(g("device_ip") == 0, "device_ip")
             .when(g("device_id") == 0, "device_id")
             .when(g("campaign_id") == 0, "query_campaign")
             .when(g("query") == 0, "query_ad")
             .otherwise("ad"))


# the sets counted on raw rows, and those added up from the last of them
BASE_SETS = [["device_ip"], ["device_id"], ["query", "campaign_id", "ad_id"]]
LATTICE_KINDS = ["ad", "query_campaign", "query_ad"]


def _lattice(c: DataFrame, measures: list, sums: list, extra: list[str]) -> DataFrame:
    """Tall table by the lattice.  ``measures``: aggregates of raw rows, ``sums``: the same of their results, ``extra``: columns besides the counts."""
    level = (F.when(F.grouping("device_ip") == 0, "device_ip").when(F.grouping("device_id") == 0, "device_id").otherwise("triple"))
    base = c.groupingSets(BASE_SETS, *KEY_COLS).agg(*measures, level.alias("level"))

    def row(kind, keys: list[str]):
        return F.struct(kind.alias("kind"), *[(F.col(k) if k in keys else F.lit(None).cast(c.schema[k].dataType)).alias(k) for k in KEY_COLS])

    device = row(F.col("level"), KEY_COLS[:2])
    triple = [row(F.lit(k), KIND_KEYS[k]) for k in LATTICE_KINDS]
    rows = base.select(F.explode(F.when(F.col("level") == "triple", F.array(*triple)).otherwise(F.array(device))).alias("r"), "clicks", "impressions", *extra)
    rows = rows.select("r.*", "clicks", "impressions", *extra)
    return rows.groupBy("kind", *KEY_COLS).agg(*sums)


def all_counters(clicks: DataFrame, method: str | None = None) -> DataFrame:
    """Tall table (kind, device_ip, device_id, query, campaign_id, ad_id, clicks, impressions).

    method="lattice": three sets from raw rows, the others from their result (default).
    method="grouping_sets": one scan, one shuffle (the default of a stream).
    method="union": five independent aggregates (five scans) -- kept for benchmarking.
    """
    c = clicks.select(*KEY_COLS, "clicked")
    method = method or ("grouping_sets" if clicks.isStreaming else "lattice")
    if method == "lattice":
        return _lattice(c, _measures(), [F.sum("clicks").alias("clicks"), F.sum("impressions").alias("impressions")], [])
    if method == "union":
        parts = []
        for kind, keys in KIND_KEYS.items():
            agg = c.groupBy(*keys).agg(*_measures())
            parts.append(agg.select(F.lit(kind).alias("kind"),
                                    *[(F.col(k) if k in keys else F.lit(None).cast(c.schema[k].dataType)).alias(k)
                                      for k in KEY_COLS], "clicks", "impressions"))
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out
    sets = [KIND_KEYS[k] for k in KIND_KEYS]
    g = c.groupingSets(sets, *KEY_COLS).agg(*_measures(), _kind_expr().alias("kind"))
    return g.select("kind", *KEY_COLS, "clicks", "impressions")


def fold_counters(clicks: DataFrame, fold_col: str, folds: int) -> DataFrame:
    """``all_counters`` with fold_clicks and fold_impressions: arrays of the counts in each of ``folds`` folds
    (``fold_col``: 0 to folds - 1), from the same aggregates."""
    c = clicks.select(*KEY_COLS, "clicked", F.col(fold_col).alias("_fold"))
    names = [f"_{m}{i}" for m in ("c", "n") for i in range(folds)]
    measures = [F.sum(F.when(F.col("_fold") == i, F.col("clicked")).otherwise(0)).cast("bigint").alias(f"_c{i}") for i in range(folds)]
    measures += [F.count(F.when(F.col("_fold") == i, 1)).alias(f"_n{i}") for i in range(folds)]
    sums = [F.sum(x).alias(x) for x in ("clicks", "impressions", *names)]
    tall = _lattice(c, _measures() + measures, sums, names)
    return tall.select("kind", *KEY_COLS, "clicks", "impressions", F.array(*names[:folds]).alias("fold_clicks"), F.array(*names[folds:]).alias("fold_impressions"))


def counters_of_kind(all_c: DataFrame, kind: str) -> DataFrame:
    """Slice one kind out of the tall table, keeping only its key columns."""
    more = [c for c in ("fold_clicks", "fold_impressions") if c in all_c.columns]
    return all_c.where(F.col("kind") == kind).select(*KIND_KEYS[kind], "clicks", "impressions", *more)
