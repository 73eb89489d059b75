"""Writers.  Published tables are parquet unless a line format is asked for;
nothing is funnelled through the driver or one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from clickfeat.operators.lookup import split_join
from clickfeat.sinks.delta_store import DeltaStore


def nested_map_lines(rows: DataFrame, group: str = "query_group_id", campaign: str = "campaign_id",
                     item: str = "ad_id", order: str = "pos", chunk: int = 10000) -> DataFrame:
    """Rows -> JSON lines ``{"chunk": k, "map": {group: {campaign: [items in order]}}}``.

    The reference writes one document; here each line holds one (group,
    campaign, chunk) so no line grows with the catalogue: a chunk covers the
    positions [k*chunk, (k+1)*chunk), hence at most ``chunk`` items, and carries its
    number, so reading all lines gives back the full map with its order.
    """
    k = F.floor(F.col(order) / chunk).alias("_chunk")
    agg = rows.groupBy(group, campaign, k).agg(
        F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col(item).alias("i")))).alias("_l"))
    inner = F.create_map(F.col(campaign).cast("string"), F.transform("_l", lambda s: s["i"]))
    return agg.select(F.to_json(F.struct(
        F.col("_chunk").alias("chunk"), F.create_map(F.col(group).cast("string"), inner).alias("map"))).alias("value"))


def write_nested_map(rows: DataFrame, path: str, mode: str = "overwrite", **kw) -> None:
    nested_map_lines(rows, **kw).write.mode(mode).text(path)


def flat_map_lines(rows: DataFrame, key: str, value: str) -> DataFrame:
    """Rows -> JSON lines ``{key: value}``, one entry a line: all lines together are the published document.  Rows without a key
    cannot be written as such and are left out."""
    return rows.where(F.col(key).isNotNull()).select(F.to_json(F.create_map(F.col(key).cast("string"), F.col(value)), {"ignoreNullFields": "false"}).alias("value"))


def list_map_lines(rows: DataFrame, key: str = "campaign_id", item: str = "ad_id", order: str = "pos", chunk: int = 10000) -> DataFrame:
    """Rows -> JSON lines ``{"chunk": k, "map": {key: [items in order]}}``; as in ``nested_map_lines`` a chunk covers ``chunk`` positions."""
    k = F.floor(F.col(order) / chunk).alias("_chunk")
    agg = rows.where(F.col(key).isNotNull()).groupBy(key, k).agg(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col(item).alias("i")))).alias("_l"))
    listed = F.create_map(F.col(key).cast("string"), F.transform("_l", lambda s: s["i"]))
    return agg.select(F.to_json(F.struct(F.col("_chunk").alias("chunk"), listed.alias("map"))).alias("value"))


def set_map_lines(rows: DataFrame, key: str = "query_group_id", member: str = "query", chunk: int = 10000) -> DataFrame:
    """Distinct rows -> JSON lines ``{key: {member: 1, ...}}``.  The members of a key are dealt by hash over as many lines as it takes
    for about ``chunk`` members each, so no line grows with a key."""
    d = rows.where(F.col(key).isNotNull() & F.col(member).isNotNull()).select(key, F.col(member).cast("string").alias("_m")).distinct()
    many = d.groupBy(key).agg(F.ceil(F.count(F.lit(1)) / chunk).alias("_lines"))
    part = F.pmod(F.xxhash64("_m"), F.col("_lines")).alias("_part")
    agg = split_join(d, many, [key]).groupBy(key, part).agg(F.sort_array(F.collect_list("_m")).alias("_l"))
    ones = F.map_from_arrays("_l", F.transform("_l", lambda _: F.lit(1)))
    return agg.select(F.to_json(F.create_map(F.col(key).cast("string"), ones)).alias("value"))


def write_lines(lines: DataFrame, path: str, mode: str = "overwrite") -> None:
    lines.write.mode(mode).text(path)


def write_jsonl(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """JSON lines (the feature pairs, synonyms, rewrites).  ``mode='append'``
    reproduces the append-on-rerun behaviour of the published feature file."""
    df.write.mode(mode).json(path)


def clicks_csv_lines(clicks: DataFrame) -> DataFrame:
    """Quoted CSV lines, so commas inside queries survive."""
    return clicks.select(F.to_csv(F.struct(*clicks.columns)).alias("value"))


def write_clicks_csv(clicks: DataFrame, path: str, mode: str = "overwrite") -> None:
    clicks.write.mode(mode).option("quoteAll", "false").csv(path)


def sentence_lines(sentences: DataFrame, col: str = "sentence", keep: list[str] | None = None) -> DataFrame:
    return sentences.select(*(keep or []), F.col(col).alias("value"))


def write_sentences(sentences: DataFrame, path: str, col: str = "sentence", mode: str = "overwrite") -> None:
    sentence_lines(sentences, col).write.mode(mode).text(path)


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).parquet(path)


def publish_feature_store(spark: SparkSession, new: DataFrame, base: str) -> int:
    """Keyed upsert into the delta store under ``base`` (sinks/delta_store.py): writes the new keys only.  Returns the version."""
    return DeltaStore(spark, base).publish(new)["version"]


def read_feature_store(spark: SparkSession, base: str) -> DataFrame:
    return DeltaStore(spark, base).read()


def write_lr_model_json(model_row: DataFrame, path: str) -> None:
    """One-row (weights array<double>, bias double) -> JSON."""
    model_row.coalesce(1).write.mode("overwrite").json(path)


def _py_quote(col) -> F.Column:
    """Quote a string the way Python's repr does for plain text: single quotes,
    or double quotes when the text holds a single quote (and no double quote)."""
    c = F.col(col) if isinstance(col, str) else col
    dq = F.instr(c, "'") > 0
    return F.when(dq & (F.instr(c, '"') == 0), F.concat(F.lit('"'), c, F.lit('"'))) \
            .otherwise(F.concat(F.lit("'"), F.regexp_replace(c, "'", "\\\\'"), F.lit("'")))


def tuple_pair_lines(df: DataFrame, key_col: str, value_col: str, keep: list[str] | None = None) -> DataFrame:
    """Legacy text form of a (key, count) pair: ``('key', 12)``."""
    return df.select(*(keep or []), F.concat(F.lit("("), _py_quote(F.col(key_col).cast("string")), F.lit(", "),
                              F.col(value_col).cast("string"), F.lit(")")).alias("value"))


def training_tuple_lines(vectors: DataFrame, feature_cols: list[str], label_col: str = "label", keep: list[str] | None = None) -> DataFrame:
    """Legacy text form of a training row: ``('f1,...,f11', label)``."""
    feats = F.concat_ws(",", *[F.col(c).cast("string") for c in feature_cols])
    return vectors.select(*(keep or []), F.concat(F.lit("('"), feats, F.lit("', "), F.col(label_col).cast("string"),
                                   F.lit(")")).alias("value"))
