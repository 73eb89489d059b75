"""File readers.  Each reader is ``spark.read.text`` (or a typed reader) plus a
column-level parser; the parsers also work on any DataFrame with a ``value``
string column, which is how the registered queries exercise them.

Row order matters for the published catalogue maps (last wins, first
appearance), so readers attach ``pos``: a dense, distributed file position
built from the hidden ``_metadata`` columns (path, block start) and the row's
place inside its split -- no single-task numbering and no sort: rows are counted per split, the counts are
added up over the splits in order, and each row adds its place to its split's offset.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from clickfeat.operators.lookup import within
from clickfeat.schemas import AD, AD_REQUIRED_WEIGHTS, CLICK, CLICK_COLUMNS, SYNONYM
from clickfeat.session import materialize

AD_RENAME = {"adId": "ad_id", "campaignId": "campaign_id", "keyWords": "keywords"}


# --------------------------------------------------------------- positions
def with_file_position(df: DataFrame, name: str = "pos") -> DataFrame:
    """Dense 0-based position in (file path, offset) order.  A split (path, block start) is read by one task from its first
    row to its last, so the first row's id and the split's offset give the position; the table of splits has one row per
    split of the input and is joined by its measured size."""
    d = df.select("*", F.col("_metadata.file_path").alias("_fp"),
                  F.col("_metadata.file_block_start").alias("_fb"),
                  F.monotonically_increasing_id().alias("_row"))
    splits = d.groupBy("_fp", "_fb").agg(F.count(F.lit(1)).alias("_n"), F.min("_row").alias("_first"))
    before = Window.orderBy("_fp", "_fb").rowsBetween(Window.unboundedPreceding, -1)        # one row per split
    splits = materialize(splits.select("_fp", "_fb", (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_off")), "splits")
    # also beyond the threshold no split has more rows than its block holds: a plain join, no hot key
    splits = F.broadcast(splits) if within(splits) else splits
    return d.join(splits, ["_fp", "_fb"]).withColumn(name, F.col("_row") + F.col("_off")).drop("_fp", "_fb", "_row", "_off")


def read_lines(spark: SparkSession, path: str, positions: bool = False) -> DataFrame:
    df = spark.read.text(path)
    return with_file_position(df) if positions else df


# --------------------------------------------------------------- ads (JSON lines)
def parse_ads(lines: DataFrame, schema: T.StructType = AD, required: list[str] = AD_REQUIRED_WEIGHTS) -> DataFrame:
    """JSON line -> typed ad row; rows missing a required field (absent or JSON
    null) are dropped.  Keeps ``pos`` when present."""
    keep = ["pos"] if "pos" in lines.columns else []
    parsed = lines.select(F.from_json("value", schema).alias("j"), *keep).select("j.*", *keep)
    parsed = parsed.dropna(subset=required)
    for a, b in AD_RENAME.items():
        if a in parsed.columns:
            parsed = parsed.withColumnRenamed(a, b)
    return parsed


def read_ads(spark: SparkSession, path: str, schema: T.StructType = AD,
             required: list[str] = AD_REQUIRED_WEIGHTS) -> DataFrame:
    return parse_ads(read_lines(spark, path, positions=True), schema, required)


# --------------------------------------------------------------- users (CSV, no header)
def parse_users(lines: DataFrame) -> DataFrame:
    """``ip,dev1,...,dev5`` -> (ip, devices[<=5], pos).  Extra fields ignored."""
    keep = ["pos"] if "pos" in lines.columns else []
    f = F.split(F.trim("value"), ",", -1)
    return lines.select(F.element_at(f, 1).alias("ip"), F.slice(f, 2, 5).alias("devices"), *keep)


def read_users(spark: SparkSession, path: str) -> DataFrame:
    return parse_users(read_lines(spark, path, positions=True))


# --------------------------------------------------------------- click log (CSV)
CLICK_DDL = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in CLICK.fields)


def valid_click_lines(lines: DataFrame) -> DataFrame:
    """Row-arity guard on raw unquoted lines: keep lines with at least 8 fields."""
    return lines.where(F.size(F.split("value", ",", -1)) >= 8)


CLICK_TEXT = [f.name for f in CLICK.fields if isinstance(f.dataType, T.StringType)]
_CORRUPT = "_corrupt"


def _click_rows(lines: DataFrame) -> DataFrame:
    """``value`` with its typed fields (struct c) and whether the line is good.  The whole line is always
    parsed with the full schema, so what is good never depends on the columns a caller reads: a line is
    bad if it does not have exactly 8 fields, a number does not parse, or a flag is not 0 or 1.  Blank
    fields are no fault: a blank id is the id ''."""
    c = F.from_csv("value", f"{CLICK_DDL}, {_CORRUPT} string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT})
    d = lines.select("value", c.alias("c"))
    flag = lambda x: F.col(f"c.{x}").isin(0, 1)
    good = F.col("c").isNotNull() & F.col(f"c.{_CORRUPT}").isNull() & flag("cat_match") & flag("clicked")
    return d.withColumn("good", F.coalesce(good, F.lit(False)))


def parse_clicks(lines: DataFrame) -> DataFrame:
    """CSV line (quoted fields allowed) -> 8 typed columns; the other lines are in ``rejected_clicks``."""
    d = _click_rows(lines).where("good")
    return d.select(*[(F.coalesce(f"c.{x}", F.lit("")) if x in CLICK_TEXT else F.col(f"c.{x}")).alias(x) for x in CLICK_COLUMNS])


def rejected_clicks(lines: DataFrame) -> DataFrame:
    """Quarantine: the lines that ``parse_clicks`` leaves out."""
    return _click_rows(lines).where(~F.col("good")).select("value")


def read_clicks(spark: SparkSession, path: str, min_partitions: int | None = None) -> DataFrame:
    """The click log of files; batch, text and stream readers share ``parse_clicks``.  ``min_partitions``
    spreads a small log for parallel work."""
    df = parse_clicks(spark.read.text(path))
    return df.repartition(min_partitions) if min_partitions else df


def blank(*cols: str):
    """Guard of the samplers: is one of the columns null or exactly empty?"""
    bad = F.lit(False)
    for c in cols:
        bad = bad | F.coalesce(F.col(c).cast("string") == "", F.lit(True))
    return bad


# --------------------------------------------------------------- counters as tuple text
def parse_tuple_pairs(lines: DataFrame) -> DataFrame:
    """``('key', 12)`` / ``("men's", 3)`` lines -> (key, value bigint).  The key
    may contain commas and either quote style."""
    m = F.regexp_extract("value", r"^\s*\((.*),\s*(-?\d+)\s*\)\s*$", 1)
    v = F.regexp_extract("value", r"^\s*\((.*),\s*(-?\d+)\s*\)\s*$", 2)
    key = F.regexp_replace(F.trim(m), r"""^[uU]?(['"])(.*)\1$""", "$2")
    key = F.regexp_replace(key, r"\\'", "'")
    others = [c for c in lines.columns if c != "value"]
    return (lines.select(*others, key.alias("key"), v.try_cast("bigint").alias("value"))
                 .where(F.col("value").isNotNull()))


def read_counter_dirs(spark: SparkSession, dirs: dict[str, str]) -> DataFrame:
    """{store prefix: text dir} -> (feature_key, feature_value)."""
    out = None
    for prefix, d in dirs.items():
        df = parse_tuple_pairs(spark.read.text(f"{d}/part*")).select(
            F.concat_ws("_", F.lit(prefix), "key").alias("feature_key"), F.col("value").alias("feature_value"))
        out = df if out is None else out.unionByName(df)
    return out


# --------------------------------------------------------------- training set as tuple text
def parse_training_points(lines: DataFrame, n_features: int = 11) -> DataFrame:
    """``('f1,f2,...,f11', label)`` -> (label double, f0..f10 double).  A field
    that is not a number makes the row NULL there; see ``rejected_points``."""
    f = F.split(F.regexp_replace(F.trim("value"), r"^\(+|\)+$", ""), ",", -1)

    def num(i):
        x = F.element_at(f, i + 1)
        x = F.trim(F.regexp_replace(F.trim(x), r"^'+|'+$", ""))
        return x.try_cast("double")

    cols = [num(i).alias(f"f{i}") for i in range(n_features)]
    others = [c for c in lines.columns if c != "value"]
    return lines.select(*others, num(n_features).alias("label"), *cols)


def rejected_points(lines: DataFrame, n_features: int = 11) -> DataFrame:
    """Quarantine: the raw lines whose label or any feature does not parse."""
    p = parse_training_points(lines.select("value", F.col("value").alias("_raw")), n_features)
    bad = F.col("label").isNull()
    for i in range(n_features):
        bad = bad | F.col(f"f{i}").isNull()
    return p.where(bad).select(F.col("_raw").alias("value"))


# --------------------------------------------------------------- sentences
def parse_sentences(lines: DataFrame) -> DataFrame:
    """Split on single spaces (empty tokens kept, as written); other columns kept."""
    return lines.select(*[c for c in lines.columns if c != "value"], F.split("value", " ", -1).alias("words"))


# --------------------------------------------------------------- synonyms (JSON lines)
def parse_synonyms(lines: DataFrame) -> DataFrame:
    """(word, synonyms + [word]); a word listed twice keeps its last line."""
    has_pos = "pos" in lines.columns
    p = lines.select(F.from_json("value", SYNONYM).alias("j"),
                     *(["pos"] if has_pos else [F.monotonically_increasing_id().alias("pos")]))
    p = p.where(F.col("j.word").isNotNull() & F.col("j.synonyms").isNotNull())
    last = p.groupBy(F.col("j.word").alias("word")).agg(F.max_by("j.synonyms", "pos").alias("synonyms"))
    return last.select("word", F.array_append("synonyms", F.col("word")).alias("synonyms"))


def read_synonyms(spark: SparkSession, path: str) -> DataFrame:
    return parse_synonyms(read_lines(spark, path, positions=True))


# --------------------------------------------------------------- map documents
def parse_flat_map(lines: DataFrame, key: str, value: str, key_type: str = "string", value_type: str = "double") -> DataFrame:
    """``{key: value, ...}`` lines (one entry or many, also a whole published document) -> (key, value)."""
    m = lines.select(F.explode(F.from_json("value", f"map<string, {value_type}>")).alias("_k", value))
    return m.select(F.col("_k").cast(key_type).alias(key), value)


def parse_list_map(lines: DataFrame, key: str = "campaign_id", item: str = "ad_id", key_type: str = "string") -> DataFrame:
    """``{"chunk": k, "map": {key: [item, ...]}}`` lines, or plain documents ``{key: [...]}``, -> (key, item, idx)."""
    kind = "map<string, array<bigint>>"
    j, whole = F.from_json("value", f"chunk bigint, map {kind}"), F.from_json("value", kind)
    m = lines.select(F.coalesce(j["chunk"], F.lit(0)).alias("_k"), F.when(j["map"].isNotNull(), j["map"]).otherwise(whole).alias("m"))
    c = m.select("_k", F.explode("m").alias("_key", "_items"))
    before = Window.partitionBy("_key").orderBy("_k").rowsBetween(Window.unboundedPreceding, -1)      # one number per chunk
    n = c.select("_key", "_k", F.coalesce(F.sum(F.size("_items")).over(before), F.lit(0)).alias("_before"))
    rows = c.join(n, ["_key", "_k"]).select("_key", "_before", F.posexplode("_items").alias("_i", item))
    return rows.select(F.col("_key").cast(key_type).alias(key), item, (F.col("_before") + F.col("_i")).cast("bigint").alias("idx"))


def parse_set_map(lines: DataFrame, key: str = "query_group_id", member: str = "query", key_type: str = "bigint") -> DataFrame:
    """``{key: {member: 1, ...}}`` lines or documents -> (key, member)."""
    m = lines.select(F.explode(F.from_json("value", "map<string, map<string, int>>")).alias("_k", "_m"))
    return m.select(F.col("_k").cast(key_type).alias(key), F.explode(F.map_keys("_m")).alias(member))


# --------------------------------------------------------------- nested map documents
NESTED_MAP = "map<string, map<string, array<bigint>>>"


def parse_nested_map(lines: DataFrame, group: str = "query_group_id", campaign: str = "campaign_id",
                     item: str = "ad_id") -> DataFrame:
    """``{"chunk": k, "map": {group: {campaign: [item, ...]}}}`` lines, or plain published documents
    ``{group: {campaign: [...]}}``, -> (group, campaign, item, idx).  ``idx`` is the place in the whole list: a
    chunk's items come after those of the list's earlier chunks.  Keys come back as strings (JSON object keys)."""
    j = F.from_json("value", f"chunk bigint, map {NESTED_MAP}")
    whole = F.from_json("value", NESTED_MAP)
    m = lines.select(F.coalesce(j["chunk"], F.lit(0)).alias("_k"), F.when(j["map"].isNotNull(), j["map"]).otherwise(whole).alias("m"))
    g = m.select("_k", F.explode("m").alias(group, "_cm"))
    c = g.select("_k", group, F.explode("_cm").alias(campaign, "_items"))
    # one number per chunk, not the items, goes through the window
    n = c.select(group, campaign, "_k", F.size("_items").alias("_n"))
    w = Window.partitionBy(group, campaign).orderBy("_k").rowsBetween(Window.unboundedPreceding, -1)
    before = n.select(group, campaign, "_k", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_before"))
    c = c.join(before, [group, campaign, "_k"])
    return c.select(group, campaign, "_before", F.posexplode("_items").alias("_i", item)).select(
        group, campaign, (F.col("_before") + F.col("_i")).cast("int").alias("idx"), item)


def read_nested_map(spark: SparkSession, path: str, **kw) -> DataFrame:
    return parse_nested_map(spark.read.text(path), **kw)
