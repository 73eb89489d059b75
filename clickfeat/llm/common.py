"""Helpers the operators of this subpackage share."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from clickfeat import session

#: Rows of whole texts that go to a Python worker at once (bounds a worker's memory).
TEXT_ROWS = 500


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below ``spark.checkpoint.dir`` and read it back: lineage is cut
    and lost executors lose nothing that was written."""
    return session.materialize(df, name)


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder below ``spark.checkpoint.dir``."""
    return f"{session.checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


_SHIPPED: set[str] = set()


def workers(spark: SparkSession) -> None:
    """Bound the Arrow batches of whole texts, and ship this package to the Python workers (once per application)."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(TEXT_ROWS))
    sc = spark.sparkContext
    if sc.applicationId not in _SHIPPED:
        root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        path = os.path.join(tempfile.mkdtemp(prefix="clickfeat-"), "clickfeat.zip")
        with zipfile.ZipFile(path, "w") as z:
            for folder, _, names in os.walk(root):
                for name in sorted(names):
                    if name.endswith(".py"):
                        full = os.path.join(folder, name)
                        z.write(full, os.path.relpath(full, os.path.dirname(root)))
        sc.addPyFile(path)
        _SHIPPED.add(sc.applicationId)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_hash(text: Column | str = "text") -> Column:
    """With doc_id, this tells apart rows that share a doc_id; null counts as empty."""
    return F.xxhash64(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")))


def fixed(df: DataFrame, **columns: Column) -> DataFrame:
    """``df`` with more columns that are computed once a row, however often (also inside lambdas) they are used later:
    a generator of one row stands between, into which the optimizer inlines nothing."""
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(k) for k, c in columns.items()]))))


def lookup(facts: DataFrame, dim: DataFrame, keys: list[str], spread: Column, least: int = 2000) -> DataFrame:
    """``facts`` inner-joined to ``dim`` (one row per key; its column ``n`` counts the key's
    rows in ``facts``), with the rows of frequent keys dealt over several tasks.

    A key is frequent beyond ``max(least, total / 1000)`` rows, so there are fewer than
    1,000 of them and that list is broadcast whatever the input's size.  Their ``facts``
    rows go to ``ceil(n / limit)`` salts by the hash of ``spread``; ``dim`` is repeated
    per salt, which adds fewer than 2,000 rows."""
    total = dim.agg(F.sum("n")).first()[0] or 0
    limit = max(least, total // 1000)
    salts = F.ceil(F.col("n") / F.lit(limit)).cast("int")
    hot = F.broadcast(dim.filter(F.col("n") > limit).select(*keys, salts.alias("__salts")))
    left = (facts.join(hot, keys, "left")
            .withColumn("__salt", F.coalesce(F.pmod(F.xxhash64(spread), F.col("__salts")).cast("int"), F.lit(0)))
            .drop("__salts"))
    many = F.when(F.col("n") > limit, salts).otherwise(1)
    right = dim.withColumn("__salt", F.explode(F.sequence(F.lit(0), many - 1)))
    return left.join(right, [*keys, "__salt"]).drop("__salt")


def whole_rows(docs: DataFrame) -> DataFrame:
    """Every row as one struct, so that no column of ``docs`` can clash with one that an operator adds."""
    quoted = ["`" + c.replace("`", "``") + "`" for c in docs.columns]
    return docs.select(F.struct(*quoted).alias("row"))


def emit(docs: DataFrame, decisions: DataFrame) -> DataFrame:
    """The rows of ``docs`` that ``decisions`` (doc_id, __h, __emit: how many times a row
    with that doc_id and text hash is wanted, one row per pair) keep, with the columns of ``docs``.

    Fully repeated rows (same doc_id, same text) count as one row here."""
    d = whole_rows(docs).select("row", F.col("row.doc_id").alias("id"), text_hash(F.col("row.text")).alias("h"))
    k = decisions.select(F.col("doc_id").alias("to_id"), F.col("__h").alias("to_h"), F.col("__emit").alias("times"))
    j = d.join(k, F.col("id").eqNullSafe(F.col("to_id")) & (F.col("h") == F.col("to_h")))
    one = Window.partitionBy("id", "h").orderBy(F.lit(1))
    j = j.withColumn("place", F.row_number().over(one)).filter("place = 1 and times > 0")
    return j.select("row", F.explode(F.sequence(F.lit(1), F.col("times").cast("int")))).select("row.*")


# ---- spans of regular expressions, as column expressions ----

SPAN = "array<struct<s:int,e:int,m:string,g:string>>"


def spans(text: Column, pattern: str, group: int | None = None, chunk: int = 256) -> Column:
    """Leftmost non-overlapping matches of ``pattern`` as array<struct<s, e, m, g>>: start and end in code
    points (end exclusive), the match, and in g that ``group`` (the match without one).

    The pieces between the matches give the positions: they are added up over chunks of matches first and
    then within each chunk, so that many matches in a text stay cheap."""
    hit = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gap = F.split(text, pattern, -1)
    n = F.size(hit)
    got = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else hit
    rows = F.arrays_zip(F.slice(F.transform(gap, lambda x: F.length(x)), F.lit(1), n).alias("gap"), hit.alias("m"), got.alias("g"))
    last = F.greatest(F.floor((n - 1) / chunk), F.lit(0)).cast("int")
    chunks = F.transform(F.sequence(F.lit(0), last), lambda c: F.slice(rows, c * chunk + 1, F.lit(chunk)))
    sizes = F.transform(chunks, lambda c: F.aggregate(c, F.lit(0), lambda acc, x: acc + x["gap"] + F.length(x["m"])))
    starts = F.aggregate(sizes, F.array(F.lit(0)), lambda acc, x: F.concat(acc, F.array(F.element_at(acc, -1) + x)))

    def step(acc, x):
        start = acc["pos"] + x["gap"]
        end = start + F.length(x["m"])
        one = F.struct(start.alias("s"), end.alias("e"), x["m"].alias("m"), x["g"].alias("g"))
        return F.struct(end.alias("pos"), F.concat(acc["out"], F.array(one)).alias("out"))

    def inside(c, start):
        return F.aggregate(c, F.struct(start.alias("pos"), no_spans().alias("out")), step, lambda acc: acc["out"])

    return F.flatten(F.zip_with(chunks, F.slice(starts, F.lit(1), F.size(chunks)), inside))


#: Characters of a piece of a text.
PIECE = 2048


def pieces(text: Column, reach: int) -> Column:
    """The text in pieces, each with the ``reach`` + 2 characters after it, so that a place deep in a long text is reached at once."""
    last = F.floor(F.length(text) / PIECE).cast("int")
    return F.transform(F.sequence(F.lit(0), last), lambda c: F.substr(text, c * PIECE + 1, F.lit(PIECE + reach + 2)))


def surroundings(items: Column, cut: Column, size: Column, reach: int) -> Column:
    """For each span in ``items`` (in order) the whole words within ``reach`` characters on either side of it, and what
    stands between them, not beyond the span before and the span after it.  ``cut``: the text's ``pieces``, ``size``: its length."""
    def between(low: Column, high: Column) -> Column:
        c = F.floor(low / PIECE).cast("int")
        return F.substr(F.get(cut, c), low - c * PIECE + 1, high - low)

    def around(x: Column, i: Column) -> Column:
        low = F.greatest(x["s"] - reach, F.coalesce(F.get(items, i - 1)["e"], F.lit(0)))
        high = F.least(x["e"] + reach, F.coalesce(F.get(items, i + 1)["s"], size))
        # one character more at each end shows whether the border cuts a word, of which no part is left then
        left = F.regexp_replace(between(F.greatest(low - 1, F.lit(0)), x["s"] + 1), r"(?<![\p{L}\p{N}])[\p{L}\p{N}]++\z", "")
        right = F.regexp_replace(between(x["e"] - 1, F.least(high + 1, size)), r"^[\p{L}\p{N}]++", "")
        left = F.when(low > 0, F.regexp_replace(left, r"^[\p{L}\p{N}]++", "")).otherwise(left)
        right = F.when(high < size, F.regexp_replace(right, r"(?<![\p{L}\p{N}])[\p{L}\p{N}]++\z", "")).otherwise(right)
        return F.concat(left, F.lit(" "), right)

    return F.transform(items, around)


def no_spans() -> Column:
    return F.array().cast(SPAN)


def span_text(items: Column, names: list[str]) -> Column:
    """``kind:start:end`` joined by commas; ``items``: array<struct<s, k, e>> with the kind's place in ``names``."""
    listed = F.array(*[F.lit(x) for x in names])
    return F.array_join(F.transform(F.array_sort(items), lambda x: F.concat(
        F.element_at(listed, x["k"] + 1), F.lit(":"), x["s"].cast("string"), F.lit(":"), x["e"].cast("string"))), ",")


def kinded(items: Column, kind: int) -> Column:
    """Spans with their kind's place, in the order in which spans are listed."""
    return F.transform(items, lambda x: F.struct(x["s"].alias("s"), F.lit(kind).alias("k"), x["e"].alias("e")))
