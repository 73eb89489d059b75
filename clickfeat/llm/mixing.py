"""Mixing sources to target weights.

Sizes are word counts.  Every source gets a weight (5, 2, 1, repeating over the sources in
code point order, null last) and a share of ``share`` times all words by weight; no source
goes beyond ``cap`` times its own words, and what that leaves over is shared again by weight.

Within a source the documents are ordered by a seeded hash of doc_id and text.  They are
range-partitioned by (source, hash), the words of each (source, range) are summed, and a
prefix sum of those few sums plus one within the range gives the words before every document:
no task sees a whole source.  The mix takes whole epochs of a source while its budget lasts
and cuts the last one at exactly the budget, in the document where the budget ends.

Defined cases: null text has size 0; a document of size 0 is never taken; null sources form
one source; rows that share a doc_id are ordered by their text's hash; an empty table, or one
without words, gives targets of 0; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from clickfeat.llm import common
from clickfeat.operators.indexing import with_global_index

WEIGHTS = (5.0, 2.0, 1.0)
SHARE = 1.5
CAP = 2.0
SEED = 17


def words(text: Column) -> Column:
    """Number of runs of characters other than ASCII white space."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]++")), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """(source, source_size, target) from (source, size).

    Sources at their cap stay there; the level of the others follows from the sums over
    both parts, until no further source reaches its cap.  Every round is one aggregate."""
    per = common.table(sizes.groupBy("source").agg(F.sum("size").alias("source_size")), "mix-sources")
    order = [F.col("source").isNull(), F.coalesce("source", F.lit(""))]
    ranked = with_global_index(per.withColumn("__null", order[0]).withColumn("__name", order[1]), ["__null", "__name"], "rank")
    listed = F.array(*[F.lit(float(w)) for w in weights])
    s = common.table(ranked.select("source", "source_size", F.element_at(listed, (F.col("rank") % len(weights) + 1).cast("int")).alias("weight"),
                                   (F.col("source_size") * cap).alias("most")), "mix-ranked")
    total = share * (s.agg(F.sum("source_size")).first()[0] or 0)
    level, full = 0.0, -1
    while True:
        at = F.col("most") <= F.lit(level) * F.col("weight")
        r = s.agg(F.count(F.when(at, 1)).alias("full"), F.coalesce(F.sum(F.when(at, F.col("most"))), F.lit(0.0)).alias("spent"),
                  F.coalesce(F.sum(F.when(~at, F.col("weight"))), F.lit(0.0)).alias("open")).first()
        if r["full"] == full or r["open"] == 0:
            break
        full, level = r["full"], max(level, (total - r["spent"]) / r["open"])
    target = F.least(F.col("most"), F.lit(level) * F.col("weight")) if full >= 0 and r["open"] else F.col("most")
    return s.select("source", "source_size", F.coalesce(target, F.lit(0.0)).alias("target"))


def mix(docs: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE, cap: float = CAP, seed: int = SEED) -> DataFrame:
    """One row per document: doc_id, __h (hash of the text), size, source_size, target, taken, copies
    (how many times the mix meets the document, the last perhaps in part)."""
    spark = docs.sparkSession
    h = common.text_hash()
    base = common.table(docs.select("doc_id", "source", h.alias("__h"), words(F.col("text")).alias("size"),
                                    F.xxhash64(F.lit(seed), "doc_id", h).alias("__k")), "mix-sizes")
    goal = common.table(targets(base, weights, share, cap), "mix-targets")
    keys = ["source", "__k", "doc_id", "__h", "size"]
    ranged = common.table(base.repartitionByRange(common.partitions(spark), *keys).withColumn("__part", F.spark_partition_id()), "mix-ranged")
    sums = ranged.groupBy("source", "__part").agg(F.sum("size").alias("__sum"))
    before = Window.partitionBy("source").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("__before", F.coalesce(F.sum("__sum").over(before), F.lit(0)))
    # one row per (source, range): ranges plus sources at most
    offsets = sums.join(goal.withColumnRenamed("source", "__s"), F.col("source").eqNullSafe(F.col("__s"))).select(
        F.col("source").alias("__s"), F.col("__part").alias("__p"), "__before", "source_size", "target")
    inside = Window.partitionBy("source", "__part").orderBy("__k", "doc_id", "__h", "size").rowsBetween(Window.unboundedPreceding, -1)
    d = ranged.withColumn("__inside", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    d = d.join(offsets, F.col("source").eqNullSafe(F.col("__s")) & (F.col("__part") == F.col("__p")))
    budget = F.floor("target")
    epochs = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(0).cast("long")
    left = budget - F.col("__epochs") * F.col("source_size") - F.col("__before") - F.col("__inside")
    d = d.withColumn("__epochs", epochs)
    d = d.withColumn("__last", F.least("size", F.greatest(F.lit(0), left)).cast("long"))
    return d.select("doc_id", "__h", "size", "source_size", "target",
                    (F.col("__epochs") * F.col("size") + F.col("__last")).alias("taken"),
                    F.when(F.col("size") > 0, F.col("__epochs") + F.when(F.col("__last") > 0, 1).otherwise(0)).otherwise(0).cast("int").alias("copies"))


def mixed_rows(docs: DataFrame) -> DataFrame:
    """The documents as the mix holds them, with all their columns: once per epoch that meets them.
    The document in which a source's budget ends is kept whole."""
    d = mix(docs).groupBy("doc_id", "__h").agg(F.sum("copies").alias("__emit"))
    return common.emit(docs, d)
