"""Query rewriting: every ordered combination of per-term alternatives.

For a query ``t1 t2 ... tn`` each term is replaced by its synonym list (the
synonyms followed by the word itself) or, without an entry, by the term alone.
The rewrites are the ordered cartesian product joined by ``_``, first
occurrence kept.

A query's row holds only its terms' alternatives (their sum, not their
product).  Rewrite number ``ord`` of the nested loops is read off the digits of
``ord`` in the mixed radix of the list sizes, so the product is never grown by
joins: each query's numbers are cut into ranges, the ranges are dealt over the
tasks, and every task lists the rewrites of its ranges.

Two rewrites of a query can only be equal if a term's list repeats an alternative or
if an alternative holds the separator.  Lists are made distinct first, which
keeps the order of the first occurrences, so ``ord`` is the final number and the product is not
shuffled.  Only queries with an alternative that holds ``_`` go through an aggregate that keeps
first occurrences.

A query with more than MOST_REWRITES rewrites cannot be listed by any engine; ``oversized_queries`` returns
these with their sizes, and ``rewrite_rows`` leaves them out.

Two queries with the same key (``a b`` and ``a_b``) have one set of rewrites,
that of the smallest query text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from clickfeat.functions.text import query_key, tokens
from clickfeat.operators.indexing import rank_within
from clickfeat.operators.lookup import lookup_join
from clickfeat.session import materialize

#: Rewrites in one range, at least (the square root of the product beyond its square).
RANGE_ROWS = 1024
#: Rewrites of one query, at most.
MOST_REWRITES = 10 ** 15


def alternatives(queries: DataFrame, synonyms: DataFrame, query_col: str = "query", lowercase: bool = False) -> DataFrame:
    """(query_key, lists array<array<string>>): per query key the alternatives of each term."""
    text = F.lower(query_col) if lowercase else F.col(query_col)
    q = queries.select(text.alias("query")).where(F.col("query").isNotNull())
    q = q.groupBy(query_key("query").alias("query_key")).agg(F.min("query").alias("query"))
    terms = q.select("query_key", F.posexplode(tokens("query")).alias("ti", "term"))
    # as a table its size is known, which decides how the terms meet it
    syn = materialize(synonyms.select(F.col("word").alias("term"), F.col("synonyms").alias("alts")), "synonyms")
    looked = lookup_join(terms, syn, ["term"]).select("query_key", "ti", F.coalesce("alts", F.array("term")).alias("alts"))
    per_q = looked.groupBy("query_key").agg(F.array_sort(F.collect_list(F.struct("ti", "alts"))).alias("_l"))
    return per_q.select("query_key", F.transform("_l", lambda s: s["alts"]).alias("lists"))


def _sized(lists: DataFrame) -> DataFrame:
    """Distinct alternatives per term, and the size of their product."""
    d = lists.withColumn("lists", F.transform("lists", F.array_distinct))
    return d.withColumn("size", F.aggregate("lists", F.lit(1.0), lambda acc, x: acc * F.size(x)))


def oversized_queries(queries: DataFrame, synonyms: DataFrame, query_col: str = "query", lowercase: bool = False) -> DataFrame:
    """(query_key, n_rewrites double): queries with more than MOST_REWRITES rewrites."""
    s = _sized(alternatives(queries, synonyms, query_col, lowercase))
    return s.where(F.col("size") > MOST_REWRITES).select("query_key", F.col("size").alias("n_rewrites"))


def _listed(q: DataFrame) -> DataFrame:
    """(query_key, ord, rewrite) of queries with their lists: ranges of numbers are dealt over the tasks and listed there."""
    one = F.lit(1).cast("bigint")
    # strides[i]: how many rewrites share the choice of terms 0..i; strides[-1] is 1
    back = F.aggregate(F.reverse("lists"), F.array(one), lambda acc, x: F.concat(acc, F.array(F.element_at(acc, -1) * F.size(x))))
    q = q.withColumn("strides", F.reverse(back)).withColumn("n", F.element_at("strides", 1)).where("n > 0")
    q = q.withColumn("width", F.greatest(F.lit(RANGE_ROWS).cast("bigint"), F.ceil(F.sqrt("n"))))
    ranges = q.withColumn("range", F.explode(F.sequence(F.lit(0).cast("bigint"), F.expr("(n - 1) div width"))))
    tasks = int(q.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = ranges.repartition(tasks, "query_key", "range")
    rows = dealt.withColumn("ord", F.explode(F.sequence(F.expr("range * width"), F.expr("least(n, (range + 1) * width) - 1"))))
    pick = F.expr("transform(lists, (x, i) -> x[cast((ord div strides[i + 1]) % size(x) as int)])")
    return rows.select("query_key", "ord", F.array_join(pick, "_").alias("rewrite"))


def rewrite_rows(queries: DataFrame, synonyms: DataFrame, query_col: str = "query", lowercase: bool = False) -> DataFrame:
    """(query_key, idx, rewrite), ``idx`` from 0 in the order of the nested loops.

    ``synonyms``: (word, synonyms), one row per word, where the list already ends with the word.
    ``lowercase=False`` matches the published behaviour (queries used as given)."""
    sized = _sized(alternatives(queries, synonyms, query_col, lowercase))
    sized = sized.withColumn("joint", (F.size("lists") > 1) & F.exists("lists", lambda x: F.exists(x, lambda w: w.contains("_"))))
    q = materialize(sized.where(F.col("size") <= MOST_REWRITES).drop("size"), "rewrite_lists")
    plain = _listed(q.where(~F.col("joint"))).select("query_key", F.col("ord").alias("idx"), "rewrite")
    if q.where("joint").isEmpty():
        return plain
    first = _listed(q.where("joint")).groupBy("query_key", "rewrite").agg(F.min("ord").alias("ord"))
    return plain.unionByName(rank_within(first, ["query_key"], ["ord"], "idx").select("query_key", "idx", "rewrite"))


def rewrite_lines(rows: DataFrame, chunk: int = 10000) -> DataFrame:
    """Rows -> (query_key, chunk, rewrites): at most ``chunk`` rewrites a line, in order; ``chunk`` numbers the lines of a key."""
    cut = rows.groupBy("query_key", F.floor(F.col("idx") / chunk).alias("chunk")).agg(
        F.array_sort(F.collect_list(F.struct("idx", "rewrite"))).alias("_l"))
    return cut.select("query_key", "chunk", F.transform("_l", lambda s: s["rewrite"]).alias("rewrites"))
