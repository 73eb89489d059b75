"""Stand-in views over the driver's TPC-H-like tables.

The test tables hold no ads, clicks or users, so these projections play them:

  ad     one ad per part: campaign = brand, query group = size, query = name,
         category = type, keywords = next part's name + own type.  pos = ad_id.
  click  one impression per lineitem: ip = customer nation, device = customer,
         session = order, query = part name, ad = part, campaign = brand,
         category match = linestatus 'F', clicked = returnflag 'R'.
  usr    one user per customer: ip = custkey, devices 5*ip+0..4, pos = custkey.
  syn    synonym list per first query word: the next two first-words in
         alphabetical order (fewer at the end); second words have no entry.

All of them are plain joins/projections, so Catalyst prunes columns and pushes
filters into the parquet scans.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from clickfeat.operators.indexing import with_global_index
from clickfeat.operators.lookup import within
from clickfeat.operators.star import ClickStar
from clickfeat.session import cut_lineage


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ad_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    a = part.select("p_partkey", "p_name", "p_brand", "p_type", "p_size")
    b = part.select((F.col("p_partkey") - 1).alias("prev_key"), F.col("p_name").alias("next_name"))
    j = a.join(b, a.p_partkey == b.prev_key, "left")
    return j.select(
        F.col("p_partkey").alias("ad_id"),
        F.col("p_brand").alias("campaign_id"),
        F.col("p_size").cast("bigint").alias("query_group_id"),
        F.lower("p_name").alias("query"),
        F.lower("p_type").alias("category"),
        F.concat_ws(" ", "p_name", "p_brand", F.col("p_size").cast("string")).alias("title"),
        F.split(F.concat_ws(" ", F.coalesce("next_name", "p_name"), F.lower("p_type")), " ", -1).alias("keywords"),
        F.col("p_partkey").alias("pos"),
    )


def spread_scan(df: DataFrame) -> DataFrame:
    """A fact scan that arrives in fewer partitions than the cluster has cores
    (a small file with one row group) is spread round-robin, so the joins and
    per-row work after it run in parallel.  A large input already has enough
    splits and is left alone (no extra exchange)."""
    n = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(n) if df.rdd.getNumPartitions() < n else df


def click_star(spark: SparkSession, sf_dir: str) -> ClickStar:
    """The click view as its three parts (see operators/star.py)."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_returnflag", "l_linestatus")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    p = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand")
    facts = (li if not within(o) else spread_scan(li)).select(
        F.col("l_orderkey").alias("session_id"),
        F.col("l_partkey").alias("ad_id"),
        (F.col("l_linestatus") == "F").cast("int").alias("cat_match"),
        (F.col("l_returnflag") == "R").cast("int").alias("clicked"),
    )
    return ClickStar(
        facts,
        o.select(F.col("o_orderkey").alias("session_id"), F.col("o_custkey").alias("device_id")),
        c.select(F.col("c_custkey").alias("device_id"), F.col("c_nationkey").alias("device_ip")),
        p.select(F.col("p_partkey").alias("ad_id"), F.col("p_name").alias("query"), F.col("p_brand").alias("campaign_id")),
    )


def click_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    return click_star(spark, sf_dir).rows()


def user_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    cust = table(spark, sf_dir, "customer").select("c_custkey")
    return cust.select(
        F.col("c_custkey").alias("ip"),
        F.transform(F.sequence(F.lit(0), F.lit(4)), lambda i: (F.col("c_custkey") * 5 + i).cast("bigint")).alias("devices"),
        F.col("c_custkey").alias("pos"),
    )


def synonym_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(word, synonyms) with the word itself NOT yet appended (the reader does)."""
    ads = ad_view(spark, sf_dir)
    words = ads.select(F.element_at(F.split("query", " ", -1), 1).alias("word")).distinct()
    # "next word in alphabetical order" = global index + equi-joins on idx+1, idx+2
    # (no single-task window over the vocabulary).
    idx = cut_lineage(with_global_index(words, ["word"], "i"))
    n1 = idx.select((F.col("i") - 1).alias("i"), F.col("word").alias("n1"))
    n2 = idx.select((F.col("i") - 2).alias("i"), F.col("word").alias("n2"))
    nxt = idx.join(n1, "i", "left").join(n2, "i", "left")
    return nxt.select("word", F.filter(F.array("n1", "n2"), lambda x: x.isNotNull()).alias("synonyms"))
