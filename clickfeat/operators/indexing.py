"""Distributed dense numbering (a DataFrame zipWithIndex).

row_number() over a window with no partition pulls every row into one task.
Instead: range-partition and sort by the order key, count rows per partition,
turn the (tiny, one row per partition) counts into offsets, and add each row's
position inside its partition.  The offsets table has at most
spark.sql.shuffle.partitions rows, so broadcasting it is size-bounded.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F


def with_global_index(df: DataFrame, order_cols: list, name: str = "idx") -> DataFrame:
    """Add a 0-based bigint ``name`` following ``order_cols`` (must be a total order).

    The (partition id, row id) pair is written once (a table in the checkpoint
    folder) before counting: the counts and the positions then come from the
    same stored values, whatever AQE does to the partitioning of each reader."""
    from clickfeat.session import materialize

    s = materialize(df.repartitionByRange(*order_cols).sortWithinPartitions(*order_cols)
                      .withColumn("_pid", F.spark_partition_id())
                      .withColumn("_mid", F.monotonically_increasing_id()), "indexed")
    counts = s.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.select(
        "_pid",
        F.coalesce(F.sum("_n").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)),
                   F.lit(0)).alias("_off"))
    out = s.join(F.broadcast(offsets), "_pid")
    local = F.col("_mid") - F.shiftleft(F.col("_pid").cast("bigint"), 33)
    return out.withColumn(name, (F.col("_off") + local).cast("bigint")).drop("_pid", "_mid", "_off")


def rank_within(df: DataFrame, group_cols: list, order_cols: list, name: str = "rank",
                chunk_width: int = 100000) -> DataFrame:
    """0-based position of each row inside its group, by ``order_cols``.

    Equal to row_number()-1 over (partition by group order by order), but a hot
    group is never sorted in one task.  The first order column must be an
    integer that is unique inside a group (a file position, an index): rows are
    cut into chunks floor(order / chunk_width) -- at most ``chunk_width`` rows
    each -- counted per (group, chunk), the counts prefix-summed per group (a
    table of at most rows/chunk_width + groups rows), and the row number inside
    a chunk comes from a window bounded by the chunk.
    """
    first = order_cols[0]
    d = df.withColumn("_ch", F.floor(F.col(first) / chunk_width))
    cnt = d.groupBy(*group_cols, "_ch").agg(F.count(F.lit(1)).alias("_cn"))
    wg = Window.partitionBy(*group_cols).orderBy("_ch").rowsBetween(Window.unboundedPreceding, -1)
    before = cnt.select(*group_cols, "_ch", F.coalesce(F.sum("_cn").over(wg), F.lit(0)).alias("_cb"))
    wc = Window.partitionBy(*group_cols, "_ch").orderBy(*order_cols)
    return (d.withColumn("_rn", F.row_number().over(wc))
             .join(before, list(group_cols) + ["_ch"])
             .withColumn(name, (F.col("_cb") + F.col("_rn") - 1).cast("bigint"))
             .drop("_ch", "_rn", "_cb"))
