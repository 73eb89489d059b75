"""Prefix sums and interval lookups that stay bounded per task.

prefix_sum: running sum per group in a given order.  A window partitioned by
the group would sort a hot group (a third of the rows) in one task; instead
rows are cut into chunks floor(position / chunk_width) (at most chunk_width rows
as positions are unique integers), chunk totals are prefix-summed per group
(that table has at most rows/chunk_width + groups rows), and the running sum
inside a chunk uses a window over at most chunk_width rows.

interval_lookup: for each probe value x find the interval lo < x <= hi of its
group (intervals of a group are disjoint and ordered).  Spark has no interval
join; an equi-join on the group alone compares every probe with every interval
of the group.  Here the group's range [0, total] is cut into as many bins as the
group has intervals, each interval is listed under every bin it overlaps (at
most 2x the intervals in total), each probe goes to its single bin, and the
equi-join on (group, bin) + the range filter finds exactly one interval after
comparing with ~2 candidates.  Bins follow the intervals, not the probes: a group with one interval has one
bin, whatever number of probes it gets.  So, unless the intervals are small enough to be broadcast, the probes
are counted per (group, bin); those of a full bin are dealt over salts and the bin's intervals are
repeated per salt.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from clickfeat.operators.lookup import within
from clickfeat.session import materialize

#: Probes of one bin that go to one task.
HOT_ROWS = 100_000


def prefix_sum(df: DataFrame, group_cols: list[str], order_col: str, value_col: str,
               out_col: str = "cum", chunk_width: int = 100000) -> DataFrame:
    """Adds ``out_col`` = sum of ``value_col`` over rows of the same group up to and
    including this row in ``order_col`` order (an integer unique inside a group)."""
    d = df.withColumn("_ch", F.floor(F.col(order_col) / chunk_width))
    tot = d.groupBy(*group_cols, "_ch").agg(F.sum(value_col).alias("_ct"))
    wg = Window.partitionBy(*group_cols).orderBy("_ch").rowsBetween(Window.unboundedPreceding, -1)
    before = tot.select(*group_cols, "_ch", F.coalesce(F.sum("_ct").over(wg), F.lit(0)).alias("_cb"))
    wc = Window.partitionBy(*group_cols, "_ch").orderBy(order_col).rowsBetween(Window.unboundedPreceding, 0)
    return (d.join(before, list(group_cols) + ["_ch"])
             .withColumn(out_col, F.col("_cb") + F.sum(value_col).over(wc))
             .drop("_ch", "_cb"))


def _bin(x, total, nbins):
    return F.least(F.greatest(F.floor(x / total * nbins), F.lit(0)), nbins - 1).cast("bigint")


def interval_lookup(probes: DataFrame, intervals: DataFrame, keys: list[str], x_col: str,
                    lo_col: str = "lo", hi_col: str = "hi", total_col: str = "total",
                    nbins_col: str = "nbins", limit: int | None = None, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Join each probe to the interval of its group with lo < x <= hi.

    ``intervals``: keys, lo, hi, total, nbins, payload...  (0 <= lo < hi <= total)
    ``probes``: keys, x, total, nbins, ...  (0 < x <= total)
    Probes outside every interval are dropped (inner semantics).  ``limit``: bytes of intervals that may be broadcast
    (by default the session's threshold).
    """
    cut = F.sequence(_bin(F.col(lo_col), F.col(total_col), F.col(nbins_col)), _bin(F.col(hi_col), F.col(total_col), F.col(nbins_col)))
    iv = intervals.withColumn("_bin", F.explode(cut)).drop(total_col, nbins_col)
    pr = probes.withColumn("_bin", _bin(F.col(x_col), F.col(total_col), F.col(nbins_col)))
    on = list(keys) + ["_bin"]
    if within(intervals, limit):
        j = pr.join(F.broadcast(iv), on)
    else:
        pr = materialize(pr, "probes")
        j = split_bins(pr, iv, on, hot_rows)
    return j.where((F.col(x_col) > F.col(lo_col)) & (F.col(x_col) <= F.col(hi_col))).drop("_bin")


def split_bins(probes: DataFrame, intervals: DataFrame, on: list[str], hot_rows: int = HOT_ROWS) -> DataFrame:
    """Join on ``on`` with the probes of full bins (more than ``hot_rows``, and more than a thousandth of all: fewer than
    1,000 bins, a bounded broadcast) dealt over salts and their intervals repeated."""
    counts = probes.groupBy(*on).agg(F.count(F.lit(1)).alias("_f"))
    full = materialize(counts.where(F.col("_f") > hot_rows), "full_bins")
    most = max(hot_rows, (probes.count() if not full.isEmpty() else 0) // 1000)
    full = full.where(F.col("_f") > most).select(*on, F.ceil(F.col("_f") / F.lit(most)).cast("int").alias("_salts"))
    salt = F.coalesce(F.pmod(F.xxhash64(*[F.col(c) for c in probes.columns]), F.col("_salts")), F.lit(0)).cast("int")
    p = probes.join(F.broadcast(full), on, "left").withColumn("_salt", salt).drop("_salts")
    i = intervals.join(F.broadcast(full), on, "left").withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_salts"), F.lit(1)) - 1))).drop("_salts")
    return p.join(i, [*on, "_salt"]).drop("_salt")
