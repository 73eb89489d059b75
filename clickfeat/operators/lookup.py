"""Skew-aware joins of rows to a keyed table (one row per key).

A key may carry a third of the rows (one busy device ip, one popular ad).  A plain
shuffle join would put all of those rows in one task, and AQE does not split a join
whose other side is an aggregate on the same key.  Here:

1. A keyed table whose measured size is within the broadcast threshold is broadcast.
2. Beyond it, the keys' frequencies are counted on the rows themselves (a partial
   aggregate).  Hot keys exceed total/max_hot_keys rows; as frequencies sum to
   ``total``, fewer than ``max_hot_keys`` keys qualify, so that set is broadcast.
3. Rows of hot keys get a salt from a hash of the row's own columns (deterministic, so a
   retried task routes every row the same way): ``salts`` of them at least, and as many
   more as it takes for at most max(MIN_TASK_ROWS, total/max_hot_keys) rows per salt.  The
   keyed side is repeated per salt.  Cold keys use salt 0.
4. One shuffle join on (key, salt): a hot key is spread over its salts.

Every salt's copy carries the same values, so the result never depends on which salt a
row gets.  Joins of up to TASK_ROWS rows are left to AQE (with its skew-join split); those of more rows
are dealt into one task per TASK_ROWS rows, or into as many as the session has shuffle partitions if those are more.
What a task sorts and counts then has a bound in rows, however few those partitions are and however well the rows
compress, which is what AQE's 64 MB are measured by.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from clickfeat.session import broadcast_limit, estimated_bytes, materialize

MIN_TASK_ROWS = 20_000
TASK_ROWS = 1_000_000


def within(df: DataFrame, limit: int | None = None) -> bool:
    """Is the measured size of ``df`` within the broadcast threshold?"""
    return 0 < estimated_bytes(df) <= (broadcast_limit(df.sparkSession) if limit is None else limit)


def join_tasks(spark: SparkSession, n_rows: int) -> int:
    """Tasks of a shuffle join of ``n_rows`` rows; 0: few enough to leave that to AQE."""
    return 0 if n_rows <= TASK_ROWS else max(-(-n_rows // TASK_ROWS), spark.sparkContext.defaultParallelism)


def _hot(count_on: DataFrame, keys: list[str], max_hot_keys: int, salts: int) -> tuple[DataFrame, int]:
    """(keys, _salts) of the hot keys, fewer than ``max_hot_keys`` rows, and the number of rows counted."""
    freq = materialize(count_on.groupBy(*keys).agg(F.count(F.lit(1)).alias("_f")), "key_counts")
    total = freq.agg(F.sum("_f")).first()[0] or 0
    per_task = max(MIN_TASK_ROWS, total // max_hot_keys)
    many = F.greatest(F.lit(salts), F.ceil(F.col("_f") / F.lit(per_task))).cast("int")
    return freq.where(F.col("_f") > total / max_hot_keys).select(*keys, many.alias("_salts")), total


def _heavy(rows: DataFrame, key: str, tasks: int) -> DataFrame:
    """(key, _salts) of the keys with more than TASK_ROWS of ``rows``.  freqItems misses none that holds more than
    its share, so that only those it names, at most ``tasks``, are counted, and not every key."""
    known = rows.select(key).where(F.col(key).isNotNull())
    named = known.stat.freqItems([key], max(1 / tasks, 0.0001)).select(F.explode(f"{key}_freqItems").alias(key))
    freq = known.join(F.broadcast(named), key).groupBy(key).agg(F.count(F.lit(1)).alias("_f"))
    return materialize(freq.where(F.col("_f") > TASK_ROWS).select(key, F.ceil(F.col("_f") / TASK_ROWS).cast("int").alias("_salts")), "heavy_keys")


def _spread(rows: DataFrame, hot: DataFrame, keys: list[str], tasks: int = 0) -> DataFrame:
    """``rows`` with _salt: 0 for cold keys.  Rows with a null key match nothing and are dealt over all tasks."""
    hashable = [f.name for f in rows.schema.fields if not isinstance(f.dataType, T.MapType)]
    h = F.xxhash64(*[F.col(c) for c in hashable])
    lost = F.lit(False)
    for k in keys:
        lost = lost | F.col(k).isNull()
    tasks = max(tasks, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    salt = F.when(lost, F.pmod(h, F.lit(tasks))).otherwise(F.coalesce(F.pmod(h, F.col("_salts")), F.lit(0)))
    return rows.join(F.broadcast(hot), keys, "left").withColumn("_salt", salt.cast("int")).drop("_salts")


def _repeated(keyed: DataFrame, hot: DataFrame, keys: list[str]) -> DataFrame:
    """``keyed`` once per salt of its key."""
    return (keyed.join(F.broadcast(hot), keys, "left")
                 .withColumn("_salt", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_salts"), F.lit(1)) - 1)))
                 .drop("_salts"))


def _salted(rows: DataFrame, keyed: DataFrame, keys: list[str], how: str, max_hot_keys: int, salts: int,
            count_on: DataFrame | None = None) -> DataFrame:
    hot, total = _hot(rows if count_on is None else count_on, keys, max_hot_keys, salts)
    tasks = join_tasks(rows.sparkSession, total)
    return _dealt(_spread(rows, hot, keys, tasks), _repeated(keyed, hot, keys), keys + ["_salt"], how, tasks).drop("_salt")


def _dealt(rows: DataFrame, keyed: DataFrame, keys: list[str], how: str, tasks: int) -> DataFrame:
    """The join in that many tasks (0: as AQE sees fit)."""
    if tasks:
        rows, keyed = rows.repartition(tasks, *keys), keyed.repartition(tasks, *keys)
    return rows.join(keyed, keys, how)


def dealt_join(rows: DataFrame, keyed: DataFrame, key: str, count_on: DataFrame | None = None) -> DataFrame:
    """INNER JOIN of ``rows`` to ``keyed``, whose keys may repeat.  Beyond the broadcast threshold it is dealt into one task per
    TASK_ROWS rows, and a key with more rows than that over several.  ``count_on``: rows with the same keys that are cheaper to count."""
    count_on = rows if count_on is None else count_on
    tasks = 0 if within(keyed) else join_tasks(rows.sparkSession, count_on.count())
    if not tasks:
        return rows.join(keyed, key)
    heavy = _heavy(count_on, key, tasks)
    if heavy.isEmpty():
        return _dealt(rows, keyed, [key], "inner", tasks)
    rows = _spread(rows.where(F.col(key).isNotNull()), heavy, [key], tasks)
    return _dealt(rows, _repeated(keyed, heavy, [key]), [key, "_salt"], "inner", tasks).drop("_salt")


def keyed_left_join(rows: DataFrame, keys: list[str], sides: list[tuple[DataFrame, list[str]]], max_hot_keys: int = 10000,
                    salts: int = 64, limit: int | None = None, count_on: DataFrame | None = None) -> DataFrame:
    """LEFT JOIN several tables onto ``rows``, each unique on some of the columns ``keys``.

    The tables are first joined to the different combinations of ``keys`` in ``rows`` (a partial aggregate, a table much
    smaller than the rows), so the rows themselves meet one table and cross the network once, whatever the number of
    sides.  The combinations carry their frequency: those that are hot are salted without another count.  Nulls in
    ``keys`` are kept apart like values here, and match no side.  ``count_on``: rows with the same combinations that
    are cheaper to count."""
    t = materialize((rows if count_on is None else count_on).groupBy(*keys).agg(F.count(F.lit(1)).alias("_f")), "combinations")
    for side, on in sides:
        t = lookup_join(t, side, on, max_hot_keys, salts, limit)
    t = materialize(t, "combined")
    names = {k: f"_key{i}" for i, k in enumerate(keys)}
    t = t.select(*[F.col(c).alias(names.get(c, c)) for c in t.columns])

    def met(left: DataFrame, right: DataFrame) -> F.Column:
        on = F.lit(True)
        for k, name in names.items():
            on = on & left[k].eqNullSafe(right[name])
        return on

    if within(t, limit):
        return rows.join(F.broadcast(t), met(rows, t), "left").drop("_f", *names.values())
    total = t.agg(F.sum("_f")).first()[0] or 0
    per_task = max(MIN_TASK_ROWS, total // max_hot_keys)
    many = F.greatest(F.lit(salts), F.ceil(F.col("_f") / F.lit(per_task))).cast("int")
    is_hot = F.col("_f") > total / max_hot_keys       # fewer than max_hot_keys combinations
    hot = t.where(is_hot).select(*names.values(), many.alias("_salts"))
    hashable = [f.name for f in rows.schema.fields if not isinstance(f.dataType, T.MapType)]
    spread = F.coalesce(F.pmod(F.xxhash64(*hashable), F.col("_salts")), F.lit(0)).cast("int")
    salted = rows.join(F.broadcast(hot), met(rows, hot), "left").withColumn("_salt", spread).drop("_salts", *names.values())
    t = t.withColumn("_copy", F.explode(F.sequence(F.lit(0), F.when(is_hot, many).otherwise(1) - 1))).drop("_f")
    return salted.join(t, met(salted, t) & (F.col("_salt") == F.col("_copy")), "left").drop("_salt", "_copy", *names.values())


def split_join(rows: DataFrame, keyed: DataFrame, keys: list[str], max_hot_keys: int = 1000, salts: int = 2,
               limit: int | None = None) -> DataFrame:
    """INNER JOIN of ``rows`` to ``keyed`` (unique on ``keys``, often an aggregate of the same
    rows).  ``keyed`` is written once, so its size is measured, not guessed."""
    keyed = materialize(keyed, "keyed")
    if within(keyed, limit):
        return rows.join(F.broadcast(keyed), keys)
    return _salted(rows, keyed, keys, "inner", max_hot_keys, salts)


def sized_join(rows: DataFrame, keyed: DataFrame, keys: list[str], source: DataFrame | None = None, limit: int | None = None,
               max_hot_keys: int = 1000, salts: int = 2) -> DataFrame:
    """INNER JOIN of ``rows`` to ``keyed`` (unique on ``keys``), which holds no more than the written table ``source``
    (``keyed`` itself by default): broadcast if that is within the threshold, otherwise as ``split_join``."""
    if within(keyed if source is None else source, limit):
        return rows.join(F.broadcast(keyed), keys)
    return split_join(rows, keyed, keys, max_hot_keys, salts, limit)


def salted_left_join(big: DataFrame, small: DataFrame, keys: list[str], max_hot_keys: int = 10000, salts: int = 64,
                     count_on: DataFrame | None = None) -> DataFrame:
    """LEFT JOIN by salts.  ``count_on``: rows with the keys of ``big`` that are cheaper to count."""
    return _salted(big, small, keys, "left", max_hot_keys, salts, count_on)


def lookup_join(big: DataFrame, small: DataFrame, keys: list[str], max_hot_keys: int = 10000, salts: int = 64,
                limit: int | None = None, count_on: DataFrame | None = None) -> DataFrame:
    """LEFT JOIN ``small`` (unique on ``keys``) onto ``big``.

    Broadcast only behind a size check: when Catalyst's estimate of ``small``
    (measured file sizes of a materialised table) is within the broadcast
    threshold, the big side is not shuffled at all.  Beyond it, the salted
    shuffle join spreads hot keys over their salts.
    """
    if within(small, limit):
        return big.join(F.broadcast(small), keys, "left")
    return salted_left_join(big, small, keys, max_hot_keys, salts, count_on)
