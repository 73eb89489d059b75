"""Session helpers.

The library never assumes a local filesystem: lineage cuts go to the folder the
cluster names in ``spark.checkpoint.dir``.  Only when that is unset *and* the
master is local (tests, laptops) do we pick a scratch folder ourselves.
"""

from __future__ import annotations

import atexit
import os
import tempfile

from pyspark.sql import SparkSession

# Settings that matter at scale; all of them are plain Spark SQL confs.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # size post-shuffle partitions by the advisory size (64 MB), not by core count
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Runtime (post-shuffle, measured) broadcast threshold; static threshold stays
    # at Spark's default and is only used when file statistics prove the size.
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64MB",
    "spark.sql.session.timeZone": "UTC",
    # reliable checkpoints of intermediate tables are removed once unreferenced
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_session(master: str | None = None, app: str = "clickfeat",
                shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    b = b.config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
    for k, v in DEFAULT_CONF.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Reliable checkpoint folder: the session's, else ``spark.checkpoint.dir``,
    else (local master only) a fresh scratch folder."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not conf_dir:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        conf_dir = tempfile.mkdtemp(prefix="clickfeat-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir()


def cut_lineage(df, name: str = "ckpt"):
    """Materialise ``df`` in the reliable checkpoint folder (never localCheckpoint).

    Written as a parquet table: an eager RDD checkpoint computes its plan twice
    (once for the count, once more to write the files) unless cached; a table
    write computes it once and also gives Catalyst measured sizes."""
    return materialize(df, name)


_MATERIALIZED: list[tuple[SparkSession, str]] = []


def materialize(df, name: str, partition_by: list[str] | None = None):
    """Write ``df`` as a parquet table under the reliable checkpoint folder and
    read it back.  Unlike checkpoint(), the file index gives Catalyst a measured
    size (and partition pruning), which the broadcast decisions rely on.
    The table is removed by ``release_materialized`` (also run at exit)."""
    import uuid

    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/tables/{name}-{uuid.uuid4().hex}"
    w = df.write.mode("errorifexists")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    _MATERIALIZED.append((spark, path))
    return spark.read.parquet(path)


def detached(model):
    """Write a fitted ``pyspark.ml`` model below the reliable checkpoint folder and read it back.

    A model fresh from ``fit`` holds its training summary, and with that the session, which goes out with every task
    that predicts.  A session that has observed a metric cannot be serialised, so predictions would fail from then on."""
    import uuid

    path = f"{checkpoint_dir(SparkSession.active()).rstrip('/')}/models/{type(model).__name__}-{uuid.uuid4().hex}"
    model.write().save(path)
    return type(model).load(path)


def release_materialized() -> int:
    """Delete the intermediate tables this process wrote (call when the
    DataFrames built on them are no longer needed).  Returns how many."""
    n = 0
    while _MATERIALIZED:
        spark, path = _MATERIALIZED.pop()
        try:
            jvm = spark.sparkContext._jvm
            p = jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
            n += 1
        except Exception:  # noqa: BLE001  (session already stopped: nothing to do)
            pass
    return n


atexit.register(release_materialized)


def estimated_bytes(df) -> int:
    """Catalyst's size estimate of ``df`` (file sizes for parquet scans, after
    partition pruning); huge when unknown."""
    v = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return int(v) if isinstance(v, int) else int(v.toString())


def broadcast_limit(spark) -> int:
    v = spark.conf.get("spark.sql.autoBroadcastJoinThreshold", "10485760")
    try:
        n = int(v)
    except ValueError:
        n = int(spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(v))
    return n
