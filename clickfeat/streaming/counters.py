"""Incremental click counters over a growing click-log folder.

readStream (text lines, parsed like the batch log) -> the same one-pass GROUPING SETS aggregate as
the batch counters (state: one row per key, like the store itself) ->
outputMode("update") -> foreachBatch: changed keys become feature pairs and
are published by keyed upsert into the versioned feature store.  The
streaming checkpoint (offsets + state) lives in the shared folder named by
spark.checkpoint.dir, so a restarted driver resumes where it stopped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from clickfeat.operators.counters import all_counters
from clickfeat.operators.feature_store import feature_store
from clickfeat.session import checkpoint_dir
from clickfeat.sinks.files import publish_feature_store
from clickfeat.sources.files import parse_clicks


def click_stream(spark: SparkSession, click_dir: str, max_files_per_trigger: int | None = None) -> DataFrame:
    r = spark.readStream.format("text")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return parse_clicks(r.load(click_dir))


def start_counter_stream(spark: SparkSession, click_dir: str, store_base: str, name: str = "click_counters",
                         available_now: bool = True, stream_checkpoint: str | None = None):
    """Start the stream; returns the StreamingQuery."""
    counts = all_counters(click_stream(spark, click_dir))
    ckpt = stream_checkpoint or f"{checkpoint_dir(spark).rstrip('/')}/streams/{name}"

    def publish(batch: DataFrame, epoch_id: int) -> None:
        batch = batch.persist()                 # evaluated once for the test and the publishing
        if not batch.isEmpty():
            publish_feature_store(batch.sparkSession, feature_store(batch), store_base)
        batch.unpersist()

    w = (counts.writeStream.outputMode("update").foreachBatch(publish)
               .option("checkpointLocation", ckpt).queryName(name))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()
