"""The streaming counters publish the same store as the batch counters."""

import os

from clickfeat.operators.counters import all_counters
from clickfeat.operators.feature_store import feature_store
from clickfeat.sinks.files import read_feature_store
from clickfeat.sources.fixtures import click_view
from clickfeat.streaming.counters import start_counter_stream
from conftest import SF_SMALL


def test_stream_matches_batch(spark, tmp_dir):
    clicks = click_view(spark, SF_SMALL).selectExpr(
        "CAST(device_ip AS STRING) device_ip", "CAST(device_id AS STRING) device_id", "session_id", "query",
        "CAST(ad_id AS STRING) ad_id", "campaign_id", "cat_match", "clicked")
    src = os.path.join(tmp_dir, "clicks")
    a, b = clicks.randomSplit([0.5, 0.5], seed=1)
    a.write.csv(os.path.join(src, "day=1"))
    store = os.path.join(tmp_dir, "store")
    ck = os.path.join(tmp_dir, "stream-ckpt")
    q = start_counter_stream(spark, os.path.join(src, "*"), store, stream_checkpoint=ck)
    q.awaitTermination(300)
    b.write.csv(os.path.join(src, "day=2"))
    q = start_counter_stream(spark, os.path.join(src, "*"), store, stream_checkpoint=ck)   # resumes
    q.awaitTermination(300)
    got = sorted(map(tuple, read_feature_store(spark, store).collect()))
    want = sorted(map(tuple, feature_store(all_counters(clicks)).collect()))
    assert got == want


def test_continuous_trigger_processes_available_files(spark, tmp_dir):
    clicks = click_view(spark, SF_SMALL).selectExpr(
        "CAST(device_ip AS STRING) device_ip", "CAST(device_id AS STRING) device_id", "session_id", "query",
        "CAST(ad_id AS STRING) ad_id", "campaign_id", "cat_match", "clicked")
    src = os.path.join(tmp_dir, "clicks")
    clicks.write.csv(os.path.join(src, "day=1"))
    store = os.path.join(tmp_dir, "store")
    q = start_counter_stream(spark, os.path.join(src, "*"), store, name="click_counters_cont",
                             available_now=False, stream_checkpoint=os.path.join(tmp_dir, "ck"))
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    got = sorted(map(tuple, read_feature_store(spark, store).collect()))
    assert got == sorted(map(tuple, feature_store(all_counters(clicks)).collect()))
