"""Plan-shape guards for the headline queries (what explain() shows)."""

import re

from clickfeat.plans.registry import QUERIES, load_all
from conftest import SF_SMALL

load_all()


def plan_of(spark, name):
    df = QUERIES[name](spark, SF_SMALL)
    return spark.sparkContext._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def test_all_counters_one_pass(spark):
    p = plan_of(spark, "all_counters")
    # raw rows are expanded for three sets only; the other three kinds come from the aggregated triples
    expanded = re.findall(r"Expand\n.*?Arguments: \[\[(.*?)\]\],", p, re.S)
    assert len(expanded) == 1 and expanded[0].count("], [") == 2
    assert len(re.findall(r"Arguments: hashpartitioning", p)) == 2        # one shuffle of raw rows' counts, one of their sums
    assert "partial_sum" in p or "partial_count" in p                     # map-side combine before it
    assert len(re.findall(r"(?m)^\(\d+\) Scan parquet", p)) == 4                                   # every table of the click view once
    scans = re.findall(r"ReadSchema: struct<([^>]*)>", p)
    lineitem = [s for s in scans if "l_orderkey" in s]
    assert lineitem and all(set(x.split(":")[0] for x in s.split(",")) <=
                            {"l_orderkey", "l_partkey", "l_returnflag", "l_linestatus"} for s in lineitem)


def test_a_streams_counters_need_one_shuffle(spark):
    from clickfeat.operators.counters import all_counters
    from clickfeat.sources.fixtures import click_view
    df = all_counters(click_view(spark, SF_SMALL), method="grouping_sets")
    p = spark.sparkContext._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    assert len(re.findall(r"Arguments: hashpartitioning", p)) == 1


def test_training_vectors_lookups_are_sized_broadcasts(spark):
    p = plan_of(spark, "training_vectors")
    assert p.count("BroadcastHashJoin LeftOuter") == 5                    # five lookups, log not shuffled
    assert "SortMergeJoin" not in p
    assert len(re.findall(r"PartitionFilters: \[[^\]]*kind", p)) == 5     # each reads one kind
