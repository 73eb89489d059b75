"""Real file round trips (temporary folders under /tmp)."""

import json
import os

from clickfeat.operators.counters import all_counters
from clickfeat.sinks import files as sinks
from clickfeat.sources import files as src
from clickfeat.sources.fixtures import click_view
from conftest import SF_SMALL


def write_lines(path, lines):
    with open(path, "w") as f:
        f.write("\n".join(lines) + "\n")


def test_ads_jsonl_required_fields_and_positions(spark, tmp_dir):
    p = os.path.join(tmp_dir, "ads.txt")
    write_lines(p, [
        json.dumps({"adId": 1, "campaignId": 8001, "query_group_id": 1, "category": "Shoes", "query": "Nike Shoes",
                    "title": "t", "keyWords": ["nike", "shoes"]}),
        json.dumps({"adId": 2, "campaignId": 8001, "query_group_id": 1, "query": "x"}),   # no category
        json.dumps({"adId": 3, "campaignId": 8002, "query_group_id": 1, "category": None, "query": "y",
                    "keyWords": ["y"]}),                                                    # explicit null
        json.dumps({"adId": 4, "campaignId": 8002, "query_group_id": 2, "category": "Bags", "query": "z",
                    "keyWords": ["z"]}),
    ])
    ads = src.read_ads(spark, p)
    rows = {r.ad_id: r for r in ads.collect()}
    assert sorted(rows) == [1, 4]
    assert rows[1].pos < rows[4].pos and rows[1].keywords == ["nike", "shoes"]


def test_users_csv(spark, tmp_dir):
    p = os.path.join(tmp_dir, "users.txt")
    write_lines(p, ["10.0.0.1,a,b,c,d,e,extra", "10.0.0.2,f,g,h,i,j"])
    u = src.read_users(spark, p).orderBy("pos").collect()
    assert [(r.ip, r.devices) for r in u] == [("10.0.0.1", ["a", "b", "c", "d", "e"]),
                                              ("10.0.0.2", ["f", "g", "h", "i", "j"])]


def test_click_csv_with_comma_query_round_trip(spark, tmp_dir):
    schema = ("device_ip string, device_id string, session_id bigint, query string, ad_id string, "
              "campaign_id string, cat_match int, clicked int")
    df = spark.createDataFrame([("1.1.1.1", "d", 5, "a, b", "7", "9", 1, 0)], schema)
    out = os.path.join(tmp_dir, "clicks")
    sinks.write_clicks_csv(df, out)
    back = src.read_clicks(spark, out).collect()
    assert [tuple(r) for r in back] == [("1.1.1.1", "d", 5, "a, b", "7", "9", 1, 0)]
    lines = spark.createDataFrame([("1,2,3",), ("1,d,5,q,7,9,1,0",)], "value string")
    assert src.valid_click_lines(lines).count() == 1
    assert src.rejected_clicks(lines).count() == 1


def test_synonyms_last_line_wins_and_self_appended(spark, tmp_dir):
    p = os.path.join(tmp_dir, "syn.txt")
    write_lines(p, [json.dumps({"word": "a", "synonyms": ["x"]}), json.dumps({"word": "b", "synonyms": []}),
                    json.dumps({"word": "a", "synonyms": ["y", "z"]})])
    got = {r.word: r.synonyms for r in src.read_synonyms(spark, p).collect()}
    assert got == {"a": ["y", "z", "a"], "b": ["b"]}


def test_nested_map_round_trip(spark, tmp_dir):
    rows = spark.createDataFrame([(1, "c", 10, 0), (1, "c", 11, 3), (1, "d", 12, 1), (2, "c", 13, 2)],
                                 "query_group_id bigint, campaign_id string, ad_id bigint, pos bigint")
    out = os.path.join(tmp_dir, "map")
    sinks.write_nested_map(rows, out, chunk=2)
    back = src.read_nested_map(spark, out)
    got = sorted((int(r.query_group_id), r.campaign_id, r.ad_id) for r in back.collect())
    assert got == [(1, "c", 10), (1, "c", 11), (1, "d", 12), (2, "c", 13)]
    order = {(r.query_group_id, r.campaign_id, r.ad_id): r.idx for r in back.collect()}
    assert order["1", "c", 10] == 0 and order["1", "c", 11] == 1       # the place in the whole list, not in its chunk
    plain = spark.createDataFrame([('{"1": {"c": [5, 6]}}',)], "value string")
    assert [(r.ad_id, r.idx) for r in src.parse_nested_map(plain).orderBy("idx").collect()] == [(5, 0), (6, 1)]


def test_click_lines_as_they_come(spark, tmp_dir):
    """File, text and stream readers agree, whatever columns are read; bad lines are set aside."""
    from clickfeat.streaming.counters import click_stream
    p = os.path.join(tmp_dir, "clicks.txt")
    good = ["1.1.1.1,d,5,q,7,9,1,0", "1.1.1.1,,6,q,7,9,0,1", '2.2.2.2,d,7,"a, b",7,9,1,1', "2.2.2.2,d,,q,7,9,1,0"]
    bad = ["1,2,3,4,5,6", "1.1.1.1,d,8,running, shoes,5,7,1,0", "1.1.1.1,d,x,q,7,9,1,0", "1.1.1.1,d,5,q,7,9,2,0", "1.1.1.1,d,5,q,7,9,1,"]
    write_lines(p, good + bad)
    clicks = src.read_clicks(spark, p)
    assert clicks.count() == clicks.select("query", "clicked").count() == len(clicks.collect()) == len(good)
    assert sorted(r.value for r in src.rejected_clicks(spark.read.text(p)).collect()) == sorted(bad)
    rows = {(r.session_id, r.device_id, r.query) for r in clicks.collect()}
    assert rows == {(5, "d", "q"), (6, "", "q"), (7, "d", "a, b"), (None, "d", "q")}
    want = sorted(map(str, all_counters(clicks).collect()))
    lines = spark.createDataFrame([(x,) for x in good + bad], "value string")
    assert sorted(map(str, all_counters(src.parse_clicks(lines)).collect())) == want
    os.makedirs(os.path.join(tmp_dir, "in"))
    write_lines(os.path.join(tmp_dir, "in", "a.txt"), good + bad)
    q = (all_counters(click_stream(spark, os.path.join(tmp_dir, "in"))).writeStream.outputMode("complete").format("memory")
         .queryName("click_lines").option("checkpointLocation", os.path.join(tmp_dir, "ck")).trigger(availableNow=True).start())
    q.awaitTermination(300)
    assert sorted(map(str, spark.table("click_lines").collect())) == want


def test_blank_guard(spark):
    df = spark.createDataFrame([("q", "1"), ("", "1"), ("q", ""), (None, "1"), (" ", "1")], "query string, ad_id string")
    assert [(r.query, r.ad_id) for r in df.where(~src.blank("query", "ad_id")).collect()] == [("q", "1"), (" ", "1")]
    assert df.where(src.blank("query", "ad_id")).count() == 3


def test_feature_store_publish_versions_and_append(spark, tmp_dir):
    base = os.path.join(tmp_dir, "store")
    old = spark.createDataFrame([("a", 1), ("b", 2)], "feature_key string, feature_value bigint")
    new = spark.createDataFrame([("b", 5)], "feature_key string, feature_value bigint")
    assert [sinks.publish_feature_store(spark, d, base) for d in (old, new)] == [0, 1]
    assert sorted(map(tuple, sinks.read_feature_store(spark, base).collect())) == [("a", 1), ("b", 5)]
    os.makedirs(os.path.join(base, "data", "left-by-a-dead-writer", "bucket=3"))
    more = spark.createDataFrame([("c", 7)], "feature_key string, feature_value bigint")
    assert sinks.publish_feature_store(spark, more, base) == 2
    assert sorted(map(tuple, sinks.read_feature_store(spark, base).collect())) == [("a", 1), ("b", 5), ("c", 7)]
    j = os.path.join(tmp_dir, "jsonl")
    sinks.write_jsonl(old, j)
    sinks.write_jsonl(old, j, mode="append")       # rerun in append mode duplicates rows
    assert spark.read.json(j).count() == 4


def test_tuple_text_counters_and_training_points(spark, tmp_dir):
    pairs = spark.createDataFrame([("men's_shoes_7", 3), ("plain", 4), ('say "hi"', 5)], "key string, v bigint")
    d = os.path.join(tmp_dir, "dipc")
    sinks.tuple_pair_lines(pairs, "key", "v").write.text(d)
    back = src.read_counter_dirs(spark, {"dipc": d})
    assert sorted(map(tuple, back.collect())) == [("dipc_men's_shoes_7", 3), ('dipc_plain', 4), ('dipc_say "hi"', 5)]
    lines = spark.createDataFrame([("('1,2,3,4,5,6,7,8,9,10,1000000', 1)",), ("('1,x,3,4,5,6,7,8,9,10,0', 0)",)],
                                  "value string")
    pts = src.parse_training_points(lines).collect()
    assert pts[0].label == 1.0 and pts[0].f10 == 1000000.0 and pts[0].f0 == 1.0
    assert pts[1].f1 is None
    assert [r.value for r in src.rejected_points(lines).collect()] == ["('1,x,3,4,5,6,7,8,9,10,0', 0)"]


def test_counters_parquet_round_trip(spark, tmp_dir):
    c = all_counters(click_view(spark, SF_SMALL))
    out = os.path.join(tmp_dir, "counters")
    sinks.write_parquet(c, out)
    assert sorted(map(tuple, spark.read.parquet(out).collect()), key=repr) == sorted(map(tuple, c.collect()), key=repr)


def test_sentences_round_trip(spark, tmp_dir):
    s = spark.createDataFrame([("nike shoes red",), (" empty query",)], "sentence string")
    out = os.path.join(tmp_dir, "sent")
    sinks.write_sentences(s, out)
    words = sorted(r.words for r in src.parse_sentences(src.read_lines(spark, out)).collect())
    assert words == [["", "empty", "query"], ["nike", "shoes", "red"]]


def test_positions_do_not_depend_on_splits(spark, tmp_dir):
    """The same positions with one split and with many, over several files, without a sort."""
    folder = os.path.join(tmp_dir, "lines")
    os.makedirs(folder)
    want = []
    for k in range(3):
        lines = [f"{k}-{i}-" + "x" * (i % 37) for i in range(2000)]
        want += lines
        with open(os.path.join(folder, f"part-{k}.txt"), "w", encoding="utf-8") as f:
            f.write("\n".join(lines) + "\n")
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        for size in ("134217728", "3000"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            spark.conf.set("spark.sql.files.openCostInBytes", "0")
            d = src.read_lines(spark, folder, positions=True)
            assert (d.rdd.getNumPartitions() > 20) == (size == "3000")
            assert [r.value for r in d.orderBy("pos").collect()] == want
            assert sorted(r.pos for r in d.collect()) == list(range(len(want)))
            plan = spark.sparkContext._jvm.PythonSQLUtils.explainString(d._jdf.queryExecution(), "simple")
            assert "rangepartitioning" not in plan and "Sort " not in plan
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
