from collections import defaultdict

import pytest

from clickfeat.llm import common, mixing
from util import WORD, edge_rows, frame


def slow_targets(sizes, weights=(5, 2, 1), share=1.5, cap=2.0):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode("utf-32-be")))
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    left, target, open_ = share * sum(sizes.values()), dict.fromkeys(names, 0.0), set(names)
    while left > 1e-9 and open_:
        total = sum(w[s] for s in open_)
        add = {s: left * w[s] / total for s in open_}
        left = 0.0
        for s in list(open_):
            target[s] += add[s]
            if target[s] >= cap * sizes[s]:
                left += target[s] - cap * sizes[s]
                target[s] = cap * sizes[s]
                open_.discard(s)
    return target


def check(spark, rows):
    out = mixing.mix(frame(spark, rows)).collect()
    sizes = defaultdict(int)
    for r in rows:
        sizes[r[3]] += len(WORD.findall(r[1] or ""))
    target = slow_targets(sizes)
    taken, source = defaultdict(int), defaultdict(list)
    for r in rows:
        source[r[0], len(WORD.findall(r[1] or ""))].append(r[3])
    assert sorted((r.doc_id is None, r.doc_id or 0, r.size) for r in out) == sorted((r[0] is None, r[0] or 0, len(WORD.findall(r[1] or ""))) for r in rows)
    for r in out:
        s = source[r.doc_id, r.size][0]
        assert r.source_size == sizes[s] and r.target == pytest.approx(target[s], abs=1e-6)
        assert 0 <= r.taken <= 2 * r.size
        taken[s] += r.taken
    for s, t in target.items():
        assert abs(taken[s] - t) < 1 + 1e-6
    return out


def many(n=600):
    import random
    rng = random.Random(2)
    names = ["a", "b", "B", "é", "\U0001F600", "zz", None, ""]
    return [(i, "w " * rng.choice([0, 1, 3, 40, 900]), "en", rng.choice(names + ["a"] * 6)) for i in range(n)]


def test_edges(spark):
    check(spark, edge_rows())


def test_targets_and_budgets(spark):
    check(spark, many())


def test_prefix_sums_follow_the_hash_order(spark):
    from pyspark.sql import functions as F
    rows = many(300)
    docs = frame(spark, rows)
    key = {r.doc_id: r.k for r in docs.select("doc_id", F.xxhash64(F.lit(mixing.SEED), "doc_id", common.text_hash()).alias("k")).collect()}
    taken = {r.doc_id: r for r in mixing.mix(docs).collect()}
    groups = defaultdict(list)
    for r in rows:
        groups[r[3]].append(r[0])
    for members in groups.values():
        members.sort(key=lambda d: key[d])
        total = sum(taken[d].size for d in members)
        budget = int(taken[members[0]].target)
        at = 0
        for d in members:
            size = taken[d].size
            epochs = budget // total if total else 0
            assert taken[d].taken == epochs * size + max(0, min(size, budget - epochs * total - at))
            at += size


def test_reruns_agree_whatever_the_partitions(spark):
    rows = many(300)
    a = sorted(map(tuple, mixing.mix(frame(spark, rows)).collect()))
    b = sorted(map(tuple, mixing.mix(frame(spark, rows[::-1]).repartition(13)).collect()))
    assert a == b


def test_rows_of_the_mix(spark):
    rows = many(200) + [(1000, "same row twice", "en", "a")] * 2
    docs = frame(spark, rows)
    copies = defaultdict(int)
    for r in mixing.mix(docs).collect():
        copies[r.doc_id] += r.copies
    out = mixing.mixed_rows(docs)
    assert out.columns == docs.columns
    got = defaultdict(int)
    for r in out.collect():
        got[r.doc_id] += 1
    assert got == {k: v for k, v in copies.items() if v}


def test_empty(spark):
    assert mixing.mix(frame(spark, [])).count() == 0 and mixing.mixed_rows(frame(spark, [])).count() == 0
    assert [r.taken for r in mixing.mix(frame(spark, [(1, None), (2, " ")])).collect()] == [0, 0]
