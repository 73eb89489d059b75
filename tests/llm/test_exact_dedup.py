import hashlib
import random
from collections import Counter, defaultdict

import numpy as np

from clickfeat.llm import exact_dedup as ed
from util import SPACE, edge_rows, frame, nulls_last


def brute(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[SPACE.sub("", r[1] or "")].append((r[0], len(r[1] or "")))
    out = []
    for text, members in groups.items():
        keep = min(members, key=lambda m: (-m[1], nulls_last(m[0])))
        first = members.index(keep)
        for i, (doc, _) in enumerate(members):
            out.append((doc, keep[0], len(members), i == first, hashlib.sha256(text.encode()).hexdigest()))
    return Counter(out)


def got(df):
    return Counter((r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in df.collect())


def test_edges(spark):
    rows = edge_rows()
    assert got(ed.exact_groups(frame(spark, rows))) == brute(rows)
    kept = ed.keep_one(frame(spark, rows))
    assert kept.columns == frame(spark, rows).columns
    want = Counter((d, k) for (d, _, _, kept_, k), n in brute(rows).items() if kept_ for _ in range(n))
    assert Counter((r.doc_id, hashlib.sha256(SPACE.sub("", r.text or "").encode()).hexdigest()) for r in kept.collect()) == want


def test_random_groups_with_small_buckets(spark):
    rng = random.Random(1)
    rows = [(i, f"t{rng.randint(0, 150)} " + " " * rng.randint(0, 3) + "z" * rng.randint(0, 1)) for i in range(1500)]
    rows += [(2000 + i, "hot copy" + " " * (i % 5)) for i in range(800)]
    rng.shuffle(rows)
    assert got(ed.exact_groups(frame(spark, rows).repartition(7), capacity=64, max_depth=8)) == brute(rows)


def test_empty(spark):
    assert ed.exact_groups(frame(spark, [])).count() == 0 and ed.keep_one(frame(spark, [])).count() == 0


def test_equal_keys_are_told_apart_by_bytes(spark, monkeypatch):
    import pyarrow as pa
    rows = [(0, 5, b"aa", 2, 1, 1), (0, 5, b"bb", 2, 2, 1), (0, 5, b"aa", 4, 3, 2), (0, 6, b"cc", 2, 4, 1)]
    cols = list(zip(*rows))
    kinds = [pa.int32(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
    batch = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=["bucket", "key", "text", "n_chars", "doc_id", "n"])
    out = [r for b in ed._own(iter([batch])) for r in b.to_pylist()]
    assert [(r["key"], r["chain"], r["keep_id"], r["n"], r["text"]) for r in out] == [(5, 0, 3, 3, b"aa"), (5, 1, 2, 1, b"bb"), (6, 0, 4, 1, b"cc")]


def test_directory_doubles_until_buckets_fit():
    rng = np.random.default_rng(0)
    weights = rng.integers(0, 50, 256)
    weights[17] = 5000                                 # cannot be split further
    slots, depths = ed.build_directory(weights, 400)
    per_slot = 256 // len(slots)
    load = np.zeros(len(depths), int)
    for prefix, w in enumerate(weights):
        load[slots[prefix // per_slot]] += w
    hot = slots[17 // per_slot]
    assert load.sum() == weights.sum() and depths[hot] == 8
    assert all(x <= 400 for b, x in enumerate(load) if b != hot)
    for b, depth in enumerate(depths):                 # a bucket of local depth d has 2**(g - d) slots
        assert (slots == b).sum() == len(slots) >> depth
