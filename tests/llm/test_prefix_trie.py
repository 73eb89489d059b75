"""The trie against brute force, in one block and in many."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from clickfeat.llm import prefix_trie
from clickfeat.llm.queries import QUERIES
from conftest import SF_SMALL

SCHEMA = "conv_id bigint, turn bigint, role string, text string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def brute_rebuilt(rows):
    convs = defaultdict(list)
    for c, t, role, text in rows:
        convs[c].append((t is not None, t or 0, hashlib.sha256(f"{len((role or '').encode())}:{role or ''}{text or ''}".encode()).digest()[:16], role or "", text or ""))
    convs = {c: [x[3:] for x in sorted(v)] for c, v in convs.items()}
    out = {}
    for c, own in convs.items():
        if c is None:
            out[c] = own
            continue
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = convs.get(c - int(abs(c) % 5) * (1 if c >= 0 else -1), [])[:h] + own[h:]
    return out


def brute_trie(convs):
    """convs: conv_id -> list of (role, text)."""
    members, ends = defaultdict(list), defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
        ends[tuple(turns)].append(c)
    children = defaultdict(list)
    for p in members:
        if p:
            children[p[:-1]].append(p)
    order = lambda v: sorted(v, key=lambda c: (c is not None, c or 0))
    smallest = {p: min((c for c in m if c is not None), default=None) for p, m in members.items()}
    leaves, saved = {}, {}
    for p in sorted(members, key=len, reverse=True):
        leaves[p] = sum(leaves[x] for x in children[p]) or 1
        saved[p] = sum(saved[x] for x in children[p]) + (len(members[p]) - 1) * (len(p[-1][1].encode()) if p else 0)
    return sorted(((smallest[p], len(p), smallest[p[:-1]] if p else None, len(m), len(children[p]), leaves[p], saved[p],
                    hashlib.sha256(",".join("" if c is None else str(c) for c in order(ends.get(p, []))).encode()).hexdigest()) for p, m in members.items()), key=repr)


def listed(df):
    return sorted((tuple(r[c] for c in COLUMNS) for r in df.collect()), key=repr)


def random_rows(rng, n, letters=3, deep=9):
    rows = []
    for c in rng.sample(range(3 * n), n):
        if rng.random() < 0.25:
            turns = [("user", "the same"), ("assistant", "copy é")]
        else:
            turns = [(rng.choice(["user", "assistant"]), rng.choice("aé字"[:letters]) * rng.randint(0, 2)) for _ in range(rng.randint(1, deep))]
        rows += [(c, t, r, x) for t, (r, x) in enumerate(turns)]
    rng.shuffle(rows)
    return rows


def test_query_equals_brute_force(spark):
    rows = [tuple(r[c] for c in ("conv_id", "turn", "role", "text")) for r in spark.read.parquet(f"{SF_SMALL}/conversations.parquet").collect()]
    got = listed(QUERIES["op13_prefix_trie"](spark, SF_SMALL))
    assert got == brute_trie(brute_rebuilt(rows))
    assert max(r[3] for r in got) > 1 and len(got) > 20


@pytest.mark.parametrize("block_bytes,chunk", [(1 << 20, 4096), (200, 3)])
def test_random_conversations(spark, monkeypatch, block_bytes, chunk):
    monkeypatch.setattr(prefix_trie, "BLOCK_BYTES", block_bytes)
    monkeypatch.setattr(prefix_trie, "CHUNK", chunk)
    rng = random.Random(block_bytes)
    for n in (1, 7, 150):
        rows = random_rows(rng, n)
        df = spark.createDataFrame(rows, SCHEMA).repartition(3)
        assert listed(prefix_trie.rebuilt_trie(df)) == brute_trie(brute_rebuilt(rows))


def test_blocks_of_every_size():
    """Nodes of blocks, added up, do not depend on where blocks are cut."""
    rng = random.Random(11)
    for _ in range(60):
        convs = {c: [("u", rng.choice("ab")) for _ in range(rng.randint(0, 6))] for c in range(rng.randint(1, 25))}
        groups = defaultdict(list)
        for c, t in convs.items():
            groups[b"".join(hashlib.sha256(repr(x).encode()).digest()[:16] for x in t)].append(c)
        keys = sorted(groups)
        sizes = {k: [1] * (len(k) // 16) for k in keys}
        cuts = sorted(rng.sample(range(1, len(keys)), rng.randint(0, len(keys) - 1))) if len(keys) > 1 else []
        total = defaultdict(lambda: [None, 0, 0, 0, 0])
        whole = set()
        for a, b in zip([0, *cuts], [*cuts, len(keys)], strict=True):
            part = keys[a:b]
            before = prefix_trie.shared(keys[a - 1], part[0]) if a else -1
            after = prefix_trie.shared(part[-1], keys[b]) if b < len(keys) else -1
            rows = prefix_trie.block_nodes(part, [sizes[k] for k in part], [min(groups[k]) for k in part], [len(groups[k]) for k in part],
                                           ["x"] * len(part), before, after, b < len(keys) and keys[b].startswith(part[-1]))
            for path, _, low, d, _, n, kids, leaves, saved, _, is_part, _ in rows:
                key = path if is_part else ("whole", low, d)
                assert is_part or key not in whole
                whole.add(key)
                t = total[key]
                t[0] = low if t[0] is None else min(t[0], low)
                for k, v in enumerate((n, kids, leaves, saved), 1):
                    t[k] += v
        # every turn has one byte here
        expect = sorted(x[3:7] for x in brute_trie(convs))
        assert sorted(tuple(t[1:]) for t in total.values()) == expect


def test_range_minima():
    rng = np.random.default_rng(2)
    x = rng.integers(0, 5, 50)
    m = prefix_trie.RangeMinima(x)
    at, depth = np.array([(i, d) for i in range(50) for d in range(6)]).T
    right = [next((j - 1 for j in range(i + 1, 50) if x[j] < d), 49) for i, d in zip(at.tolist(), depth.tolist(), strict=True)]
    left = [next((j for j in range(i, 0, -1) if x[j] < d), 0) for i, d in zip(at.tolist(), depth.tolist(), strict=True)]
    assert m.right(at, depth).tolist() == right and m.left(at, depth).tolist() == left


def test_odd_rows(spark):
    rows = [(None, 0, "user", "no id"), (None, 1, None, None), (5, None, "user", "no turn"), (5, 0, "user", None), (6, 0, "user", ""), (6, 0, "user", ""),
            (7, 3, None, "x" * 100_000), (8, 3, None, "x" * 100_000), (-7, 0, "user", "hi"), (9_007_199_254_740_993, 1, "user", "hi"), (9_007_199_254_740_992, 1, "user", "hi"),
            *[(1000 + i, 0, "user", "hi") for i in range(40)], *[(12, i, "user", str(i)) for i in range(500)]]
    df = spark.createDataFrame(rows, SCHEMA)
    for name in ("d", "b", "h", "family", "key", "n", "path", "has", "turns", "part", "block", "sizes"):
        df = df.withColumn(name, F.lit("x"))
    assert listed(prefix_trie.rebuilt_trie(df)) == brute_trie(brute_rebuilt(rows))
    assert prefix_trie.rebuilt_trie(df.limit(0)).collect() == []
