"""Runs against brute force, and the trees behind them."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from llm.util import WORD, edge_rows, frame

from clickfeat.llm import common, periodic_runs
from clickfeat.llm.queries import QUERIES
from conftest import SF_SMALL


def brute(w, shortest=12):
    n, out = len(w), []
    for p in range(1, n // 2 + 1):
        i = 0
        while i + p < n:
            s = i
            while i + p < n and w[i] == w[i + p]:
                i += 1
            length = i + p - s
            if i > s and length >= max(shortest, 2 * p):
                if not any(all(w[s + k] == w[s + k + q] for k in range(length - q)) for q in range(1, p)):
                    out.append((s, length, p))
            i = max(i, s + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def periodic(rng, n, letters):
    w = [rng.randrange(letters) for _ in range(n)]
    for _ in range(rng.randrange(3)):
        if n > 4:
            a = rng.randrange(n)
            p = rng.randint(1, max(1, (n - a) // 3))
            w = [w[a + (i - a) % p] if i >= a else w[i] for i in range(n)]
    return w


@pytest.mark.parametrize("shortest", [2, 5, 12])
def test_runs_equal_brute_force(shortest):
    rng = random.Random(shortest)
    for _ in range(700):
        w = periodic(rng, rng.randint(0, 70), rng.choice([1, 2, 2, 3, 5, 9]))
        assert periodic_runs.runs(np.array(w, np.int64), shortest) == brute(w, shortest), w


def test_fibonacci_word_and_single_letter():
    a, b = [0], [0, 1]
    while len(b) < 300:
        a, b = b, b + a
    assert periodic_runs.runs(np.array(b), 2) == brute(b, 2)
    assert periodic_runs.runs(np.zeros(5000, np.int64)) == [(0, 5000, 1)]


def test_common_extensions():
    rng = random.Random(4)
    s = [rng.randrange(1, 3) for _ in range(120)] + [0]
    t = periodic_runs.SuffixTree(s)
    t.tour(np.arange(3))
    assert t.leaves.tolist() == sorted(range(len(s)), key=lambda i: s[i:]) == t.sorted_suffixes(np.arange(3)).tolist()
    i, j = np.array([(i, j) for i in range(121) for j in range(121) if i != j]).T
    expect = [next(k for k in range(121) if s[a + k] != s[b + k]) for a, b in zip(i.tolist(), j.tolist(), strict=True)]
    assert t.common(i, j).tolist() == expect


def test_minima():
    rng = np.random.default_rng(1)
    for n in (1, 2, 15, 16, 17, 400):
        x = rng.integers(50, size=n).astype(np.int32)
        m = periodic_runs.Minima(x)
        a, b = np.array([(a, b) for a in range(n) for b in range(a, n)][::max(1, n // 40)]).T
        assert m.over(a, b).tolist() == [x[p:q + 1].min() for p, q in zip(a.tolist(), b.tolist(), strict=True)]


def test_stretches_hold_every_run():
    rng = random.Random(9)
    for _ in range(300):
        w = periodic(rng, rng.randint(12, 90), 4)
        parts = periodic_runs.stretches(np.array(w))
        for s, n, _ in brute(w):
            assert any(a <= s and s + n <= b for a, b in parts)


def expected(doc_id, text):
    w = WORD.findall(text or "")
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    n, g = len(w), h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    return w


def test_query_equals_brute_force(spark):
    docs = {r.doc_id: r.text for r in common.documents(spark, SF_SMALL).collect()}
    got = QUERIES["op11_periodic_runs"](spark, SF_SMALL).collect()
    assert len(got) == len(docs)
    checked = 0
    for r in got:
        w = expected(r.doc_id, docs[r.doc_id])
        if len(w) > 900:
            continue
        checked += 1
        found = brute(w)
        best = min(found, key=lambda x: (-x[1], x[0], x[2]), default=None)
        assert r.n_runs == len(found) and (r.start, r.length, r.period) == (best or (None,) * 3)
        assert r.exponent_milli == (best and 1000 * best[1] // best[2])
        assert r.runs_sha256 == hashlib.sha256("".join(f"{s},{n},{p}\n" for s, n, p in found).encode()).hexdigest()
        drop = {i for s, n, p in found for i in range(s + p, s + n)}
        assert r.collapsed_sha256 == hashlib.sha256(" ".join(x for i, x in enumerate(w) if i not in drop).encode()).hexdigest()
    assert checked > 150 and sum(r.n_runs for r in got) > 20


def test_odd_rows(spark):
    rows = [*edge_rows(), (20, "la " * 40_000 + "end", "fr", "a"), (20, "la " * 40_000 + "end", "fr", "a")]
    got = periodic_runs.find(frame(spark, rows)).collect()
    assert len(got) == len(rows)
    by_id = {}
    for r in got:
        by_id.setdefault(r.doc_id, []).append(r)
    assert by_id[3][0].runs == [] and by_id[3][0].collapsed == "" and by_id[4][0].collapsed == ""
    assert len(by_id[20]) == 2 and all([tuple(x) for x in r.runs] == [(0, 40_000, 1)] and r.collapsed == "la end" for r in by_id[20])
    assert [tuple(x) for x in by_id[-5][0].runs] == [(1, 19_999, 1)]
    assert len(by_id[None]) == 2
    assert periodic_runs.find(frame(spark, [])).collect() == [] and periodic_runs.digests(frame(spark, [])).collect() == []
