import hashlib
import random

import numpy as np

from clickfeat.llm import fingerprints as fp
from util import edge_rows, frame, nulls_last


def slow_winnow(text, k, w):
    """Straight from the definition, with the operator's hash of each run taken alone."""
    if not text:
        return []
    k = min(k, len(text))
    h = [int(fp._hashes(fp.points(text[i:i + k]), k)[0]) for i in range(len(text) - k + 1)]
    w = min(w, len(h))
    chosen = set()
    for a in range(len(h) - w + 1):
        low = min(h[a:a + w])
        chosen.add((max(i for i in range(a, a + w) if h[i] == low), low))
    return sorted(chosen)


def test_definition(monkeypatch):
    monkeypatch.setattr(fp, "CHUNK", 50)
    rng = random.Random(1)
    for _ in range(150):
        text = "".join(rng.choice("ab\U0001F600") for _ in range(rng.randint(0, 300)))
        k, w = rng.randint(1, 20), rng.randint(1, 40)
        pos, val = fp.winnow(text, k, w)
        assert list(zip(pos.tolist(), val.tolist())) == slow_winnow(text, k, w)


def test_shared_passages_are_found_at_their_positions():
    rng = random.Random(2)
    for _ in range(50):
        make = lambda n: "".join(rng.choice("abcdefghijklmnop ") for _ in range(n))
        same = make(fp.K + fp.W - 1)
        a, b = make(rng.randint(0, 200)), make(rng.randint(0, 200))
        x, y = fp.winnow(a + same + make(90)), fp.winnow(b + same + make(70))
        places = {int(h): int(p) - len(a) for p, h in zip(*x)}
        assert any(places.get(int(h)) == int(p) - len(b) for p, h in zip(*y))


def brute(rows):
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] if r[0] is not None else 0), reverse=True)
    out = []
    for i, r in enumerate(order):
        t, nxt = r[1] or "", order[(i + 1) % len(order)][1] or ""
        e = t[:len(t) - len(t) // 2] + nxt[:len(t) // 2]
        a, b, c = (fp.winnow(x) for x in (t, e, nxt))
        sets = [set(x[1].tolist()) for x in (a, b, c)]
        j = lambda p, q: len(p & q) / len(p | q) if p | q else 1.0
        out.append((r[0], len(t), hashlib.sha256(e.encode()).hexdigest(), fp.digest(a), fp.digest(b), j(sets[0], sets[1]), j(sets[0], sets[2])))
    return sorted(out, key=lambda x: (nulls_last(x[0]), x))


def got(df):
    cols = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=lambda x: (nulls_last(x[0]), x))


def test_next_document(spark, monkeypatch):
    rows = [r for r in edge_rows() if r[0] not in (None, 2, 6)]       # the order of equal ids is the operator's own
    assert got(fp.compare_with_next(frame(spark, rows))) == brute(rows)
    rng = random.Random(3)
    rows = [(i * 7 - 300, "".join(rng.choice("abc de") for _ in range(rng.randint(0, 400)))) for i in range(250)]
    rng.shuffle(rows)
    monkeypatch.setattr(fp, "RANGE_ROWS", 1000)
    for size in (1000, 1, 17):
        df = fp.in_order(frame(spark, rows), size).select("place", "lone", "doc_id", "text").mapInArrow(fp._pairs(fp.K, fp.W), fp.OUT)
        assert got(df) == brute(rows)


def test_edges(spark):
    rows = edge_rows()
    out = fp.compare_with_next(frame(spark, rows)).collect()
    assert sorted((nulls_last(r.doc_id), r.n_chars) for r in out) == sorted((nulls_last(r[0]), len(r[1] or "")) for r in rows)
    same = [r.fingerprint for r in out if r.doc_id == 2]
    assert len(same) == 2 and same[0] == same[1]
    assert fp.compare_with_next(frame(spark, [])).count() == 0
    one = fp.compare_with_next(frame(spark, [(4, "only one document here")])).collect()
    assert len(one) == 1 and one[0].near_next == 1.0
    full = fp.fingerprints(frame(spark, rows)).collect()
    assert len(full) == len(rows) and all(len(r.positions) == len(r.hashes) for r in full)
    assert np.array_equal(next(r.positions for r in full if r.doc_id == 1), fp.winnow(rows[0][1])[0])
