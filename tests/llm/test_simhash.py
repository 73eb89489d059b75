import random

import numpy as np
import xxhash

from clickfeat.llm import simhash
from util import WORD, edge_rows, frame


def slow_fingerprint(text):
    t = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = WORD.findall(t)
    sh = [" ".join(w[i:i + 4]) for i in range(max(1, len(w) - 3))] if w else []
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute(rows, bits=4):
    fp = [slow_fingerprint(r[1]) for r in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(len(rows)):
        for j in range(i):
            if (fp[i] ^ fp[j]).bit_count() <= bits:
                root[find(i)] = find(j)
    best = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            best[find(i)] = min(best.get(find(i), r[0]), r[0])
    return sorted((r[0] is not None, r[0] or 0, fp[i], best.get(find(i))) for i, r in enumerate(rows))


def groups(fp, bits=4):
    """The number of components."""
    left, n = set(fp), 0
    while left:
        new, n = {left.pop()}, n + 1
        while new:
            near = {x for x in left if any((x ^ y).bit_count() <= bits for y in new)}
            left, new = left - near, near
    return n


def got(df):
    return sorted((r.doc_id is not None, r.doc_id or 0, r.fp % (1 << 64), r.component_id) for r in df.collect())


def near_texts(n, seed=5):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7))) for _ in range(400)]
    rows = []
    for i in range(n):
        if rows and rng.random() < 0.6:
            w = rng.choice(rows[-40:])[1].split()
            for _ in range(rng.choice([0, 1, 1, 2, 5])):
                w[rng.randrange(len(w))] = rng.choice(words)
            rows.append((i, " ".join(w).title() if rng.random() < 0.3 else " ".join(w)))
        else:
            rows.append((i, " ".join(rng.choice(words) for _ in range(rng.choice([2, 4, 30, 200])))))
    return rows


def test_edges(spark):
    rows = edge_rows()
    assert got(simhash.near_groups(frame(spark, rows))) == brute(rows)


def test_near_copies(spark):
    rows = near_texts(400)
    want = brute(rows)
    assert got(simhash.near_groups(frame(spark, rows))) == want
    assert got(simhash.near_groups(frame(spark, rows), leaf_rows=16)) == want       # many cut leaves
    kept = simhash.keep_one(frame(spark, rows))
    assert sorted(r.doc_id for r in kept.collect()) == sorted({w[3] for w in want})
    assert kept.columns == frame(spark, rows).columns


def test_null_and_repeated_ids_keep_one_of_every_group(spark):
    plain = [t.lower() for _, t in near_texts(60) if len(t.split()) >= 30]
    apart = [t for i, t in enumerate(plain) if all((slow_fingerprint(t) ^ slow_fingerprint(o)).bit_count() > 12 for o in plain[:i])][:6]
    a, b, c, d, e, f = apart
    rows = [(None, a), (None, a.upper()), (None, b), (7, c), (7, d), (7, d), (None, e), (3, e.upper()), (9, e), (None, f)]
    kept = sorted((r.doc_id is not None, r.doc_id or 0, r.text.lower()) for r in simhash.keep_one(frame(spark, rows)).collect())
    assert kept == sorted([(False, 0, a), (False, 0, b), (True, 7, c), (True, 7, d), (True, 3, e), (False, 0, f)])
    every = edge_rows()
    fp = [slow_fingerprint(r[1]) for r in every]
    out = [slow_fingerprint(r.text) for r in simhash.keep_one(frame(spark, every)).collect()]
    assert len(out) == len({*out}) == groups(fp)


def test_empty(spark):
    assert simhash.near_groups(frame(spark, [])).count() == 0 and simhash.keep_one(frame(spark, [])).count() == 0


def test_links_are_exact_on_close_fingerprints(spark):
    rng = np.random.default_rng(2)
    base = rng.integers(0, 1 << 63, 60, dtype=np.uint64)
    fps = [base]
    for _ in range(12):                                # chains of flips, tight clusters among them
        x = fps[-1].copy()
        for _ in range(int(rng.integers(1, 6))):
            x ^= np.uint64(1) << rng.integers(0, 64, len(x)).astype(np.uint64)
        fps.append(x)
    tight = base[0] ^ (np.uint64(1) << rng.integers(0, 3, 300).astype(np.uint64))
    fp = np.unique(np.concatenate([*fps, tight]))
    for bits in (0, 1, 2, 3, 4, 5, 7):
        near = np.bitwise_count(fp[:, None] ^ fp[None, :]) <= bits
        label = np.arange(len(fp))
        while True:
            new = np.where(near, label[None, :], len(fp)).min(axis=1)
            if (new == label).all():
                break
            label = new
        df = spark.createDataFrame([(int(x),) for x in fp.view(np.int64)], "fp bigint")
        for leaf in (8, 4096):
            edges = simhash.links(df, bits, leaf)
            pairs = [(r.a, r.b) for r in edges.collect()]
            at = {int(x): i for i, x in enumerate(fp.view(np.int64))}
            assert all(near[at[a], at[b]] for a, b in pairs)
            mine = np.arange(len(fp))
            changed = True
            while changed:
                changed = False
                for a, b in pairs:
                    low = min(mine[at[a]], mine[at[b]])
                    if mine[at[a]] != low or mine[at[b]] != low:
                        mine[at[a]] = mine[at[b]] = low
                        changed = True
            assert (mine == label).all(), (bits, leaf)


def test_a_tight_group_gives_a_spanning_forest_not_all_pairs():
    x = np.arange(16, dtype=np.uint64)                 # all within four bits
    a, _ = simhash.link(x, np.zeros(0, np.uint64), True, 4)
    assert len(a) == 15


def components_of(fp, pairs):
    at = {int(x): i for i, x in enumerate(fp)}
    root = list(range(len(fp)))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i
    for a, b in pairs:
        root[find(at[a])] = find(at[b])
    return [find(i) for i in range(len(fp))]


def plain_pairs(fp, bits):
    out = []
    for i in range(0, len(fp), 500):
        for r, c in zip(*np.nonzero(np.bitwise_count(fp[i:i + 500, None] ^ fp[None, :]) <= bits), strict=True):
            if i + r < c:
                out.append((int(fp[i + r]), int(fp[c])))
    return out


def partition(labels):
    first = {}
    return [first.setdefault(x, i) for i, x in enumerate(labels)]


def test_local_trees_find_all_links(monkeypatch):
    """Rows of one leaf, also equal ones within the block and tight clusters; few rows are compared plainly."""
    monkeypatch.setattr(simhash, "LOCAL_ROWS", 24)
    rng = np.random.default_rng(4)
    mask = simhash.cut_bits((1 << 64) - 1, 3)[1]
    for kind in range(4):
        base = rng.integers(0, 1 << 63, 300, dtype=np.uint64)
        if kind == 1:                                  # equal in the block
            base = base & ~np.uint64(mask)
        fps = [base]
        for _ in range(5):
            x = fps[-1].copy()
            for _ in range(int(rng.integers(1, 4))):
                x ^= np.uint64(1) << rng.integers(0, 64, len(x)).astype(np.uint64)
            fps.append(x)
        fp = np.concatenate(fps)
        if kind == 2:
            fp = np.concatenate([fp[:200], base[0] ^ rng.integers(0, 64, 64, dtype=np.uint64)])
        fp = np.unique(fp)
        for bits in (0, 2, 4):
            blocks = simhash.cut_bits((1 << 64) - 1, bits // 2 + 1)
            got = []
            for part in blocks:
                a, b = simhash.near(fp, fp[:0], True, bits, part)
                got += list(zip(a.tolist(), b.tolist(), strict=True))
            want = plain_pairs(fp, bits)
            assert all((a ^ b).bit_count() <= bits for a, b in got)
            assert partition(components_of(fp, got)) == partition(components_of(fp, want)), (kind, bits)
            left, right = fp[::2], fp[1::2]            # two sides
            sides = [p for part in blocks for p in zip(*(x.tolist() for x in simhash.near(left, right, False, bits, part)), strict=True)]
            own = set(left.tolist())
            across = [(a, b) for a, b in want if (a in own) != (b in own)]
            assert partition(components_of(fp, sides)) == partition(components_of(fp, across)), (kind, bits)


def test_trees_deepen_with_the_input():
    """Visits grow far slower than the input, and with them the comparisons a fingerprint."""
    rng = np.random.default_rng(7)
    cost = []
    for n in (50_000, 200_000, 800_000):
        fp = rng.integers(0, 1 << 64, n, dtype=np.uint64)
        f = simhash.Forest(4, fp[: 16 * n // 512], n, 512)
        met = 0
        for t in f.trees:
            size = np.bincount(t.homes(fp), minlength=t.end)
            some = fp[:2000]
            met += size[t.homes(some)].sum() + size[t.visits(some)[1]].sum()
        cost.append(met / 2000)
    assert cost[2] < 4.5 * cost[0] and cost[2] < 0.05 * 800_000, cost       # sixteen times the input
    assert len({int(x) for t in f.trees for x in t.points}) > 300           # a vantage point per node


def test_a_neighbour_is_at_home_or_visited():
    rng = np.random.default_rng(8)
    fp = rng.integers(0, 1 << 64, 20_000, dtype=np.uint64)
    for mask in simhash.cut_bits((1 << 64) - 1, 3):
        t = simhash.Tree(fp, mask, len(fp), 64)
        bits = [i for i in range(64) if mask >> i & 1]
        x = fp[:500]
        y = x ^ np.array([1 << bits[i % len(bits)] for i in range(500)], np.uint64)
        hx, hy = t.homes(x), t.homes(y)
        one, other = ({(int(r), int(z)) for r, z in zip(*t.visits(v), strict=True)} for v in (x, y))
        assert all(hx[i] == hy[i] or (i, int(hy[i])) in one or (i, int(hx[i])) in other for i in range(500))
        every = {(int(r), int(z)) for r, z in zip(*t.visits(x, both=True), strict=True)}
        assert all(hx[i] == hy[i] or (i, int(hy[i])) in every for i in range(500))
