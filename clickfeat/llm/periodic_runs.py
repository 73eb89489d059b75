"""Periodic runs of words by suffix-tree LCE.

A run is a stretch of consecutive words with smallest period q (words q apart are equal), at least
``max(SHORTEST, 2 q)`` words long, which no neighbouring word extends.  Every run contains, for one of
two opposite orders of the words, a Lyndon root: the longest Lyndon word that starts at one of its
places has length q.  So there are two candidates (place, q) a place, each of which is extended to
the right and to the left as far as words q apart agree; it is a run if it spans 2 q words.

The extensions are longest-common-extension queries: Ukkonen's suffix tree of the words and another
of their reversal, each with an Euler tour and a range-minimum table over its depths, give the lowest
common ancestor of two leaves, whose string depth is the answer, in constant time.  The leaves of
the tree in the order of its edges' first words are the sorted suffixes, which give the longest
Lyndon words (up to the next smaller suffix); the words in opposite order give the other half.

Only words that can be in a run enter the trees.  A run of L words repeats its first L - q >= L / 2
words q later, and these and the repeat cover it.  So every word of a run of at least 12 words lies
in a window of 6 words that occurs again in the same covered stretch.  All other words are
left out first; a collision of window hashes can only leave a word in.

Defined cases: null text counts as empty (no runs, empty collapsed text); rows that share a doc_id
get a result each; ``planted`` leaves a document without an id as it is; an empty table gives no rows; other
columns are not read.  A text's words are held
by one task, some 200 bytes for each word that enters the trees.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from clickfeat.llm import common

SHORTEST = 12
#: Rounds of leaving words out; what is left after them goes to the trees whole.
ROUNDS = 8

Rewrite = Callable[[int | None, list[bytes]], list[bytes]]


# ---- the words that can be in a run ----

_MIX = np.random.default_rng(11).integers(1 << 62, size=SHORTEST // 2 + 1, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _again(x: np.ndarray) -> np.ndarray:
    """Which values occur more than once."""
    order = np.argsort(x, kind="stable")
    s = x[order]
    same = s[1:] == s[:-1]
    out = np.empty(len(x), bool)
    out[order] = np.append(same, False) | np.append(False, same)
    return out


def stretches(words: np.ndarray, shortest: int = SHORTEST) -> list[tuple[int, int]]:
    """Stretches (start, end) of words that hold every run of at least ``shortest`` words."""
    k = shortest // 2
    n = len(words)
    if n < shortest:
        return []
    size = n - k + 1
    h = np.zeros(size, np.uint64)
    w = words.astype(np.uint64)
    for j in range(k):
        h += w[j:j + size] * _MIX[j % len(_MIX)] * np.uint64(2 * j + 1)
        h ^= h >> np.uint64(29)
    at = np.flatnonzero(_again(h))                    # windows that occur again
    for _ in range(ROUNDS):
        if not len(at):
            return []
        new = np.append(True, np.diff(at) > k)        # windows further apart than k leave a word uncovered, or a border
        part = np.cumsum(new)
        key = h[at] + part.astype(np.uint64) * _MIX[-1]
        keep = _again(key)
        if keep.all():
            break
        at = at[keep]
    if not len(at):
        return []
    first = np.flatnonzero(np.append(True, np.diff(at) > k))
    last = np.append(first[1:], len(at)) - 1
    return [(a, b) for a, b in zip(at[first].tolist(), (at[last] + k).tolist(), strict=True) if b - a >= shortest]


# ---- suffix tree, Euler tour, LCE ----

class SuffixTree:
    """Ukkonen's tree of a list of small integers whose last one occurs nowhere else."""

    def __init__(self, s: list[int]):
        self.s = s
        self.width = max(s) + 1
        self._build()

    def _build(self) -> None:
        s, width, n = self.s, self.width, len(self.s)
        start, end, link = [0], [0], [0]
        edges: dict[int, int] = {}
        get = edges.get
        node = length = edge = left = 0               # the active point, and suffixes still to be added
        for i, c in enumerate(s):
            last = 0
            left += 1
            while left:
                if not length:
                    edge = i
                key = node * width + s[edge]
                child = get(key)
                if child is None:
                    edges[key] = len(start)
                    start.append(i)
                    end.append(n)
                    link.append(0)
                    if last:
                        link[last] = node
                        last = 0
                else:
                    a = start[child]
                    size = end[child] - a
                    if length >= size and a + size <= i:
                        edge += size
                        length -= size
                        node = child
                        continue
                    if s[a + length] == c:
                        if last:
                            link[last] = node
                        length += 1
                        break
                    split = len(start)                # a node within the edge, and a leaf
                    edges[key] = split
                    edges[split * width + c] = split + 1
                    edges[split * width + s[a + length]] = child
                    start += (a, i)
                    end += (a + length, n)
                    link += (0, 0)
                    start[child] = a + length
                    if last:
                        link[last] = split
                    last = split
                left -= 1
                if node:
                    node = link[node]
                elif length:
                    length -= 1
                    edge = i - left + 1
        self.size = np.array(end) - np.array(start)
        keys = np.fromiter(edges.keys(), np.int64, len(edges))
        child = np.fromiter(edges.values(), np.int64, len(edges))
        self.parent = np.zeros(len(start), np.int64)
        self.parent[child] = keys // width
        self.first = np.zeros(len(start), np.int64)   # the first word of the edge to a node
        self.first[child] = keys % width

    def children(self, rank: np.ndarray) -> tuple[list[int], list[int]]:
        """Children by ``rank`` of their edges' first words: places in a list, and the list."""
        order = np.lexsort((rank[self.first[1:]], self.parent[1:])) + 1
        count = np.bincount(self.parent[1:], minlength=len(self.parent))
        return np.concatenate([[0], np.cumsum(count)]).tolist(), order.tolist()

    def tour(self, rank: np.ndarray) -> None:
        """The Euler tour: ``seen`` the nodes visited, ``place`` each leaf's place in it by the start of its suffix,
        ``leaves`` the starts of the suffixes in sorted order."""
        at, order = self.children(rank)
        size = self.size.tolist()
        n = len(self.s)
        depth = [0] * len(size)
        seen, leaves, place = [], [], [0] * n
        stack = [0]
        visit, push, pop = seen.append, stack.append, stack.pop
        nxt = at[:-1]
        while stack:
            u = stack[-1]
            i = nxt[u]
            if i == at[u] == at[u + 1]:               # a leaf
                x = n - depth[u]
                place[x] = len(seen)
                leaves.append(x)
                visit(u)
                pop()
            elif i < at[u + 1]:
                visit(u)
                v = order[i]
                nxt[u] = i + 1
                depth[v] = depth[u] + size[v]
                push(v)
            else:
                visit(u)
                pop()
        self.leaves = np.array(leaves)
        self.place = np.array(place)
        self.minima = Minima(np.array(depth, np.int32)[np.array(seen)])

    def sorted_suffixes(self, rank: np.ndarray) -> np.ndarray:
        """Starts of the suffixes in the order that ``rank`` gives the words."""
        at, order = self.children(rank)
        size, n = self.size.tolist(), len(self.s)
        out, stack = [], [(0, 0)]
        while stack:
            u, d = stack.pop()
            if at[u] == at[u + 1]:
                out.append(n - d)
            else:
                stack += [(v, d + size[v]) for v in order[at[u]:at[u + 1]][::-1]]
        return np.array(out)

    def common(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Longest common extension of the suffixes at i and at j (i != j)."""
        a, b = self.place[i], self.place[j]
        return self.minima.over(np.minimum(a, b), np.maximum(a, b))


class Minima:
    """Minima of ranges in constant time and linear room: a sparse table over blocks, and scans within blocks."""

    BLOCK = 16

    def __init__(self, x: np.ndarray):
        b = self.BLOCK
        rows = -(-len(x) // b)
        self.x = np.full(rows * b, np.iinfo(x.dtype).max, x.dtype)
        self.x[:len(x)] = x
        grid = self.x.reshape(rows, b)
        self.before = np.minimum.accumulate(grid, axis=1).ravel()
        self.after = np.ascontiguousarray(np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1]).ravel()
        self.table = [grid.min(axis=1)]
        step = 1
        while 2 * step <= rows:
            t = self.table[-1]
            self.table.append(np.minimum(t[:-step], t[step:]))
            step *= 2

    def over(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The least of x[a..b], both ends included."""
        p, q = a // self.BLOCK, b // self.BLOCK
        out = np.minimum(self.after[a], self.before[b])
        near = np.flatnonzero(p == q)
        if len(near):
            low, high = a[near], b[near]
            least = self.x[low]
            for k in range(1, self.BLOCK):
                least = np.minimum(least, self.x[np.minimum(low + k, high)])
            out[near] = least
        far = np.flatnonzero(q - p > 1)
        if len(far):
            low, size = p[far] + 1, q[far] - p[far] - 1
            level = np.frexp(size)[1] - 1
            for k in np.unique(level).tolist():
                at = np.flatnonzero(level == k)
                t, s = self.table[k], low[at]
                out[far[at]] = np.minimum(out[far[at]], np.minimum(t[s], t[s + size[at] - (1 << k)]))
        return out


# ---- runs ----

def _next_smaller(order: np.ndarray) -> np.ndarray:
    """For every suffix the start of the next smaller one to its right."""
    n = len(order)
    rank = np.empty(n, np.int64)
    rank[order] = np.arange(n)
    rank = rank.tolist()
    out, stack = [n] * n, []
    for i, r in enumerate(rank):
        while stack and rank[stack[-1]] > r:
            out[stack.pop()] = i
        stack.append(i)
    return np.array(out)


def runs(words: np.ndarray, shortest: int = SHORTEST) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run, by start and then period.  ``words``: numbers, equal for equal words."""
    parts = stretches(words, shortest)
    if not parts:
        return []
    seps = len(parts)                                # stretches are joined by numbers that occur once
    joined, origin = [], []
    known: dict[int, int] = {}
    for k, (a, b) in enumerate(parts):
        joined += [known.setdefault(w, len(known) + seps) for w in words[a:b].tolist()]
        joined.append(k)
        origin += [*range(a, b), -1]
    n = len(joined)
    width = seps + len(known)
    up = np.arange(width)                             # a stretch's end is smaller than every word in both orders
    down = np.append(np.arange(seps), width + seps - 1 - np.arange(seps, width))
    forward = SuffixTree(joined)
    forward.tour(up)
    # the reversal ends in a number of its own in place of the one in front of the first stretch
    backward = SuffixTree([*joined[:-1][::-1], joined[-1]])
    backward.tour(up)
    inside = np.array(joined) >= seps
    found = []
    for order in (forward.leaves, forward.sorted_suffixes(down)):
        to = _next_smaller(order)
        i = np.flatnonzero(inside & (to < n))
        i = i[inside[to[i]]]                          # a root that reaches its stretch's end is not repeated behind it
        j = to[i]
        end = j + forward.common(i, j)
        # the words in front of i and j, read backwards; nothing stands in front of the first word
        left = np.zeros(len(i), np.int64)
        some = np.flatnonzero(i > 0)
        left[some] = backward.common(n - 1 - i[some], n - 1 - j[some])
        start, period = i - left, j - i
        keep = end - start >= np.maximum(2 * period, shortest)
        found.append(np.stack([start, end - start, period], axis=1)[keep])
    got = np.unique(np.concatenate(found), axis=0)
    place = np.array(origin)
    return sorted(zip(place[got[:, 0]].tolist(), got[:, 1].tolist(), got[:, 2].tolist(), strict=True), key=lambda x: (x[0], x[2]))


def collapse(n: int, found: list[tuple[int, int, int]]) -> np.ndarray | None:
    """Which of n words stay when each run keeps its first period; None if all do."""
    if not found:
        return None
    edge = np.zeros(n + 1, np.int64)
    for start, length, period in found:
        edge[start + period] += 1
        edge[start + length] -= 1
    return np.cumsum(edge[:-1]) == 0


def of_text(doc_id: int | None, text: str | None, rewrite: Rewrite | None = None, shortest: int = SHORTEST) -> tuple[list[tuple[int, int, int]], bytes]:
    """A text's runs, and its words without the repeats, joined by one space."""
    words = (text or "").encode().split()             # bytes: split at \x20 and \x09-\x0D only
    if rewrite:
        words = rewrite(doc_id, words)
    if len(words) < shortest:
        return [], b" ".join(words)
    known: dict[bytes, int] = {}
    ids = np.array([known.setdefault(w, len(known)) for w in words])
    found = runs(ids, shortest)
    stay = collapse(len(words), found)
    return found, b" ".join(words if stay is None else [w for w, s in zip(words, stay.tolist(), strict=True) if s])


def planted(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The words with a period planted in a tenth of the documents (those whose crc32 of the decimal doc_id ends in 0)."""
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 or not words:
        return words
    n, g = len(words), h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    root = words[a:a + p]
    return words[:a] + (root * (-(-(n - a) // p)))[:n - a]


def _find(rewrite: Rewrite | None, shortest: int):
    kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = [of_text(d, t, rewrite, shortest) for d, t in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist(), strict=True)]
            listed = [[dict(zip(("start", "length", "period"), r, strict=True)) for r in found] for found, _ in got]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(listed, kind), pa.array([c.decode() for _, c in got], pa.string())],
                                             names=["doc_id", "runs", "collapsed"])
    return run


def find(docs: DataFrame, rewrite: Rewrite | None = None, shortest: int = SHORTEST) -> DataFrame:
    """Per document: doc_id, runs (array of start, length, period, by start and then period) and the collapsed text."""
    common.workers(docs.sparkSession)
    return docs.select("doc_id", "text").mapInArrow(_find(rewrite, shortest), "doc_id long, runs array<struct<start:long,length:long,period:long>>, collapsed string")


DIGESTS = "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string"


def _digests(rewrite: Rewrite | None, shortest: int):
    names = [x.split()[0] for x in DIGESTS.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for d, t in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist(), strict=True):
                found, kept = of_text(d, t, rewrite, shortest)
                best = min(found, key=lambda r: (-r[1], r[0], r[2]), default=None)
                listed = "".join(f"{s},{n},{p}\n" for s, n, p in found).encode()
                rows.append((d, len(found), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
                             hashlib.sha256(listed).hexdigest(), hashlib.sha256(kept).hexdigest()))
            cols = list(zip(*rows, strict=True)) or [()] * len(names)
            kinds = [pa.int64()] * 6 + [pa.string()] * 2
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=names)
    return run


def digests(docs: DataFrame, rewrite: Rewrite | None = None, shortest: int = SHORTEST) -> DataFrame:
    """Per document the number of runs, the longest one and digests of all runs and of the collapsed text."""
    common.workers(docs.sparkSession)
    return docs.select("doc_id", "text").mapInArrow(_digests(rewrite, shortest), DIGESTS)
