"""Packing by non-negative least squares over length combinations.

Every document is a list of ids with an end id.  Its full windows of ``size`` ids become sequences of
their own; what is left, its rest (1 to size - 1 ids), shares sequences with other rests.  Of the
histogram of rests (at most size - 1 numbers, however many documents there are) the driver plans:

1. all combinations of two or three lengths with documents that fill a window exactly are enumerated;
2. non-negative least squares gives how often each is to be used, so that together they come close to the
   histogram.  The active-set method returns at most as many combinations as there are lengths;
3. the counts are rounded down and held to what the histogram has;
4. the residual is packed greedily: the longest length opens a window and the longest that still fit are
   added; windows that come out full are kept.  All others follow in one row, longest first, which is cut at every
   ``size`` ids, and whose last part is cut into powers of two.  So there is no padding, and few rests are cut.

A rest finds its place from its rank among the rests of its length: ranks are counted within hash
chunks of a length and added up over the chunks, so no length is ranked in one task.  Only rests that
are cut need their ids again; these are looked up in the table of encoded documents.

Ids come from the tokenizers library.  A worker cuts a batch of texts into pre-tokens, keeps a bounded
cache of them, and encodes new ones many at a time, joined by line ends, which are a
token of their own.  Texts that may hold an added token's string go to the library whole, which gives that string
its id.

Defined cases: null text counts as empty and has only the end id; rows that share a doc_id are told
apart by their text's hash, fully repeated rows by their place; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from clickfeat.llm import common, pretokens

SIZE = 1024
#: Pre-tokens that a worker remembers.
CACHE = 700_000
#: Rows of one length that are ranked in one group, on average.
CHUNK_ROWS = 100_000
#: Cut rests up to this many are broadcast to find their ids.
FEW = 100_000

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


# ---- the plan ----

def combinations(lengths: np.ndarray, size: int) -> np.ndarray:
    """All pairs and triples of ``lengths`` (ascending within each) that add up to ``size``; 0 stands for no third."""
    has = np.zeros(size + 1, bool)
    has[lengths] = True
    a, b = np.meshgrid(lengths, lengths, indexing="ij")
    c = size - a - b
    ok = (a <= b) & (c == 0)
    pairs = np.stack([a[ok], b[ok], c[ok]], axis=1)
    ok = (a <= b) & (b <= c)
    a, b, c = a[ok], b[ok], c[ok]
    ok = has[c]
    return np.concatenate([pairs, np.stack([a[ok], b[ok], c[ok]], axis=1)])


def nnls(columns: np.ndarray, target: np.ndarray, rounds: int = 60, block: int = 96) -> np.ndarray:
    """x >= 0 with A x close to ``target`` by active sets.  Column j of A counts the lengths in ``columns[j]``.
    Each round frees the columns with the steepest descent (disjoint ones, several at once) and solves for the free ones."""
    x = np.zeros(len(columns))
    free: list[int] = []
    held = np.zeros(len(columns), bool)
    scale = max(1.0, float(target.max(initial=0)))
    goal = target / scale
    goal[0] = 0

    def fitted(at, values):
        return np.bincount(columns[at].ravel(), np.repeat(values, columns.shape[1]), len(goal))

    least = np.inf
    for _ in range(rounds):
        off = goal - fitted(free, x[free])
        off[0] = 0
        error = float(off @ off)
        if error > least * (1 - 1e-3):                # several at once may hinder each other; one alone always descends
            if block == 1 and error >= least * (1 - 1e-9):
                break
            block = max(1, block // 4)
        least = min(least, error)
        if error <= 1e-9:
            break
        slope = off[columns].sum(axis=1)
        slope[held] = 0
        used, added = set(), 0
        for j in np.argsort(-slope, kind="stable")[:20 * block].tolist():
            if slope[j] <= 1e-9 or added == block:
                break
            names = set(columns[j].tolist()) - {0}
            if not names & used:
                used |= names
                free.append(j)
                held[j] = True
                added += 1
        if not added:
            break
        while free:
            a = np.zeros((len(goal), len(free)))
            for c in range(columns.shape[1]):
                np.add.at(a, (columns[free, c], np.arange(len(free))), 1.0)
            a[0] = 0
            z = np.linalg.solve(a.T @ a + 1e-9 * np.eye(len(free)), a.T @ goal)
            if (z > 0).all():
                x[free] = z
                break
            now = x[free]
            low = z <= 0
            step = float(np.min(now[low] / (now[low] - z[low] + 1e-300)))
            now = now + step * (z - now)
            now[low & (now <= 1e-12)] = 0
            x[free] = now
            gone = [j for j, v in zip(free, now.tolist(), strict=True) if v <= 0]
            if not gone:
                break
            held[gone] = False
            free = [j for j, v in zip(free, now.tolist(), strict=True) if v > 0]
    return x * scale


def rounded(columns: np.ndarray, x: np.ndarray, have: np.ndarray) -> list[tuple[tuple[int, ...], int]]:
    """Whole counts, none beyond what is left of a length; ``have`` is lowered."""
    out = []
    for j in np.argsort(-x, kind="stable").tolist():
        n = int(x[j] + 1e-6)
        if not n:
            break
        lengths = tuple(v for v in columns[j].tolist() if v)
        n = min(n, *(have[v] // lengths.count(v) for v in set(lengths)))
        if n > 0:
            for v in lengths:
                have[v] -= n
            out.append((lengths, int(n)))
    return out


def greedy(have: np.ndarray, size: int) -> list[tuple[tuple[int, ...], int]]:
    """Windows that the longest lengths that still fit fill exactly; ``have`` is lowered."""
    out = []
    for top in range(size - 1, 0, -1):
        while have[top]:
            left, need = size, {}
            v = top
            while left and v:
                k = min(left // v, int(have[v]))
                if k:
                    need[v] = k
                    left -= k * v
                v = min(v - 1, left)
            if left:
                break
            n = min(int(have[v]) // k for v, k in need.items())
            for v, k in need.items():
                have[v] -= n * k
            out.append((tuple(v for v, k in need.items() for _ in range(k)), n))
    return out


class Plan:
    """Where the rests of each length go, by rank."""

    def __init__(self, counts: np.ndarray, size: int = SIZE):
        self.size = size
        have = np.array(counts, np.int64)
        have[0] = 0
        lengths = np.flatnonzero(have)
        self.patterns: list[tuple[tuple[int, ...], int]] = []
        if len(lengths):
            columns = combinations(lengths, size)
            if len(columns):
                self.patterns += rounded(columns, nnls(columns, have.astype(float)), have)
            self.patterns += greedy(have, size)
        taken = np.zeros(size, np.int64)
        slots, seq = [], 0
        for lengths, n in self.patterns:
            at = 0
            for v in lengths:
                slots.append((v, int(taken[v]), seq, at))
                taken[v] += n
                at += v
            seq += n
        self.row_first = taken                        # rests from this rank on stand in the row that is cut
        by_length = np.arange(size - 1, 0, -1)
        self.row_base = np.zeros(size, np.int64)
        self.row_base[by_length] = np.concatenate([[0], np.cumsum(have[by_length] * by_length)])[:-1]
        total = int((have * np.arange(size)).sum())
        self.cut_rests = int(have.sum())
        # cuts of the row: every ``size`` ids, then powers of two
        whole, tail = divmod(total, size)
        self.whole, self.row_seq = whole, seq
        sizes = [1 << k for k in range(size.bit_length() - 1, -1, -1) if tail >> k & 1]
        self.tail = whole * size + np.concatenate([[0], np.cumsum(np.array(sizes, np.int64))]).astype(np.int64)
        self.sequences = seq + whole + len(sizes)
        slots.sort()
        s = np.array(slots, np.int64).reshape(-1, 4)
        self.slot_key, self.slot = s[:, 0] << 48 | s[:, 1], s

    def place(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sequence and offset of rests that are kept whole by a pattern."""
        at = np.searchsorted(self.slot_key, length << 48 | rank, "right") - 1
        s = self.slot[at]
        return s[:, 2] + rank - s[:, 1], s[:, 3]

    def cuts(self, length: int, rank: int) -> list[tuple[int, int, int, int]]:
        """(first id, length, sequence, offset) of the parts of a rest in the row that is cut."""
        at = int(self.row_base[length]) + (rank - int(self.row_first[length])) * length
        end, out, first = at + length, [], at
        while at < end:
            if at < self.whole * self.size:
                k = at // self.size
                low, high = k * self.size, (k + 1) * self.size
            else:
                i = int(np.searchsorted(self.tail, at, "right")) - 1
                k, low, high = self.whole + i, int(self.tail[i]), int(self.tail[i + 1])
            stop = min(high, end)
            out.append((at - first, stop - at, self.row_seq + k, at - low))
            at = stop
        return out


# ---- ids ----

class Encoder:
    """The tokenizers library behind a bounded cache of pre-tokens; ids are integers of two bytes, or four if the
    vocabulary needs them."""

    def __init__(self, path: str, pattern: str):
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.kind = np.dtype("<u2" if self.tok.get_vocab_size() <= 1 << 16 else "<u4")
        with open(path, encoding="utf-8") as f:
            self.added = [x["content"] for x in json.load(f).get("added_tokens") or []]
        line = self._whole("\n")
        self.line = line[0] if len(line) == 1 else None
        self.pieces = pretokens.Pieces(lambda texts: pretokens.cut(texts, pattern), self._learn, self.kind, CACHE)

    def _whole(self, text: str) -> np.ndarray:
        return np.array(self.tok.encode(text, add_special_tokens=False).ids, self.kind)

    def _learn(self, pieces: list[str]) -> list[np.ndarray]:
        """Ids of pre-tokens, each encoded alone: many at a time, between line ends."""
        out: list[np.ndarray | None] = [None] * len(pieces)
        plain = [i for i, p in enumerate(pieces) if self.line is not None and not p.isspace()]
        for k in range(0, len(plain), 2000):
            part = plain[k:k + 2000]
            ids = self._whole("\n".join([pieces[i] for i in part]))
            ends = np.flatnonzero(ids == self.line)
            if len(ends) == len(part) - 1:
                for i, a, b in zip(part, [0, *(ends + 1).tolist()], [*ends.tolist(), len(ids)], strict=True):
                    out[i] = ids[a:b]
        return [self._whole(p) if x is None else x for p, x in zip(pieces, out, strict=True)]

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        odd = {i for i, t in enumerate(texts) if t and any(x in t for x in self.added)}
        out = self.pieces.encode(["" if i in odd or not t else t for i, t in enumerate(texts)])
        for i in odd:
            out[i] = self._whole(texts[i])
        return out


_ENCODERS: dict = {}


def encoder(path: str, pattern: str) -> Encoder:
    if (path, pattern) not in _ENCODERS:
        _ENCODERS[path, pattern] = Encoder(path, pattern)
    return _ENCODERS[path, pattern]


ROWS = "doc_id long, h long, doc_tokens long, length int, crcs array<long>, rest_crc long, rest binary"


def _encode(path: str, pattern: str, end_id: int, size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(path, pattern)
        end = np.array([end_id], e.kind)
        names = [x.split()[0] for x in ROWS.split(", ")]
        for b in batches:
            for i in range(0, b.num_rows, 250):
                part = b.slice(i, 250)
                n, length, crcs, rest_crc, rest = [], [], [], [], []
                for ids in e.encode(part.column("text").to_pylist()):
                    ids = np.concatenate([ids, end])
                    raw = ids.astype("<u4").tobytes()
                    full = len(ids) // size
                    n.append(len(ids))
                    length.append(len(ids) - full * size)
                    crcs.append([zlib.crc32(raw[k * 4 * size:(k + 1) * 4 * size]) for k in range(full)])
                    rest_crc.append(zlib.crc32(raw[full * 4 * size:]))
                    rest.append(ids[full * size:].tobytes())
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("h"), pa.array(n, pa.int64()), pa.array(length, pa.int32()), pa.array(crcs, pa.list_(pa.int64())),
                     pa.array(rest_crc, pa.int64()), pa.array(rest, pa.binary())], names=names)
    return run


# ---- places ----

def _cut(plan: Plan, kind: np.dtype):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [x.split()[0] for x in PIECES.split(", ")]
        for b in batches:
            rows = []
            for doc_id, n, length, rank, rest in zip(*(b.column(c).to_pylist() for c in ("doc_id", "doc_tokens", "length", "rank", "rest")), strict=True):
                ids = np.frombuffer(rest, kind)
                for first, m, seq, offset in plan.cuts(length, rank):
                    rows.append((doc_id, n - length + first, m, zlib.crc32(ids[first:first + m].astype("<u4").tobytes()), n, seq, offset))
            cols = list(zip(*rows, strict=True)) or [()] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=names)
    return run


def _kept(plan: Plan):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [x.split()[0] for x in PIECES.split(", ")]
        for b in batches:
            length, rank, n = (b.column(c).to_numpy().astype(np.int64) for c in ("length", "rank", "doc_tokens"))
            seq, offset = plan.place(length, rank) if b.num_rows else (length, length)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(n - length), pa.array(length), b.column("rest_crc"), pa.array(n), pa.array(seq), pa.array(offset)],
                                             names=names)
    return run


def pack(docs: DataFrame, tokenizer: str, pattern: str, end_id: int, size: int = SIZE) -> DataFrame:
    """One row per piece of a document: doc_id, start, length, ids_crc32, doc_tokens, sequence_id and offset.
    ``pattern`` cuts texts into the tokenizer's own pre-tokens."""
    spark = docs.sparkSession
    common.workers(spark)
    d = docs.select("doc_id", "text", common.text_hash().alias("h"))
    rows = common.table(d.mapInArrow(_encode(tokenizer, pattern, end_id, size), ROWS).withColumn("row", F.monotonically_increasing_id()), "pack-rows")
    chunks = max(16, rows.count() // CHUNK_ROWS)
    slim = rows.select("row", "doc_id", "h", "doc_tokens", "length", "crcs", "rest_crc", F.size("crcs").cast("long").alias("full"),
                       F.pmod(F.xxhash64("doc_id", "h", "row"), F.lit(chunks)).alias("chunk"))
    before = Window.partitionBy("length").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)     # one row per chunk
    groups = common.table(slim.groupBy("length", "chunk").agg(F.count("*").alias("n"), F.sum("full").alias("f"))
                          .withColumn("rank0", F.coalesce(F.sum("n").over(before), F.lit(0)))
                          .withColumn("full0", F.coalesce(F.sum("f").over(before), F.lit(0))), "pack-groups")
    counts, fulls = np.zeros(size, np.int64), np.zeros(size, np.int64)
    for r in groups.groupBy("length").agg(F.sum("n").alias("n"), F.sum("f").alias("f")).collect():         # at most ``size`` rows
        counts[r["length"]], fulls[r["length"]] = r["n"], r["f"]
    plan = Plan(counts, size)
    inside = Window.partitionBy("length", "chunk").orderBy(F.col("doc_id").asc_nulls_first(), "h", "row")
    ranked = (slim.withColumn("rn", F.row_number().over(inside).cast("long"))
              .withColumn("fn", F.coalesce(F.sum("full").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
              .join(groups.select("length", "chunk", "rank0", "full0"), ["length", "chunk"])
              .select("row", "doc_id", "doc_tokens", "length", "crcs", "rest_crc", (F.col("rank0") + F.col("rn") - 1).alias("rank"), (F.col("full0") + F.col("fn")).alias("full_at")))
    ranked = common.table(ranked, "pack-ranks")

    listed = lambda a: F.element_at(F.array(*[F.lit(int(v)) for v in a]).cast("array<bigint>"), F.col("length") + 1)
    base = plan.sequences + np.concatenate([[0], np.cumsum(fulls)])[:-1]
    full = ranked.filter(F.size("crcs") > 0).select("doc_id", "doc_tokens", F.posexplode("crcs").alias("i", "ids_crc32"), (listed(base) + F.col("full_at")).alias("seq"))
    full = full.select("doc_id", (F.col("i").cast("long") * size).alias("start"), F.lit(size).cast("long").alias("length"), "ids_crc32", "doc_tokens",
                       (F.col("seq") + F.col("i")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    is_kept = F.col("rank") < listed(plan.row_first)
    slots = ["doc_id", "doc_tokens", "length", "rank", "rest_crc"]
    kept = ranked.filter((F.col("length") > 0) & is_kept).select(*slots).mapInArrow(_kept(plan), PIECES)
    cut = ranked.filter((F.col("length") > 0) & ~is_kept).select("row", "doc_id", "doc_tokens", "length", "rank")
    cut = F.broadcast(cut) if plan.cut_rests <= FEW else cut
    cut = rows.select("row", "rest").join(cut, "row").mapInArrow(_cut(plan, _kind(tokenizer, pattern)), PIECES)
    return full.unionByName(kept).unionByName(cut)


def _kind(tokenizer: str, pattern: str) -> np.dtype:
    return encoder(tokenizer, pattern).kind
