"""Document fingerprints by winnowing.

Every run of ``k`` code points gets a rolling hash (doubled: a run of 2n characters from two
runs of n).  Of every window of ``w`` consecutive hashes the smallest is chosen, of equal ones
the rightmost; the chosen hashes with their positions are the fingerprint.  So any passage of
``w + k - 1`` code points that two texts share gives both a common hash, at known positions, and
nothing shorter than ``k`` is ever matched.  A text with fewer than ``w`` hashes is one window, one
shorter than ``k`` is one run.

The likeness of two fingerprints is the Jaccard index of their hash sets (1 for two empty ones).

Defined cases: null text counts as empty, with an empty fingerprint; an empty table gives no
rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickfeat.llm import common

K = 16
W = 32
#: Documents of a range of doc_ids, and the most ranges (then ranges grow with the input).
RANGE_ROWS = 1000
MOST_RANGES = 10_000
#: Positions of a long text that are hashed at once.
CHUNK = 1 << 18
#: Low bits of a winnowing key that hold the position, so that the rightmost of equal hashes is the smallest key.
PLACE = 20

_BASE = 0x9E3779B97F4A7C15


def points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")


def _hashes(c: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all runs of k code points, 44 bits each."""
    have: list[tuple[int, np.ndarray]] = [(1, (c.astype(np.uint64) + np.uint64(1)) * np.uint64(_BASE))]
    while 2 * have[-1][0] <= k:
        n, h = have[-1]
        have.append((2 * n, h[:-n] * np.uint64(pow(_BASE, n, 1 << 64)) + h[n:]))
    size, out = 0, None
    for n, h in reversed(have):                        # k as a sum of powers of two
        if size + n <= k:
            if out is None:
                out = h
            else:
                m = len(out) - n
                out = out[:m] * np.uint64(pow(_BASE, n, 1 << 64)) + h[size:size + m]
            size += n
    out = out ^ (out >> np.uint64(31))
    out = out * np.uint64(0xBF58476D1CE4E5B9)
    return (out ^ (out >> np.uint64(29))) >> np.uint64(PLACE)


def _windows(keys: np.ndarray, w: int) -> np.ndarray:
    """Smallest key of every window."""
    n = 1
    while 2 * n <= w:
        keys = np.minimum(keys[:-n], keys[n:])
        n *= 2
    return np.minimum(keys[:len(keys) - (w - n)], keys[w - n:]) if w > n else keys


def winnow(text: str | None, k: int = K, w: int = W) -> tuple[np.ndarray, np.ndarray]:
    """(positions, hashes) that the windows choose, in order of position."""
    c = points(text or "")
    if not len(c):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    k = min(k, len(c))
    n = len(c) - k + 1                                 # hashes
    w = min(w, n)
    step = max(CHUNK, w)
    pos, val = [], []
    for a in range(0, n - w + 1, step):                # windows a .. a + step - 1
        last = min(n, a + step + w - 1)
        h = _hashes(c[a:last + k - 1], k)
        place = np.arange(len(h), dtype=np.uint64)
        keys = (h << np.uint64(PLACE)) | (np.uint64((1 << PLACE) - 1) - place)
        best = _windows(keys, w)
        best = best[np.concatenate([[True], best[1:] != best[:-1]])]       # neighbours mostly choose the same
        at = (np.uint64((1 << PLACE) - 1) - (best & np.uint64((1 << PLACE) - 1))).astype(np.int64) + a
        pos.append(at)
        val.append(best >> np.uint64(PLACE))
    p, first = np.unique(np.concatenate(pos), return_index=True)
    return p, np.concatenate(val)[first]


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard index of two sorted sets of hashes."""
    if not len(a) and not len(b):
        return 1.0
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both)


def digest(found: tuple[np.ndarray, np.ndarray]) -> str:
    """The fingerprint as one string: a digest of the chosen positions and hashes."""
    return hashlib.sha256(found[0].astype("<i8").tobytes() + found[1].astype("<u8").tobytes()).hexdigest()[:32]


def _rows(k: int, w: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = [winnow(t, k, w) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array([x[0] for x in got], pa.list_(pa.int64())),
                 pa.array([x[1].astype(np.int64) for x in got], pa.list_(pa.int64()))], names=["doc_id", "positions", "hashes"])
    return run


def fingerprints(docs: DataFrame, k: int = K, w: int = W) -> DataFrame:
    """One row per document: doc_id, positions array<long>, hashes array<long>."""
    common.workers(docs.sparkSession)
    return docs.select("doc_id", "text").mapInArrow(_rows(k, w), "doc_id long, positions array<long>, hashes array<long>")


# ---- each document beside the next one ----

def in_order(docs: DataFrame, range_rows: int = RANGE_ROWS) -> DataFrame:
    """The documents dealt into ranges of descending doc_id (null last, equal ones by their text's hash),
    sorted, each range with a copy of the row that follows it (``lone``): columns place, lone, doc_id, text.

    The bounds are doc_ids from a pass over that column; a range's first row is found by
    aggregation.  Both lists have one row per range, and there are at most MOST_RANGES."""
    order = [F.col("doc_id").desc_nulls_last(), F.col("h").desc()]
    d = docs.select("doc_id", "text", common.text_hash().alias("h"))
    rows = docs.count()
    many = max(1, min(rows // range_rows + 1, MOST_RANGES))
    found = docs.approxQuantile("doc_id", [i / many for i in range(1, many)], 0.2 / many) if many > 1 else []
    cuts = sorted({int(x) for x in found}, reverse=True)
    # the place of a doc_id is the number of cuts above it, counted in steps of 100; a null one goes to the last range
    above = lambda a: F.size(F.filter(a, lambda c: c > F.col("doc_id")))
    listed = lambda x: F.array(*[F.lit(c).cast("long") for c in x]).cast("array<bigint>")
    d = d.withColumn("step", above(listed(cuts[99::100])) * 100)
    place = F.col("step") + above(F.slice(listed(cuts), F.col("step") + 1, F.lit(100)))
    d = d.withColumn("place", F.when(F.col("doc_id").isNull(), F.lit(len(cuts))).otherwise(place).cast("int"))
    first = F.struct(F.col("doc_id").isNotNull().alias("known"), "doc_id", "h")
    heads = [r.asDict(True) for r in d.groupBy("place").agg(F.max(first).alias("first")).select("place", "first.doc_id", "first.h").orderBy("place").collect()]
    spark = docs.sparkSession
    if not heads:
        return d.select("place", F.lit(False).alias("lone"), "doc_id", "text", "h")
    before = [heads[(i - 1) % len(heads)]["place"] for i in range(len(heads))]
    copies = spark.createDataFrame([(x["doc_id"], x["h"], b) for x, b in zip(heads, before, strict=True)], "id long, g long, goes int")
    lone = d.join(F.broadcast(copies), F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("h") == F.col("g")))
    lone = lone.dropDuplicates(["goes"]).select(F.col("goes").alias("place"), F.lit(True).alias("lone"), "doc_id", "text", "h")
    both = d.select("place", F.lit(False).alias("lone"), "doc_id", "text", "h").unionByName(lone)
    n = max(common.partitions(spark), len(heads))
    return both.repartition(n, "place").sortWithinPartitions("place", "lone", *order)


def edited(text: str, following: str) -> str:
    """The last half of the code points replaced by as many first ones (or all) of the next document."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


OUT = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, "
       "near_next double, n_hashes long")


def _pairs(k: int, w: int):
    def prepared(text: str):
        found = winnow(text, k, w)
        return text, found, np.unique(found[1])

    def row(doc_id, own, following):
        text, found, values = own
        new = edited(text, following[0])
        other = winnow(new, k, w)
        return (doc_id, len(text), hashlib.sha256(new.encode()).hexdigest(), digest(found), digest(other),
                likeness(values, np.unique(other[1])), likeness(values, following[2]), len(found[0]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, out = None, []                           # the row that waits for the next one

        def flush():
            cols = list(zip(*out, strict=True))
            names = [x.split()[0] for x in OUT.split(", ")]
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], names=names)

        for b in batches:
            for place, lone, doc_id, text in zip(*(b.column(c).to_pylist() for c in ("place", "lone", "doc_id", "text")), strict=True):
                own = prepared(text or "")
                if held and held[0] == place:
                    out.append(row(held[1], held[2], own))
                held = None if lone else (place, doc_id, own)
            if len(out) > 500:
                yield flush()
                out = []
        if out:
            yield flush()

    return run


def compare_with_next(docs: DataFrame, k: int = K, w: int = W) -> DataFrame:
    """One row per document with the fingerprints of its text and its edited text, and their likeness."""
    common.workers(docs.sparkSession)
    return in_order(docs).select("place", "lone", "doc_id", "text").mapInArrow(_pairs(k, w), OUT)
