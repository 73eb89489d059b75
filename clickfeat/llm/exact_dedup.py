"""Exact deduplication by an extendible-hash index on shared files.

Texts are equal when they are identical after deleting ASCII white space.  A pass over
the documents writes one light row per document (64-bit key, sizes, digest).  From the
key's histogram the driver builds the directory: starting with one bucket, a bucket
beyond ``capacity`` bytes splits on its next key bit, and the directory doubles when the
bucket already uses all its bits.  A second pass sends every text once per map task (copies
met by the task are folded first) to its bucket; the owner task of the bucket reads its rows
in key order, keeps one chain of different texts per key, compares bytes along the chain and
writes the bucket's entries to shared files.  Documents then look up their chain entry.

Defined cases: null text counts as empty; of rows with the same length the smallest doc_id
stays, a null doc_id last; of fully repeated rows one stays; an empty table gives no rows;
other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from clickfeat.llm import common

#: The white space that does not count: \x20 and \x09-\x0D.
SPACE = b" \t\n\x0b\x0c\r"
#: Bytes of different texts in a bucket before it splits.
CAPACITY = 32 << 20
#: The directory has at most 2**MAX_DEPTH slots (a fixed bound; fuller buckets then stay as they are, and are streamed).
MAX_DEPTH = 16
#: Bytes of different texts that a map task holds while it folds copies.
FOLD_BYTES = 32 << 20

LIGHT = "doc_id long, n_chars long, key long, text_sha256 string, n_bytes long"
FOLDED = "bucket int, key long, text binary, n_chars long, doc_id long, n long"
ENTRY = "bucket int, key long, chain int, text_sha256 string, keep_chars long, keep_id long, n long, text binary"


def normalise(text: str | None) -> bytes:
    return (text or "").encode().translate(None, SPACE)


def key_of(norm: bytes) -> int:
    h = xxhash.xxh64_intdigest(norm)
    return h - (1 << 64) if h >> 63 else h


def _light(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        texts = b.column("text").to_pylist()
        norms = [normalise(t) for t in texts]
        yield pa.RecordBatch.from_arrays(
            [b.column("doc_id"), pa.array([len(t or "") for t in texts], pa.int64()),
             pa.array([key_of(x) for x in norms], pa.int64()),
             pa.array([hashlib.sha256(x).hexdigest() for x in norms], pa.string()),
             pa.array([len(x) for x in norms], pa.int64())],
            names=["doc_id", "n_chars", "key", "text_sha256", "n_bytes"])


def build_directory(weights: np.ndarray, capacity: int) -> tuple[np.ndarray, list[int]]:
    """Directory (slot -> bucket) and the buckets' local depths, from the bytes per key prefix
    (``len(weights)`` is a power of two)."""
    most = int(len(weights)).bit_length() - 1
    total = np.concatenate([[0], np.cumsum(weights)])
    depth, slots, buckets = 0, [0], [(0, 0)]           # a bucket: (prefix, local depth)

    def load(prefix: int, local: int) -> int:
        return int(total[(prefix + 1) << (most - local)] - total[prefix << (most - local)])

    todo = [0]
    while todo:
        b = todo.pop()
        prefix, local = buckets[b]
        if local == most or load(prefix, local) <= capacity:
            continue
        if local == depth:                             # all bits in use: double the directory
            slots, depth = [s for s in slots for _ in (0, 1)], depth + 1
        new = len(buckets)
        buckets[b] = (2 * prefix, local + 1)
        buckets.append((2 * prefix + 1, local + 1))
        first = (2 * prefix + 1) << (depth - local - 1)
        for s in range(first, first + (1 << (depth - local - 1))):
            slots[s] = new
        todo += [b, new]
    return np.array(slots, np.int32), [x[1] for x in buckets]


def _fold(slots: np.ndarray):
    """Map side: one row per different text that the task meets."""
    shift = 65 - len(slots).bit_length()

    def rows(held: dict) -> pa.RecordBatch:
        keys = [key_of(x) for x in held]
        place = [int(slots[(k % (1 << 64)) >> shift]) if shift < 64 else 0 for k in keys]
        v = list(held.values())
        return pa.RecordBatch.from_arrays(
            [pa.array(place, pa.int32()), pa.array(keys, pa.int64()), pa.array(list(held), pa.binary()),
             pa.array([x[0] for x in v], pa.int64()), pa.array([x[1] for x in v], pa.int64()),
             pa.array([x[2] for x in v], pa.int64())],
            names=["bucket", "key", "text", "n_chars", "doc_id", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bytes, list] = {}
        size = 0
        for b in batches:
            for i, t in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist(), strict=True):
                x = normalise(t)
                if (was := held.get(x)) is None:
                    held[x] = [len(t or ""), i, 1]
                    size += len(x) + 100
                else:
                    was[:] = [*better(was, (len(t or ""), i)), was[2] + 1]
            if size > FOLD_BYTES:
                yield rows(held)
                held, size = {}, 0
        if held:
            yield rows(held)

    return run


def better(a, b) -> tuple:
    """Of two (n_chars, doc_id) the one that stays."""
    return min(((-x[0], x[1] is None, x[1] or 0), x[0], x[1]) for x in (a, b))[1:]


def _own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Owner: rows come ordered by bucket and key; a chain holds the different texts of a key."""
    at, chain, out, size = None, [], [], 0

    def flush() -> pa.RecordBatch:
        cols = list(zip(*out, strict=True))
        kinds = [pa.int32(), pa.int64(), pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
        names = [x.split()[0] for x in ENTRY.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=names)

    def close() -> int:
        for no, (text, best, n) in enumerate(chain):
            out.append((*at, no, hashlib.sha256(text).hexdigest(), best[0], best[1], n, text))
        return sum(len(x[0]) for x in chain)

    for b in batches:
        for bucket, key, text, n_chars, doc_id, n in zip(*(b.column(c).to_pylist() for c in ("bucket", "key", "text", "n_chars", "doc_id", "n")), strict=True):
            if (bucket, key) != at:
                size += close()
                at, chain = (bucket, key), []
                if size > 4 << 20 or len(out) >= 5000:
                    yield flush()
                    out, size = [], 0
            for entry in chain:
                if entry[0] == text:                   # the bytes decide, not the hash
                    entry[1], entry[2] = better(entry[1], (n_chars, doc_id)), entry[2] + n
                    break
            else:
                chain.append([text, (n_chars, doc_id), n])
    close()
    if out:
        yield flush()


def build_index(docs: DataFrame, capacity: int = CAPACITY, max_depth: int = MAX_DEPTH) -> tuple[DataFrame, DataFrame]:
    """(light rows, index entries), both tables below ``spark.checkpoint.dir``."""
    spark = docs.sparkSession
    common.workers(spark)
    own = docs.select("doc_id", "text")
    light = common.table(own.mapInArrow(_light, LIGHT), "dedup-light")
    prefix = F.shiftrightunsigned("key", 64 - max_depth)
    load = (light.groupBy("key", "text_sha256").agg(F.max("n_bytes").alias("n_bytes"))
            .groupBy(prefix.alias("prefix")).agg(F.sum("n_bytes").alias("load")))
    weights = np.zeros(1 << max_depth, np.int64)
    for r in load.collect():                           # 2**max_depth rows at most
        weights[r["prefix"]] = r["load"]
    slots, depths = build_directory(weights, capacity)
    parts = max(common.partitions(spark), min(len(depths), 1 << 14))
    folded = own.mapInArrow(_fold(slots), FOLDED)
    entries = folded.repartition(parts, "bucket").sortWithinPartitions("bucket", "key").mapInArrow(_own, ENTRY)
    return light, common.table(entries, "dedup-index")


def exact_groups(docs: DataFrame, capacity: int = CAPACITY, max_depth: int = MAX_DEPTH) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256, n_chars."""
    light, index = build_index(docs, capacity, max_depth)
    groups = index.select("key", "text_sha256", "keep_chars", "keep_id", "n")
    j = common.lookup(light, groups, ["key", "text_sha256"], F.struct("doc_id", "n_chars"))
    same = F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("n_chars") == F.col("keep_chars"))
    twin = F.row_number().over(Window.partitionBy("doc_id", "key", "n_chars", "text_sha256").orderBy(F.lit(1)))
    j = j.withColumn("kept", same & (twin == 1))
    return j.select("doc_id", "keep_id", F.col("n").alias("group_size"), "kept", "text_sha256", "n_chars")


def keep_one(docs: DataFrame) -> DataFrame:
    """The documents that stay, with all their columns."""
    got = exact_groups(docs).filter("kept")
    text = F.coalesce(F.col("row.text"), F.lit(""))
    d = common.whole_rows(docs).select("row", F.col("row.doc_id").alias("id"), F.length(text).alias("n"), common.text_hash(F.col("row.text")).alias("h"),
                                       F.sha2(F.regexp_replace(text, r"[\x20\x09-\x0D]+", ""), 256).alias("sha"))
    k = got.select(F.col("doc_id").alias("to_id"), F.col("text_sha256").alias("to_sha"), F.col("n_chars").alias("to_n"))
    j = d.join(k, F.col("id").eqNullSafe(F.col("to_id")) & (F.col("sha") == F.col("to_sha")) & (F.col("n") == F.col("to_n")))
    one = Window.partitionBy("id", "sha", "n").orderBy("h")
    return j.withColumn("place", F.row_number().over(one)).filter("place = 1").select("row.*")
