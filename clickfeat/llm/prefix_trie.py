"""Trie of conversation prefixes by range minima over sorted LCPs.

A conversation is a sequence of turns; a turn is known by the first 16 bytes of the SHA-256 of its role and
text, so a conversation is a key of 16 bytes a turn.  Among the different keys in byte order, the
conversations with a given prefix stand side by side: a trie node of depth d is an interval in
which every two neighbours have d turns in common at least.

The sorted keys are cut into blocks of bounded size.  In a block, neighbours' common lengths (LCPs) go into
a sparse table of range minima, and every candidate prefix (a key and a depth beyond the LCP with the key before)
searches by halving, independently of all others, how far to the left and to the right the minimum
stays at its depth or more.  That is its member interval.  Members, childless nodes, children and saved bytes of
the subtree are sums over an interval, taken from running sums over the block.

An interval that reaches over a block's border is a part; parts of one prefix are added up by their
prefix's key.  There are at most two a depth and block, however many conversations share a prefix.
A part needs of other blocks only the neighbouring keys.

Equal conversations are folded before the trie: their ids are sorted by range over all tasks, each task
joins up to CHUNK of them to one string, and the digest of all is taken over these strings in order.  So a
conversation that most rows repeat is neither sorted nor joined in one task.

Defined cases: turns are ordered by turn (null first), equal turns by their digest; null role or text counts as
empty; rows without a conv_id are one conversation, which is not rebuilt, is no smallest member beside others
and is listed first, as an empty string; an empty table gives no rows; other columns are not read.  One
conversation's turns are held by one task, some 60 bytes each.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from clickfeat.llm import common

TURN = 16
CHUNK = 4096
#: Bytes of keys in a block, on average.
BLOCK_BYTES = 8 << 20
MOST_BLOCKS = 10_000

NODES = ("path binary, parent binary, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, "
         "saved_tokens long, ends string, part boolean, parent_part boolean")
NAMES = [x.split()[0] for x in NODES.split(", ")]


def conversations(turns: DataFrame) -> DataFrame:
    """family (conv_id - conv_id % 5), conv_id, turns (array of struct d: digest, b: bytes of the text) in order."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    digest = F.substring(F.unhex(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256)), 1, TURN)
    t = turns.select("conv_id", F.col("turn").isNotNull().alias("has"), "turn", digest.alias("d"), F.octet_length(text).alias("b"))
    t = t.withColumn("family", F.col("conv_id") - F.col("conv_id") % 5).repartition("family")       # of which ``rebuilt`` makes use
    listed = F.array_sort(F.collect_list(F.struct("has", "turn", "d", "b")))
    return t.groupBy("family", "conv_id").agg(F.transform(listed, lambda x: F.struct(x["d"].alias("d"), x["b"].alias("b"))).alias("turns"))


def rebuilt(convs: DataFrame, head: Column) -> DataFrame:
    """Every conversation with its first ``head`` (at most 8) turns replaced by those of the conversation conv_id - conv_id % 5."""
    first = F.slice("turns", F.lit(1), F.lit(8))
    base = F.max(F.when(F.col("conv_id") == F.col("family"), first)).over(Window.partitionBy("family"))
    c = convs.withColumn("h", F.when(F.col("conv_id").isNull(), 0).otherwise(head).cast("int")).withColumn("base", F.coalesce(base, F.slice("turns", F.lit(1), F.lit(0))))
    return c.select("conv_id", F.concat(F.slice("base", F.lit(1), F.col("h")), F.slice("turns", F.col("h") + 1, F.size("turns"))).alias("turns"))


# ---- equal conversations ----

def _decimals(ids: list[int | None]) -> str:
    return ",".join("" if i is None else str(i) for i in ids)


def _fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (key, conv_id) to chunks of at most CHUNK members."""
    key, held, sizes = None, [], None

    def chunk():
        known = [i for i in held if i is not None]
        return (key, sizes, known[0] if known else None, held[0] is not None, held[0], len(held), _decimals(held))

    def batch(rows):
        cols = list(zip(*rows, strict=True)) or [()] * 7
        kinds = [pa.binary(), pa.list_(pa.int32()), pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=["key", "sizes", "least", "has", "first", "n", "members"])

    for b in batches:
        out = []
        for k, i, s in zip(b.column("key").to_pylist(), b.column("conv_id").to_pylist(), b.column("sizes"), strict=True):
            if held and (k != key or len(held) >= CHUNK):
                out.append(chunk())
                held = []
            if not held:
                key, sizes = k, s.as_py()
            held.append(i)
        yield batch(out)
    if held:
        yield batch([chunk()])


def _unique(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted chunks to one row a key."""
    from pyspark import TaskContext

    block = TaskContext.get().partitionId()
    now, digest = None, None

    def batch(rows):
        cols = list(zip(*rows, strict=True)) or [()] * 6
        kinds = [pa.int32(), pa.binary(), pa.list_(pa.int32()), pa.int64(), pa.int64(), pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=["block", "key", "sizes", "least", "n", "ends"])

    for b in batches:
        out = []
        for k, s, least, n, members in zip(*(b.column(c).to_pylist() for c in ("key", "sizes", "least", "n", "members")), strict=True):
            if now and now[1] == k:
                now[3] = least if now[3] is None else now[3]
                now[4] += n
                digest.update(b"," + members.encode())
                continue
            if now:
                out.append((*now, digest.hexdigest()))
            now, digest = [block, k, s, least, n], hashlib.sha256(members.encode())
        yield batch(out)
    if now:
        yield batch([(*now, digest.hexdigest())])


# ---- a block of the trie ----

EMPTY = hashlib.sha256(b"").hexdigest()
NONE = np.iinfo(np.int64).max


def shared(a: bytes, b: bytes) -> int:
    """Turns that two keys have in common at their start."""
    n = min(len(a), len(b))
    x = np.frombuffer(a[:n], np.uint8) != np.frombuffer(b[:n], np.uint8)
    return (int(x.argmax()) if x.any() else n) // TURN


class RangeMinima:
    """Sparse table of the minima of all ranges whose length is a power of two."""

    def __init__(self, x: np.ndarray):
        self.table = [x]
        step = 1
        while 2 * step <= len(x):
            t = self.table[-1]
            self.table.append(np.minimum(t[:-step], t[step:]))
            step *= 2

    def right(self, at: np.ndarray, depth: np.ndarray) -> np.ndarray:
        """The last place to the right of ``at`` up to which all values behind ``at`` are at least ``depth``."""
        n, pos = len(self.table[0]), at.copy()
        for k in range(len(self.table) - 1, -1, -1):
            t = self.table[k]
            fits = pos + (1 << k) < n
            ok = fits & (t[np.where(fits, pos + 1, 0)] >= depth)
            pos[ok] += 1 << k
        return pos

    def left(self, at: np.ndarray, depth: np.ndarray) -> np.ndarray:
        """The first place from which all values up to and with ``at`` are at least ``depth``; ``x[0]`` is not looked at."""
        pos = at.copy()
        for k in range(len(self.table) - 1, -1, -1):
            t = self.table[k]
            fits = pos - (1 << k) >= 0
            ok = fits & (t[np.where(fits, pos - (1 << k) + 1, 0)] >= depth)
            pos[ok] -= 1 << k
        return pos

    def over(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The least of the values from a to b, both included."""
        out = np.empty(len(a), self.table[0].dtype)
        level = np.frexp(b - a + 1)[1] - 1
        for k in np.unique(level).tolist():
            at, t = np.flatnonzero(level == k), self.table[k]
            out[at] = np.minimum(t[a[at]], t[b[at] - (1 << k) + 1])
        return out


def block_nodes(keys: list[bytes], sizes: list[list[int]], least: list[int | None], count: list[int], ends: list[str], before: int, after: int, longer: bool) -> list[tuple]:
    """Nodes (and parts of nodes) of one block of sorted keys.  ``before``: turns in common with the key in front of the
    block (-1: there is none), ``after``: with the key behind it, ``longer``: that key begins with the block's last one."""
    m = len(keys)
    size = np.array([len(k) // TURN for k in keys])
    lcp = np.array([before, *(shared(a, b) for a, b in zip(keys, keys[1:], strict=False))])
    n = np.array(count, np.int64)
    low = np.array([NONE if x is None else x for x in least], np.int64)
    width = np.array([sum(s) for s in sizes], np.int64)
    sums = [np.concatenate([[0], np.cumsum(s, dtype=np.int64)]) for s in sizes]          # bytes of the first d turns

    known = np.maximum(lcp, 0)                        # turns already met in the key in front
    upto = np.array([int(sums[i][known[i]]) for i in range(m)], np.int64)
    leaf = np.append(lcp[1:] < size[:-1], not longer)
    running = lambda x: np.concatenate([[0], np.cumsum(x)])
    members, leaves = running(n), running(leaf.astype(np.int64))
    all_bytes, new_bytes = running(n * width), running(width - upto)

    # candidates: what begins at a key, and at the block's first key also what began before
    new_from = lcp + 1
    new_from[0] = 0
    row = np.repeat(np.arange(m), size - new_from + 1)
    depth = np.concatenate([np.arange(a, b + 1) for a, b in zip(new_from.tolist(), size.tolist(), strict=True)]) if m else row
    table = RangeMinima(lcp)
    first = table.left(row, np.maximum(depth, 0))
    last = table.right(row, depth)
    first[depth == 0], last[depth == 0] = 0, m - 1
    smallest = RangeMinima(low).over(first, last)

    begun = (first == 0) & (depth <= before)          # begins in an earlier block
    open_ = (last == m - 1) & (depth <= after)        # goes on in a later one
    above = np.array([int(sums[i][d - 1]) if d else 0 for i, d in zip(row.tolist(), depth.tolist(), strict=True)], np.int64)
    total = members[last + 1] - members[first]
    every = new_bytes[last + 1] - new_bytes[np.where(begun, first, first + 1)] + np.where(begun, 0, width[first] - above)
    saved = all_bytes[last + 1] - all_bytes[first] - total * above - every
    # a child is counted where it begins: at the first key if that goes on, and at keys whose LCP is the depth
    starts = np.where(begun & (lcp[first] > depth), 0, (size[first] > depth).astype(np.int64))
    order = np.lexsort((np.arange(m), lcp))
    ranked = lcp[order] * np.int64(m) + order
    inside = np.searchsorted(ranked, depth * np.int64(m) + last, "right") - np.searchsorted(ranked, depth * np.int64(m) + first, "right")
    children = starts + inside
    part = begun | open_

    # parents by their first key in this block and their depth
    up = np.maximum(depth - 1, 0)
    up_first = np.where(depth > 1, table.left(row, up), 0)
    place = {(a, d): k for k, (a, d) in enumerate(zip(first.tolist(), depth.tolist(), strict=True))}
    out = []
    for k, (i, d, u, f) in enumerate(zip(row.tolist(), depth.tolist(), up.tolist(), up_first.tolist(), strict=True)):
        own = place[f, u] if d else None
        path = keys[i][:d * TURN]
        joined = own is not None and bool(part[own])
        low_up = None if own is None or joined or smallest[own] == NONE else int(smallest[own])
        out.append((hashlib.sha256(path).digest() if part[k] else None, hashlib.sha256(path[:-TURN]).digest() if joined else None,
                    None if smallest[k] == NONE else int(smallest[k]), d, low_up, int(total[k]), int(children[k]),
                    int(leaves[last[k] + 1] - leaves[first[k]]), int(saved[k]), ends[i] if size[i] == d else EMPTY,
                    bool(part[k]), joined))
    return out


def _trie(borders: dict[int, tuple[int, int, bool]]):
    def nodes(rows: list[tuple]) -> pa.RecordBatch:
        cols = list(zip(*rows, strict=True)) or [()] * len(NAMES)
        kinds = [pa.binary(), pa.binary(), *[pa.int64()] * 7, pa.string(), pa.bool_(), pa.bool_()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=NAMES)

    def done(block, held):
        rows = block_nodes(*(list(x) for x in zip(*held, strict=True)), *borders[block])
        for i in range(0, len(rows), 20_000):
            yield nodes(rows[i:i + 20_000])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held = None, []
        for b in batches:
            for block, *row in zip(*(b.column(c).to_pylist() for c in ("block", "key", "sizes", "least", "n", "ends")), strict=True):
                if block != at:
                    if held:
                        yield from done(at, held)
                    at, held = block, []
                held.append(tuple(row))
        if held:
            yield from done(at, held)
    return run


def _borders(uniques: DataFrame) -> dict[int, tuple[int, int, bool]]:
    """Per block (at most MOST_BLOCKS) what its first and last key share with their neighbours: three numbers each."""
    names = "block int, before int, after int, longer boolean"

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [(k, -1 if p is None else shared(p, a), -1 if q is None else shared(z, q), q is not None and q.startswith(z))
                    for k, a, z, p, q in zip(*(b.column(c).to_pylist() for c in ("block", "a", "z", "p", "q")), strict=True)]
            cols = list(zip(*rows, strict=True)) or [()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int32(), pa.int32(), pa.int32(), pa.bool_()), strict=True)],
                                             names=["block", "before", "after", "longer"])

    inorder = Window.orderBy("block")                 # one row per block
    ends = uniques.groupBy("block").agg(F.min("key").alias("a"), F.max("key").alias("z"))
    ends = ends.select("block", "a", "z", F.lag("z").over(inorder).alias("p"), F.lead("a").over(inorder).alias("q"))
    return {r["block"]: (r["before"], r["after"], r["longer"]) for r in ends.mapInArrow(compare, names).collect()}


def trie(convs: DataFrame) -> DataFrame:
    """Nodes of the prefix trie of ``convs`` (conv_id, turns: array of struct d, b): conv_id, depth, parent_conv_id, n_convs,
    n_children, n_leaves, saved_tokens, ends_sha256."""
    spark = convs.sparkSession
    common.workers(spark)
    key = F.unhex(F.array_join(F.transform("turns", lambda x: F.hex(x["d"])), ""))
    c = common.table(convs.select("conv_id", key.alias("key"), F.transform("turns", lambda x: x["b"]).alias("sizes")), "trie-keys")
    size = c.agg(F.coalesce(F.sum(F.octet_length("key") + 64), F.lit(0)).alias("s")).first()["s"]
    blocks = max(common.partitions(spark) if size > BLOCK_BYTES else 1, min(MOST_BLOCKS, size // BLOCK_BYTES + 1))
    many = max(blocks, common.partitions(spark))
    chunks = (c.repartitionByRange(many, "key", F.col("conv_id").asc_nulls_first()).sortWithinPartitions("key", F.col("conv_id").asc_nulls_first())
              .mapInArrow(_fold, "key binary, sizes array<int>, least long, has boolean, first long, n long, members string"))
    chunks = common.table(chunks, "trie-chunks")
    uniques = (chunks.repartitionByRange(blocks, "key").sortWithinPartitions("key", "has", "first")
               .mapInArrow(_unique, "block int, key binary, sizes array<int>, least long, n long, ends string"))
    uniques = common.table(uniques, "trie-uniques")
    nodes = (uniques.repartition(blocks, "block").sortWithinPartitions("block", "key").mapInArrow(_trie(_borders(uniques)), NODES))
    nodes = common.table(nodes, "trie-nodes")

    none = F.lit(EMPTY)
    joined = (nodes.filter("part").groupBy("path").agg(
        F.min("conv_id").alias("conv_id"), F.max("depth").alias("depth"), F.min("parent_conv_id").alias("parent_conv_id"), F.max("parent").alias("parent"),
        F.sum("n_convs").alias("n_convs"), F.sum("n_children").alias("n_children"), F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens"),
        F.coalesce(F.max(F.when(F.col("ends") != none, F.col("ends"))), none).alias("ends")))
    joined = common.table(joined, "trie-joined")
    cols = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends"]
    every = nodes.filter("not part").select(*cols, "parent").unionByName(joined.select(*cols, "parent"))
    # parents that were put together from parts: their children are spread, as such a node may have most of them
    up = joined.select(F.col("path").alias("parent"), F.col("conv_id").alias("up"), F.col("n_children").alias("n"))
    far = common.lookup(every.filter("parent is not null"), up, ["parent"], F.struct("conv_id", "depth")).withColumn("parent_conv_id", F.col("up"))
    out = every.filter("parent is null").select(*cols).unionByName(far.select(*cols))
    return out.withColumnRenamed("ends", "ends_sha256")


def rebuilt_trie(turns: DataFrame) -> DataFrame:
    """The trie of conversations whose first crc32(conv_id) % 9 turns come from conversation conv_id - conv_id % 5."""
    head = F.crc32(F.col("conv_id").cast("string")) % 9
    return trie(rebuilt(conversations(turns), head))
