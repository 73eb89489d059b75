"""SimHash near-duplicates by a forest of vantage-point trees.

A fingerprint bit is set if it is set in over half of the shingles' XXH64 hashes.  Two
fingerprints link at ``max_bits`` or fewer differing bits.  The bits are cut into
``max_bits // 2 + 1`` blocks, so two linked fingerprints differ in at most one bit within
at least one block; each block has its own vantage-point tree.

Every node of a tree has a vantage point of its own, chosen among the fingerprints of a sample that reach
it; a node's branches are the distances (within the block) from it.  A branch is a leaf, a shard, once it is expected to
hold at most ``leaf_rows`` fingerprints, so trees deepen with the input.
By the triangle inequality a neighbour within one bit lies on the same branch or the next
one; since one changed bit changes every distance by exactly one, it lies in
the same leaf or on a branch beside it at every node.  Every fingerprint therefore has
one home leaf and visits the boundary-overlapping leaves whose first distance is one more
(the others are visited from the opposite side).

The task of a leaf goes on in the same way on its own rows: a larger leaf gets a tree of its own over the block, and rows that
are equal within the block one over blocks of the remaining bits, until LOCAL_ROWS are left.  These are compared
exactly, over all 64 bits, and only
a spanning forest of the links is reported, never all pairs of a group.  Leaves beyond
``leaf_rows`` are cut into blocks of rows.  Components come from repeated minimum labels with
pointer jumping; every round is a written table.

Defined cases: null text counts as empty; no words give fingerprint zero, linked like any
other; equal fingerprints link; an empty table gives no rows; a null doc_id never names a
component unless all its members are null; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickfeat.llm import common

SHINGLE = 4
MAX_BITS = 4
#: Home rows of a leaf's block.
LEAF_ROWS = 4096
#: Rows of a task that are compared without a tree of their own.
LOCAL_ROWS = 512
#: Distinct fingerprints (by hash order) on which the trees are built: SAMPLED per expected leaf, MOST_SAMPLE at most.
SAMPLED, MOST_SAMPLE = 16, 1 << 18
#: Vantage points tried per node, and sampled fingerprints below which a node is not split.
TRIALS, LEAST_SEEN = 12, 8


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    words = (text or "").encode().lower().split()      # bytes: only A-Z lower, only ASCII white space
    if not words:
        return 0
    digest = xxhash.xxh64_intdigest
    if len(words) <= shingle:
        return digest(b" ".join(words), 42)
    line = b" ".join(words)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes + 1) - 1
    starts = (ends - sizes)[: len(words) - shingle + 1].tolist()
    ends = ends[shingle - 1:].tolist()
    ones, n, step = np.zeros(64, np.int64), len(starts), 1 << 15
    for at in range(0, n, step):
        h = np.array([digest(line[a:b], 42) for a, b in zip(starts[at:at + step], ends[at:at + step], strict=True)], "<u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def _fingerprints(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = np.array([fingerprint(t, shingle) for t in b.column("text").to_pylist()], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("__h"), pa.array(fp, pa.int64())], names=["doc_id", "__h", "fp"])
    return run


class Tree:
    """A vantage-point tree over the bits of ``mask``; leaves are numbered from ``first``."""

    def __init__(self, seen: np.ndarray, mask: int, rows: int, leaf_rows: int, first: int = 0, seed: int = 1):
        self.mask = np.uint64(mask)
        width = mask.bit_count()
        rng = np.random.default_rng(seed)
        points, children, leaves = [], [], first
        todo = [(seen, None, 0)]                       # the sample at a node, and the place that names it
        self.root = -1 - leaves                        # nodes are 0 and more, leaf i is -1 - i
        while todo:
            own, parent, ring = todo.pop()
            part = own & self.mask
            if len(own) < LEAST_SEEN or len(own) / len(seen) * rows <= leaf_rows or (part == part[0]).all():
                name, leaves = -1 - leaves, leaves + 1
            else:
                name = len(points)
                some = part[rng.integers(0, len(part), TRIALS)]
                far = np.bitwise_count(part[None, :] ^ some[:, None])
                load = [float((np.bincount(x, minlength=1).astype(float) ** 2).sum()) for x in far]
                best = int(np.argmin(load))
                points.append(some[best])
                children.append(np.full(width + 1, 0, np.int64))
                for d in range(width + 1):
                    todo.append((own[far[best] == d], name, d))
            if parent is None:
                self.root = name
            else:
                children[parent][ring] = name
        self.points = np.array(points, np.uint64)
        self.children = np.array(children, np.int64).reshape(len(points), width + 1)
        self.end = leaves

    def _down(self, fp: np.ndarray, node: np.ndarray, move: int) -> tuple[np.ndarray, np.ndarray]:
        """(which, next node): to the branch whose distance is ``move`` more."""
        d = np.bitwise_count((fp ^ self.points[node]) & self.mask).astype(np.int64) + move
        ok = np.flatnonzero((d >= 0) & (d < self.children.shape[1]))
        return ok, self.children[node[ok], d[ok]]

    def homes(self, fp: np.ndarray) -> np.ndarray:
        node = np.full(len(fp), self.root, np.int64)
        while len(inner := np.flatnonzero(node >= 0)):
            node[inner] = self._down(fp[inner], node[inner], 0)[1]
        return -1 - node

    def visits(self, fp: np.ndarray, both: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """(row, leaf): the leaves besides its home that may hold a fingerprint at a distance of one; without ``both`` only those
        whose distance from the first vantage point is one more."""
        rows, leaves = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        who, node = np.arange(len(fp)), np.full(len(fp), self.root, np.int64)
        moves = (1, -1) if both else (1,)
        while len(who) and (node >= 0).any():
            next_who, next_node = [], []
            for move in moves:
                ok, to = self._down(fp[who], node, move)
                inner = to >= 0
                next_who.append(who[ok[inner]])
                next_node.append(to[inner])
                rows.append(who[ok[~inner]])
                leaves.append(-1 - to[~inner])
            who, node, moves = np.concatenate(next_who), np.concatenate(next_node), (1, -1)
        return np.concatenate(rows), np.concatenate(leaves)


def cut_bits(mask: int, blocks: int) -> list[int]:
    """The bits of ``mask`` in blocks of about equal size."""
    bits = [i for i in range(64) if mask >> i & 1]
    ends = [len(bits) * i // blocks for i in range(blocks + 1)]
    return [sum(1 << i for i in bits[a:b]) for a, b in zip(ends[:-1], ends[1:], strict=True) if b > a]


class Forest:
    """A tree for every block of bits."""

    def __init__(self, max_bits: int, sample: np.ndarray, rows: int, leaf_rows: int):
        self.max_bits = max_bits
        self.trees: list[Tree] = []
        for mask in cut_bits((1 << 64) - 1, max_bits // 2 + 1):
            self.trees.append(Tree(sample, mask, rows, leaf_rows, self.trees[-1].end if self.trees else 0) if len(sample) else Tree(np.zeros(1, np.uint64), mask, 0, 1))
        self.masks = [int(t.mask) for t in self.trees]
        self.ends = np.array([t.end for t in self.trees])

    def mask_of(self, leaf: int) -> int:
        return self.masks[int(np.searchsorted(self.ends, leaf, "right"))]

    def visits(self, fp: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(leaf, fingerprint, at home) of all leaves that the fingerprints are in or visit."""
        leaf, who, home = [], [], []
        for t in self.trees:
            leaf.append(t.homes(fp))
            who.append(fp)
            home.append(np.ones(len(fp), bool))
            if self.max_bits > 0:
                rows, to = t.visits(fp)
                leaf.append(to)
                who.append(fp[rows])
                home.append(np.zeros(len(rows), bool))
        return np.concatenate(leaf), np.concatenate(who), np.concatenate(home)


def _visits(forest: Forest):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            leaf, fp, home = forest.visits(b.column("fp").to_numpy(zero_copy_only=False).view(np.uint64))
            yield pa.RecordBatch.from_arrays([pa.array(leaf, pa.int64()), pa.array(fp.view(np.int64)), pa.array(home)], names=["leaf", "fp", "home"])
    return run


def link(left: np.ndarray, right: np.ndarray, whole: bool, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest (pairs of fingerprints) of the links between ``left`` and ``right`` and, if ``whole``, within ``left``."""
    nodes = np.concatenate([left, right])
    label = np.arange(len(nodes))
    a: list[int] = []
    b: list[int] = []
    step = max(1, (1 << 20) // max(1, len(nodes)))
    for at in range(0, len(left), step):
        part = left[at:at + step]
        first = at if whole else len(left)
        near = np.bitwise_count(part[:, None] ^ nodes[None, first:]) <= max_bits
        if whole:                                      # each pair once, and no row with itself
            near &= np.arange(first, len(nodes))[None, :] > np.arange(at, at + len(part))[:, None]
        for i in np.flatnonzero(near.any(axis=1)):
            own = at + i
            js = np.flatnonzero(near[i]) + first
            for root in np.unique(label[js]):
                if root != label[own]:
                    j = js[np.argmax(label[js] == root)]
                    a.append(own)
                    b.append(j)
                    label[label == root] = label[own]
    return nodes[a], nodes[b]


def near(left: np.ndarray, right: np.ndarray, whole: bool, max_bits: int, mask: int, equal: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """``link`` for many rows: of pairs that differ in at most one bit of ``mask``.  The bits of ``equal`` are the same in all rows.

    A tree over the bits of ``mask`` deals the rows into leaves; rows that are equal there are dealt on by blocks of the remaining
    bits, in at least one of which a pair differs in one bit at most."""
    if len(left) + len(right) <= LOCAL_ROWS or not len(left):
        return link(left, right, whole, max_bits)
    every = np.concatenate([left, right])
    if ((every ^ every[0]) & np.uint64(mask) == 0).all():
        return _rest(left, right, whole, max_bits, equal | mask)
    return _dealt(left, right, whole, max_bits, mask, equal)


def _dealt(left: np.ndarray, right: np.ndarray, whole: bool, max_bits: int, mask: int, equal: int) -> tuple[np.ndarray, np.ndarray]:
    tree = Tree(left, mask, len(left), LOCAL_ROWS // 2)
    if tree.root < 0:                                  # one leaf
        if len(left) + len(right) > LOCAL_ROWS and ((left ^ left[0]) & np.uint64(mask) == 0).all():
            return _rest(left, right, whole, max_bits, equal | mask)
        return link(left, right, whole, max_bits)
    rows, leaf, role = [left], [tree.homes(left)], [np.zeros(len(left), np.int8)]
    if max_bits and whole:
        who, to = tree.visits(left)
        rows.append(left[who])
        leaf.append(to)
        role.append(np.ones(len(who), np.int8))
    if len(right):
        who, to = tree.visits(right, both=True) if max_bits else (np.empty(0, np.int64),) * 2
        rows += [right, right[who]]
        leaf += [tree.homes(right), to]
        role += [np.ones(len(right) + len(who), np.int8)]
    rows, leaf, role = np.concatenate(rows), np.concatenate(leaf), np.concatenate(role)
    order = np.lexsort((role, leaf))
    rows, leaf, role = rows[order], leaf[order], role[order]
    cuts = np.flatnonzero(np.append(True, leaf[1:] != leaf[:-1])).tolist() + [len(leaf)]
    a, b = [np.empty(0, np.uint64)], [np.empty(0, np.uint64)]
    for x, y in zip(cuts[:-1], cuts[1:], strict=True):
        m = x + int(np.searchsorted(role[x:y], 1))
        if m == x:
            continue                                   # visitors alone
        own, other = rows[x:m], rows[m:y]
        if y - x > LOCAL_ROWS and ((own ^ own[0]) & np.uint64(mask) == 0).all():
            # home rows that are equal here, and visitors a bit away: the remaining bits tell them apart
            i, j = _rest(own, other, whole, max_bits, equal | mask)
        else:
            i, j = link(own, other, whole, max_bits)
        a.append(i)
        b.append(j)
    return np.concatenate(a), np.concatenate(b)


def _rest(left: np.ndarray, right: np.ndarray, whole: bool, max_bits: int, equal: int) -> tuple[np.ndarray, np.ndarray]:
    """By blocks of the bits that are not in ``equal``: a pair within ``max_bits`` differs in one bit at most of one of them."""
    rest = ((1 << 64) - 1) & ~equal
    if not rest:
        return link(left, right, whole, max_bits)
    got = [_dealt(left, right, whole, max_bits, part, equal) for part in cut_bits(rest, max_bits // 2 + 1)]
    return np.concatenate([x for x, _ in got]), np.concatenate([y for _, y in got])


def _leaves(max_bits: int, forest: Forest):
    """Rows come ordered by (leaf, i, j); compares each block of a leaf."""
    def block(leaf: int, cols) -> tuple[np.ndarray, np.ndarray]:
        fp, role = (np.concatenate(x) for x in cols)
        whole = bool((role == 2).any())
        left, right = np.unique(fp[role != 1]), np.unique(fp[role == 1])
        a, b = near(left, right, whole, max_bits, forest.mask_of(leaf))
        keep = a != b
        return a[keep], b[keep]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held = None, ([], [])
        out: list[tuple[np.ndarray, np.ndarray]] = []

        def rows():
            a, b = (np.concatenate(x).view(np.int64) for x in zip(*out, strict=True))
            return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

        for batch in batches:
            keys = np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in ("leaf", "i", "j")], axis=1)
            fp = batch.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)
            role = batch.column("role").to_numpy(zero_copy_only=False)
            cuts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1).tolist(), len(keys)]
            for x, y in zip(cuts[:-1], cuts[1:], strict=True):
                if x == y:
                    continue
                if (key := tuple(keys[x])) != at:
                    if at is not None:
                        out.append(block(at[0], held))
                    at, held = key, ([], [])
                held[0].append(fp[x:y])
                held[1].append(role[x:y])
            if sum(len(x[0]) for x in out) > 50_000:
                yield rows()
                out = []
        if at is not None:
            out.append(block(at[0], held))
        if out:
            yield rows()

    return run


def links(fps: DataFrame, max_bits: int = MAX_BITS, leaf_rows: int = LEAF_ROWS) -> DataFrame:
    """Spanning links (a, b) between the distinct fingerprints in column fp, through the forest."""
    spark = fps.sparkSession
    rows = fps.count()
    size = min(MOST_SAMPLE, max(SAMPLED * LEAST_SEEN, SAMPLED * rows // leaf_rows))
    sample = fps.orderBy(F.xxhash64("fp")).limit(size).collect()
    forest = Forest(max_bits, np.array([r["fp"] for r in sample], np.int64).view(np.uint64), rows, leaf_rows)
    visits = common.table(fps.select("fp").mapInArrow(_visits(forest), "leaf long, fp long, home boolean"), "simhash-visits")
    # leaves beyond limit rows are cut; limit follows the input, so they are fewer than 10,000 and their list is broadcast
    limit = max(leaf_rows, visits.count() // 10_000)
    sizes = visits.groupBy("leaf").agg(F.sum(F.col("home").cast("long")).alias("homes"), F.count(F.lit(1)).alias("rows"))
    cut = sizes.filter(F.col("rows") > 2 * limit).select(
        "leaf", F.ceil(F.col("homes") / limit).cast("int").alias("lefts"), F.ceil(F.col("rows") / limit).cast("int").alias("rights"))
    v = visits.join(F.broadcast(cut), "leaf", "left")
    own_i = F.pmod(F.xxhash64("fp"), F.greatest("lefts", F.lit(1))).cast("int")
    own_j = F.pmod(F.xxhash64("fp", F.lit(1)), F.greatest("rights", F.lit(1))).cast("int")
    count = lambda c: F.sequence(F.lit(0), F.greatest(F.col(c), F.lit(1)) - 1)
    place = lambda i, j, role: F.struct(i.cast("int").alias("i"), j.cast("int").alias("j"), F.lit(role).alias("role"))
    zero = F.lit(0)
    as_left = F.transform(count("rights"), lambda j: place(own_i, j, 0))
    as_right = F.transform(count("lefts"), lambda i: place(i, own_j, 1))
    # role 2: a whole leaf's home row, on both sides; 0 and 1: left and right of a cut leaf's blocks; 1 also: visitors
    places = (F.when(F.col("lefts").isNull(), F.array(F.when(F.col("home"), place(zero, zero, 2)).otherwise(place(zero, zero, 1))))
              .when(F.col("lefts") < 1, F.array().cast("array<struct<i:int,j:int,role:int>>"))
              .when(F.col("home"), F.concat(as_left, as_right)).otherwise(as_right))
    dealt = v.select("leaf", "fp", F.explode(places).alias("p")).select("leaf", "p.i", "p.j", "fp", "p.role")
    n = common.partitions(spark)
    ordered = dealt.repartition(n, "leaf", "i", "j").sortWithinPartitions("leaf", "i", "j")
    return ordered.mapInArrow(_leaves(max_bits, forest), "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """(fp, label) of all fingerprints in ``edges`` (a, b): label is the smallest of the component.

    Each round gives every node the smallest label around it and then the label's own
    label, until nothing changes.  Joins deal frequent nodes over several tasks."""
    both = common.table(edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "simhash-edges")
    degree = common.table(both.groupBy(F.col("a").alias("fp")).agg(F.count(F.lit(1)).alias("n")), "simhash-degree")
    labels = degree.select("fp", F.col("fp").alias("label"), "n")
    while True:
        near = (common.lookup(both.select(F.col("b").alias("fp"), "a"), labels, ["fp"], F.col("a"))
                .groupBy(F.col("a").alias("fp")).agg(F.min("label").alias("near")))
        low = common.table(labels.join(near, "fp").select("fp", F.col("label").alias("was"), F.least("label", "near").alias("label"), "n"), "simhash-low")
        # jump: the label's label
        uses = low.groupBy(F.col("label").alias("to")).agg(F.count(F.lit(1)).alias("n"))
        ends = low.select(F.col("fp").alias("to"), F.col("label").alias("end")).join(uses, "to")
        new = common.lookup(low.select("fp", "was", F.col("label").alias("to"), F.col("n").alias("degree")), ends, ["to"], F.col("fp"))
        new = common.table(new.select("fp", "was", F.col("end").alias("label"), F.col("degree").alias("n")), "simhash-label")
        labels = new.select("fp", "label", "n")
        if new.filter("was <> label").limit(1).count() == 0:
            return labels.select("fp", "label")


def near_groups(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS, leaf_rows: int = LEAF_ROWS) -> DataFrame:
    """One row per document: doc_id, __h (hash of the text), fp, component_id, size (of the component), root (the
    component's smallest fingerprint, which tells components apart whatever their doc_ids are)."""
    spark = docs.sparkSession
    common.workers(spark)
    own = docs.select("doc_id", "text", common.text_hash().alias("__h"))
    fps = common.table(own.mapInArrow(_fingerprints(shingle), "doc_id long, __h long, fp long"), "simhash-fp")
    reps = common.table(fps.groupBy("fp").agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("n")), "simhash-distinct")
    labels = components(links(reps, max_bits, leaf_rows))
    roots = common.table(reps.join(labels, "fp", "left").select("fp", "rep", "n", F.coalesce("label", "fp").alias("root")), "simhash-root")
    heads = roots.groupBy("root").agg(F.min("rep").alias("component_id"), F.sum("n").alias("size"), F.count(F.lit(1)).alias("n"))
    named = common.lookup(roots.select("fp", "root", F.col("n").alias("rows")), heads, ["root"], F.col("fp"))
    named = common.table(named.select("fp", "root", "component_id", "size", F.col("rows").alias("n")), "simhash-named")
    return common.lookup(fps, named, ["fp"], F.col("doc_id")).select("doc_id", "__h", "fp", "component_id", "size", "root")


def keep_one(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """One document of every group, with all its columns: the one with the smallest doc_id (a null one last), and of
    rows that share it the one with the smallest text hash."""
    got = near_groups(docs, shingle, max_bits)
    first = got.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "__h")).alias("one"))
    return common.emit(docs, first.select("one.doc_id", "one.__h", F.lit(1).alias("__emit")))
