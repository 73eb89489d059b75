"""Exact top-k cosine neighbours without emitting all pairs.

Up to ``block_rows`` vectors, and where pruning is not asked for, the vectors are numbered and cut into blocks
and every (query block, candidate block) pair is one cogroup task: a matrix product in numpy (queries in
sub-chunks of 256 rows, so memory stays at 256 x block_rows doubles) that keeps only each query's k best
candidates (ties by id).

More vectors are pruned by the triangle inequality of angles:

1. Each vector goes to the nearest of at most MOST_PIVOTS pivots (chosen by hash); a pivot's vectors, cut by hash
   into blocks of about ``block_rows``, lie between a least and a largest angle from it.
2. Round one compares each query with its own block, which gives it k candidates and so an angle beyond which nothing
   matters.
3. In round two a query goes only to the blocks whose nearest possible vector (the difference between the query's
   angle to the pivot and the block's angles) is within that angle.  Queries of a block are dealt in chunks of about
   ``block_rows``, for which the block is repeated.

The result is exact: a skipped block cannot hold a better candidate, nor an equal one (TOLERANCE covers rounding).
Vectors without any structure are hardly pruned; then round two compares every pair of blocks.

The winners per block are merged by a window of at most k rows a block and query.  Each task holds two bounded
blocks; nothing but pivots and the list of blocks goes through the driver, and no pair table is written.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from clickfeat.operators.indexing import with_global_index
from clickfeat.session import materialize


def _block_topk(k: int, sub_rows: int = 256):
    """numpy task for one (query block, candidate block) pair.  Queries are
    processed ``sub_rows`` at a time, so the similarity matrix held in memory
    is at most sub_rows x block_rows doubles."""
    empty = pd.DataFrame({"qid": pd.Series([], dtype="int64"), "cid": pd.Series([], dtype="int64"),
                          "sim": pd.Series([], dtype="float64")})

    def fn(q: pd.DataFrame, c: pd.DataFrame) -> pd.DataFrame:
        if q.empty or c.empty:
            return empty
        cm = np.stack(c["cvec"].to_numpy()).astype(np.float64)
        cn = np.linalg.norm(cm, axis=1)
        cid = c["cid"].to_numpy()
        qall = q["qid"].to_numpy()
        qvecs = q["qvec"].to_numpy()
        kk = min(k, len(cid))
        parts = []
        for start in range(0, len(qall), sub_rows):
            qid = qall[start:start + sub_rows]
            qm = np.stack(qvecs[start:start + sub_rows]).astype(np.float64)
            qn = np.linalg.norm(qm, axis=1)
            with np.errstate(divide="ignore", invalid="ignore"):
                s = (qm @ cm.T) / np.outer(qn, cn)
            s[qid[:, None] == cid[None, :]] = np.nan          # self excluded
            s = np.where(np.isnan(s), -np.inf, s)
            kth = -np.partition(-s, kk - 1, axis=1)[:, kk - 1]  # k-th largest per row
            rows, cols = np.nonzero((s >= kth[:, None]) & np.isfinite(s))
            order = np.lexsort((cid[cols], -s[rows, cols], rows))   # exactly k per query: ties by id
            rows, cols = rows[order], cols[order]
            place = np.arange(len(rows)) - np.searchsorted(rows, rows)
            rows, cols = rows[place < kk], cols[place < kk]
            parts.append(pd.DataFrame({"qid": qid[rows].astype("int64"), "cid": cid[cols].astype("int64"),
                                       "sim": s[rows, cols]}))
        return pd.concat(parts, ignore_index=True) if parts else empty
    return fn


#: Pivots, at most; angles by which rounding may be off.
MOST_PIVOTS = 1024
TOLERANCE = 1e-6
FOUND = "qid bigint, cid bigint, sim double"


def _merged(best: DataFrame, k: int, id_col: str) -> DataFrame:
    w = Window.partitionBy("qid").orderBy(F.col("sim").desc(), F.col("cid"))
    ranked = best.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
    return ranked.select(F.col("qid").alias(id_col), F.col("rank").cast("bigint").alias("rank"),
                         F.col("cid").alias("other_id"), F.col("sim").alias("similarity"))


def top_k_cosine(vectors: DataFrame, id_col: str, vec_col: str, k: int = 5,
                 block_rows: int = 16384, pruned: bool | None = None) -> DataFrame:
    """(id, rank 1..k, other_id, similarity) by cosine, self excluded, ties by id.

    ``id_col`` must be a bigint key; ``vec_col`` an array of numbers.  ``pruned``: by pivots; by default if there are
    more than ``block_rows`` vectors.
    """
    v = vectors.select(F.col(id_col).cast("bigint").alias("id"),
                       F.col(vec_col).cast("array<double>").alias("vec"))
    n = vectors.count()
    if pruned or pruned is None and n > block_rows:
        return _merged(_pruned(v, n, k, block_rows), k, id_col)
    # blocks of block_rows at most, and enough of them for every core to have a pair of blocks
    cores = vectors.sparkSession.sparkContext.defaultParallelism
    blocks = max(-(-n // block_rows), min(math.isqrt(cores - 1) + 1, -(-n // 64)), 1)
    rows = max(1, -(-n // blocks))
    v = with_global_index(v, ["id"], "_i").withColumn("_b", F.floor(F.col("_i") / rows).cast("int"))
    v = materialize(v.drop("_i"), "vector_blocks")   # read twice (query and candidate sides)
    nb = v.agg(F.max("_b") + 1).scalar()
    every = F.sequence(F.lit(0), nb - 1)
    q = v.select(F.col("id").alias("qid"), F.col("vec").alias("qvec"), F.col("_b").alias("qb"),
                 F.explode(every).alias("cb"))
    c = v.select(F.col("id").alias("cid"), F.col("vec").alias("cvec"), F.col("_b").alias("cb"),
                 F.explode(every).alias("qb"))
    best = q.groupBy("qb", "cb").cogroup(c.groupBy("qb", "cb")).applyInPandas(_block_topk(k), FOUND)
    return _merged(best, k, id_col)


# ---- pruning by pivots ----

def _angles(vecs, pivots: np.ndarray) -> np.ndarray:
    m = np.stack(vecs).astype(np.float64)
    return np.arccos(np.clip(m @ pivots.T / np.linalg.norm(m, axis=1)[:, None], -1.0, 1.0))


def _nearest(pivots: np.ndarray):
    def fn(frames):
        for f in frames:
            if f.empty:
                continue
            ang = _angles(f["vec"].to_numpy(), pivots)
            cell = ang.argmin(axis=1)
            yield f.assign(cell=cell.astype("int32"), ang=ang[np.arange(len(f)), cell])
    return fn


def _reached(pivots: np.ndarray, cell: np.ndarray, low: np.ndarray, high: np.ndarray):
    """For every query the blocks (numbers into ``cell``, the block's pivot) that may hold one of its neighbours."""
    def fn(frames):
        for f in frames:
            for start in range(0, len(f), 256):
                part = f.iloc[start:start + 256]
                ang = _angles(part["vec"].to_numpy(), pivots)[:, cell]
                least = np.maximum(np.maximum(ang - high, low - ang), 0.0)
                ok = least <= part["reach"].to_numpy()[:, None] + TOLERANCE
                ok[np.arange(len(part)), part["block"].to_numpy()] = False       # round one
                yield part[["id", "vec"]].assign(target=[np.flatnonzero(x).astype("int32") for x in ok])
    return fn


def pivot_blocks(v: DataFrame, n: int, block_rows: int):
    """(table id, vec, ang, block; pivots; per block its pivot, least and largest angle) of vectors with a direction."""
    norm = F.sqrt(F.aggregate("vec", F.lit(0.0), lambda acc, x: acc + x * x))
    v = v.withColumn("_norm", norm).where((F.col("_norm") > 0) & (F.col("_norm") < float("inf"))).drop("_norm")
    many = min(MOST_PIVOTS, max(1, -(-4 * n // block_rows)))
    chosen = v.orderBy(F.xxhash64("id"), "id").limit(many).collect()             # at most MOST_PIVOTS rows
    if not chosen:
        return v.select("id", "vec", F.lit(0.0).alias("ang"), F.lit(0).alias("block")), np.zeros((0, 1)), np.zeros((3, 0))
    pivots = np.array([r["vec"] for r in chosen], np.float64)
    pivots /= np.linalg.norm(pivots, axis=1)[:, None]
    cells = materialize(v.mapInPandas(_nearest(pivots), "id bigint, vec array<double>, cell int, ang double"), "vector_cells")
    rows = cells.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.min("ang").alias("low"), F.max("ang").alias("high")).orderBy("cell").collect()
    parts = [max(1, -(-r["n"] // block_rows)) for r in rows]
    firsts = np.concatenate([[0], np.cumsum(parts)]).tolist()
    listed = F.create_map(*[F.lit(x) for r, p, a in zip(rows, parts, firsts) for x in (r["cell"], a * (1 << 31) + p)])
    code = F.element_at(listed, F.col("cell")).cast("bigint")
    block = (F.shiftright(code, 31) + F.pmod(F.xxhash64("id"), code % (1 << 31))).cast("int")
    bounds = np.array([[r["cell"], r["low"], r["high"]] for r, p in zip(rows, parts) for _ in range(p)]).T
    return cells.select("id", "vec", "ang", block.alias("block")), pivots, bounds


def query_blocks(blocks: DataFrame, found: DataFrame, pivots: np.ndarray, bounds: np.ndarray, k: int) -> DataFrame:
    """(id, vec, target): the blocks beyond its own that each query has to be compared with.  ``found``: round one."""
    reach = found.groupBy("qid").agg(F.count(F.lit(1)).alias("m"), F.min("sim").alias("s"))
    reach = reach.select(F.col("qid").alias("id"), F.when(F.col("m") >= k, F.acos(F.greatest(F.least("s", F.lit(1.0)), F.lit(-1.0)))).alias("reach"))
    q = blocks.select("id", "vec", "block").join(reach, "id", "left").fillna({"reach": math.pi})
    some = q.mapInPandas(_reached(pivots, bounds[0].astype(int), bounds[1], bounds[2]), "id bigint, vec array<double>, target array<int>")
    return some.select("id", "vec", F.explode("target").alias("target"))


def _pruned(v: DataFrame, n: int, k: int, block_rows: int) -> DataFrame:
    blocks, pivots, bounds = pivot_blocks(v, n, block_rows)
    if not len(pivots):
        return v.sparkSession.createDataFrame([], FOUND)
    c = blocks.select(F.col("id").alias("cid"), F.col("vec").alias("cvec"), "block")
    own = blocks.select(F.col("id").alias("qid"), F.col("vec").alias("qvec"), "block")
    found = materialize(own.groupBy("block").cogroup(c.groupBy("block")).applyInPandas(_block_topk(k), FOUND), "neighbours_own")
    q = materialize(query_blocks(blocks, found, pivots, bounds, k), "neighbour_queries")
    # a block's queries in chunks; the list has one row per block
    chunks = q.groupBy("target").agg(F.ceil(F.count(F.lit(1)) / F.lit(block_rows)).cast("int").alias("chunks"))
    chunks = F.broadcast(materialize(chunks, "neighbour_chunks"))
    q = q.join(chunks, "target").select(F.col("id").alias("qid"), F.col("vec").alias("qvec"), F.col("target").alias("block"),
                                        F.pmod(F.xxhash64("id"), F.col("chunks")).cast("int").alias("chunk"))
    c = c.join(chunks.withColumnRenamed("target", "block"), "block").select("cid", "cvec", "block", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"))
    more = q.groupBy("block", "chunk").cogroup(c.groupBy("block", "chunk")).applyInPandas(_block_topk(k), FOUND)
    return found.unionByName(more)


def word_neighbours(word_vectors: DataFrame, k: int = 5, word_col: str = "word",
                    vec_col: str = "vector") -> DataFrame:
    """Top-k synonyms per vocabulary word: (word, rank, synonym, similarity)."""
    idx = with_global_index(word_vectors.select(word_col, vec_col), [word_col], "_wid")
    nb = top_k_cosine(idx, "_wid", vec_col, k)
    names = idx.select(F.col("_wid"), F.col(word_col))
    out = (nb.join(names, "_wid")
             .join(names.select(F.col("_wid").alias("other_id"), F.col(word_col).alias("synonym")), "other_id"))
    return out.select(word_col, "rank", "synonym", "similarity")
