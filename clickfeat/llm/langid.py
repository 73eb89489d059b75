"""Language identification by a byte convolutional network.

Bytes (A-Z lowered) are embedded, filters of several widths run over each window, every
filter keeps its largest response, and a softmax names the language.  The network is trained
in numpy by Adam on a bounded, hash-chosen sample of labelled windows per language.  A text is
cut into consecutive windows of fixed length that cover all its bytes; the windows of a batch
of documents go through the network together and a document's probabilities are the
byte-weighted mean over its windows.

Defined cases: null text, a text without a letter, or nothing to learn from gives ``und`` with
score 0; an empty table gives no rows; lang, source and doc_id are never inputs of a prediction;
other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from clickfeat.llm import common

WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 16
EMBED = 8
#: The sample: documents per language (dealt evenly over CLASSES hash classes), windows per document, and rows in all.
DOCS_PER_LANG = 416
CLASSES = 32
WINDOWS_PER_DOC = 4
MOST_ROWS = 16384
EPOCHS = 6
UNKNOWN = "und"

LETTER = regex.compile(r"\p{L}")


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


# ---- the network ----

def as_bytes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode().lower(), np.uint8)


def init(classes: int, seed: int = 0) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    p = {"embed": rng.normal(0, 0.5, (256, EMBED)), "out": rng.normal(0, 0.1, (FILTERS * len(WIDTHS), classes)), "bias": np.zeros(classes)}
    p["embed"][0] = 0                                  # the padding byte
    for w in WIDTHS:
        p[f"conv{w}"] = rng.normal(0, (2 / (w * EMBED)) ** 0.5, (w * EMBED, FILTERS))
        p[f"add{w}"] = np.zeros(FILTERS)
    return {k: v.astype(np.float32) for k, v in p.items()}


def _forward(p: dict, x: np.ndarray):
    e = p["embed"][x]
    kept, parts = [], []
    for w in WIDTHS:
        n = x.shape[1] - w + 1
        cols = np.concatenate([e[:, j:j + n] for j in range(w)], axis=2)
        z = cols @ p[f"conv{w}"] + p[f"add{w}"]
        at = z.argmax(axis=1)
        top = np.take_along_axis(z, at[:, None], axis=1)[:, 0]
        parts.append(np.maximum(top, 0))
        kept.append((cols, at, top > 0))
    h = np.concatenate(parts, axis=1)
    return kept, h, h @ p["out"] + p["bias"]


def softmax(z: np.ndarray) -> np.ndarray:
    z = np.exp(z - z.max(axis=1, keepdims=True))
    return z / z.sum(axis=1, keepdims=True)


def train(x: np.ndarray, y: np.ndarray, classes: int, epochs: int = EPOCHS, batch: int = 64, rate: float = 3e-3) -> dict[str, np.ndarray]:
    p = init(classes)
    m, v = ({k: np.zeros_like(a) for k, a in p.items()} for _ in range(2))
    rng, step = np.random.default_rng(1), 0
    for _ in range(epochs):
        order = rng.permutation(len(x))
        for a in range(0, len(x), batch):
            rows = order[a:a + batch]
            xb, yb = x[rows].copy(), y[rows]
            for r in np.flatnonzero(rng.random(len(rows)) < 0.5):          # short texts too
                xb[r, int(rng.integers(8, x.shape[1])):] = 0
            kept, h, z = _forward(p, xb)
            d = softmax(z)
            d[np.arange(len(yb)), yb] -= 1
            d /= len(yb)
            g = {"out": h.T @ d, "bias": d.sum(axis=0), "embed": np.zeros_like(p["embed"])}
            dh = d @ p["out"].T
            for i, w in enumerate(WIDTHS):
                cols, at, on = kept[i]
                dz = dh[:, i * FILTERS:(i + 1) * FILTERS] * on
                picked = np.take_along_axis(cols, at[:, :, None], axis=1)  # the winning position of each filter
                g[f"conv{w}"] = np.einsum("bfc,bf->cf", picked, dz)
                g[f"add{w}"] = dz.sum(axis=0)
                de = np.einsum("cf,bf->bfc", p[f"conv{w}"], dz)
                for j in range(w):
                    byte = np.take_along_axis(xb, at + j, axis=1)
                    np.add.at(g["embed"], byte, de[:, :, j * EMBED:(j + 1) * EMBED])
            g["embed"][0] = 0
            step += 1
            for k, a_ in g.items():
                m[k] = 0.9 * m[k] + 0.1 * a_
                v[k] = 0.999 * v[k] + 0.001 * a_ * a_
                p[k] -= (rate * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v[k] / (1 - 0.999 ** step)) + 1e-8)).astype(np.float32)
    return p


class Net:
    """The trained network; filters of two bytes become tables over byte pairs, so that a window costs look-ups and additions."""

    def __init__(self, p: dict[str, np.ndarray]):
        e, f = p["embed"], FILTERS
        at = lambda w, j: e @ p[f"conv{w}"][j * EMBED:(j + 1) * EMBED]  # noqa: E731  byte -> response at place j of width w
        pair = lambda a, b: (a[:, None, :] + b[None, :, :]).reshape(-1, f)
        self.first = np.concatenate([pair(at(w, 0), at(w, 1)) + p[f"add{w}"] for w in WIDTHS], axis=1).astype(np.float32)
        self.third = at(3, 2).astype(np.float32)
        self.next = pair(at(4, 2), at(4, 3)).astype(np.float32)
        self.out, self.bias = p["out"], p["bias"]

    def probabilities(self, x: np.ndarray, step: int = 32) -> np.ndarray:
        got = []
        for a in range(0, len(x), step):
            xb = x[a:a + step].astype(np.intp)
            pair = xb[:, :-1] * 256 + xb[:, 1:]
            z = self.first[pair]
            f = FILTERS
            z[:, :-1, f:2 * f] += self.third[xb[:, 2:]]
            z[:, :-2, 2 * f:] += self.next[pair[:, 2:]]
            h = np.concatenate([z[:, :, :f].max(axis=1), z[:, :-1, f:2 * f].max(axis=1), z[:, :-2, 2 * f:].max(axis=1)], axis=1)
            got.append(softmax(np.maximum(h, 0) @ self.out + self.bias))
        return np.concatenate(got)


def sample(docs: DataFrame, docs_per_lang: int = DOCS_PER_LANG, windows: int = WINDOWS_PER_DOC) -> DataFrame:
    """Labelled windows (lang, piece): of each language and hash class the documents with the smallest
    hashes (so no task ranks a whole language), windows spread over the whole text.  ``docs_per_lang`` and MOST_ROWS bound it whatever the input's size."""
    own = (docs.filter(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")) & F.col("text").rlike(r"\p{L}"))
           .select("lang", F.xxhash64("doc_id", F.lit(7)).alias("k"), common.text_hash().alias("h")))
    rank = F.row_number().over(Window.partitionBy("lang", F.pmod("k", F.lit(CLASSES))).orderBy("k", "h"))
    picked = own.withColumn("r", rank).filter(F.col("r") <= -(-docs_per_lang // CLASSES)).orderBy("r", "lang", "k").limit(MOST_ROWS // windows)
    # docs_per_lang rows per language and MOST_ROWS in all: small enough to broadcast
    d = docs.select("lang", "text", F.xxhash64("doc_id", F.lit(7)).alias("k"), common.text_hash().alias("h"))
    d = d.join(F.broadcast(picked.select("lang", "k", "h", "r").distinct()), ["lang", "k", "h"])
    n = F.length("text")
    piece = F.explode(F.transform(F.sequence(F.lit(0), F.lit(windows - 1)), lambda i: F.substr(
        F.col("text"), (F.greatest(n - WINDOW, F.lit(0)) * i / max(1, windows - 1)).cast("int") + 1, F.lit(WINDOW)))).alias("piece")
    return d.select("lang", "r", piece).orderBy("r", "lang", "piece").limit(MOST_ROWS)


def fit(docs: DataFrame) -> tuple[dict[str, np.ndarray], list[str]]:
    rows = [(r["lang"], r["piece"]) for r in sample(docs).collect()]
    langs = sorted({r[0] for r in rows})
    if not langs:
        return {}, []
    x = np.zeros((len(rows), WINDOW), np.uint8)
    for i, (_, piece) in enumerate(rows):
        b = as_bytes(piece)[:WINDOW]
        x[i, :len(b)] = b
    return train(x, np.array([langs.index(r[0]) for r in rows]), len(langs)), langs


_NETS: dict = {}


def predict(params: dict, langs: list[str], texts: list[str | None]) -> list[tuple[str, float]]:
    """(language, score) of each text."""
    key = id(params)
    if key not in _NETS and langs:
        _NETS.clear()
        _NETS[key] = (Net(params), params)
    out: list = [(UNKNOWN, 0.0)] * len(texts)
    if not langs:
        return out
    net = _NETS[key][0]
    held: list = []                                    # (document, bytes) until there are enough windows

    def run() -> None:
        counts = [-(-len(b) // WINDOW) for _, b in held]
        x = np.zeros((sum(counts), WINDOW), np.uint8)
        weight, at = np.full(len(x), WINDOW, np.float64), 0
        for (_, b), n in zip(held, counts, strict=True):
            x[at:at + n].reshape(-1)[:len(b)] = b
            weight[at + n - 1] = len(b) - (n - 1) * WINDOW
            at += n
        p = net.probabilities(x) * weight[:, None]
        sums = np.add.reduceat(p, np.cumsum([0, *counts[:-1]]), axis=0)
        for (i, b), s in zip(held, sums, strict=True):
            best = int(s.argmax())
            out[i] = (langs[best], min(1.0, float(s[best] / len(b))))
        held.clear()

    size = 0
    for i, t in enumerate(texts):
        if t is not None and LETTER.search(t):
            b = as_bytes(t)
            held.append((i, b))
            size += len(b)
            if size > 1 << 20:
                run()
                size = 0
    if held:
        run()
    return out


def _predict(params: dict, langs: list[str], columns: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = predict(params, langs, b.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [*(b.column(c) for c in columns), pa.array([x[0] for x in got], pa.string()), pa.array([x[1] for x in got], pa.float64())],
                names=[*columns, "lang_pred", "score"])
    return run


def languages(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score."""
    common.workers(docs.sparkSession)
    params, langs = fit(docs)
    own = docs.select("doc_id", "text")
    got = own.mapInArrow(_predict(params, langs, ["doc_id"]), "doc_id long, lang_pred string, score double")
    return got.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def known_language(docs: DataFrame, least: float = 0.5) -> DataFrame:
    """The documents, with all their columns, whose language is known with at least ``least`` of the probability."""
    common.workers(docs.sparkSession)
    params, langs = fit(docs)
    inner = common.whole_rows(docs).select("row", F.col("row.text").alias("text"))
    schema = T.StructType([inner.schema["row"], T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    got = inner.mapInArrow(_predict(params, langs, ["row"]), schema)
    return got.filter((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= least)).select("row.*")
