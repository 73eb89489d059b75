"""Byte-level BPE by prefix dynamic programming.

For a fixed vocabulary every byte string has one valid encoding, and so has each of its
prefixes.  It is therefore enough to store, for every prefix, the *last token* of the
prefix's encoding: that is the one token which ends there and may follow the last token of
the prefix before it.  Two tokens may stand side by side when merging their joined bytes
gives those two tokens again.  Appending bytes only adds entries, and after an edit the
entries before the edit stay and those behind it are computed until they agree again.

A text is cut into the pre-tokens of ``pattern``; each is encoded separately.  Workers keep
bounded caches of pre-tokens and token pairs; an automaton lists the tokens that end at a place.

Defined cases: null text counts as empty and gives no ids; an empty table gives no rows;
other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from clickfeat.llm import common, pretokens

#: Pre-tokens that a worker remembers, and a quarter of the token pairs (only speed depends on it).
CACHE = 600_000
SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


class Bpe:
    """The vocabulary with its pair rule."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.tokens = {v: k for k, v in ranks.items()}
        self.longest = max(map(len, ranks))
        self.pairs: dict[int, bool] = {}
        self.halves: dict[int, tuple[int, int] | None] = {}
        self.endings = ahocorasick.Automaton()        # the tokens that end at each place of a byte string
        for k, v in ranks.items():
            self.endings.add_word(k.decode("latin-1"), (v, len(k)))
        self.endings.make_automaton()
        size = max(ranks.values()) + 1
        sizes = np.array([len(self.tokens.get(i, b"")) for i in range(size)])
        self.blob = np.frombuffer(b"".join([self.tokens.get(i, b"") for i in range(size)]), np.uint8)
        self.sizes, self.starts = sizes, np.cumsum(sizes) - sizes

    def merged(self, data: bytes, below: int = 1 << 60) -> list[int]:
        """Encoding by the merges themselves: join the neighbours of lowest rank until none (``below`` a rank) is left."""
        parts = [data[i:i + 1] for i in range(len(data))]
        while len(parts) > 1:
            rank, at = min((self.ranks.get(parts[i] + parts[i + 1], 1 << 60), i) for i in range(len(parts) - 1))
            if rank >= below:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return [self.ranks[x] for x in parts]

    def half(self, token: int) -> tuple[int, int] | None:
        """The two tokens whose merge makes this one; None for a single byte, and for a token that merges do not make of two."""
        if token not in self.halves:
            parts = self.merged(self.tokens[token], token)
            self.halves[token] = tuple(parts) if len(parts) == 2 else None
        return self.halves[token]

    def follows(self, a: int, b: int) -> bool:
        """May token b stand behind token a?  The merges that made a and b are undone at their common border, the
        latest first.  The pair that then meets there must not merge before the merge undone."""
        key = a << 32 | b
        known = self.pairs.get(key)
        if known is None:
            if len(self.pairs) > 4 * CACHE:
                self.pairs.clear()
            known = self.pairs[key] = self._follows(a, b)
        return known

    def _follows(self, a: int, b: int) -> bool:
        tokens, ranks, left, right = self.tokens, self.ranks, a, b
        first = 1 << 60                               # a joint merge of a rank below this came before the merge undone
        while True:
            if ranks.get(tokens[left] + tokens[right], 1 << 60) < first:
                return False
            one, two = len(tokens[left]) > 1, len(tokens[right]) > 1
            if not one and not two:
                return True
            # of equal merges the left one comes first: also before the joint one, which comes before the right one
            undo_left = one and (left > right or not two)
            parts = self.half(left if undo_left else right)
            if parts is None:
                break
            if undo_left:
                first, left = left, parts[1]
            else:
                first, right = right + 1, parts[0]
        return self.merged(tokens[a] + tokens[b]) == [a, b]

    def extend(self, data: bytes, last: list[int], stop=None) -> None:
        """Add the last token of every further prefix of ``data`` to ``last`` (``last[i]``: of the prefix of
        i + 1 bytes).  ``stop(i)`` may end it early.  Only tokens that end at a place are tried there, the longest first."""
        pairs, follows = self.pairs, self.follows
        done = len(last)
        for end, (token, size) in self.endings.iter(data.decode("latin-1"), max(0, done + 1 - self.longest)):
            if end < done:
                continue
            if end > done:
                break
            start = end + 1 - size
            if start == 0 or (ok := pairs.get(last[start - 1] << 32 | token)) or ok is None and follows(last[start - 1], token):
                last.append(token)
                done += 1
                if stop and stop(end):
                    return
        if done < len(data):
            raise ValueError("the vocabulary lacks a byte")

    def walk(self, last: list[int], end: int | None = None) -> list[int]:
        """The ids of the prefix of ``end`` bytes."""
        ids, i = [], len(last) if end is None else end
        while i:
            ids.append(last[i - 1])
            i -= len(self.tokens[last[i - 1]])
        return ids[::-1]

    def encode(self, data: bytes) -> list[int]:
        if (whole := self.ranks.get(data)) is not None:
            return [whole]
        last: list[int] = []
        self.extend(data, last)
        return self.walk(last)

    def decode(self, ids) -> bytes:
        ids = np.asarray(ids, np.int64)
        n = self.sizes[ids]
        ends = np.cumsum(n)
        return self.blob[np.repeat(self.starts[ids] - (ends - n), n) + np.arange(ends[-1])].tobytes() if len(ids) else b""


class Piece:
    """One pre-token's bytes with the last token of every prefix: exact appends and edits."""

    def __init__(self, bpe: Bpe, data: bytes = b""):
        self.bpe, self.data, self.last = bpe, b"", []
        self.append(data)

    def append(self, more: bytes) -> None:
        self.data += more
        self.bpe.extend(self.data, self.last)

    def edit(self, start: int, end: int, new: bytes) -> int:
        """Replace the bytes start..end; returns how many prefixes were computed again.  Once as many
        consecutive entries as the longest token behind the edit have the tokens they had, all later ones do."""
        old, shift = self.last, len(new) - (end - start)
        self.data = self.data[:start] + new + self.data[end:]
        self.last = old[:start]
        same = 0

        def stop(i: int) -> bool:
            nonlocal same
            same = same + 1 if i >= start + len(new) and self.last[i] == old[i - shift] else 0
            return same >= self.bpe.longest

        self.bpe.extend(self.data, self.last, stop)
        done = len(self.last)
        self.last += old[done - shift:] if done < len(self.data) else []
        return done - start

    def ids(self) -> list[int]:
        return self.bpe.walk(self.last)


class Encoder:
    """Whole texts: pre-tokens by ``pattern``, the different ones each through the dynamic program, with a bounded cache.
    Ids are kept as little-endian 32-bit bytes."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.bpe = Bpe(ranks)
        self.pieces = pretokens.Pieces(lambda texts: pretokens.cut(texts, pattern), lambda new: [self.bpe.encode(p.encode()) for p in new], np.dtype("<u4"), CACHE)

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        return self.pieces.encode([t or "" for t in texts])


_ENCODERS: dict = {}


def encoder(path: str, pattern: str) -> Encoder:
    """One per worker."""
    if (path, pattern) not in _ENCODERS:
        _ENCODERS[path, pattern] = Encoder(load_ranks(path), pattern)
    return _ENCODERS[path, pattern]


def _encode(path: str, pattern: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(path, pattern)
        for b in batches:
            for i in range(0, b.num_rows, 250):
                part = b.slice(i, 250)
                ids = [x.tobytes() for x in e.encode(part.column("text").to_pylist())]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(ids, pa.binary())], names=["doc_id", "ids"])
    return run


def encode(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """One row per document: doc_id and its ids as little-endian unsigned 32-bit integers.  ``path``: a file of ranks."""
    common.workers(docs.sparkSession)
    return docs.select("doc_id", "text").mapInArrow(_encode(path, pattern), "doc_id long, ids binary")


def _digests(path: str, pattern: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(path, pattern)
        for b in batches:
            rows = []
            for i in range(0, b.num_rows, 250):
                for ids in e.encode(b.column("text").slice(i, 250).to_pylist()):
                    rows.append((len(ids), hashlib.sha256(ids).hexdigest(), hashlib.sha256(e.bpe.decode(ids)).hexdigest()))
            n, a, c = zip(*rows, strict=True) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(n, pa.int64()), pa.array(a, pa.string()), pa.array(c, pa.string())],
                                             names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
    return run


def digests(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """One row per document: doc_id, n_tokens and the digests of its ids and of the bytes decoded from them."""
    common.workers(docs.sparkSession)
    return docs.select("doc_id", "text").mapInArrow(_digests(path, pattern), SCHEMA)
