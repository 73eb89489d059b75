"""Token files: independent zstandard frames with a trailing seek table.

A file holds the ids of a range of ascending doc_ids, little-endian.  Whole documents are
gathered into frames of about FRAME ids, each compressed alone.  After the frames comes a
skippable frame with the document index (doc_id, frame, place in the frame, number of ids)
and, last, the seek table of the zstandard seekable format: per frame its compressed size, its
size and the low 32 bits of the XXH64 of its content, then the number of frames, a flag byte
and a magic number.  Any zstandard reader can decompress the whole file; a reader of
one document reads the tail, then only that document's frame, and checks its checksum.

Words are encoded by the tokenizers library; as its white space never joins words, the different pieces of a batch
of texts are encoded once, and each worker keeps a bounded cache of the ids of pieces met before.  With ``added`` (as in ``round_trip``) the
strings of the tokenizer's added tokens get those tokens' ids, the library's default; texts that may
hold one go to the library whole.  Without it they are ordinary text.

Files are written under a name of their own per attempt and then renamed, so a task that is
run again after a lost executor leaves one complete file.  Paths are opened through
``pyarrow.fs``, which reads local (shared) folders and remote stores by URI.

Defined cases: null text counts as empty and has only the end id; rows that share a doc_id are
ordered by their text's hash; a null doc_id comes first; an empty table gives no rows and no
files; other columns are not read.
"""

from __future__ import annotations

import io
import json
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import regex
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from clickfeat.llm import common, pretokens

FRAME = 1 << 16
LEVEL = 3
RANGE_ROWS = 4000
MOST_RANGES = 10_000
CACHE = 700_000

SKIPPABLE, INDEX_FRAME, SEEK_MAGIC = 0x184D2A5E, 0x184D2A5D, 0x8F92EAB1
DOC = np.dtype([("doc_id", "<i8"), ("known", "u1"), ("frame", "<u4"), ("start", "<u4"), ("n", "<u4")])


# ---- the file format ----

class Writer:
    """Appends documents and returns nothing before ``close``."""

    def __init__(self, out, frame: int = FRAME):
        self.out, self.frame = out, frame
        self.pack = zstandard.ZstdCompressor(level=LEVEL)
        self.table: list[tuple[int, int, int]] = []
        self.docs: list[tuple] = []
        self.held: list[bytes] = []
        self.size = self.n_ids = 0

    def add(self, doc_id: int | None, ids: bytes) -> None:
        if self.size and self.size + len(ids) > 4 * self.frame:
            self._flush()
        self.docs.append((doc_id or 0, doc_id is not None, len(self.table), self.size // 4, len(ids) // 4))
        self.held.append(ids)
        self.size += len(ids)
        self.n_ids += len(ids) // 4

    def _flush(self) -> None:
        raw = b"".join(self.held)
        packed = self.pack.compress(raw)
        self.out.write(packed)
        self.table.append((len(packed), len(raw), xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF))
        self.held, self.size = [], 0

    def close(self) -> None:
        if self.held:
            self._flush()
        index = self.pack.compress(np.array(self.docs, DOC).tobytes())
        self.out.write(struct.pack("<II", INDEX_FRAME, len(index)) + index)
        rows = b"".join(struct.pack("<III", *x) for x in self.table)
        foot = struct.pack("<IBI", len(self.table), 0x80, SEEK_MAGIC)
        self.out.write(struct.pack("<II", SKIPPABLE, len(rows) + len(foot)) + rows + foot)


class Reader:
    """Reads single documents or all of them, frame by frame."""

    def __init__(self, f, size: int):
        self.f, self.unpack = f, zstandard.ZstdDecompressor()
        f.seek(size - 9)
        n, _, magic = struct.unpack("<IBI", f.read(9))
        if magic != SEEK_MAGIC:
            raise ValueError("no seek table")
        f.seek(size - 9 - 12 * n)
        self.table = np.frombuffer(f.read(12 * n), "<u4").reshape(n, 3).astype(np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.table[:, 0])])
        f.seek(int(self.starts[-1]))
        magic, length = struct.unpack("<II", f.read(8))
        if magic != INDEX_FRAME:
            raise ValueError("no document index")
        self.docs = np.frombuffer(self.unpack.decompress(f.read(length)), DOC)
        self._at, self._raw = -1, b""

    def frame(self, i: int) -> bytes:
        if i != self._at:
            self.f.seek(int(self.starts[i]))
            raw = self.unpack.decompress(self.f.read(int(self.table[i, 0])), max_output_size=int(self.table[i, 1]))
            if xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF != self.table[i, 2]:
                raise ValueError(f"frame {i} is damaged")
            self._at, self._raw = i, raw
        return self._raw

    def document(self, place: int) -> bytes:
        """The ids (bytes) of the document at this place of the index; only its frame is decompressed."""
        d = self.docs[place]
        a = int(d["start"]) * 4
        return self.frame(int(d["frame"]))[a:a + int(d["n"]) * 4]


# ---- encoding ----

#: Marks that NFC and lower case neither make of other characters nor change, except by a mark that composes.
MARKS = regex.compile(r"[!-/:<-@\[-_{-~]+")
LATIN = regex.compile(r"[\x21-\x7e\xa1-\xff]+")


class WordEncoder:
    """The tokenizers library over the different pieces of a batch of texts, with a bounded cache.

    Words of Latin-1 letters are cut into the tokenizer's own pre-tokens, whose ids are taken from
    one call for many of them: each pre-token ends with an id whose text ends with the word-end mark.
    Other words go to the library whole, and whole texts if the tokenizer is of another kind."""

    def __init__(self, path: str, added: bool = False):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            said = json.load(f)
        self.tok = Tokenizer.from_file(path)
        self.tok.encode_special_tokens = not added
        mark = said["model"].get("end_of_word_suffix")
        steps = (said["pre_tokenizer"] or {}).get("pretokenizers", [])
        plain = said["normalizer"] and [x["type"] for x in said["normalizer"].get("normalizers", [])] == ["NFC", "Replace", "Lowercase"]
        split = next((x["pattern"]["Regex"] for x in steps if x["type"] == "Split" and x["invert"] and x["behavior"] == "Removed"), None)
        # a text without the marks of an added token's string does not hold it; a string without marks may be in any text
        strings = [x["content"] for x in said.get("added_tokens") or []] if added else []
        self.hints = {max(MARKS.findall(x) if plain else [], key=len, default="") for x in strings}
        vocab = said["model"]["vocab"]
        self.ends = np.zeros(max(vocab.values()) + 1, bool)
        if mark:
            self.ends[[i for w, i in vocab.items() if w.endswith(mark)]] = True
        known = mark and plain and split == pretokens.WORD_PATTERN
        self.pieces = pretokens.Pieces(pretokens.cut_words, self._learn, np.dtype("<u4"), CACHE) if known else None

    def _whole(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(x.ids, "<u4") for x in self.tok.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, pieces: list[str]) -> list[np.ndarray]:
        latin = [bool(LATIN.fullmatch(p)) and "<|" not in p for p in pieces]
        out: list[np.ndarray | None] = [None] * len(pieces)
        some = [i for i, x in enumerate(latin) if x]
        for k in range(0, len(some), 2000):
            part = some[k:k + 2000]
            ids = self._whole([" ".join([pieces[i] for i in part])])[0]
            cuts = (np.flatnonzero(self.ends[ids]) + 1).tolist()
            if len(cuts) == len(part):                 # else not one end per pre-token: take them one by one
                for i, a, b in zip(part, [0, *cuts[:-1]], cuts, strict=True):
                    out[i] = ids[a:b]
        left = [i for i, x in enumerate(out) if x is None]
        for i, ids in zip(left, self._whole([pieces[i] for i in left]), strict=True):
            out[i] = ids
        return out

    def encode(self, texts: list[str | None]) -> list[bytes]:
        whole = [i for i, t in enumerate(texts) if t and (self.pieces is None or any(h in t for h in self.hints))]
        skip = set(whole)
        out = self.pieces.encode(["" if i in skip else t or "" for i, t in enumerate(texts)]) if self.pieces else [np.empty(0, "<u4")] * len(texts)
        for i, ids in zip(whole, self._whole([texts[i] for i in whole]), strict=True):
            out[i] = ids
        return [x.tobytes() for x in out]


_ENCODERS: dict = {}


def word_encoder(path: str, added: bool) -> WordEncoder:
    if (path, added) not in _ENCODERS:
        _ENCODERS[path, added] = WordEncoder(path, added)
    return _ENCODERS[path, added]


def _encode(path: str, end_id: int, added: bool):
    end = struct.pack("<I", end_id)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = word_encoder(path, added)
        for b in batches:
            for i in range(0, b.num_rows, 250):
                part = b.slice(i, 250)
                ids = [x + end for x in e.encode(part.column("text").to_pylist())]
                yield pa.RecordBatch.from_arrays([part.column(c) for c in ("place", "doc_id", "h")] + [pa.array(ids, pa.binary())], names=["place", "doc_id", "h", "ids"])
    return run


# ---- writing and reading with Spark ----

def _write(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = pafs.FileSystem.from_uri(folder) if "://" in folder else (pafs.LocalFileSystem(), folder.removeprefix("file:"))
        at, writer, out, names, done = None, None, None, (), []

        def close() -> None:
            writer.close()
            out.close()
            fs.move(*names)
            done.append((at, names[1], len(writer.docs), writer.n_ids))

        for b in batches:
            for place, doc_id, ids in zip(*(b.column(c).to_pylist() for c in ("place", "doc_id", "ids")), strict=True):
                if place != at:
                    if writer:
                        close()
                    at = place
                    final = f"{root}/range-{place:05d}.tok.zst"
                    names = (f"{final}.{uuid.uuid4().hex}", final)
                    out = fs.open_output_stream(names[0])
                    writer = Writer(out)
                writer.add(doc_id, ids)
        if writer:
            close()
        cols = list(zip(*done, strict=True)) or [(), (), (), ()]
        yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int32()), pa.array(cols[1], pa.string()), pa.array(cols[2], pa.int64()), pa.array(cols[3], pa.int64())],
                                         names=["place", "path", "n_docs", "n_ids"])
    return run


def write(docs: DataFrame, tokenizer: str, end_id: int, folder: str, range_rows: int = RANGE_ROWS, added: bool = False) -> DataFrame:
    """Encode the documents and write their files; the manifest (place, path, n_docs, n_ids, first: ids of
    all files before it) has one row per file and is a table."""
    spark = docs.sparkSession
    common.workers(spark)
    rows = docs.count()
    many = max(1, min(rows // range_rows + 1, MOST_RANGES))
    cuts = sorted({int(x) for x in docs.approxQuantile("doc_id", [i / many for i in range(1, many)], 0.2 / many)}) if many > 1 else []
    below = lambda a: F.size(F.filter(a, lambda c: c <= F.col("doc_id")))
    listed = lambda x: F.array(*[F.lit(c).cast("long") for c in x]).cast("array<bigint>")
    d = docs.select("doc_id", "text", common.text_hash().alias("h")).withColumn("step", below(listed(cuts[99::100])) * 100)
    place = F.col("step") + below(F.slice(listed(cuts), F.col("step") + 1, F.lit(100)))
    d = d.withColumn("place", F.when(F.col("doc_id").isNull(), F.lit(0)).otherwise(place).cast("int")).select("place", "doc_id", "h", "text")
    fs, root = pafs.FileSystem.from_uri(folder) if "://" in folder else (pafs.LocalFileSystem(), folder.removeprefix("file:"))
    fs.create_dir(root, recursive=True)
    ids = d.mapInArrow(_encode(tokenizer, end_id, added), "place int, doc_id long, h long, ids binary")
    dealt = ids.repartition(max(common.partitions(spark), len(cuts) + 1), "place").sortWithinPartitions("place", F.col("doc_id").asc_nulls_first(), "h")
    files = common.table(dealt.mapInArrow(_write(folder), "place int, path string, n_docs long, n_ids long"), "token-manifest")
    before = Window.orderBy("place").rowsBetween(Window.unboundedPreceding, -1)      # one row per file
    return files.withColumn("first", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))


def _read(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, _ = pafs.FileSystem.from_uri(folder) if "://" in folder else (pafs.LocalFileSystem(), folder)
        for b in batches:
            for path, first in zip(b.column("path").to_pylist(), b.column("first").to_pylist(), strict=True):
                with fs.open_input_file(path) as f:
                    r = Reader(f, f.size())
                    starts = first + np.concatenate([[0], np.cumsum(r.docs["n"].astype(np.int64))])[:-1]
                    crc = [zlib.crc32(r.document(i)) for i in range(len(r.docs))]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(r.docs["doc_id"].astype(np.int64), pa.int64(), mask=r.docs["known"] == 0), pa.array(starts.astype(np.int64)),
                         pa.array(r.docs["n"].astype(np.int64)), pa.array(crc, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])
    return run


def read(manifest: DataFrame, folder: str) -> DataFrame:
    """Per document of the files: doc_id, start, n_tokens, ids_crc32."""
    n = max(1, min(manifest.count(), common.partitions(manifest.sparkSession)))
    files = manifest.select("path", "first").repartition(n)
    return files.mapInArrow(_read(folder), "doc_id long, start long, n_tokens long, ids_crc32 long")


def find(path: str, wanted: set[int]) -> dict[int, bytes]:
    """The ids of some documents of one file."""
    fs, p = pafs.FileSystem.from_uri(path) if "://" in path else (pafs.LocalFileSystem(), path)
    with fs.open_input_file(p) as f:
        r = Reader(f, f.size())
        return {int(d["doc_id"]): r.document(i) for i, d in enumerate(r.docs) if int(d["doc_id"]) in wanted and d["known"]}


def pack(rows: list[tuple[int | None, bytes]], frame: int = FRAME) -> bytes:
    """A file's bytes from (doc_id, ids) in ascending order."""
    out = io.BytesIO()
    w = Writer(out, frame)
    for doc_id, ids in rows:
        w.add(doc_id, ids)
    w.close()
    return out.getvalue()


def round_trip(docs: DataFrame, tokenizer: str, end_id: int) -> DataFrame:
    """Write the documents' files below ``spark.checkpoint.dir`` and read them back; ids are the library's by default."""
    folder = common.shared_folder(docs.sparkSession, "tokens")
    return read(common.table(write(docs, tokenizer, end_id, folder, added=True), "token-files"), folder)
