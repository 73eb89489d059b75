import io
import struct
import zlib

import numpy as np
import public_tokenizers as P
import pytest
import zstandard
from tokenizers import Tokenizer

from clickfeat.llm import common, token_files as tf
from conftest import SF_SMALL
from test_bpe import texts
from util import edge_rows, frame

PATH = P.path("word_bpe_49k.json")
REAL = Tokenizer.from_file(PATH)
REAL.encode_special_tokens = True


def ids_of(text):
    return REAL.encode(text or "", add_special_tokens=False).ids


def raw(ids):
    return np.array(ids, "<u4").tobytes()


def test_words_are_encoded_like_whole_texts(spark, monkeypatch):
    e = tf.WordEncoder(PATH)
    some = [*texts(), *(r[1] for r in edge_rows()), *(r.text for r in common.documents(spark, SF_SMALL).collect())]
    some += ["ÀÉ Straße ªº µ² ¼x İstanbul ΣΑΣ ﬁne ẹ́ x\xa0y", "it's we'll DON'T 'S s's", "a'b''c 12ab34 ..!?"]
    for i in range(0, len(some), 50):
        for t, got in zip(some[i:i + 50], e.encode(some[i:i + 50])):
            assert np.frombuffer(got, "<u4").tolist() == ids_of(t), (t or "")[:80]
    monkeypatch.setattr(tf, "CACHE", 3)
    for t in some[:60]:
        assert np.frombuffer(e.encode([t])[0], "<u4").tolist() == ids_of(t)


def test_file_format():
    rows = [(i, raw(range(i, i + (i * 37) % 900))) for i in range(200)] + [(None, raw([1])), (500, b"")]
    data = tf.pack(rows, frame=1000)
    r = tf.Reader(io.BytesIO(data), len(data))
    assert len(r.table) > 5 and [r.document(i) for i in (150, 3, 200, 201)] == [rows[i][1] for i in (150, 3, 200, 201)]
    # any zstandard reader sees the documents one after another
    got = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(data), read_across_frames=True).read()
    assert got == b"".join(x[1] for x in rows)
    n, flags, magic = struct.unpack("<IBI", data[-9:])
    assert n == len(r.table) and flags == 0x80 and magic == 0x8F92EAB1
    bad = bytearray(data)
    bad[int(r.starts[2]) + 30] ^= 1
    r = tf.Reader(io.BytesIO(bytes(bad)), len(bad))
    r.frame(1)
    with pytest.raises((ValueError, zstandard.ZstdError)):
        r.frame(2)


def test_only_the_wanted_frame_is_read():
    data = tf.pack([(i, raw(np.random.default_rng(i).integers(0, 40000, 2000))) for i in range(100)], frame=2000)

    class Counted(io.BytesIO):
        n = 0

        def read(self, k=-1):
            out = super().read(k)
            Counted.n += len(out)
            return out
    f = Counted(data)
    r = tf.Reader(f, len(data))
    Counted.n = 0
    r.document(40)
    assert Counted.n == r.table[int(r.docs[40]["frame"]), 0] < len(data) / 10


def test_round_trip(spark):
    rows = [r for r in edge_rows() if r[0] != 6] + [(1000 + 3 * i, t) for i, t in enumerate(texts(120))]
    docs = frame(spark, rows).repartition(5)
    folder = common.shared_folder(spark, "tokens-test")
    manifest = common.table(tf.write(docs, PATH, 2, folder, range_rows=20), "m")
    assert manifest.count() > 3
    got = sorted((r.start, r.doc_id, r.n_tokens, r.ids_crc32) for r in tf.read(manifest, folder).collect())
    at, want = 0, []
    for r in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = [*ids_of(r[1]), 2]
        want.append((at, r[0], len(ids), zlib.crc32(raw(ids))))
        at += len(ids)
    if {w[1] for w in want[:2]} == {None}:             # two null ids: their order is the hash's
        assert {w[1:] for w in want[:2]} == {g[1:] for g in got[:2]}
        want, got = want[2:], got[2:]
    assert got == want
    path = manifest.filter("place = 2").first().path
    ids = tf.find(path, {r.doc_id for r in tf.read(manifest.filter("place = 2"), folder).collect()})
    text = {r[0]: r[1] for r in rows}
    assert ids and all(np.frombuffer(v, "<u4").tolist() == [*ids_of(text[k]), 2] for k, v in ids.items())


def test_empty(spark):
    assert tf.round_trip(frame(spark, []), PATH, 2).count() == 0


def test_added_tokens_like_the_unmodified_library(spark):
    plain = Tokenizer.from_file(PATH)

    def ids(t):
        return plain.encode(t or "", add_special_tokens=False).ids
    assert ids("hello <|endoftext|> world") == [3306, 49407, 1002]
    some = ["hello <|endoftext|> world", "<|startoftext|>one<|endoftext|>two", "a <|ENDOFTEXT|> b <| endoftext |>", "<|endoftext|>", "x <|endoftext|\u0338> y", "  <|endoftext|>\n<|endoftext|> ",
            "no token", None, *texts()]
    e = tf.WordEncoder(PATH, added=True)
    for i in range(0, len(some), 7):
        for t, got in zip(some[i:i + 7], e.encode(some[i:i + 7])):
            assert np.frombuffer(got, "<u4").tolist() == ids(t), t
    rows = [(i, t) for i, t in enumerate(some)]
    at, want = 0, []
    for i, t in rows:
        raw_ids = raw([*ids(t), 2])
        want.append((i, at, len(raw_ids) // 4, zlib.crc32(raw_ids)))
        at += len(raw_ids) // 4
    assert sorted((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in tf.round_trip(frame(spark, rows), PATH, 2).collect()) == want
