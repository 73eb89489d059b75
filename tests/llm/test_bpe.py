import hashlib
import random

import numpy as np
import public_tokenizers as P
import tiktoken

from clickfeat.llm import bpe
from util import edge_rows, frame

PATH = P.path("byte_bpe_50k.tiktoken")
RANKS = bpe.load_ranks(PATH)
REAL = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=RANKS, special_tokens={})


def texts(n=400):
    rng = random.Random(8)
    parts = ["the", " ", "  ", "\n", "\t", " ", "\x85", "\x1c", "é", "é", "字", "\U0001F600", "'s", "'ll", "don't", "123", "4", "...", "--", "²", "\x00",
             "<|endoftext|>", "ability", "unthinkable", "xqzj", "Σς", "\r\n", "a", "Ab", "‍"]
    return ["".join(rng.choice(parts) + rng.choice(["", "", " "]) for _ in range(rng.randint(0, 30))) for _ in range(n)]


def test_like_the_library():
    e = bpe.Encoder(RANKS, P.PATTERN)
    for t in [*texts(), *(r[1] or "" for r in edge_rows())]:
        ids = e.encode([t])[0].tolist()
        if len(t) < 60_000 or " " in t:
            assert ids == REAL.encode_ordinary(t), t[:100]
        assert e.bpe.decode(ids) == t.encode()


def test_small_caches_change_nothing(monkeypatch):
    monkeypatch.setattr(bpe, "CACHE", 5)
    e = bpe.Encoder(RANKS, P.PATTERN)
    for t in texts(100):
        assert e.encode([t])[0].tolist() == REAL.encode_ordinary(t)


def test_appends_and_edits_are_exact():
    rng = random.Random(4)
    b = bpe.Bpe(RANKS)
    piece = bpe.Piece(b, b"internationalisation")
    for _ in range(300):
        if rng.random() < 0.4:
            piece.append(bytes(rng.choice(b"aeinrst the") for _ in range(rng.randint(0, 6))))
        else:
            a = rng.randint(0, len(piece.data))
            z = rng.randint(a, min(len(piece.data), a + 5))
            again = piece.edit(a, z, bytes(rng.choice(b"aeinrst the") for _ in range(rng.randint(0, 5))))
            assert again <= len(piece.data)
        assert piece.last == bpe.Piece(b, piece.data).last
        assert piece.ids() == b.merged(piece.data) and b.decode(piece.ids()) == piece.data


def test_pair_rule_equals_the_merges():
    rng = random.Random(6)
    b = bpe.Bpe(RANKS)
    short = [v for k, v in RANKS.items() if len(k) <= 4]
    words = [b.merged(w.encode()) for w in ("internationalisation", "aaaaaaaaaaaaaaa", "hahahahahaha", "!!!!!!!!!!!!!", "  " * 9, "ababababab")]
    near = {(x, y) for w in words for x in w for y in w} | {(x, x) for x in rng.sample(short, 1500)}
    for x, y in [*near, *((rng.choice(short), rng.choice(short)) for _ in range(6000)), *((rng.randrange(50256), rng.randrange(50256)) for _ in range(6000))]:
        assert b.follows(x, y) == (b.merged(b.tokens[x] + b.tokens[y]) == [x, y]), (b.tokens[x], b.tokens[y])


def test_long_word_takes_little_time():
    import time
    b = bpe.Bpe(RANKS)
    rng = random.Random(1)
    word = "".join(rng.choice("etaoinshrdlu") for _ in range(40_000)).encode()
    b.encode(word[:4000])
    start = time.process_time()
    ids = b.encode(word)
    assert time.process_time() - start < 1.0
    assert ids == REAL.encode_ordinary(word.decode()) and b.decode(ids) == word


def test_an_edit_far_from_the_end_is_local():
    b = bpe.Bpe(RANKS)
    piece = bpe.Piece(b, b"abcdefghijklmnopqrstuvwxyz" * 60)
    assert piece.edit(30, 32, b"zz") < 600
    assert piece.ids() == b.merged(piece.data)


def test_digests(spark):
    rows = edge_rows() + [(100 + i, t) for i, t in enumerate(texts(60))]
    got = sorted((r.doc_id is None, r.doc_id or 0, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bpe.digests(frame(spark, rows), PATH, P.PATTERN).collect())
    want = []
    for r in rows:
        ids = REAL.encode_ordinary(r[1] or "")
        want.append((r[0] is None, r[0] or 0, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((r[1] or "").encode()).hexdigest()))
    assert got == sorted(want)
    assert bpe.digests(frame(spark, []), PATH, P.PATTERN).count() == 0
    ids = {r.doc_id: r.ids for r in bpe.encode(frame(spark, [(1, "hello world")]), PATH, P.PATTERN).collect()}
    assert np.frombuffer(bytes(ids[1]), "<u4").tolist() == REAL.encode_ordinary("hello world")
