"""Packing: pieces cover every document once, sequences are gapless and full, ids are the library's."""

import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers as P
import pytest
import regex
from llm.util import edge_rows, frame
from tokenizers import Tokenizer

from clickfeat.llm import common, packing, pretokens
from clickfeat.llm.queries import QUERIES
from conftest import SF_SMALL

FILE = P.path("byte_bpe_50k.json")


def ids_of(texts):
    return [[*x.ids, 0] for x in Tokenizer.from_file(FILE).encode_batch([t or "" for t in texts], add_special_tokens=False)]


def check(rows, docs, size=1024):
    """rows: pieces; docs: (doc_id, ids).  Returns padding and the number of cuts."""
    by_doc = defaultdict(list)
    seqs = defaultdict(list)
    for r in rows:
        by_doc[r.doc_id, r.doc_tokens].append(r)
        seqs[r.sequence_id].append((r.offset, r.length))
    left = defaultdict(list)
    for doc_id, ids in docs:
        left[doc_id, len(ids)].append(ids)
    assert set(by_doc) == set(left)
    for key, pieces in by_doc.items():
        same = left[key]
        want = sorted((a, b, zlib.crc32(np.array(ids[a:a + b], "<u4").tobytes()))
                      for ids in same for a, b in {(r.start, r.length) for r in pieces})
        got = sorted((r.start, r.length, r.ids_crc32) for r in pieces)
        if len(same) == 1:
            assert got == want
            assert [a for a, _, _ in got] == [0, *np.cumsum([b for _, b, _ in got])[:-1].tolist()]
        else:
            assert set(got) <= set(want)
        assert sum(r.length for r in pieces) == key[1] * len(same)
    padding = 0
    for parts in seqs.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end and length > 0
            end += length
        assert end <= size
        padding += 0 if end & (end - 1) == 0 else size - end
    return padding, len(rows)


def test_query_packs_every_document(spark):
    docs = common.documents(spark, SF_SMALL).collect()
    rows = QUERIES["op12_packing"](spark, SF_SMALL).collect()
    ids = ids_of([r.text for r in docs])
    padding, pieces = check(rows, list(zip([r.doc_id for r in docs], ids, strict=True)))
    assert padding == 0
    least = sum(-(-len(x) // 1024) for x in ids)
    assert least <= pieces <= 1.5 * least
    assert {r.sequence_id for r in rows} == set(range(len({r.sequence_id for r in rows})))


def test_odd_rows(spark):
    rows = [*edge_rows(), (30, "a <|endoftext|> b", "en", "a"), (31, "don't 've it's 'till  x", "en", "a"), (32, "x" * 1023, "en", "a")]
    got = packing.pack(frame(spark, rows), FILE, P.PATTERN, 0).collect()
    ids = ids_of([r[1] for r in rows])
    padding, _ = check(got, list(zip([r[0] for r in rows], ids, strict=True)))
    assert padding == 0
    assert 50256 in ids[-3]
    assert packing.pack(frame(spark, []), FILE, P.PATTERN, 0).collect() == []


def test_many_equal_lengths_and_a_small_window(spark):
    """A third of all rests have one length that no combination fills."""
    rng = random.Random(8)
    rows = [(i, " ".join(["a"] * (44 if i % 3 == 0 else rng.randint(1, 200)))) for i in range(300)]
    got = packing.pack(frame(spark, rows), FILE, P.PATTERN, 0, size=64).collect()
    padding, _ = check(got, list(zip([r[0] for r in rows], ids_of([r[1] for r in rows]), strict=True)), 64)
    assert padding == 0


@pytest.mark.parametrize("seed", range(12))
def test_plan(seed):
    rng = np.random.default_rng(seed)
    counts = np.zeros(256, np.int64)
    some = rng.integers(1, 256, rng.integers(1, 90))
    counts[some] = rng.integers(1, [3, 30, 300][seed % 3], len(some))
    plan = packing.Plan(counts, 256)
    seqs = defaultdict(list)
    for v in np.flatnonzero(counts).tolist():
        for rank in range(counts[v]):
            if rank < plan.row_first[v]:
                s, o = plan.place(np.array([v]), np.array([rank]))
                parts = [(0, v, int(s[0]), int(o[0]))]
            else:
                parts = plan.cuts(v, rank)
            assert sum(p[1] for p in parts) == v
            for _, n, s, o in parts:
                seqs[s].append((o, n))
    assert sorted(seqs) == list(range(plan.sequences))
    for s, parts in seqs.items():
        end = 0
        for o, n in sorted(parts):
            assert o == end
            end += n
        assert end == 256 or s >= plan.row_seq + plan.whole and end & (end - 1) == 0


def test_least_squares():
    """A histogram made of combinations is met; the result is a least-squares optimum (no descent is left)."""
    rng = np.random.default_rng(3)
    columns = packing.combinations(np.arange(1, 64), 64)
    assert all(sum(c) == 64 for c in columns.tolist()) and len({tuple(c) for c in columns.tolist()}) == len(columns)
    made = np.zeros(64)
    for j in rng.choice(len(columns), 30, replace=False):
        for v in columns[j]:
            made[v] += 10 * (v > 0)
    x = packing.nnls(columns, made)
    fit = np.bincount(columns.ravel(), np.repeat(x, 3), 64)
    assert (x >= 0).all() and np.abs(fit - made)[1:].max() < 0.05
    odd = np.zeros(64)
    odd[[10, 54, 7]] = 7, 3, 9                         # 10 + 54 is the only combination
    x = packing.nnls(packing.combinations(np.array([7, 10, 54]), 64), odd)
    assert np.allclose(x, [5.0])


def test_pre_tokens_equal_the_pattern():
    assert pretokens.PATTERN == P.PATTERN
    find = regex.compile(P.PATTERN).findall
    rng = random.Random(2)
    letters = "'  \n\t stmdrevl'' a1é²!. 　字\x1c\x85​\U0001F600"
    for _ in range(4000):
        texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 14))) for _ in range(5)]
        pieces, counts = pretokens.cut(texts, P.PATTERN)
        assert pieces.to_pylist() == [p for t in texts for p in find(t)] and counts.tolist() == [len(find(t)) for t in texts]
    every = "".join(chr(c) + "a " for c in range(0x3000))
    assert pretokens.cut([every], P.PATTERN)[0].to_pylist() == find(every)


def test_words_equal_the_pattern():
    find = regex.compile(pretokens.WORD_PATTERN).findall
    rng = random.Random(3)
    letters = "''  \n\tstmdrevlÀé²!.1½ªµß'×<>|"
    for _ in range(4000):
        texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 14))) for _ in range(5)]
        pieces, counts = pretokens.cut_words(texts)
        want = [[p for w in t.split() for p in ([w] if "<|" in w else find(w.lower()))] for t in texts]
        assert pieces.to_pylist() == [p for x in want for p in x] and counts.tolist() == [len(x) for x in want]


def test_long_texts_are_cut_safely(monkeypatch):
    monkeypatch.setattr(pretokens, "BLOCK", 50)
    rng = random.Random(5)
    texts = ["".join(rng.choice("ab' .\n") for _ in range(n)) for n in (0, 400, 30, 51, 120)]
    e = packing.Encoder(FILE, P.PATTERN)
    assert [[*x.tolist(), 0] for x in e.encode(texts)] == ids_of(texts)
