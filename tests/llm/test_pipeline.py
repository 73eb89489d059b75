"""The whole pipeline against a plain version of its stages."""

import hashlib
from collections import Counter, defaultdict

import numpy as np
import pytest

import corpus_pipeline
from clickfeat.llm import common, langid, mixing
from conftest import SF_SMALL
from test_bpe import REAL
from test_exact_dedup import brute as exact
from test_mixing import slow_targets
from test_simhash import brute as near
from util import WORD, edge_rows, frame


def expected(spark, rows, docs):
    from pyspark.sql import functions as F
    params, langs = langid.fit(docs)
    said = langid.predict(params, langs, [r[1] for r in rows])
    rows = [r for r, (lang, score) in zip(rows, said) if lang != "und" and score >= 0.5]
    kept = Counter((d, k) for (d, _, _, stays, k), n in exact(rows).items() if stays for _ in range(n))
    norm = lambda t: hashlib.sha256("".join(WORD.findall(t or "")).encode()).hexdigest()
    after = []
    for r in sorted(rows, key=lambda r: -len(r[1] or "")):
        if kept[r[0], norm(r[1])]:
            kept[r[0], norm(r[1])] -= 1
            after.append(r)
    heads = {x[3] for x in near(after)}
    rows = [r for r in after if r[0] in heads]
    sizes = defaultdict(int)
    for r in rows:
        sizes[r[3]] += len(WORD.findall(r[1] or ""))
    target = slow_targets(sizes)
    key = {r.doc_id: r.k for r in docs.select("doc_id", F.xxhash64(F.lit(mixing.SEED), "doc_id", common.text_hash()).alias("k")).collect()}
    at, out = defaultdict(int), Counter()
    for r in sorted(rows, key=lambda r: key[r[0]]):
        size, s = len(WORD.findall(r[1])), r[3]
        budget = int(target[s] + 1e-9)
        epochs = budget // sizes[s]
        last = min(size, budget - epochs * sizes[s] - at[s])
        at[s] += size
        ids = REAL.encode_ordinary(r[1])
        row = (r[0], len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(r[1].encode()).hexdigest())
        out[row] += epochs + (1 if last > 0 else 0)
    return +out


def test_like_the_plain_version(spark):
    docs = common.documents(spark, SF_SMALL)
    rows = [tuple(r) for r in docs.select("doc_id", "text", "lang", "source").collect()]
    out = corpus_pipeline.run(spark, SF_SMALL)
    assert out.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert Counter(map(tuple, out.collect())) == expected(spark, rows, docs)


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES)
def test_every_stage_takes_odd_rows(spark, name, stage):
    for rows in (edge_rows(), []):
        docs = frame(spark, rows)
        out = stage(spark, docs, SF_SMALL)
        got = out.collect()
        if name != "bpe_encode":
            assert out.columns == docs.columns
            text = {(r[0], r[1]) for r in rows}
            assert all((r.doc_id, r.text) in text for r in got)
        else:
            assert len(got) == len(rows)


def test_no_extra_column_can_clash(spark):
    """Every stage returns the same rows when the documents have columns with the names that operators use inside."""
    from pyspark.sql import functions as F
    names = ["__h", "__id", "__g", "__emit", "__row", "__copy", "__sha", "__n", "__k", "__c", "row", "id", "h", "times", "place", "to_id", "to_h", "to_sha", "to_n", "sha", "n",
             "__part", "__sum", "__before", "__s", "__p", "__inside", "__epochs", "__last", "fp", "leaf", "root", "component_id", "one", "size", "lang_pred", "score", "key", "odd.name", "b`q"]
    plain = frame(spark, [*edge_rows(), *[(100 + i, f"some words number {i % 7} of the river bank and the lazy dog", "en", "abc"[i % 3]) for i in range(40)]], extra=False)
    wide = plain
    for x in names:
        wide = wide.withColumn(x, F.lit("x"))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        a = stage(spark, plain, None)
        b = stage(spark, wide, None)
        assert b.columns == wide.columns, name
        cols = plain.columns
        assert sorted(map(repr, a.select(*cols).collect())) == sorted(map(repr, b.select(*cols).collect())), name
        assert b.filter(F.col("`odd.name`") != "x").count() == 0
    last = corpus_pipeline.STAGES[-1][1]
    assert sorted(map(repr, last(spark, plain, None).collect())) == sorted(map(repr, last(spark, wide, None).collect()))
