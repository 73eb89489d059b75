import zlib

from pyspark.sql import functions as F

from clickfeat.llm import common, langid
from conftest import SF_CHECK
from util import edge_rows, frame


def test_held_out_accuracy(spark):
    docs = common.documents(spark, SF_CHECK)
    got = {r.doc_id: r for r in langid.languages(docs).collect()}
    rows = docs.select("doc_id", "lang", "text").collect()
    assert len(got) == len(rows)
    for r in rows:
        assert got[r.doc_id].held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
    test = [r for r in rows if got[r.doc_id].held_out]
    right = [got[r.doc_id].lang_pred == r.lang for r in test]
    assert len(right) > 100 and sum(right) / len(right) >= 0.97
    assert all(0 <= r.score <= 1 for r in got.values())
    # nothing but the text decides: other labels, ids and sources for the held-out rows change nothing
    other = docs.withColumn("lang", F.when(langid.held_out(F.col("doc_id")), F.lit("xx")).otherwise(F.col("lang"))).withColumn("source", F.lit("q"))
    assert {r.doc_id: (r.lang_pred, r.score) for r in langid.languages(other).collect()} == {k: (r.lang_pred, r.score) for k, r in got.items()}


def test_clean_documents_stay(spark):
    docs = common.documents(spark, SF_CHECK)
    kept = langid.known_language(docs)
    assert kept.columns == docs.columns and kept.schema == docs.schema
    assert kept.count() >= 0.97 * docs.count()


def test_edges(spark):
    rows = edge_rows()
    docs = frame(spark, rows)
    got = langid.languages(docs).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got if r.doc_id is not None}
    assert all(by[i].lang_pred == "und" and by[i].score == 0 for i in (3, 4, 5, 11))
    assert by[1].lang_pred in ("en", "de", "fr", "es")
    assert langid.known_language(docs).columns == docs.columns
    assert langid.languages(frame(spark, [])).count() == 0
    none = langid.languages(frame(spark, [(1, "no label here", None)])).collect()
    assert none[0].lang_pred == "und"


def test_tables_equal_the_network():
    import numpy as np
    rng = np.random.default_rng(0)
    p = langid.init(3, 5)
    x = rng.integers(0, 256, (40, langid.WINDOW)).astype(np.uint8)
    x[3, 10:] = 0
    z = langid._forward(p, x)[2]
    assert np.allclose(langid.Net(p).probabilities(x), langid.softmax(z), atol=1e-4)


def test_windows_cover_the_whole_text(spark):
    """The end of a long text counts."""
    docs = common.documents(spark, SF_CHECK)
    params, langs = langid.fit(docs)
    text = {r.lang: r.text for r in docs.filter("n_chars > 3000").select("lang", "text").collect()}
    mixed = text["en"][:1000] + " " + text["de"][:2900] * 3
    assert langid.predict(params, langs, [mixed])[0][0] == "de"
