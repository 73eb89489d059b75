"""Word2Vec vocabulary and neighbour properties."""

from pyspark.sql import functions as F

from clickfeat.operators import text as tx
from clickfeat.operators.neighbours import word_neighbours
from clickfeat.operators.word2vec import fit_word2vec, word_vectors
from clickfeat.sources.fixtures import ad_view
from conftest import SF_CHECK


def test_vocabulary_and_synonym_counts(spark):
    words = tx.sentence_words(tx.sentences(ad_view(spark, SF_CHECK)))
    model = fit_word2vec(words)
    vec = word_vectors(model)
    vocab = {r.word for r in tx.vocabulary(words, 5).collect()}
    assert {r.word for r in vec.collect()} == vocab
    nb = word_neighbours(vec, k=5)
    per = {r.word: r.n for r in nb.groupBy("word").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert set(per) == vocab and all(n == min(5, len(vocab) - 1) for n in per.values())
    assert nb.where("word = synonym").count() == 0
    # similarities are non-increasing with rank
    rows = sorted(((r.word, r.rank, r.similarity) for r in nb.collect()))
    for (w1, r1, s1), (w2, r2, s2) in zip(rows, rows[1:]):
        if w1 == w2:
            assert s1 >= s2


def test_single_partition_parity_option_is_deterministic(spark):
    words = tx.sentence_words(tx.sentences(ad_view(spark, SF_CHECK)))
    a = {r.word: r.vector for r in word_vectors(fit_word2vec(words, num_partitions=1)).collect()}
    b = {r.word: r.vector for r in word_vectors(fit_word2vec(words, num_partitions=1)).collect()}
    assert a == b and set(a) == {r.word for r in tx.vocabulary(words, 5).collect()}
    assert all(len(v) == 10 for v in a.values())
