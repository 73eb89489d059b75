"""Word2Vec embeddings (pyspark.ml) with the published training settings."""

from __future__ import annotations

from pyspark.ml.feature import Word2Vec, Word2VecModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame

from clickfeat.session import estimated_bytes, materialize

# Skip-gram settings of the published model.
W2V_VECTOR_SIZE = 10
W2V_MIN_COUNT = 5
W2V_STEP_SIZE = 0.02
W2V_SEED = 2017
# Bytes of the written corpus per training partition.  The count follows from the corpus, not from the cores.  A corpus of
# one partition gives the same vectors each time; with more, the library's tasks update vectors in an order that changes from
# run to run, so vectors agree within a tolerance only.
W2V_BYTES = 64 << 20


def partitions_for(corpus: DataFrame) -> int:
    return max(1, -(-estimated_bytes(corpus) // W2V_BYTES))


def fit_word2vec(words: DataFrame, col: str = "words", num_partitions: int | None = None, max_iter: int = 1,
                 window_size: int = 5) -> Word2VecModel:
    """Skip-gram training over ``num_partitions`` tasks (by default from the bytes of the written corpus).  The sentences are
    dealt by their own hash and sorted, so with one partition the vectors do not depend on cores or file splits."""
    words = materialize(words.select(col), "corpus")
    num_partitions = num_partitions or partitions_for(words)
    words = words.repartition(num_partitions, col).sortWithinPartitions(col)
    w2v = Word2Vec(vectorSize=W2V_VECTOR_SIZE, minCount=W2V_MIN_COUNT, stepSize=W2V_STEP_SIZE,
                   seed=W2V_SEED, maxIter=max_iter, numPartitions=num_partitions, windowSize=window_size,
                   inputCol=col, outputCol="_w2v")
    return w2v.fit(words)


def word_vectors(model: Word2VecModel) -> DataFrame:
    """(word, vector array<double>)."""
    return model.getVectors().select("word", vector_to_array("vector").alias("vector"))
