"""CTR models on the training vectors (pyspark.ml).

The assembled training set is cut from its lineage (a parquet table in
spark.checkpoint.dir, partitioned by the split flag) before fitting, so the iterative solvers re-read a
materialised table instead of re-running the five enrichment joins, and a lost
executor costs a re-read, not a recomputation.
"""

from __future__ import annotations

import uuid

from pyspark import StorageLevel
from pyspark.ml.classification import (GBTClassificationModel, GBTClassifier, LogisticRegression,
                                       LogisticRegressionModel)
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, SparkSession, functions as F

from clickfeat.functions.random import hash_uniform
from clickfeat.operators.boosting import BoostedTrees
from clickfeat.schemas import FEATURE_COLUMNS
from clickfeat.session import checkpoint_dir, detached, estimated_bytes, materialize

# Published solver settings.
LR_MAX_ITER = 100
LR_TOL = 1e-6
GBT_MAX_ITER = 100
GBT_MAX_DEPTH = 3
GBT_STEP = 0.1
GBT_MAX_BINS = 32
TRAIN_SHARE = 0.7
# Bytes of the written training table per partition: the count follows from the data, not from the machine, so that
# fits agree on any machine.  At least MODEL_PARTITIONS.
MODEL_BYTES = 32 << 20
MODEL_PARTITIONS = 16
# Names of the columns of the node table.
NODE_COLUMNS = ["tree", "node", "feature", "threshold", "left", "right", "value", "gain", "impurity", "rows", "weight"]


def assemble(vectors: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """(keep..., label double, features vector) in the fixed feature order."""
    base = vectors.select(*(keep or []), F.col("label").cast("double").alias("label"),
                          *[F.col(c).cast("double").alias(c) for c in FEATURE_COLUMNS])
    return VectorAssembler(inputCols=FEATURE_COLUMNS, outputCol="features").transform(base).drop(*FEATURE_COLUMNS)


def split_flag(df: DataFrame, key_cols: list[str], seed: int = 42, share: float = TRAIN_SHARE) -> DataFrame:
    """Adds is_train (1/0) from a seeded uniform of the row key: stable across
    runs, partitionings and retries."""
    return df.withColumn("is_train", (hash_uniform(seed, F.lit("split"), *key_cols) < share).cast("int"))


def _fitted(estimator, train: DataFrame):
    """``estimator`` fitted on ``train``, whose rows are dealt and sorted once: a solver takes several passes over its
    input, each of which would deal and sort them again.  On disk, so that the solver's own tables have the memory."""
    if train.storageLevel.useDisk or train.storageLevel.useMemory:
        return estimator.fit(train)
    kept = train.persist(StorageLevel.DISK_ONLY)
    try:
        return estimator.fit(kept)
    finally:
        kept.unpersist()


def fit_lr(train: DataFrame) -> LogisticRegressionModel:
    """Binary logistic regression by L-BFGS, no intercept, no regularisation.  The model comes without its training summary."""
    lr = LogisticRegression(maxIter=LR_MAX_ITER, regParam=0.0, elasticNetParam=0.0, fitIntercept=False,
                            tol=LR_TOL, featuresCol="features", labelCol="label")
    return detached(_fitted(lr, train))


def fit_gbt(train: DataFrame, max_iter: int = GBT_MAX_ITER, seed: int = 42) -> GBTClassificationModel:
    """Gradient-boosted trees, log loss, all features continuous (see operators/boosting.py)."""
    gbt = GBTClassifier(maxIter=max_iter, maxDepth=GBT_MAX_DEPTH, stepSize=GBT_STEP, maxBins=GBT_MAX_BINS,
                        seed=seed, featuresCol="features", labelCol="label")
    return _fitted(BoostedTrees(gbt), train)


def lr_model_row(spark: SparkSession, model: LogisticRegressionModel) -> DataFrame:
    """One row (weights array<double>, bias double) -- the published JSON shape."""
    return spark.createDataFrame([(model.coefficients.toArray().tolist(), float(model.intercept))],
                                 "weights array<double>, bias double")


def test_error(predictions: DataFrame) -> DataFrame:
    """(n_test, n_errors, test_error) from (label, prediction) rows."""
    return predictions.agg(
        F.count(F.lit(1)).alias("n_test"),
        F.sum((F.col("label") != F.col("prediction")).cast("bigint")).alias("n_errors"),
        F.avg((F.col("label") != F.col("prediction")).cast("double")).alias("test_error"))


def score_fixed(assembled_or_vectors: DataFrame, weights: list[float], threshold: float = 0.5) -> DataFrame:
    """Intercept-free logistic score with given weights, as columns:
    probability = 1 / (1 + exp(-w.x)), prediction = probability > threshold."""
    margin = None
    for w, c in zip(weights, FEATURE_COLUMNS):
        term = F.lit(float(w)) * F.col(c).cast("double")
        margin = term if margin is None else margin + term
    p = F.lit(1.0) / (F.lit(1.0) + F.exp(-margin))
    return assembled_or_vectors.withColumn("probability", p).withColumn(
        "prediction", (F.col("probability") > threshold).cast("double"))


def tree_nodes(spark: SparkSession, model: GBTClassificationModel) -> DataFrame:
    """The whole ensemble as a table, one row per node: tree, node (0 is the root), feature (-1 in a leaf), threshold (rows
    with a value of at most that go left), left, right, value, gain, impurity, rows, weight of the tree."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/tables/gbt-{uuid.uuid4().hex}"
    model.write().save(path)
    saved = spark.read.parquet(f"{path}/data")
    n, split = F.col("nodeData"), F.col("nodeData.split")
    leaf = n["leftChild"] < 0
    weights = F.array(*[F.lit(float(w)) for w in model.treeWeights])
    return saved.select(
        F.col("treeID").alias("tree"), n["id"].alias("node"), F.when(leaf, -1).otherwise(split["featureIndex"]).alias("feature"),
        F.when(~leaf, F.get(split["leftCategoriesOrThreshold"], F.lit(0))).alias("threshold"),
        n["leftChild"].alias("left"), n["rightChild"].alias("right"), n["prediction"].alias("value"),
        F.when(~leaf, n["gain"]).alias("gain"), n["impurity"].alias("impurity"), n["rawCount"].alias("rows"),
        F.get(weights, F.col("treeID")).alias("weight"))


def score_nodes(vectors: DataFrame, nodes: DataFrame, threshold: float = 0.5) -> DataFrame:
    """``vectors`` (with FEATURE_COLUMNS) scored from a node table, as columns: margin = sum of weight * value of the leaf a
    row reaches in every tree, probability = 1 / (1 + exp(-2 margin)), prediction = probability > threshold.

    The ensemble (as many nodes as the solver's settings allow) becomes one column expression, so rows are neither
    joined nor repeated per tree."""
    by_tree: dict[int, dict[int, object]] = {}
    for r in nodes.collect():
        by_tree.setdefault(r["tree"], {})[r["node"]] = r

    def walk(tree: dict, at: int) -> F.Column:
        r = tree[at]
        if r["feature"] < 0:
            return F.lit(float(r["value"]))
        x = F.col(FEATURE_COLUMNS[r["feature"]]).cast("double")
        return F.when(x <= F.lit(float(r["threshold"])), walk(tree, r["left"])).otherwise(walk(tree, r["right"]))

    margin = F.lit(0.0)
    for _, tree in sorted(by_tree.items()):
        margin = margin + F.lit(float(tree[0]["weight"])) * walk(tree, 0)
    scored = vectors.withColumn("margin", margin)
    p = F.lit(1.0) / (F.lit(1.0) + F.exp(F.lit(-2.0) * F.col("margin")))
    return scored.withColumn("probability", p).withColumn("prediction", (F.col("probability") > threshold).cast("double"))


def gbt_summary(spark: SparkSession, model: GBTClassificationModel) -> DataFrame:
    """One row: sizes, importances and the full text dump of the trees."""
    return spark.createDataFrame(
        [(int(model.getNumTrees), int(model.totalNumNodes), len(model.toDebugString),
          model.featureImportances.toArray().tolist(), model.toDebugString)],
        "num_trees int, total_nodes int, debug_chars int, feature_importances array<double>, debug_string string")


def partitions_for(table: DataFrame) -> int:
    """Partitions of a written training table, from its bytes."""
    return max(MODEL_PARTITIONS, -(-estimated_bytes(table) // MODEL_BYTES))


def materialised_split(vectors: DataFrame, key_cols: list[str], seed: int = 42, partitions: int | None = None):
    """Assembled train/test sets from one written table.  The training rows are dealt by their key into
    ``partitions`` (by default from the table's bytes) sorted partitions, so a fit does not depend on the machine's cores
    or file splits."""
    assembled = materialize(split_flag(assemble(vectors, keep=key_cols), key_cols, seed), "training_set", partition_by=["is_train"])
    train = assembled.where(F.col("is_train") == 1).drop("is_train")
    n = partitions or partitions_for(train)
    return (train.repartition(n, *key_cols).sortWithinPartitions(*key_cols, "label"),
            assembled.where(F.col("is_train") == 0).drop("is_train"))
