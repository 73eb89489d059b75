"""Boosted trees over blocks of binned rows: the trees of pyspark.ml, whatever the layout of the rows."""

import os
import subprocess
import sys

import numpy as np
import pytest
from pyspark import cloudpickle
from pyspark.errors import PySparkException
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.sql import functions as F

from clickfeat.operators import boosting as bo
from clickfeat.operators import models as ml
from clickfeat.schemas import FEATURE_COLUMNS


def rows(spark, n, parts, start=0):
    """Rows with a label that depends on three features; one feature is constant, one mostly zero, one negative."""
    i = F.col("id")
    cols = [(F.xxhash64(i, F.lit(k)) % (23 * (k + 1) ** 2)).cast("double") * (1 if k % 2 else 0.37) for k in range(9)]
    cols += [F.lit(3.0), F.when(i % 9 == 0, F.xxhash64(i) % 5).otherwise(0)]
    df = spark.range(start, start + n, 1, parts).select(i.alias("k"), *[c.alias(name) for c, name in zip(cols, FEATURE_COLUMNS)])
    score = F.col(FEATURE_COLUMNS[3]) * 0.01 - F.col(FEATURE_COLUMNS[6]) * 0.003 + F.col(FEATURE_COLUMNS[1]) * F.col(FEATURE_COLUMNS[2]) * 0.002
    return ml.assemble(df.withColumn("label", (F.pmod(F.xxhash64("k", F.lit("y")), F.lit(1000)) / 1000 < 1 / (1 + F.exp(-score))).cast("int")), ["k"])


def flat(model):
    """(tree, place, feature, threshold, rows) and (value, impurity, gain) of every node."""
    where, what = [], []

    def walk(node, tree, place):
        leaf = node.subtreeDepth() == 0
        where.append((tree, place, *((-1, None) if leaf else (node.split().featureIndex(), node.split().threshold())), node.impurityStats().rawCount()))
        what.append((node.prediction(), node.impurity(), 0.0 if leaf else node.gain()))
        if not leaf:
            walk(node.leftChild(), tree, 2 * place)
            walk(node.rightChild(), tree, 2 * place + 1)
    for t, x in enumerate(model._java_obj.trees()):
        walk(x.rootNode(), t, 1)
    return where, np.array(what)


def test_trees_are_those_of_the_library(spark):
    train = rows(spark, 24_000, 5).cache()                 # more rows than are sampled for the thresholds
    real = GBTClassifier(maxIter=9, maxDepth=3, stepSize=0.1, maxBins=32, seed=42).fit(train)
    got = ml.fit_gbt(train, max_iter=9)
    (a, x), (b, y) = flat(real), flat(got)
    assert a == b
    assert np.abs(x - y).max() < 1e-8
    assert got.treeWeights == real.treeWeights and got.numFeatures == 11 and got.numClasses == 2
    assert np.abs(got.featureImportances.toArray() - real.featureImportances.toArray()).max() < 1e-8
    err = [ml.test_error(m.transform(train)).first().n_errors for m in (real, got)]
    assert err[0] == err[1]
    train.unpersist()


def test_layout_of_the_rows_changes_nothing(spark, monkeypatch):
    train = rows(spark, 6000, 3)                           # all rows give the thresholds
    one = ml.fit_gbt(train, max_iter=7)
    monkeypatch.setattr(bo, "TASK_ROWS", (500, 700))
    monkeypatch.setattr(bo, "BLOCK_ROWS", 128)
    monkeypatch.setattr(bo, "DRIVER_TASKS", 4)
    two = ml.fit_gbt(train.repartition(11).orderBy(F.xxhash64("k")), max_iter=7)
    (a, x), (b, y) = flat(one), flat(two)
    assert a == b and (x == y).all()                       # to the last digit


def test_blocks_are_small_and_whole(spark):
    train, sharp = rows(spark, 3000, 1), [np.array([float(f)]) for f in range(11)]
    blocks = train.select("label", bo.vector_to_array("features").alias("x")).mapInArrow(bo._binned(sharp, 2), "pairs binary, labels binary").collect()
    held = [bo._block(b) for b in blocks]
    assert sum(len(y) for _, y, _ in held) == 3000
    assert sum(len(b.pairs) + len(b.labels) for b in blocks) == 3000 * 13
    x = np.array([r.features.toArray() for r in train.collect()])
    bins = bo._bins(np.hstack([p for p, _, _ in held]), 2)
    assert all((bins(f) == (x[:, f] > f)).all() for f in range(11))


def test_model_can_be_written_and_read(spark, tmp_dir):
    model = ml.fit_gbt(rows(spark, 500, 2), max_iter=3)
    assert model.getMaxIter() == 3 and model.getMaxDepth() == 3
    model.write().save(os.path.join(tmp_dir, "gbt"))
    back = GBTClassificationModel.load(os.path.join(tmp_dir, "gbt"))
    assert flat(back)[0] == flat(model)[0] and (flat(back)[1] == flat(model)[1]).all()
    assert ml.tree_nodes(spark, model).count() == model.totalNumNodes


def test_pure_and_constant_rows(spark):
    same = ml.assemble(spark.range(40).select(*[F.lit(1).alias(c) for c in FEATURE_COLUMNS], (F.col("id") % 4 == 0).cast("int").alias("label")))
    sure = ml.assemble(spark.range(40).select(*[F.col("id").alias(c) for c in FEATURE_COLUMNS], F.lit(1).alias("label")))
    for df in (same, sure):
        real = GBTClassifier(maxIter=2, maxDepth=3, stepSize=0.1, maxBins=32, seed=42).fit(df)
        (a, x), (b, y) = flat(real), flat(ml.fit_gbt(df, max_iter=2))
        assert a == b and np.abs(x - y).max() < 1e-9


def test_refused_rows(spark):
    good = rows(spark, 20, 2)
    for label in (F.lit(None), F.lit(2.0), F.lit(0.5)):
        with pytest.raises(PySparkException):
            ml.fit_gbt(good.withColumn("label", F.when(F.col("k") == 7, label).otherwise(F.col("label"))), max_iter=2)
    with pytest.raises(ValueError):
        ml.fit_gbt(good.where("k < 0"), max_iter=2)


def test_tasks_do_not_need_this_package():
    code = cloudpickle.dumps(bo._root_sums([], False, 3, 2, 4))
    run = "import sys, numpy as np; from pyspark import cloudpickle; f = cloudpickle.loads(sys.stdin.buffer.read());" \
          "print(next(f([(np.array([[5, 6]], np.uint16), np.array([1, -1], np.int8), np.zeros(2))]))[0].shape)"
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", run], input=code, capture_output=True, cwd="/", env=env, timeout=120)
    assert out.stdout.decode().strip() == "(3, 1, 2, 4)", out.stderr.decode()[-2000:]
