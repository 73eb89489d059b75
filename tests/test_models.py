"""Model properties (labels here are synthetic, so no accuracy gain is asserted)."""

import os

import numpy as np
from pyspark.ml.classification import LogisticRegressionModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from clickfeat.operators import models as ml
from clickfeat.operators.enrichment import training_vectors
from clickfeat.schemas import FEATURE_COLUMNS
from clickfeat.sources.fixtures import click_view
from conftest import SF_SMALL

KEY = ["session_id", "device_id", "ad_id"]


def test_lr_score_equations_and_persistence(spark, tmp_dir):
    train, test = ml.materialised_split(training_vectors(click_view(spark, SF_SMALL)), KEY)
    model = ml.fit_lr(train)
    assert model.intercept == 0.0 and len(model.coefficients) == 11
    pdf = model.transform(train).select("label", "features", vector_to_array("probability")[1].alias("p")).toPandas()
    x = np.stack(pdf["features"].map(lambda v: v.toArray()).to_numpy())
    r = (pdf["p"] - pdf["label"]).to_numpy()[:, None] * x
    num = np.abs(r.sum(axis=0))
    den = np.abs(r).sum(axis=0)
    mask = den > 0
    assert np.all(num[mask] / den[mask] < 1e-3)
    row = ml.lr_model_row(spark, model).first()
    assert len(row.weights) == 11 and row.bias == 0.0
    path = os.path.join(tmp_dir, "lr")
    model.write().overwrite().save(path)
    assert LogisticRegressionModel.load(path).coefficients == model.coefficients


def test_gbt_not_worse_than_majority_on_train(spark):
    train, _ = ml.materialised_split(training_vectors(click_view(spark, SF_SMALL)), KEY)
    model = ml.fit_gbt(train, max_iter=5)
    err = ml.test_error(model.transform(train)).first().test_error
    base = train.agg(F.avg("label")).first()[0]
    assert err <= min(base, 1 - base) + 1e-9
    s = ml.gbt_summary(spark, model).first()
    assert s.num_trees == 5 and s.total_nodes > 0


def test_split_is_stable(spark):
    tv = training_vectors(click_view(spark, SF_SMALL))
    a = ml.split_flag(tv, KEY).groupBy("is_train").count().collect()
    b = ml.split_flag(tv.repartition(7), KEY).groupBy("is_train").count().collect()
    assert sorted(map(tuple, a)) == sorted(map(tuple, b))


def test_node_table_scores_like_the_model(spark):
    tv = training_vectors(click_view(spark, SF_SMALL))
    train, test = ml.materialised_split(tv, KEY)
    model = ml.fit_gbt(train, max_iter=6)
    nodes = ml.tree_nodes(spark, model)
    assert nodes.count() == model.totalNumNodes and nodes.columns == ml.NODE_COLUMNS
    rows = nodes.collect()
    assert {r.tree for r in rows} == set(range(6)) and all((r.feature < 0) == (r.left < 0) == (r.threshold is None) for r in rows)
    real = {tuple(r[c] for c in KEY): (r.p, r.prediction) for r in model.transform(ml.assemble(tv, keep=KEY)).select(*KEY, vector_to_array("probability")[1].alias("p"), "prediction").collect()}
    got = {tuple(r[c] for c in KEY): (r.probability, r.prediction) for r in ml.score_nodes(tv, nodes).select(*KEY, "probability", "prediction").collect()}
    assert set(real) == set(got)
    assert all(abs(real[k][0] - got[k][0]) < 1e-12 and real[k][1] == got[k][1] for k in real)
    assert "If (feature" in ml.gbt_summary(spark, model).first().debug_string


def test_partitions_follow_the_data_not_the_cores(spark, tmp_dir, monkeypatch):
    tv = training_vectors(click_view(spark, SF_SMALL))
    ml.assemble(tv, keep=KEY).write.parquet(f"{tmp_dir}/t")
    table = spark.read.parquet(f"{tmp_dir}/t")
    assert ml.partitions_for(table) == ml.MODEL_PARTITIONS
    monkeypatch.setattr(ml, "MODEL_BYTES", 1000)
    assert ml.partitions_for(table) > 3 * ml.MODEL_PARTITIONS


def test_predictions_work_in_a_session_that_has_observed(spark):
    from pyspark.sql import Observation
    rows = spark.range(200).select(*[((F.col("id") * (i + 3)) % (17 + i)).alias(c) for i, c in enumerate(FEATURE_COLUMNS)],
                                   (F.xxhash64("id") % 2 == 0).cast("int").alias("label"))
    seen = Observation("seen")
    spark.range(3).observe(seen, F.count(F.lit(1)).alias("n")).collect()
    assert seen.get["n"] == 3
    model = ml.fit_lr(ml.assemble(rows))
    assert not model.hasSummary
    assert ml.test_error(model.transform(ml.assemble(rows))).first().n_test == 200


def test_a_fit_deals_and_sorts_its_rows_once(spark):
    rows = spark.range(300).select(F.col("id").alias("k"), (F.col("id") % 3 == 0).cast("double").alias("label"))
    train = rows.repartition(5, "k").sortWithinPartitions("k")

    class Solver:
        def fit(self, df):
            assert df.storageLevel.useDisk and not df.storageLevel.useMemory
            return df.rdd.glom().map(lambda p: [r.k for r in p]).collect()

    want = train.rdd.glom().map(lambda p: [r.k for r in p]).collect()
    assert ml._fitted(Solver(), train) == want and len(want) == 5      # the same partitions in the same order
    assert not train.storageLevel.useDisk
