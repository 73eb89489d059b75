"""Split, LR, GBT, fixed-weight scoring and error rates."""

from __future__ import annotations

from pyspark.sql import functions as F

from clickfeat.operators import models as ml
from clickfeat.operators.enrichment import training_vectors
from clickfeat.plans.queries_counters import TRAINING_SQL_BODY
from clickfeat.plans.queries_sampling import U
from clickfeat.plans.registry import register, sql_with
from clickfeat.schemas import FEATURE_COLUMNS
from clickfeat.sources.fixtures import click_star

KEY = ["session_id", "device_id", "ad_id"]
# Fixed scoring weights for the SQL-checkable scorer (feature order of FEATURE_COLUMNS).
FIXED_WEIGHTS = [0.002, -0.001, 0.004, -0.002, 0.003, -0.001, 0.02, -0.01, 0.05, -0.02, -0.000001]
GBT_QUERY_ITER = ml.GBT_MAX_ITER   # the published 100 boosting iterations

SPLIT_SQL = f"CAST({U(chr(39) + 'split' + chr(39), 'session_id', 'device_id', 'ad_id')} < 0.7 AS INTEGER)"
TV_CTE = [f"tv AS ({TRAINING_SQL_BODY})"]


def _vectors(spark, sf_dir):
    return training_vectors(click_star(spark, sf_dir))


@register("split_70_30", sql_with(["click"], f"SELECT session_id, device_id, ad_id, label, {SPLIT_SQL} AS is_train FROM tv",
                                  TV_CTE))
def q_split_70_30(spark, sf_dir):
    return ml.split_flag(_vectors(spark, sf_dir).select(*KEY, "label"), KEY)


def _margin_sql() -> str:
    return " + ".join(f"{w!r} * CAST({c} AS DOUBLE)" for w, c in zip(FIXED_WEIGHTS, FEATURE_COLUMNS))


SCORE_SQL = f"""SELECT session_id, device_id, ad_id, CAST(label AS DOUBLE) AS label,
  round(1.0 / (1.0 + exp(-({_margin_sql()}))), 9) AS probability,
  CAST(1.0 / (1.0 + exp(-({_margin_sql()}))) > 0.5 AS DOUBLE) AS prediction
FROM tv WHERE {SPLIT_SQL} = 0"""


@register("lr_score", sql_with(["click"], SCORE_SQL, TV_CTE))
def q_lr_score(spark, sf_dir):
    tv = ml.split_flag(_vectors(spark, sf_dir), KEY).where(F.col("is_train") == 0)
    s = ml.score_fixed(tv, FIXED_WEIGHTS)
    return s.select(*KEY, F.col("label").cast("double").alias("label"),
                    F.round("probability", 9).alias("probability"), "prediction")


@register("error_rate", sql_with(["click"], """SELECT count(*) AS n_test, CAST(sum(CAST(label <> prediction AS INTEGER)) AS BIGINT)
AS n_errors, round(avg(CAST(label <> prediction AS DOUBLE)), 9) AS test_error FROM sc""", TV_CTE + [f"sc AS ({SCORE_SQL})"]))
def q_error_rate(spark, sf_dir):
    tv = ml.split_flag(_vectors(spark, sf_dir), KEY).where(F.col("is_train") == 0)
    e = ml.test_error(ml.score_fixed(tv, FIXED_WEIGHTS).withColumn("label", F.col("label").cast("double")))
    return e.select("n_test", "n_errors", F.round("test_error", 9).alias("test_error"))


@register("lr_weights")
def q_lr_weights(spark, sf_dir):
    train, _ = ml.materialised_split(_vectors(spark, sf_dir), KEY)
    return ml.lr_model_row(spark, ml.fit_lr(train))


@register("lr_error")
def q_lr_error(spark, sf_dir):
    train, test = ml.materialised_split(_vectors(spark, sf_dir), KEY)
    return ml.test_error(ml.fit_lr(train).transform(test))


@register("gbt_error")
def q_gbt_error(spark, sf_dir):
    train, test = ml.materialised_split(_vectors(spark, sf_dir), KEY)
    return ml.test_error(ml.fit_gbt(train, GBT_QUERY_ITER).transform(test))


@register("gbt_summary")
def q_gbt_summary(spark, sf_dir):
    train, _ = ml.materialised_split(_vectors(spark, sf_dir), KEY)
    return ml.gbt_summary(spark, ml.fit_gbt(train, GBT_QUERY_ITER))


@register("gbt_nodes")
def q_gbt_nodes(spark, sf_dir):
    """Every node of the fitted ensemble, one row each."""
    train, _ = ml.materialised_split(_vectors(spark, sf_dir), KEY)
    return ml.tree_nodes(spark, ml.fit_gbt(train, GBT_QUERY_ITER))
