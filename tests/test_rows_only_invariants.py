"""Invariants of the queries that have no SQL oracle (models, sampling, SVD)."""

import math

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def q():
    return E.queries()


def test_svd_recommend_top3(spark, q):
    df = q["svd_recommend"](spark, SF_SMALL)
    per_user = df.groupBy("IDNUMBER").agg(F.count("*").alias("n"), F.max("rank").alias("mx")).collect()
    assert per_user and all(r.n == r.mx <= 3 for r in per_user)
    assert all(math.isfinite(r.PUNTUACION) for r in df.select("PUNTUACION").collect())


def test_svd_rmse_values(spark, q):
    for name in ("svd_rmse", "svd_block_rmse"):
        r = q[name](spark, SF_SMALL).first()
        # ratings are 0..4 and the prediction falls back on the user's mean
        assert r.n_cells > 0 and 0 < r.rmse < 2


def test_sampled_block_sizes(spark, q):
    df = q["sampled_block"](spark, SF_SMALL)
    assert df.select("USUARIO").distinct().count() <= 100
    assert df.select("CURID").distinct().count() <= 10


def test_stratified_split_exact_shares(spark, q):
    rows = q["stratified_split"](spark, SF_SMALL).groupBy("CUMPLIMIENTO").agg(
        F.count("*").alias("n"), F.sum(F.col("is_train").cast("int")).alias("t")).collect()
    assert rows and all(r.t == math.floor(r.n * 0.8) for r in rows)


def test_cluster_queries(spark, q):
    labels = {r.clusters for r in q["kmeans_scores"](spark, SF_SMALL).select("clusters").distinct().collect()}
    assert labels <= {1, 2, 3}
    prof = q["cluster_profile"](spark, SF_SMALL).collect()
    total = q["score_table"](spark, SF_SMALL).count()
    assert sum(r.n for r in prof) == total and len(prof) <= 4


def test_dropout_report_ranges(spark, q):
    r = q["dropout_report"](spark, SF_SMALL).first()
    for m in ("precision", "recall", "accuracy", "f1", "auc"):
        assert 0.0 <= r[m] <= 1.0
    assert r.gini == pytest.approx(2 * r.auc - 1)


def test_model_roundtrip_equals_fitted_model(spark, q):
    a = {(r.USUARIO, r.prediction) for r in q["dropout_scores"](spark, SF_SMALL).collect()}
    b = {(r.USUARIO, r.prediction) for r in q["model_roundtrip"](spark, SF_SMALL).collect()}
    assert a == b and a


def test_kruskal_p_range(spark, q):
    assert all(0.0 <= r.p_value <= 1.0 for r in q["kruskal_p"](spark, SF_SMALL).collect())


def test_dropout_variants_score_every_row(spark, q):
    for name in ("dropout_gbt", "dropout_new_cohort"):
        rows = q[name](spark, SF_SMALL).collect()
        assert rows and all(0.0 <= r.p1 <= 1.0 and r.prediction == float(r.p1 > 0.5) for r in rows)


def test_mlp_scores_all_rows_that_the_fit_left(spark, q):
    rows = q["mlp_scores"](spark, SF_SMALL).collect()
    n = spark.read.parquet(f"{SF_SMALL}/orders.parquet").groupBy(F.col("o_orderstatus") == "F").count().collect()
    assert len(rows) == sum(r["count"] - math.floor(r["count"] * 0.8) for r in n)
    assert not any(r.is_train for r in rows) and all(0.0 <= r.p1 <= 1.0 for r in rows)


def test_rating_regressor(spark, q):
    rows = q["gbt_ratings"](spark, SF_SMALL).collect()
    err = math.sqrt(sum((r.puntuacion - r.prediction) ** 2 for r in rows) / len(rows))
    assert rows and rows[0].rmse == pytest.approx(err) and err < 2
    imp = {r.feature: r.importance for r in q["gbt_importance"](spark, SF_SMALL).collect()}
    assert len(imp) == 13 and sum(imp.values()) == pytest.approx(1.0)


def test_elbow_and_clusterer_comparison(spark, q):
    costs = [r.inertia for r in q["elbow"](spark, SF_SMALL).orderBy("k").collect()]
    assert len(costs) == 10 and all(a >= b - 1e-9 for a, b in zip(costs, costs[1:]))
    rows = q["compare_k"](spark, SF_SMALL).collect()
    assert {(r.algorithm, r.k) for r in rows} == {(a, k) for a in ("kmeans", "minibatch_kmeans") for k in range(3, 7)}
    assert all(r.davies_bouldin > 0 and -1 <= r.silhouette <= 1 for r in rows)
