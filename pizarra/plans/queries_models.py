"""Named queries: the model jobs (drop-out, forecast, clustering, ratings)."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from pizarra.functions.scalar import recode
from pizarra.operators import features, models, newton, stats
from pizarra.operators.clean import drop_nulls, fill_nulls, filter_ne_keep_nulls
from pizarra.operators.ordering import GROUP_N, GROUP_POS, with_group_positions
from pizarra.operators.ratings import ratings
from pizarra.operators.recommend import neighbour_features
from pizarra.operators.reshape import ordered_split
from pizarra.plans import jobs
from pizarra.plans import standin_sql as Q
from pizarra.plans.catalog import register
from pizarra.plans.queries_basic import SCORE_TABLE_CTES
from pizarra.session import scratch_path
from pizarra.sources import io
from pizarra.sources import standins as S

# ---------------------------------------------------------------- J2 drop-out model

DROPOUT_CATEGORICAL = ["ESCALA", "condicion_laboral", "DAREACENSO", "NIVEL"]
DROPOUT_NUMERIC = ["Porc_act_realizada", "PORC_DIAS", "NOTA"]


def dropout_frame(spark, sf):
    """Prepared cohort without the excluded status; target 1 = did not finish."""
    c = filter_ne_keep_nulls(jobs.cohort_prepared(spark, sf), "CUMPLIMIENTO", jobs.EXCLUDED_STATUS)
    c = drop_nulls(fill_nulls(c, {"PORC_DIAS": 0.0}), DROPOUT_NUMERIC)
    return c.withColumn("target", recode("CUMPLIMIENTO", {"CULMINARON": 0}, 1).cast("double"))


def _dropout_split(spark, sf):
    d = features.hash_split(dropout_frame(spark, sf), ["USUARIO"], 0.8, seed=123)
    return d.filter("is_train"), d.filter(~F.col("is_train"))


def _dropout_model(train):
    table = models.fit_table(train, ["USUARIO"])
    return models.logistic_pipeline(DROPOUT_CATEGORICAL, DROPOUT_NUMERIC, "target", table.count()).fit(table)


@register("dropout_scores")
def q_dropout_scores(spark, sf):
    """Logistic regression (L2, C=1) fitted on 80 %, scores for the other 20 %."""
    train, test = _dropout_split(spark, sf)
    scored = models.positive_probability(_dropout_model(train).transform(test))
    return scored.select("USUARIO", "target", F.col("prediction"), "p1")


@register("dropout_newton", sql=Q.with_(Q.COHORT) + """
SELECT count(*) AS n_rows, count(*) FILTER (WHERE CUMPLIMIENTO IS DISTINCT FROM 'CULMINARON') AS n_positive, true AS optimal, true AS agrees
FROM cohort WHERE CUMPLIMIENTO IS DISTINCT FROM 'NINGUNA ACTIVIDAD' AND Porc_act_realizada IS NOT NULL AND NOTA IS NOT NULL""")
def q_dropout_newton(spark, sf):
    """Drop-out model fitted on the whole cohort by Newton steps.  ``optimal``: the gradient, recomputed over
    all rows, is below 1e-6.  ``agrees``: the pipeline's coefficients on features of unit spread are within 1e-4."""
    d = dropout_frame(spark, sf)
    d = features.standardise(d, DROPOUT_NUMERIC, suffix="_z")
    numeric = [f"{c}_z" for c in DROPOUT_NUMERIC]
    table = models.fit_table(d.select("USUARIO", "target", *DROPOUT_CATEGORICAL, *numeric), ["USUARIO"])
    rows = newton.encoded_rows(table, DROPOUT_CATEGORICAL, numeric, "target")
    fit = newton.logistic_newton(rows, "x", "y")
    gradient, n, positive = newton.gradient_at(rows, "x", "y", fit.coefficients, fit.intercept)
    other = models.logistic_pipeline(DROPOUT_CATEGORICAL, numeric, "target", n, tol=1e-10).fit(table).stages[-1]
    apart = max(abs(other.coefficients.toArray() - fit.coefficients).max(), abs(other.intercept - fit.intercept))
    return spark.range(1).select(F.lit(n).cast("long").alias("n_rows"), F.lit(positive).cast("long").alias("n_positive"),
                                 F.lit(gradient < 1e-6).alias("optimal"), F.lit(bool(apart < 1e-4)).alias("agrees"))


@register("dropout_report")
def q_dropout_report(spark, sf):
    """Hold-out classification report of the drop-out model (truth, prediction)."""
    train, test = _dropout_split(spark, sf)
    scored = _dropout_model(train).transform(test)
    return stats.class_report(scored, "target", "prediction", positive=1.0, counts=True)


# Fixed value: enrolments from this date on form the second (scoring) cohort.
NEW_COHORT_FROM = "1999-01-01"


@register("dropout_new_cohort")
def q_dropout_new_cohort(spark, sf):
    """Model fitted on the earlier cohort, applied to the later one with the
    training dummy layout (unseen categories encode as zeros)."""
    d = dropout_frame(spark, sf)
    old = d.filter(F.col("MAX_FECHA") < F.lit(NEW_COHORT_FROM).cast("timestamp_ntz"))
    new = d.filter(F.col("MAX_FECHA") >= F.lit(NEW_COHORT_FROM).cast("timestamp_ntz"))
    scored = models.positive_probability(_dropout_model(old).transform(new))
    return scored.select("USUARIO", "CURID", "target", "prediction", "p1")


@register("dropout_gbt")
def q_dropout_gbt(spark, sf):
    """Boosted-tree classifier (100 trees) on the same features and split."""
    train, test = _dropout_split(spark, sf)
    model = models.gbt_classifier_pipeline(DROPOUT_CATEGORICAL, DROPOUT_NUMERIC, "target").fit(
        models.boosting_table(train, ["USUARIO"]))
    scored = models.positive_probability(model.transform(test))
    return scored.select("USUARIO", "target", "prediction", "p1")


@register("model_roundtrip")
def q_model_roundtrip(spark, sf):
    """Fitted drop-out pipeline saved to the shared folder, loaded back and applied."""
    train, test = _dropout_split(spark, sf)
    path = scratch_path(spark, "model")
    io.save_model(_dropout_model(train), path)
    loaded = io.load_model(path)
    return models.positive_probability(loaded.transform(test)).select("USUARIO", "target", "prediction", "p1")


# ---------------------------------------------------------------- J3 pass/fail forecast

FORECAST_STRINGS = ["o_orderpriority", "c_mktsegment", "n_name", "r_name"]
FORECAST_NUMBERS = ["o_totalprice", "c_acctbal", "month"]
# The reference's extract takes at most so many rows per class; here it bounds the fit only.
PER_CLASS_CAP = 100_000


def forecast_frame(spark, sf):
    """Outcome, text and numbers of every order."""
    od = S.table(spark, sf, "orders")
    cust = S.table(spark, sf, "customer")
    nation = S.table(spark, sf, "nation")
    region = S.table(spark, sf, "region")
    return (od.join(cust, od.o_custkey == cust.c_custkey)
            .join(F.broadcast(nation), cust.c_nationkey == nation.n_nationkey)
            .join(F.broadcast(region), nation.n_regionkey == region.r_regionkey)
            .select("o_orderkey", "o_orderpriority", "c_mktsegment", "n_name", "r_name", "o_totalprice",
                    "c_acctbal", F.month("o_orderdate").cast("double").alias("month"),
                    F.when(F.col("o_orderstatus") == "F", "EXITOSO").otherwise("NO EXITOSO").alias("RENDIMIENTO"))
            .withColumn("label", (F.col("RENDIMIENTO") == "NO EXITOSO").cast("double")))


@register("mlp_scores")
def q_mlp_scores(spark, sf):
    """Perceptron (100, 100 hidden, 300 iterations): label-encoded text and
    min-max scaled numbers.  Encoders and the fit take the first 100 000 rows per
    class of the stratified 80 %; every other row is scored."""
    d = features.hash_split(forecast_frame(spark, sf), ["o_orderkey"], 0.8, seed=123, stratify="label")
    placed = with_group_positions(d, F.struct("is_train", "label"), [F.col("o_orderkey")])
    fit = F.col("is_train") & (F.col(GROUP_POS) < PER_CLASS_CAP)
    placed = placed.withColumn("_fit", fit).drop(GROUP_POS, GROUP_N)
    train, rest = placed.filter("_fit"), placed.filter("not _fit")
    enc = features.fit_labels(train, FORECAST_STRINGS)
    scal = features.fit_min_max(train, FORECAST_NUMBERS)
    cols = [f"{c}_code" for c in FORECAST_STRINGS] + FORECAST_NUMBERS

    def prep(df):
        df = scal.transform(enc.transform(df))
        df = fill_nulls(df, {f"{x}_code": -1 for x in FORECAST_STRINGS})
        return models.vectors(df, cols)

    # the optimiser reads the training vectors once per iteration: written once
    train_vec = models.fit_table(prep(train).select("o_orderkey", "features", "label"), ["o_orderkey"])
    mlp = models.mlp_pipeline(len(cols), "label").fit(train_vec)
    return mlp.transform(prep(rest)).select("o_orderkey", "label", "is_train", "prediction",
                                            vector_to_array("probability")[1].alias("p1"))


# ---------------------------------------------------------------- J1 clustering


def _scaled_scores(spark, sf):
    t = jobs.score_table(spark, sf)
    return features.standardise(t, ["view", "click"], suffix="_z")


@register("kmeans_scores")
def q_kmeans_scores(spark, sf):
    """k-means (k=3) on the standardised entry/exit scores, labels 1..3, written to
    the result table and read back."""
    data = models.vectors(_scaled_scores(spark, sf), ["view_z", "click_z"])
    _, scored = models.kmeans_labels(data, 3, seed=1, key=["CURID", "IDNUMBER"])
    # the job's output: labels written over the result table
    path = scratch_path(spark, "clusters")
    io.replace_files(scored.select("CURID", "IDNUMBER", "view", "click", "clusters"), path)
    return io.read_files(spark, path)


@register("kmeans_certificate", sql=SCORE_TABLE_CTES + """
SELECT count(*) AS n_points, CAST(3 AS BIGINT) AS n_clusters, CAST(0 AS BIGINT) AS n_misplaced, CAST(0 AS BIGINT) AS n_moved FROM score_table""")
def q_kmeans_certificate(spark, sf):
    """k-means (k=3) run until its centers stand still, and the check of that over all rows."""
    cols = ["view_z", "click_z"]
    table = models.fit_table(_scaled_scores(spark, sf).select("CURID", "IDNUMBER", *cols), ["CURID", "IDNUMBER"])
    fit, _ = models.kmeans_labels(models.vectors(table, cols), 3, seed=1, key=["CURID", "IDNUMBER"])
    centers = models.settle_centers(table, cols, fit.clusterCenters(), key=["CURID", "IDNUMBER"])
    points = table.select(F.array(*cols).alias("x"))
    return models.kmeans_certificate(points.withColumn("lab", models.nearest_center("x", centers)), "x", "lab", centers)


@register("cluster_profile")
def q_cluster_profile(spark, sf):
    """Teachers per k-means cluster (k=4), with the two quality indices."""
    data = models.vectors(_scaled_scores(spark, sf), ["view_z", "click_z"])
    _, scored = models.kmeans_labels(data, 4, seed=1, key=["CURID", "IDNUMBER"])
    scored = models.fit_table(scored.withColumn("_arr", vector_to_array("features")), ["CURID", "IDNUMBER"])
    db = stats.davies_bouldin(scored, "_arr", "clusters").first()["davies_bouldin"]
    sil = stats.silhouette_sq(scored, "_arr", "clusters").first()["silhouette"]
    prof = scored.groupBy("clusters").agg(F.count(F.lit(1)).alias("n"), F.avg("view").alias("mean_view"),
                                          F.avg("click").alias("mean_click"))
    return prof.withColumns({"davies_bouldin": F.lit(db), "silhouette": F.lit(sil)})


@register("elbow")
def q_elbow(spark, sf):
    """Inertia for k = 1..10, best of 20 seeded restarts."""
    costs = models.elbow(_scaled_scores(spark, sf), ["view_z", "click_z"], range(1, 11), restarts=20)
    return spark.createDataFrame(costs, "k long, inertia double")


@register("compare_k")
def q_compare_k(spark, sf):
    """k-means vs mini-batch k-means, both over all rows, for k = 3..6: Davies-Bouldin and silhouette."""
    rows = models.compare_clusterers(_scaled_scores(spark, sf), ["view_z", "click_z"], range(3, 7))
    return spark.createDataFrame(rows, "algorithm string, k long, davies_bouldin double, silhouette double")


# ---------------------------------------------------------------- J4 rating regression

GBT_FEATURES = (["total_average"] + [f"similar_user_pun{i}" for i in range(1, 6)]
                + [f"similar_cur_rating{i}" for i in range(1, 6)] + ["user_average", "cur_average"])


def _rating_features(spark, sf, part: str):
    """Neighbourhood features of the ordered train or test part (each part's
    features come from that part's own ratings, as in the reference)."""
    r = ratings(S.survey(spark, sf), user="USUARIO", digits=0)
    train, test = ordered_split(r, ["CURID", "USUARIO"], 0.8)
    f = neighbour_features(train if part == "train" else test, "USUARIO", "CURID", "PUNTUACION")
    # written once to the checkpoint folder: the boosting passes read it many
    # times and must not re-run the similarity blocks
    return models.boosting_table(f.withColumn("puntuacion", F.col("puntuacion").cast("double")), ["USUARIO", "CURID"])


@register("gbt_ratings")
def q_gbt_ratings(spark, sf):
    """Boosted-tree regressor (100 trees) on the 13 neighbourhood features:
    test predictions, with the test RMSE on every row."""
    model = models.gbt_regressor_pipeline(GBT_FEATURES, "puntuacion").fit(_rating_features(spark, sf, "train"))
    pred = model.transform(_rating_features(spark, sf, "test")).select("USUARIO", "CURID", "puntuacion", "prediction")
    err = pred.agg(F.sqrt(F.avg(F.pow(F.col("puntuacion") - F.col("prediction"), 2)))).scalar()
    return pred.withColumn("rmse", err)


@register("gbt_importance")
def q_gbt_importance(spark, sf):
    """Feature importances of the rating regressor (gain share)."""
    model = models.gbt_regressor_pipeline(GBT_FEATURES, "puntuacion").fit(_rating_features(spark, sf, "train"))
    return spark.createDataFrame(models.feature_importances(model, GBT_FEATURES), "feature string, importance double")
