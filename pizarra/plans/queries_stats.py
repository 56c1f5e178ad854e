"""Named queries: features, cluster indices, tests and evaluation metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from pizarra.operators import features, silhouette, stats
from pizarra.operators.ratings import ratings
from pizarra.operators.reshape import ordered_split
from pizarra.plans import jobs
from pizarra.plans import standin_sql as Q
from pizarra.plans.catalog import register
from pizarra.plans.queries_basic import SCORE_TABLE_CTES, _FILLED, _RATINGS0
from pizarra.sources import standins as S

# ---------------------------------------------------------------- scalers and encoders


@register("standardise", settle=["view_z", "click_z"], sql=SCORE_TABLE_CTES + """
, m AS (SELECT avg("view") AS mv, stddev_pop("view") AS sv, avg("click") AS mc, stddev_pop("click") AS sc
        FROM score_table)
SELECT CURID, IDNUMBER,
       ("view" - mv) / CASE WHEN sv = 0 OR sv IS NULL THEN 1 ELSE sv END AS view_z,
       ("click" - mc) / CASE WHEN sc = 0 OR sc IS NULL THEN 1 ELSE sc END AS click_z
FROM score_table, m""")
def q_standardise(spark, sf):
    """z-scores of the two questionnaire scores (population std)."""
    t = jobs.score_table(spark, sf)
    return features.standardise(t, ["view", "click"], suffix="_z").select("CURID", "IDNUMBER", "view_z", "click_z")


@register("min_max", settle=["NOTA_s", "Porc_act_realizada_s"], sql=Q.with_(Q.COHORT) + """
, m AS (SELECT min(NOTA) AS a, max(NOTA) AS b, min(Porc_act_realizada) AS c, max(Porc_act_realizada) AS d
        FROM cohort)
SELECT USUARIO, (NOTA - a) / CASE WHEN b - a = 0 THEN 1 ELSE b - a END AS NOTA_s,
       (Porc_act_realizada - c) / CASE WHEN d - c = 0 THEN 1 ELSE d - c END AS Porc_act_realizada_s
FROM cohort, m""")
def q_min_max(spark, sf):
    """Min-max scaling to [0, 1]; a constant column maps to 0."""
    c = S.cohort(spark, sf)
    return features.min_max(c, ["NOTA", "Porc_act_realizada"], suffix="_s").select(
        "USUARIO", "NOTA_s", "Porc_act_realizada_s")


_ENC_COLS = ["condicion_laboral", "NIVEL", "DAREACENSO", "ESCALA"]


@register("label_encode", sql=Q.with_(Q.COHORT) + """
SELECT USUARIO, """ + ", ".join(f"dense_rank() OVER (ORDER BY {c}) - 1 AS {c}_code" for c in _ENC_COLS) + """,
       NIVEL AS NIVEL_back
FROM cohort""")
def q_label_encode(spark, sf):
    """Codes in sorted order of the distinct values, and the inverse mapping."""
    c = S.cohort(spark, sf)
    fit = features.fit_labels(c, _ENC_COLS)
    out = fit.transform(c)
    out = fit.inverse(out, {"NIVEL": "NIVEL_code"}).withColumnRenamed("NIVEL", "NIVEL_back")
    return out.select("USUARIO", *[f"{x}_code" for x in _ENC_COLS], "NIVEL_back")


_ESCALA = [str(i) for i in range(8)] + ["X"]
_LEVELS = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]


@register("one_hot", sql=Q.with_(Q.COHORT) + "SELECT USUARIO, Porc_act_realizada, " + ", ".join(
    [f"CASE WHEN ESCALA = '{v}' THEN 1 ELSE 0 END AS \"ESCALA_{v}\"" for v in _ESCALA]
    + [f"CASE WHEN NIVEL = '{v}' THEN 1 ELSE 0 END AS \"NIVEL_{v}\"" for v in _LEVELS]) + " FROM cohort")
def q_one_hot(spark, sf):
    """Dummy columns per category seen at fit; numeric columns pass through."""
    c = S.cohort(spark, sf)
    fit = features.fit_one_hot(c, ["ESCALA", "NIVEL"])
    return fit.transform(c, keep=["USUARIO", "Porc_act_realizada"])


@register("one_hot_sparse", sql=Q.with_(Q.COHORT) + """
SELECT USUARIO, concat_ws(',', CAST(dense_rank() OVER (ORDER BY ESCALA) - 1 AS VARCHAR),
       CAST(dense_rank() OVER (ORDER BY NIVEL) - 1 + (SELECT count(DISTINCT ESCALA) FROM cohort) AS VARCHAR)) AS ones,
       (SELECT count(DISTINCT ESCALA) + count(DISTINCT NIVEL) FROM cohort) AS width
FROM cohort""")
def q_one_hot_sparse(spark, sf):
    """Dummies as positions of the ones, for any number of categories."""
    c = S.cohort(spark, sf)
    fit = features.fit_sparse_one_hot(c, ["ESCALA", "NIVEL"])
    return fit.transform(c).select("USUARIO", F.concat_ws(",", F.col("ones").cast("array<string>")).alias("ones"),
                                   F.lit(fit.width).cast("long").alias("width"))


@register("stratified_split", sql=Q.with_(Q.COHORT) + """
SELECT USUARIO, CUMPLIMIENTO, row_number() OVER (PARTITION BY CUMPLIMIENTO ORDER BY md5(concat_ws('|', CAST(USUARIO AS VARCHAR), '42')), USUARIO)
       <= floor(CAST(count(*) OVER (PARTITION BY CUMPLIMIENTO) AS DOUBLE) * CAST(0.8 AS DOUBLE)) AS is_train
FROM cohort""")
def q_stratified_split(spark, sf):
    """Seeded 80/20 split per outcome class (share per class is the check)."""
    c = S.cohort(spark, sf).select("USUARIO", "CUMPLIMIENTO")
    return features.hash_split(c, ["USUARIO"], 0.8, seed=42, stratify="CUMPLIMIENTO")


# ---------------------------------------------------------------- metrics

@register("confusion", sql=Q.with_(Q.PREDICTIONS) + """
SELECT count(*) FILTER (WHERE y_true <> 1 AND y_pred <> 1) AS tn, count(*) FILTER (WHERE y_true <> 1 AND y_pred = 1) AS fp,
       count(*) FILTER (WHERE y_true = 1 AND y_pred <> 1) AS fn, count(*) FILTER (WHERE y_true = 1 AND y_pred = 1) AS tp
FROM predictions""")
def q_confusion(spark, sf):
    """Confusion matrix cells, always (truth, prediction)."""
    return stats.confusion(S.predictions(spark, sf), "y_true", "y_pred")


@register("class_report", settle=["precision", "recall", "accuracy", "f1", "auc", "gini"],
          sql=Q.with_(Q.PREDICTIONS) + """
, c AS (SELECT CAST(count(*) FILTER (WHERE y_true <> 1 AND y_pred <> 1) AS DOUBLE) AS tn,
               CAST(count(*) FILTER (WHERE y_true <> 1 AND y_pred = 1) AS DOUBLE) AS fp,
               CAST(count(*) FILTER (WHERE y_true = 1 AND y_pred <> 1) AS DOUBLE) AS fn,
               CAST(count(*) FILTER (WHERE y_true = 1 AND y_pred = 1) AS DOUBLE) AS tp FROM predictions),
r AS (SELECT tn, fp, fn, tp,
             CASE WHEN tp + fp = 0 THEN 0 ELSE tp / (tp + fp) END AS prec,
             CASE WHEN tp + fn = 0 THEN 0 ELSE tp / (tp + fn) END AS rec,
             CASE WHEN tn + fp = 0 THEN 0 ELSE tn / (tn + fp) END AS tnr FROM c)
SELECT prec AS precision, rec AS recall, (tp + tn) / (tp + tn + fp + fn) AS accuracy,
       CASE WHEN prec + rec = 0 THEN 0 ELSE 2 * prec * rec / (prec + rec) END AS f1,
       (rec + tnr) / 2 AS auc, 2 * ((rec + tnr) / 2) - 1 AS gini
FROM r""")
def q_class_report(spark, sf):
    """Precision, recall, accuracy, F1, AUC of hard labels, Gini."""
    return stats.class_report(S.predictions(spark, sf), "y_true", "y_pred")


@register("rmse", settle=["rmse"], sql=Q.with_(Q.SURVEY, _FILLED, _RATINGS0) + """
, o AS (SELECT *, row_number() OVER (ORDER BY CURID, USUARIO) - 1 AS pos, count(*) OVER () AS n FROM ratings0),
train AS (SELECT * FROM o WHERE pos < floor(CAST(n AS DOUBLE) * CAST(0.8 AS DOUBLE))),
test AS (SELECT * FROM o WHERE pos >= floor(CAST(n AS DOUBLE) * CAST(0.8 AS DOUBLE))),
um AS (SELECT USUARIO, avg(PUNTUACION) AS m FROM train WHERE PUNTUACION <> 0 GROUP BY USUARIO),
g AS (SELECT avg(PUNTUACION) AS gm FROM train WHERE PUNTUACION <> 0)
SELECT sqrt(avg(power(t.PUNTUACION - coalesce(um.m, g.gm), 2))) AS rmse, count(*) AS n_cells
FROM test t LEFT JOIN um USING (USUARIO), g""")
def q_rmse(spark, sf):
    """RMSE of the user-mean baseline on the ordered test part (global mean for new users)."""
    r = ratings(S.survey(spark, sf), user="USUARIO", digits=0)
    train, test = ordered_split(r, ["CURID", "USUARIO"], 0.8)
    nz = train.filter(F.col("PUNTUACION") != 0)
    gm = nz.agg(F.avg("PUNTUACION")).scalar()
    um = nz.groupBy("USUARIO").agg(F.avg("PUNTUACION").alias("_m"))
    pred = test.join(um, "USUARIO", "left").select("CURID", "USUARIO", F.coalesce("_m", gm).alias("pred"))
    return stats.rmse(test, pred, ["CURID", "USUARIO"], "PUNTUACION", "pred")


# ---------------------------------------------------------------- cluster indices and tests

_PTS = """pts AS (SELECT vec_id, label, unnest(range(len(embedding))) AS dim,
                         CAST(unnest(embedding) AS DOUBLE) AS x FROM embeddings)"""


@register("davies_bouldin", settle=["davies_bouldin"], sql="WITH " + _PTS + """,
c AS (SELECT label, dim, avg(x) AS c FROM pts GROUP BY label, dim),
d AS (SELECT p.vec_id, p.label, sqrt(sum(power(p.x - c.c, 2))) AS dist
      FROM pts p JOIN c USING (label, dim) GROUP BY p.vec_id, p.label),
s AS (SELECT label, avg(dist) AS s FROM d GROUP BY label),
cc AS (SELECT a.label AS i, b.label AS j, sqrt(sum(power(a.c - b.c, 2))) AS dij
       FROM c a JOIN c b ON a.dim = b.dim AND a.label <> b.label GROUP BY a.label, b.label),
r AS (SELECT i, max((si.s + sj.s) / dij) AS worst FROM cc JOIN s si ON si.label = i JOIN s sj ON sj.label = j
      GROUP BY i)
SELECT avg(worst) AS davies_bouldin, count(*) AS n_clusters FROM r""")
def q_davies_bouldin(spark, sf):
    """Davies-Bouldin index of the given vector labels."""
    return stats.davies_bouldin(S.cluster_vectors(spark, sf), "embedding", "label")


@register("silhouette", settle=["silhouette"], sql="WITH " + _PTS + """,
cs AS (SELECT label, dim, sum(x) AS s FROM pts GROUP BY label, dim),
px AS (SELECT vec_id, label, sum(x * x) AS xx FROM pts GROUP BY vec_id, label),
cn AS (SELECT label, count(*) AS n, sum(xx) AS q FROM px GROUP BY label),
dots AS (SELECT p.vec_id, cs.label AS c, sum(p.x * cs.s) AS dot FROM pts p JOIN cs USING (dim)
         GROUP BY p.vec_id, cs.label),
tot AS (SELECT px.vec_id, px.label AS own, dots.c, cn.n, cn.n * px.xx - 2 * dots.dot + cn.q AS t
        FROM px JOIN dots USING (vec_id) JOIN cn ON cn.label = dots.c),
ab AS (SELECT vec_id, max(CASE WHEN c = own AND n > 1 THEN t / (n - 1) END) AS a,
              min(CASE WHEN c <> own THEN t / n END) AS b, max(CASE WHEN c = own THEN n END) AS own_n
       FROM tot GROUP BY vec_id)
SELECT avg(CASE WHEN own_n <= 1 THEN 0 ELSE (b - a) / greatest(a, b) END) AS silhouette, count(*) AS n_points
FROM ab""")
def q_silhouette(spark, sf):
    """Mean silhouette (squared Euclidean) of the given vector labels, linear time."""
    return stats.silhouette_sq(S.cluster_vectors(spark, sf), "embedding", "label")


@register("silhouette_euclid", settle=["silhouette"], sql="""
WITH e AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS x FROM embeddings),
n AS (SELECT label, count(*) AS n FROM e GROUP BY label),
s AS (SELECT a.vec_id, a.label AS own, b.label AS c, sum(list_distance(a.x, b.x)) AS s FROM e a, e b GROUP BY a.vec_id, a.label, b.label),
ab AS (SELECT vec_id, max(CASE WHEN c = own AND n > 1 THEN s / (n - 1) END) AS a, min(CASE WHEN c <> own THEN s / n END) AS b
       FROM s JOIN n ON n.label = s.c GROUP BY vec_id)
SELECT avg(CASE WHEN a IS NULL THEN 0 ELSE (b - a) / greatest(a, b) END) AS silhouette, count(*) AS n_points FROM ab""")
def q_silhouette_euclid(spark, sf):
    """Mean silhouette (Euclidean) of the given vector labels, exact, over all pairs of points."""
    return silhouette.silhouette_euclid(S.cluster_vectors(spark, sf), "embedding", "label")


def _emb_long(spark, sf):
    long = stats.dims_long(S.cluster_vectors(spark, sf), "embedding", ["vec_id", "label"])
    return long.withColumn("dim", F.col("dim").cast("long"))


_NORM_SQL = "WITH " + _PTS + """,
mu AS (SELECT dim, avg(x) AS mu, count(*) AS n FROM pts GROUP BY dim),
mom AS (SELECT p.dim, any_value(n) AS n, avg(power(x - mu, 2)) AS m2, avg(power(x - mu, 3)) AS m3,
               avg(power(x - mu, 4)) AS m4 FROM pts p JOIN mu USING (dim) GROUP BY p.dim),
g AS (SELECT dim, CAST(n AS DOUBLE) AS n, m3 / power(m2, 1.5) AS g1, m4 / (m2 * m2) AS b2 FROM mom),
z AS (SELECT *, g1 * sqrt((n + 1) * (n + 3) / (6.0 * (n - 2))) AS y,
             3 * (n * n + 27 * n - 70) * (n + 1) * (n + 3) / ((n - 2) * (n + 5) * (n + 7) * (n + 9)) AS beta,
             3 * (n - 1) / (n + 1) AS e,
             24 * n * (n - 2) * (n - 3) / ((n + 1) * (n + 1) * (n + 3) * (n + 5)) AS v,
             6 * (n * n - 5 * n + 2) / ((n + 7) * (n + 9)) * sqrt(6 * (n + 3) * (n + 5) / (n * (n - 2) * (n - 3))) AS sb
      FROM g),
z2 AS (SELECT *, sqrt(2 * (beta - 1)) - 1 AS w2, (b2 - e) / sqrt(v) AS xk,
              6 + 8 / sb * (2 / sb + sqrt(1 + 4 / (sb * sb))) AS a_ FROM z),
z3 AS (SELECT *, 1 / sqrt(0.5 * ln(w2)) AS delta, sqrt(2 / (w2 - 1)) AS alpha, 1 + xk * sqrt(2 / (a_ - 4)) AS d
       FROM z2),
z4 AS (SELECT dim, n, g1, b2, delta * asinh(y / alpha) AS z1,
              ((1 - 2 / (9 * a_)) - sign(d) * cbrt((1 - 2 / a_) / abs(d))) / sqrt(2 / (9 * a_)) AS z2 FROM z3)
SELECT CAST(dim AS BIGINT) AS dim, CAST(n AS BIGINT) AS n, g1 AS skew, b2 AS kurt, z1 AS z_skew, z2 AS z_kurt,
       z1 * z1 + z2 * z2 AS k2, exp(-(z1 * z1 + z2 * z2) / 2) AS p_value
FROM z4"""


@register("normality", settle=["skew", "kurt", "z_skew", "z_kurt", "k2", "p_value"], sql=_NORM_SQL)
def q_normality(spark, sf):
    """D'Agostino-Pearson normality test of every vector dimension."""
    return stats.normality(_emb_long(spark, sf), "dim", "value")


_KRUSKAL = "WITH " + _PTS + """,
r AS (SELECT dim, label, rank() OVER (PARTITION BY dim ORDER BY x)
                           + (count(*) OVER (PARTITION BY dim, x) - 1) / 2.0 AS rk FROM pts),
g AS (SELECT dim, label, sum(rk) AS R, count(*) AS ni FROM r GROUP BY dim, label),
t AS (SELECT dim, sum(power(c, 3) - c) AS tt FROM (SELECT dim, x, count(*) AS c FROM pts GROUP BY dim, x) GROUP BY dim),
h AS (SELECT dim, sum(R * R / ni) AS sr, CAST(sum(ni) AS DOUBLE) AS N, count(*) AS k FROM g GROUP BY dim)
SELECT CAST(dim AS BIGINT) AS dim, (12.0 / (N * (N + 1)) * sr - 3 * (N + 1)) / (1 - tt / (N * N * N - N)) AS H,
       CAST(k - 1 AS BIGINT) AS dof, CAST(N AS BIGINT) AS n
FROM h JOIN t USING (dim)"""


@register("kruskal", settle=["H"], sql=_KRUSKAL)
def q_kruskal(spark, sf):
    """Kruskal-Wallis H of every vector dimension across the given labels."""
    return stats.kruskal_h(_emb_long(spark, sf), "dim", "label", "value")


# chi-square tail: closed series for even degrees of freedom; for odd ones the series of erf as well
_CHI2_TAIL = """
SELECT dim, H, dof, n, CASE WHEN H <= 0 THEN 1 WHEN dof % 2 = 0 THEN
    exp(-H / 2) * list_sum(list_transform(range(0, dof // 2), lambda j: exp(j * ln(H / 2) - lgamma(j + 1))))
  ELSE 1 - 2 / sqrt(pi()) * exp(-H / 2) * list_sum(list_transform(range(0, 200), lambda j:
      exp(j * ln(4.0) + lgamma(j + 1) - lgamma(2 * j + 2) + (2 * j + 1) * ln(sqrt(H / 2)))))
    + coalesce(sqrt(2 * H / pi()) * exp(-H / 2) * list_sum(list_transform(range(0, (dof - 1) // 2), lambda j:
      exp(j * ln(H) + j * ln(2.0) + lgamma(j + 1) - lgamma(2 * j + 2)))), 0) END AS p_value
FROM (""" + _KRUSKAL + ")"


@register("kruskal_p", settle=["H", "p_value"], sql=_CHI2_TAIL)
def q_kruskal_p(spark, sf):
    """Kruskal-Wallis H with its chi-square p-value."""
    h = stats.kruskal_h(_emb_long(spark, sf), "dim", "label", "value")
    return stats.with_chi2_p(h, "H", "dof")
