"""Named queries: course recommendation (similarity, features, SVD, sampling)."""

from __future__ import annotations

from pyspark.sql import functions as F

from pizarra.operators import recommend
from pizarra.operators.ratings import ratings
from pizarra.operators import stats
from pizarra.operators.reshape import block_slice, ordered_split
from pizarra.plans import standin_sql as Q
from pizarra.plans.catalog import register
from pizarra.plans.queries_basic import _FILLED, _RATINGS0, _RATINGS2
from pizarra.session import written
from pizarra.sources import standins as S


def _ratings0(spark, sf):
    r = ratings(S.survey(spark, sf), user="USUARIO", digits=0)
    return r.filter(F.col("PUNTUACION") != 0)


_R = Q.with_(Q.SURVEY, _FILLED, _RATINGS0) + """,
r AS (SELECT USUARIO AS u, CURID AS c, PUNTUACION AS p FROM ratings0 WHERE PUNTUACION <> 0),
nrm AS (SELECT u, sqrt(sum(p * p)) AS n FROM r GROUP BY u),
cn AS (SELECT c, sqrt(sum(p * p)) AS n FROM r GROUP BY c)"""

_US = """, us AS (SELECT a.u, b.u AS v, sum(a.p * b.p) / (na.n * nb.n) AS sim
        FROM r a JOIN r b ON a.c = b.c AND a.u <> b.u JOIN nrm na ON na.u = a.u JOIN nrm nb ON nb.u = b.u
        GROUP BY a.u, b.u, na.n, nb.n)"""
_CS = """, cs AS (SELECT a.c, b.c AS d, sum(a.p * b.p) / (na.n * nb.n) AS sim
        FROM r a JOIN r b ON a.u = b.u AND a.c <> b.c JOIN cn na ON na.c = a.c JOIN cn nb ON nb.c = b.c
        GROUP BY a.c, b.c, na.n, nb.n)"""


@register("user_similarity", settle=["sim"], sql=_R + _US + """
SELECT u AS USUARIO, v AS other, sim, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY u ORDER BY sim DESC, v) AS rank FROM us) WHERE rank <= 10""")
def q_user_similarity(spark, sf):
    """10 most cosine-similar teachers of every teacher."""
    return recommend.user_similarity_topk(_ratings0(spark, sf), "USUARIO", "CURID", "PUNTUACION", k=10)


@register("course_similarity", settle=["sim"], sql=_R + _CS + """
SELECT c AS CURID, d AS item2, sim, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY c ORDER BY sim DESC, d) AS rank FROM cs) WHERE rank <= 5""")
def q_course_similarity(spark, sf):
    """5 most cosine-similar courses of every course."""
    return recommend.item_similarity_topk(_ratings0(spark, sf), "USUARIO", "CURID", "PUNTUACION", k=5)


_SLOTS_U = ", ".join(f"CAST(max(rv) FILTER (WHERE k = {i}) AS DOUBLE) AS s{i}" for i in range(1, 6))
_SLOTS_C = ", ".join(f"CAST(max(rd) FILTER (WHERE k = {i}) AS DOUBLE) AS t{i}" for i in range(1, 6))
_FEAT_SELECT = ", ".join(
    [f"coalesce(s{i}, cur_average) AS similar_user_pun{i}" for i in range(1, 6)]
    + [f"coalesce(t{i}, user_average) AS similar_cur_rating{i}" for i in range(1, 6)])


@register("neighbour_features",
          settle=["total_average", "user_average", "cur_average"]
          + [f"similar_user_pun{i}" for i in range(1, 6)] + [f"similar_cur_rating{i}" for i in range(1, 6)],
          sql=_R + _US + _CS + f"""
, ucand AS (SELECT r1.u, r1.c, r2.u AS v, r2.p AS rv, us.sim
            FROM r r1 JOIN r r2 ON r2.c = r1.c AND r2.u <> r1.u JOIN us ON us.u = r1.u AND us.v = r2.u),
utop AS (SELECT u, c, rv, row_number() OVER (PARTITION BY u, c ORDER BY sim DESC, v) AS k FROM ucand),
uslot AS (SELECT u, c, {_SLOTS_U} FROM utop WHERE k <= 5 GROUP BY u, c),
ccand AS (SELECT r1.u, r1.c, r2.c AS d, r2.p AS rd, cs.sim
          FROM r r1 JOIN r r2 ON r2.u = r1.u AND r2.c <> r1.c JOIN cs ON cs.c = r1.c AND cs.d = r2.c),
ctop AS (SELECT u, c, rd, row_number() OVER (PARTITION BY u, c ORDER BY sim DESC, d) AS k FROM ccand),
cslot AS (SELECT u, c, {_SLOTS_C} FROM ctop WHERE k <= 5 GROUP BY u, c),
um AS (SELECT u, avg(p) AS user_average FROM r GROUP BY u),
im AS (SELECT c, avg(p) AS cur_average FROM r GROUP BY c),
tot AS (SELECT avg(p) AS total_average FROM r)
SELECT r.u AS USUARIO, r.c AS CURID, total_average, {_FEAT_SELECT}, user_average, cur_average, r.p AS puntuacion
FROM r JOIN um USING (u) JOIN im USING (c) LEFT JOIN uslot USING (u, c) LEFT JOIN cslot USING (u, c), tot""")
def q_neighbour_features(spark, sf):
    """16-column neighbourhood feature row for every rated (teacher, course)."""
    return recommend.neighbour_features(_ratings0(spark, sf), "USUARIO", "CURID", "PUNTUACION", k=5)


@register("cold_start", sql=Q.with_(Q.SURVEY, _FILLED, _RATINGS0) + """
, o AS (SELECT *, row_number() OVER (ORDER BY CURID, USUARIO) - 1 AS pos, count(*) OVER () AS n FROM ratings0),
train AS (SELECT * FROM o WHERE pos < floor(CAST(n AS DOUBLE) * CAST(0.8 AS DOUBLE)) AND PUNTUACION <> 0),
t AS (SELECT 'users' AS entity, (SELECT count(DISTINCT USUARIO) FROM ratings0) AS total,
             (SELECT count(DISTINCT USUARIO) FROM train) AS in_train
      UNION ALL
      SELECT 'courses', (SELECT count(DISTINCT CURID) FROM ratings0), (SELECT count(DISTINCT CURID) FROM train))
SELECT entity, total, in_train, total - in_train AS missing,
       round_even(CAST(total - in_train AS DOUBLE) / CAST(total AS DOUBLE) * CAST(100 AS DOUBLE), 0) AS missing_pct
FROM t""")
def q_cold_start(spark, sf):
    """Teachers and courses with no rating in the ordered train part."""
    r = ratings(S.survey(spark, sf), user="USUARIO", digits=0)
    train, _ = ordered_split(r, ["CURID", "USUARIO"], 0.8)
    train = train.filter(F.col("PUNTUACION") != 0)
    return recommend.cold_start(r, train, "USUARIO", "users").unionByName(
        recommend.cold_start(r, train, "CURID", "courses"))


@register("svd_recommend")
def q_svd_recommend(spark, sf):
    """Three best courses per teacher from the rank-6 SVD of the centred ratings."""
    r = ratings(S.survey(spark, sf))
    return recommend.svd_top_k(r, "IDNUMBER", "CURID", "PUNTUACION", rank=6, k=3)


@register("svd_rmse")
def q_svd_rmse(spark, sf):
    """RMSE of the rank-6 SVD reconstruction on the observed cells."""
    return recommend.svd_rmse(ratings(S.survey(spark, sf)), "IDNUMBER", "CURID", "PUNTUACION", rank=6)


@register("svd_identity", settle=["sum_s2", "sum_s4"], sql=Q.with_(Q.SURVEY, _FILLED, _RATINGS2) + """,
r AS (SELECT CURID, IDNUMBER, PUNTUACION AS p FROM ratings2),
c AS (SELECT CURID, IDNUMBER, p - avg(p) OVER (PARTITION BY IDNUMBER) AS x FROM r),
g AS (SELECT a.CURID, b.CURID AS d, sum(a.x * b.x) AS g FROM c a JOIN c b ON a.IDNUMBER = b.IDNUMBER GROUP BY a.CURID, b.CURID)
SELECT (SELECT count(DISTINCT CURID) FROM r) AS n_values, (SELECT sum(x * x) FROM c) AS sum_s2,
       (SELECT sum(g * g) FROM g) / 1000 AS sum_s4, (SELECT count(*) FROM r) AS n_cells, true AS restored""")
def q_svd_identity(spark, sf):
    """All singular values of the centred ratings: their squares add up to the trace of the Gramian, their
    fourth powers to its squared norm, and the full-rank prediction restores every rating."""
    r = ratings(S.survey(spark, sf))
    n = r.select("CURID").distinct().count()
    model = recommend.svd_model(r, "IDNUMBER", "CURID", "PUNTUACION", n)
    pred = recommend.svd_predict_cells(r, "IDNUMBER", "CURID", "PUNTUACION", model=model)
    both = r.join(pred, ["IDNUMBER", "CURID"])
    s2 = model.values ** 2
    return both.agg(F.lit(len(s2)).cast("long").alias("n_values"), F.lit(float(s2.sum())).alias("sum_s2"),
                    F.lit(float((s2 * s2).sum()) / 1000).alias("sum_s4"), F.count(F.lit(1)).alias("n_cells"),
                    (F.max(F.abs(F.col("PUNTUACION") - F.col("prediction"))) < 1e-6).alias("restored"))


@register("svd_block_rmse")
def q_svd_block_rmse(spark, sf):
    """RMSE of the SVD prediction on the observed cells of the first 50
    teachers x first 15 courses (the reference's check block)."""
    r = written(ratings(S.survey(spark, sf)), "ratings")
    pred = recommend.svd_predict_cells(r, "IDNUMBER", "CURID", "PUNTUACION", rank=6)
    block = F.broadcast(block_slice(r, "IDNUMBER", "CURID", 50, 15))      # 50 x 15 cells at most
    return stats.rmse(block, pred, ["IDNUMBER", "CURID"], "PUNTUACION", "prediction")


@register("sampled_block", sql=_R + """
, us AS (SELECT u FROM (SELECT DISTINCT u FROM r) ORDER BY md5(concat_ws('|', CAST(u AS VARCHAR), '15')), u LIMIT 100),
ci AS (SELECT c, row_number() OVER (ORDER BY c) - 1 AS pos, count(*) OVER () AS n FROM (SELECT DISTINCT c FROM r)),
dr AS (SELECT CAST(concat('0x', substr(md5(concat_ws('|', CAST(i AS VARCHAR), '15')), 1, 8)) AS BIGINT) AS h FROM range(10) t(i))
SELECT r.c AS CURID, r.u AS USUARIO, r.p AS PUNTUACION FROM r
WHERE r.u IN (SELECT u FROM us) AND r.c IN (SELECT ci.c FROM ci JOIN dr ON ci.pos = dr.h % ci.n)""")
def q_sampled_block(spark, sf):
    """Ratings of 100 sampled teachers x 10 course draws (with replacement), seed 15."""
    return recommend.sampled_block(_ratings0(spark, sf), "USUARIO", "CURID", 100, 10, seed=15)
