import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from pizarra.operators import krylov, models, newton, partial_sums, recommend, silhouette
from pizarra.operators.ratings import ratings as rating_table
from pizarra.sources import standins as S
from tests.conftest import SF_SMALL


def _matrix(rng, n, decay):
    q = np.linalg.qr(rng.standard_normal((n, n)))[0]
    values = decay ** np.arange(n)
    return q @ np.diag(values) @ q.T, values, q


@pytest.mark.parametrize("n,width,decay", [(40, 8, 0.7), (120, 10, 0.98), (120, 30, 0.999), (30, 64, 0.9)])
def test_leading_eigenvectors_settle(n, width, decay):
    g, values, q = _matrix(np.random.default_rng(n + width), n, decay)
    got, vectors = krylov.leading_eigenvectors(lambda b: g @ b, n, 4, width)
    assert np.allclose(got, values[:4], rtol=1e-9)
    assert np.abs(g @ vectors - vectors * got).max() < 1e-7 and np.allclose(vectors.T @ vectors, np.eye(4))


def test_restarts_keep_the_best_vectors(monkeypatch):
    g, values, _ = _matrix(np.random.default_rng(3), 200, 0.97)
    monkeypatch.setattr(krylov, "MAX_BASIS_CELLS", 200 * 15)      # room for three blocks of 15 only
    calls = []
    got, vectors = krylov.leading_eigenvectors(lambda b: calls.append(b.shape) or g @ b, 200, 4, 64)
    assert max(w for _, w in calls) == 15 and len(calls) > 3 and np.allclose(got, values[:4])


def test_invariant_spaces_and_zero_values():
    g = np.diag([5.0, 5.0, 5.0] + [0.0] * 27)          # three equal values, the rest none
    got, vectors = krylov.leading_eigenvectors(lambda b: g @ b, 30, 5, 8)
    assert np.allclose(got, [5, 5, 5, 0, 0]) and np.allclose(vectors.T @ vectors, np.eye(5), atol=1e-9)


def test_products_meet_by_chunk_and_slice(spark, monkeypatch):
    rng = np.random.default_rng(5)
    rows = [(u, int(c), float(rng.standard_normal())) for u in range(50) for c in rng.choice(37, rng.integers(1, 20), replace=False)]
    x = np.zeros((50, 37))
    for u, c, v in rows:
        x[u, c] = v
    triples = spark.createDataFrame(rows, "u long, c long, v double")
    sparse = krylov.user_rows(triples, "u", "c", "v")
    ids = krylov.distinct_items(sparse, 2)
    block = rng.standard_normal((37, 3))
    means = np.array([[np.mean([v for w, _, v in rows if w == u])] for u in range(50)])
    centred = np.where(x != 0, x - means, 0.0)
    for chunk, step in ((1 << 17, 1 << 19), (6, 60)):
        monkeypatch.setattr(partial_sums, "CHUNK_CELLS", chunk)
        monkeypatch.setattr(krylov.user_blocks, "__defaults__", (step,))
        assert np.allclose(krylov.gramian_times(sparse, ids, block, False), x.T @ (x @ block))
        assert np.allclose(krylov.gramian_times(sparse, ids, block, True), centred.T @ (centred @ block))


def test_packed_rows_multiply_like_the_matrix_in_few_tasks(spark, monkeypatch):
    rng = np.random.default_rng(8)
    rows = [(u, int(c), float(rng.integers(1, 5))) for u in range(60) for c in rng.choice(31, rng.integers(1, 25), replace=False)]
    x = np.zeros((60, 31))
    for u, c, v in rows:
        x[u, c] = v
    triples = spark.createDataFrame(rows + [(7, 3, 2.0)] * 2, "u long, c long, v double")      # repeated cells add up
    x[7, 3] += 4.0
    sparse = krylov.user_rows(triples.repartition(40), "u", "c", "v").repartition(40)
    block = rng.standard_normal((31, 4))
    monkeypatch.setattr(krylov, "PACK_ENTRIES", 20)        # some users have more
    packed = krylov.packed_rows(sparse, krylov.distinct_items(sparse, 2), False)
    assert packed.rdd.getNumPartitions() <= spark.sparkContext.defaultParallelism and packed.count() > 20
    assert np.allclose(krylov.packed_times(packed, block), x.T @ (x @ block))


def test_best_items_over_many_steps_with_equal_predictions(spark, monkeypatch):
    rng = np.random.default_rng(9)
    cells = [(u, c, float(rng.integers(1, 5))) for u in range(30) for c in rng.choice(40, 12, replace=False).tolist()]
    df = spark.createDataFrame(cells, "u long, c long, r double")
    model = recommend.svd_model(df, "u", "c", "r", rank=2)
    x = pd.DataFrame(cells, columns=["u", "c", "r"]).pivot(index="u", columns="c", values="r")
    mean = x.mean(axis=1).to_numpy()[:, None]
    centred = (x - mean).fillna(0.0).to_numpy()
    monkeypatch.setattr(recommend, "ITEM_STEP", 3)
    for digits in (0, 1, 9):                               # no digits: almost all are equal
        pred = np.rint((centred @ model.basis @ model.basis.T + mean) * 10.0 ** digits) / 10.0 ** digits
        want = [(u, int(model.items[c]), p + 1) for u in range(30) for p, c in enumerate(np.lexsort((np.arange(len(model.items)), -pred[u]))[:4])]
        got = recommend.svd_top_k(df, "u", "c", "r", k=4, digits=digits, model=model).collect()
        assert sorted((r.u, r.c, r["rank"]) for r in got) == sorted(want, key=lambda t: (t[0], t[1], t[2]))


def test_items_may_be_text(spark):
    rows = [(u, f"c{(u * k) % 5}", float(u + k)) for u in range(1, 9) for k in (1, 2)]
    pdf = pd.DataFrame(rows, columns=["u", "c", "r"]).drop_duplicates(["u", "c"])
    df = spark.createDataFrame(pdf)
    model = recommend.svd_model(df, "u", "c", "r", rank=2, centre=False)
    x = pdf.pivot(index="u", columns="c", values="r").fillna(0.0)
    assert list(model.items) == list(x.columns) and np.allclose(model.values, np.linalg.svd(x.to_numpy(), compute_uv=False)[:2])
    assert recommend.svd_top_k(df, "u", "c", "r", k=2, model=model).where("c like 'c%'").count() == 16


def test_rmse_of_the_survey_equals_a_dense_svd(spark):
    r = rating_table(S.survey(spark, SF_SMALL))
    x = r.toPandas().pivot(index="IDNUMBER", columns="CURID", values="PUNTUACION").to_numpy()
    mean = np.nanmean(x, axis=1, keepdims=True)
    c = np.where(np.isnan(x), 0.0, x - mean)
    u, s, vt = np.linalg.svd(c, full_matrices=False)
    want = np.sqrt(np.nanmean((u[:, :6] * s[:6] @ vt[:6] + mean - x) ** 2))
    assert recommend.svd_rmse(r, "IDNUMBER", "CURID", "PUNTUACION", 6).first().rmse == pytest.approx(want, abs=1e-6)


# ---------------------------------------------------------------- exact silhouette

def _silhouette(x, lab):
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(axis=2))
    out = []
    for i in range(len(x)):
        mine = lab == lab[i]
        if mine.sum() == 1:
            out.append(0.0)
            continue
        a = d[i, mine].sum() / (mine.sum() - 1)
        b = min(d[i, lab == c].mean() for c in set(lab) - {lab[i]})
        out.append((b - a) / max(a, b) if max(a, b) > 0 else 0.0)
    return np.mean(out)


@pytest.mark.parametrize("block", [8192, 7])
def test_exact_silhouette_matches_all_pairs(spark, block, monkeypatch):
    rng = np.random.default_rng(8)
    x = np.vstack([rng.normal(i % 3, 0.7, (1, 4)) for i in range(60)] + [[[1e4, 1, 1, 1]], [[1e4, 1, 1, 1 + 1e-6]], [[0, 0, 0, 0]]])
    lab = np.array([i % 3 for i in range(60)] + [3, 3, 4])          # a tight far pair, and a point alone
    monkeypatch.setattr(silhouette, "_TILE", 5)
    rows = [(v.tolist(), f"k{c}") for v, c in zip(x, lab)] + [(None, "k0"), ([0.0] * 4, None)]
    df = spark.createDataFrame(rows, "v array<double>, c string")
    got = silhouette.silhouette_euclid(df, "v", "c", block).first()
    assert got.n_points == 63 and got.silhouette == pytest.approx(_silhouette(x, lab), abs=1e-9)


def test_exact_silhouette_of_few_clusters(spark):
    one = spark.createDataFrame([([1.0], 1), ([2.0], 1)], "v array<double>, c int")
    assert tuple(silhouette.silhouette_euclid(one, "v", "c").first()) == (None, 2)
    assert tuple(silhouette.silhouette_euclid(one.limit(0), "v", "c").first()) == (None, 0)
    same = spark.createDataFrame([([1.0], 1), ([1.0], 2), ([1.0], 1), ([1.0], 2)], "v array<double>, c int")
    assert tuple(silhouette.silhouette_euclid(same, "v", "c").first()) == (0.0, 4)


# ---------------------------------------------------------------- Newton

def test_newton_reaches_the_optimum_that_the_certificate_sees(spark, monkeypatch):
    rng = np.random.default_rng(2)
    x = rng.standard_normal((400, 3)) * [1, 1000, 1e-3] + [0, 5000, 0]
    y = (rng.random(400) < 1 / (1 + np.exp(-(x[:, 0] * 2 - (x[:, 1] - 5000) / 700)))).astype(float)
    df = spark.createDataFrame([(a.tolist(), float(b)) for a, b in zip(x, y)], "x array<double>, y double").repartition(3)
    monkeypatch.setattr(newton, "SLICE", 50)
    fit = newton.logistic_newton(df, "x", "y", l2=0.5)
    gradient, n, positive = newton.gradient_at(df, "x", "y", fit.coefficients, fit.intercept, l2=0.5)
    assert n == fit.n_rows == 400 and positive == fit.n_positive == y.sum() and gradient < 1e-6 and fit.steps < 30
    w = np.append(fit.coefficients, fit.intercept)
    z = np.hstack([x, np.ones((400, 1))])

    def objective(v):
        return np.logaddexp(0, z @ v).sum() - y @ (z @ v) + 0.25 * (v[:-1] ** 2).sum()

    for k in range(4):
        for sign in (1, -1):
            assert objective(w + sign * 1e-4 * np.eye(4)[k] / np.abs(z[:, k]).mean()) >= objective(w) - 1e-9
    off, _, _ = newton.gradient_at(df, "x", "y", fit.coefficients + [0.1, 0, 0], fit.intercept, l2=0.5)
    assert off > 1e-4                                      # elsewhere the certificate says so
    p = df.select(newton.probability("x", fit).alias("p"), "y").agg(F.sum("p"), F.sum("y")).first()
    assert p[0] == pytest.approx(p[1], abs=1e-4)           # the free intercept balances the classes


def test_newton_on_separable_and_empty_rows(spark):
    df = spark.createDataFrame([([float(i)], float(i > 5)) for i in range(12)] + [(None, 1.0), ([1.0], None)], "x array<double>, y double")
    fit = newton.logistic_newton(df, "x", "y")
    assert fit.n_rows == 12 and fit.gradient < 1e-6 and fit.coefficients[0] > 0
    with pytest.raises(ValueError):
        newton.logistic_newton(df.limit(0), "x", "y")


# ---------------------------------------------------------------- k-means certificate

def test_kmeans_certificate_tells_fixed_points_apart(spark):
    rng = np.random.default_rng(0)
    pts = np.vstack([rng.normal(c, 0.4, (80, 2)) for c in ((0, 0), (3, 0), (0, 3))])
    df = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(pts)], "i long, a double, b double")
    centers = models.settle_centers(df, ["a", "b"], pts[[0, 1, 170]], key=["i"])
    x = df.select("i", F.array("a", "b").alias("x"))
    placed = x.withColumn("lab", models.nearest_center("x", centers))
    assert tuple(models.kmeans_certificate(placed, "x", "lab", centers).first()) == (240, 3, 0, 0)
    wrong = placed.withColumn("lab", F.when(F.col("i") == 5, (F.col("lab") + 1) % 3).otherwise(F.col("lab")))
    assert tuple(models.kmeans_certificate(wrong, "x", "lab", centers).first()) == (240, 3, 1, 2)
    moved = centers + [[1e-3, 0], [0, 0], [0, 0]]
    assert models.kmeans_certificate(x.withColumn("lab", models.nearest_center("x", moved)), "x", "lab", moved).first().n_moved == 1


def test_sums_of_too_many_cells_are_refused(spark, monkeypatch):
    monkeypatch.setattr(partial_sums, "MAX_CELLS", 10)
    with pytest.raises(ValueError):
        partial_sums.summed(spark.range(3), lambda batches: np.zeros(11), 11)
    assert partial_sums.summed(spark.range(30).repartition(3), lambda b: np.array([sum(x.num_rows for x in b), 0.0]), 2).tolist() == [30.0, 0.0]
