"""Model fitting and scoring with ``pyspark.ml``.

Everything trains distributed: the data stay in executors and only model
parameters (coefficients, centers, trees) live on the driver.  Numbers are
not expected to equal scikit-learn's or XGBoost's; the objectives are the
same (logistic regression) or the same kind of model is fitted (boosted
trees, perceptron, k-means).
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, MultilayerPerceptronClassifier
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pizarra.operators.clean import qcol
from pizarra.session import ensure_checkpoint_dir


def fit_table(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """``df`` dealt by ``key`` and written once to the checkpoint folder, for a fit
    that reads it again and again.

    It has as many partitions as the session's ``spark.sql.shuffle.partitions``,
    however its input was partitioned and whatever its size.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(n, *[qcol(k) for k in key]).checkpoint(eager=True)


# Rows of a task of a boosting pass, beyond which there are more tasks than cores.
BOOST_ROWS = 1 << 20


def boosting_table(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """:func:`fit_table` in as many partitions as the cluster has cores, more (up to those of
    ``fit_table``) beyond ``BOOST_ROWS`` rows each.

    A hundred trees of five levels are some 600 passes, each a job: tasks of few rows would cost more than their rows.
    """
    table = fit_table(df, key)
    cores = max(1, table.sparkSession.sparkContext.defaultParallelism)
    return table.coalesce(max(cores, -(-table.count() // BOOST_ROWS)))


def encoded_features(categorical: Sequence[str], numeric: Sequence[str], out: str = "features") -> list:
    """``get_dummies`` + numeric columns as one vector.

    Categories come from the training data (code-point order); a null or
    unseen value encodes as all zeros, in training too, and the vector layout
    is the training one.  (The indexer keeps such values as one more category,
    the last, and the encoder drops the last.)  Numeric columns must have no
    nulls: drop them first.
    """
    stages = []
    vec_cols = []
    if categorical:
        idx_cols = [f"{c}__idx" for c in categorical]
        oh_cols = [f"{c}__oh" for c in categorical]
        stages.append(StringIndexer(inputCols=list(categorical), outputCols=idx_cols,
                                    stringOrderType="alphabetAsc", handleInvalid="keep"))
        stages.append(OneHotEncoder(inputCols=idx_cols, outputCols=oh_cols, dropLast=True, handleInvalid="error"))
        vec_cols += oh_cols
    vec_cols += list(numeric)
    stages.append(VectorAssembler(inputCols=vec_cols, outputCol=out, handleInvalid="error"))
    return stages


def logistic_pipeline(categorical: Sequence[str], numeric: Sequence[str], label: str, n_train: int,
                      c: float = 1.0, max_iter: int = 1000, tol: float = 1e-6) -> Pipeline:
    """L2 logistic regression with the objective of ``LogisticRegression(C=c)``.

    scikit-learn minimises C*sum(logloss) + ||w||^2/2; dividing by C*n gives
    Spark's mean(logloss) + regParam/2 ||w||^2 with regParam = 1/(C*n).
    """
    lr = LogisticRegression(featuresCol="features", labelCol=label, regParam=1.0 / (c * max(n_train, 1)),
                            elasticNetParam=0.0, standardization=False, maxIter=max_iter, tol=tol, fitIntercept=True)
    return Pipeline(stages=encoded_features(categorical, numeric) + [lr])


def gbt_classifier_pipeline(categorical: Sequence[str], numeric: Sequence[str], label: str, trees: int = 100,
                            seed: int = 123) -> Pipeline:
    gbt = GBTClassifier(featuresCol="features", labelCol=label, maxIter=trees, seed=seed)
    return Pipeline(stages=encoded_features(categorical, numeric) + [gbt])


def gbt_regressor_pipeline(numeric: Sequence[str], label: str, trees: int = 100, seed: int = 0) -> Pipeline:
    gbt = GBTRegressor(featuresCol="features", labelCol=label, maxIter=trees, seed=seed)
    return Pipeline(stages=encoded_features([], numeric) + [gbt])


def mlp_pipeline(n_features: int, label: str, hidden: Sequence[int] = (100, 100), max_iter: int = 300,
                 seed: int = 1, features: str = "features") -> MultilayerPerceptronClassifier:
    layers = [n_features, *hidden, 2]
    return MultilayerPerceptronClassifier(featuresCol=features, labelCol=label, layers=layers, maxIter=max_iter,
                                          seed=seed)


def positive_probability(df: DataFrame, prob_col: str = "probability", name: str = "p1") -> DataFrame:
    return df.withColumn(name, vector_to_array(qcol(prob_col))[1])


def feature_importances(model: PipelineModel, names: Sequence[str]) -> list[tuple[str, float]]:
    imp = model.stages[-1].featureImportances.toArray()
    return [(n, float(v)) for n, v in zip(names, imp)]


# ------------------------------------------------------------------ k-means


def vectors(df: DataFrame, cols: Sequence[str], out: str = "features") -> DataFrame:
    return df.withColumn(out, array_to_vector(F.array(*[qcol(c).cast("double") for c in cols])))


def kmeans_labels(df: DataFrame, k: int, seed: int = 1, features: str = "features", out: str = "clusters",
                  max_iter: int = 300, key: Sequence[str] | None = None):
    """Fit k-means and label rows 1..k, clusters numbered by centroid order.

    Centroids are sorted lexicographically, so the same partition of the
    data gets the same numbers whatever the run.  ``key`` (by default all
    other columns) deals the rows for the fit.
    """
    fit_on = fit_table(df, key or [c for c in df.columns if c != features])
    model = KMeans(k=k, seed=seed, featuresCol=features, predictionCol="_raw", maxIter=max_iter).fit(fit_on)
    centers = [tuple(c) for c in model.clusterCenters()]
    order = sorted(range(len(centers)), key=lambda i: centers[i])
    relabel = {raw: pos + 1 for pos, raw in enumerate(order)}
    m = F.create_map(*[x for a, b in relabel.items() for x in (F.lit(a), F.lit(b))])
    scored = model.transform(df).withColumn(out, F.element_at(m, F.col("_raw"))).drop("_raw")
    return model, scored


def inertia_one_cluster(df: DataFrame, cols: Sequence[str]) -> float:
    """k=1 inertia: total squared distance to the mean (MLlib needs k >= 2).

    From Spark's running variance, which doesn't cancel on shifted data."""
    aggs = [(F.coalesce(F.var_pop(qcol(c).cast("double")), F.lit(0.0)) * F.count(qcol(c))).alias(f"v{i}") for i, c in enumerate(cols)]
    return float(sum(df.agg(*aggs).first()))


def _points(df: DataFrame, cols: Sequence[str], key: Sequence[str]) -> DataFrame:
    x = F.array(*[qcol(c).cast("double") for c in cols])
    return fit_table(df.select(x.alias("x"), F.xxhash64(*[qcol(k) for k in key]).alias("_id")), ["_id"])


_RACE = pa.schema([("chain", pa.int32()), ("time", pa.float64()), ("x", pa.list_(pa.float64()))])


def _decoded(batch, dim: int) -> np.ndarray:
    """The points of a batch, one row a coordinate."""
    return np.ascontiguousarray(batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, dim).T)


def _nearest(pts: np.ndarray, centers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of the nearest center (the first of equals) and the squared distance to it, a center at a time."""
    best, lab = np.full(pts.shape[1], np.inf), np.zeros(pts.shape[1], np.intp)
    for c, center in enumerate(centers):
        dist = (pts[0] - center[0]) ** 2
        for x, v in zip(pts[1:], center[1:]):
            dist += (x - v) ** 2
        near = dist < best
        best[near], lab[near] = dist[near], c
    return lab, best


def seed_chains(data: DataFrame, k: int, chains: int, seed: int) -> list[np.ndarray]:
    """k-means++ seeding over all rows: ``chains`` sequences of ``k`` centers, each next
    one drawn with probability proportional to the squared distance to the
    nearest so far.  The first j centers of a chain seed a model of j clusters.

    A draw is an exponential race: every row gets -log(u) / weight, u from a hash of
    its id, and the smallest wins, so one pass draws a center for all chains and
    only the winners reach the driver.
    """
    spark = data.sparkSession
    dim = len(data.select("x").first()["x"])
    found: list[list[np.ndarray]] = [[] for _ in range(chains)]
    for j in range(k):
        sent = spark.sparkContext.broadcast([np.array(c) for c in found])

        def race(batches, j=j, sent=sent):
            for batch in batches:
                if not batch.num_rows:
                    continue
                pts = _decoded(batch, dim)
                ids = batch.column("_id").to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
                rows = []
                for c, centers in enumerate(sent.value):
                    with np.errstate(over="ignore"):
                        h = ids ^ np.uint64((seed * 1_000_003 + c * 1009 + j + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
                        h = (h ^ h >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
                        h = (h ^ h >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
                        h ^= h >> np.uint64(31)
                    u = ((h >> np.uint64(11)).astype(float) + 0.5) / 2.0 ** 53
                    weight = np.ones(len(ids)) if not len(centers) else _nearest(pts, centers)[1]
                    # rows that coincide with a center lose unless all do
                    time = -np.log(u) / np.maximum(weight, 1e-300)
                    best = int(time.argmin())
                    rows.append({"chain": c, "time": float(time[best]), "x": pts[:, best].tolist()})
                yield pa.RecordBatch.from_pylist(rows, schema=_RACE)

        won = (data.mapInArrow(race, "chain int, time double, x array<double>").groupBy("chain")
               .agg(F.min_by("x", F.struct("time", "x")).alias("x")).collect())   # one row a chain
        for r in won:
            found[r["chain"]].append(np.array(r["x"], dtype=float))
    return [np.array(c).reshape(-1, dim) for c in found]


def _assign(data: DataFrame, models: dict[int, np.ndarray], dim: int) -> dict[int, tuple[np.ndarray, np.ndarray, float]]:
    """One pass: per model the clusters' sizes and sums and the total cost.  Tasks
    send sums, which Spark adds up; models x clusters rows reach the driver."""
    sent = data.sparkSession.sparkContext.broadcast(models)
    names = ["m", "c", "n", "cost"] + [f"s{j}" for j in range(dim)]

    def step(batches):
        sums = {m: np.zeros((dim + 2, len(cen))) for m, cen in sent.value.items()}      # of the whole task
        for batch in batches:
            if not batch.num_rows:
                continue
            pts = _decoded(batch, dim)
            for m, cen in sent.value.items():
                lab, dist = _nearest(pts, cen)
                for j, weights in enumerate((None, dist, *pts)):
                    sums[m][j] += np.bincount(lab, weights=weights, minlength=len(cen))
        rows = [(m, c, int(s[0, c]), *s[1:, c].tolist()) for m, s in sums.items() for c in np.flatnonzero(s[0]).tolist()]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*rows), [pa.int32(), pa.int32(), pa.int64()] + [pa.float64()] * (dim + 1))], names=names)

    schema = "m int, c int, n long, cost double, " + ", ".join(f"s{j} double" for j in range(dim))
    total = (data.select("x").mapInArrow(step, schema).groupBy("m", "c")
             .agg(*[F.sum(c).alias(c) for c in ["n", "cost"] + [f"s{j}" for j in range(dim)]]).collect())
    out = {m: (np.zeros(len(c)), np.zeros((len(c), dim)), 0.0) for m, c in models.items()}
    for r in total:
        n, sums, cost = out[r["m"]]
        n[r["c"]], sums[r["c"]] = r["n"], [r[f"s{j}"] for j in range(dim)]
        out[r["m"]] = (n, sums, cost + r["cost"])
    return out


def batched_kmeans(df: DataFrame, cols: Sequence[str], ks: Sequence[int], restarts: int = 20, seed: int = 123,
                   max_iter: int = 300, tol: float = 1e-4, key: Sequence[str] | None = None) -> list[tuple]:
    """Lloyd's k-means for every (k, restart) at once: one pass over the data
    per iteration serves all models that still move.

    Each restart (the reference's ``n_init``) has its own k-means++ seeds, drawn from
    all rows.  Returns ``(k, restart, inertia)`` for every model, the inertia of
    its final centers.
    """
    if not ks:
        return []
    dim = len(cols)
    data = _points(df, cols, list(key or cols))
    chains = seed_chains(data, max(ks), restarts, seed)
    names = [(k, r) for k in ks for r in range(restarts)]
    centers = {m: chains[r][:k].copy() for m, (k, r) in enumerate(names)}
    # convergence as in scikit-learn: squared center shift <= tol * mean variance
    n_rows = data.count()
    xs = data.select(*[F.col("x")[j].alias(f"x{j}") for j in range(dim)])
    threshold = tol * inertia_one_cluster(xs, xs.columns) / max(n_rows * dim, 1)
    moving = set(centers)
    for _ in range(max_iter):
        if not moving:
            break
        for m, (n, sums, _) in _assign(data, {m: centers[m] for m in moving}, dim).items():
            new = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], centers[m])
            if float(((new - centers[m]) ** 2).sum()) <= threshold:
                moving.discard(m)
            centers[m] = new
    final = _assign(data, centers, dim)
    return [(k, r, final[m][2]) for m, (k, r) in enumerate(names)]


def minibatch_kmeans(df: DataFrame, cols: Sequence[str], ks: Sequence[int], batches: int = 8, epochs: int = 2,
                     seed: int = 2, key: Sequence[str] | None = None) -> dict[int, np.ndarray]:
    """Mini-batch k-means for every k: rows are dealt to ``batches`` batches by a hash of
    their key, and in every epoch each batch moves the centers by its share of
    all rows seen, so every row is read in every epoch.  Centers by k."""
    dim = len(cols)
    data = _points(df, cols, list(key or cols))
    chain = seed_chains(data, max(ks), 1, seed)[0]
    centers = {k: chain[:k].copy() for k in ks}
    seen = {k: np.zeros(k) for k in ks}
    for _ in range(epochs):
        for b in range(batches):
            batch = data.where(F.pmod(F.xxhash64("_id"), F.lit(batches)) == b)
            for k, (n, sums, _) in _assign(batch, centers, dim).items():
                seen[k] += n
                centers[k] += (sums - n[:, None] * centers[k]) / np.maximum(seen[k], 1)[:, None]
    return centers


def settle_centers(df: DataFrame, cols: Sequence[str], centers: np.ndarray, key: Sequence[str] | None = None,
                   max_iter: int = 1000) -> np.ndarray:
    """Lloyd's steps from ``centers`` until they stand still (a library fit stops a little before)."""
    data = _points(df, cols, list(key or cols))
    centers = np.array(centers, dtype=float)
    for _ in range(max_iter):
        n, sums, _ = _assign(data, {0: centers}, len(cols))[0]
        new = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], centers)
        if np.abs(new - centers).max() <= 1e-12 * max(1.0, np.abs(centers).max()):
            return centers
        centers = new
    raise RuntimeError(f"the centers did not stand still in {max_iter} steps")


def kmeans_certificate(df: DataFrame, features: str, label: str, centers: np.ndarray, tolerance: float = 1e-9) -> DataFrame:
    """Whether labels and centers are a fixed point of Lloyd's method, from all rows of ``df``.

    One row: ``n_points``, ``n_clusters``, ``n_misplaced`` (rows whose own center, number ``label`` from 0, isn't
    the nearest) and ``n_moved`` (clusters whose center isn't the mean of their rows).  Both are 0 at a fixed point.
    """
    x = qcol(features)
    dist = [F.aggregate(F.zip_with(x, F.array(*[F.lit(float(v)) for v in c]), lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda acc, v: acc + v)
            for c in centers]
    placed = df.select(x.alias("x"), qcol(label).alias("lab"), F.array(*dist).alias("d")).select(
        "x", "lab", (F.get("d", F.col("lab")) > F.array_min("d") * (1 + tolerance) + tolerance).alias("off"))
    dim = len(centers[0])
    per = placed.groupBy("lab").agg(F.count(F.lit(1)).alias("n"), F.count_if("off").alias("off"),
                                    *[F.avg(F.col("x")[j]).alias(f"m{j}") for j in range(dim)])
    center = F.array(*[F.array(*[F.lit(float(v)) for v in c]) for c in centers])
    shift = F.greatest(*[F.abs(F.col(f"m{j}") - F.get(center, F.col("lab"))[j]) for j in range(dim)], F.lit(0.0))
    return per.agg(F.sum("n").cast("long").alias("n_points"), F.count(F.lit(1)).cast("long").alias("n_clusters"),
                   F.sum("off").cast("long").alias("n_misplaced"), F.count_if(shift > tolerance).cast("long").alias("n_moved"))


def nearest_center(features: str, centers: np.ndarray) -> Column:
    """Index of the nearest center of an array column."""
    x = qcol(features)
    dist = [F.aggregate(F.zip_with(x, F.array(*[F.lit(float(v)) for v in c]), lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda acc, v: acc + v)
            for c in centers]
    return F.array_min(F.array(*[F.struct(d.alias("d"), F.lit(i).alias("i")) for i, d in enumerate(dist)]))["i"]


def elbow(df: DataFrame, cols: Sequence[str], ks: Sequence[int] = range(1, 11), restarts: int = 20,
          seed: int = 123) -> list[tuple[int, float]]:
    """Best-of-``restarts`` inertia (within-cluster sum of squares) per k."""
    fits = batched_kmeans(df, cols, [k for k in ks if k >= 2], restarts, seed)
    best: dict[int, float] = {}
    for k, _, cost in fits:
        best[k] = min(best.get(k, np.inf), cost)
    if 1 in ks:
        best[1] = inertia_one_cluster(df, cols)
    return sorted(best.items())


def compare_clusterers(df: DataFrame, cols: Sequence[str], ks: Sequence[int] = range(3, 7)) -> list[tuple]:
    """k-means vs mini-batch k-means, both over all rows, for each k:
    Davies-Bouldin and silhouette."""
    from pizarra.operators.stats import davies_bouldin, silhouette_sq

    arr = df.select(F.array(*[qcol(c).cast("double") for c in cols]).alias("_arr"), *[qcol(c) for c in cols])
    data = fit_table(vectors(arr, cols), list(cols))
    mini = minibatch_kmeans(df, cols, list(ks))
    out = []
    for k in ks:
        full = KMeans(k=k, seed=1, featuresCol="features", predictionCol="_lab").fit(data).transform(data)
        for name, lab in (("kmeans", full), ("minibatch_kmeans", data.withColumn("_lab", nearest_center("_arr", mini[k])))):
            db = davies_bouldin(lab, "_arr", "_lab").first()["davies_bouldin"]
            sil = silhouette_sq(lab, "_arr", "_lab").first()["silhouette"]
            out.append((name, k, float(db), None if sil is None else float(sil)))
    return out
