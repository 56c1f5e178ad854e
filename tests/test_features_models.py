import numpy as np
import pytest
from pyspark.sql import functions as F

from pizarra.operators import features, models


def test_scalers_constant_columns(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "a double, b double")
    z = features.standardise(df, ["a", "b"]).collect()
    assert [r.a for r in z] == [-1.0, 1.0] and [r.b for r in z] == [0.0, 0.0]
    mm = features.min_max(df, ["a", "b"]).collect()
    assert [r.a for r in mm] == [0.0, 1.0] and [r.b for r in mm] == [0.0, 0.0]


def test_labels_sorted_and_inverse(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("a",)], "s string")
    fit = features.fit_labels(df, ["s"])
    other = spark.createDataFrame([("b", 1), ("c", 2), ("zz", 3), (None, 4), ("a", 5)], "s string, i long")
    coded = fit.transform(other)
    assert {r.i: r.s_code for r in coded.collect()} == {1: 1, 2: 2, 3: None, 4: None, 5: 0}
    assert {r.i: r.s for r in fit.inverse(coded, {"s": "s_code"}).collect()} == {1: "b", 2: "c", 3: None, 4: None, 5: "a"}


def test_one_hot_unseen_is_zero(spark):
    train = spark.createDataFrame([("x",), ("y",)], "s string")
    fit = features.fit_one_hot(train, ["s"])
    test = spark.createDataFrame([("y",), ("z",), (None,)], "s string")
    rows = fit.transform(test).collect()
    assert fit.columns() == ["s_x", "s_y"]
    assert [tuple(r) for r in rows] == [(0, 1), (0, 0), (0, 0)]


def test_stratified_split_share(spark):
    df = spark.createDataFrame([(i, "a" if i % 3 else "b") for i in range(3000)], "id long, k string")
    out = features.hash_split(df, ["id"], 0.8, seed=7, stratify="k").groupBy("k").agg(
        F.avg(F.col("is_train").cast("double")).alias("share"), F.count("*").alias("n")).collect()
    for r in out:
        assert abs(r.share - 0.8) < 1.0 / r.n + 1e-9


def test_kmeans_labels_stable(spark):
    pts = [(float(x), float(y)) for x, y in np.random.default_rng(1).normal(0, 1, (200, 2))]
    pts += [(x + 10, y) for x, y in pts[:100]]
    df = models.vectors(spark.createDataFrame(pts, "a double, b double"), ["a", "b"])
    _, s1 = models.kmeans_labels(df, 2, seed=1)
    _, s2 = models.kmeans_labels(df, 2, seed=99)
    l1 = [r.clusters for r in s1.orderBy("a", "b").collect()]
    l2 = [r.clusters for r in s2.orderBy("a", "b").collect()]
    assert l1 == l2 and set(l1) == {1, 2}


def test_elbow_decreasing(spark):
    pts = [(float(x), float(y)) for x, y in np.random.default_rng(2).normal(0, 1, (300, 2))]
    df = spark.createDataFrame(pts, "a double, b double")
    costs = dict(models.elbow(df, ["a", "b"], range(1, 5), restarts=3))
    x = np.array(pts)
    assert costs[1] == pytest.approx(((x - x.mean(axis=0)) ** 2).sum())
    assert costs[1] > costs[2] > costs[3] > costs[4]


def test_hash_split_is_repeatable(spark):
    df = spark.createDataFrame([(i,) for i in range(500)], "id long")
    a = {r.id for r in features.hash_split(df, ["id"], 0.8, seed=3).filter("is_train").collect()}
    b = {r.id for r in features.hash_split(df.repartition(7), ["id"], 0.8, seed=3).filter("is_train").collect()}
    c = {r.id for r in features.hash_split(df, ["id"], 0.8, seed=4).filter("is_train").collect()}
    assert a == b and len(a) == 400 and a != c


def test_describe_sketch_close_to_exact(spark):
    from pizarra.operators import profile

    df = spark.createDataFrame([(float(x),) for x in np.random.default_rng(9).normal(0, 1, 5000)], "v double")
    exact = profile.describe(df, ["v"]).first()
    approx = profile.describe(df, ["v"], approximate=True).first()
    for q in ("p25", "p50", "p75"):
        assert abs(exact[q] - approx[q]) < 0.01


def test_scalers_take_columns_without_values(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 3.0)], "a double, b double")
    for scaled in (features.standardise(df, ["a", "b"]), features.min_max(df, ["a", "b"])):
        assert [r.a for r in scaled.collect()] == [None, None]


def test_null_and_unseen_categories_encode_as_zeros(spark):
    from pyspark.ml import Pipeline

    train = spark.createDataFrame([("x", 1.0), ("y", 2.0), (None, 3.0)], "s string, v double")
    model = Pipeline(stages=models.encoded_features(["s"], ["v"])).fit(train)
    new = spark.createDataFrame([("x", 0.0), ("y", 0.0), (None, 0.0), ("new", 0.0)], "s string, v double")
    got = {r.s: list(r.features) for r in model.transform(new).collect()}
    assert got == {"x": [1.0, 0.0, 0.0], "y": [0.0, 1.0, 0.0], None: [0.0, 0.0, 0.0], "new": [0.0, 0.0, 0.0]}


def test_one_cluster_inertia_on_shifted_data(spark):
    df = spark.createDataFrame([(1e9 + i,) for i in range(10)], "a double")
    assert models.inertia_one_cluster(df, ["a"]) == pytest.approx(82.5)


def test_seeds_come_from_all_rows_and_reach_far_ones(spark):
    # one far row among 30 000: D-squared sampling must pick it as an early center
    df = spark.range(30_000).selectExpr("id", "cast(id % 7 as double) as a", "if(id = 29999, 1e6, 0.0) as b")
    data = models._points(df, ["a", "b"], ["id"])
    for chain in models.seed_chains(data, 2, 3, seed=5):
        assert (chain[:, 1] == 1e6).any()


def test_every_batch_and_pass_reads_every_row(spark):
    df = spark.range(5000).selectExpr("id", "cast(id % 5 as double) as a")
    data = models._points(df, ["a"], ["id"])
    (n, sums, cost), = models._assign(data, {0: np.array([[0.0]])}, 1).values()
    assert n.sum() == 5000 and sums[0, 0] == 10_000 and cost == 30_000
    parts = [models._assign(data.where(f"pmod(xxhash64(_id), 8) = {b}"), {0: np.array([[0.0]])}, 1)[0][0].sum() for b in range(8)]
    assert sum(parts) == 5000 and min(parts) > 400
    assert sorted(models.minibatch_kmeans(df, ["a"], [2], key=["id"])[2].ravel().tolist())[0] < 2


def test_one_hot_refuses_too_many_categories(spark, monkeypatch):
    monkeypatch.setattr(features, "MAX_CATEGORIES", 3)
    with pytest.raises(ValueError):
        features.fit_one_hot(spark.range(4).selectExpr("cast(id as string) as s"), ["s"])


def test_nearest_center_a_center_at_a_time_holds_no_points_x_centers_table():
    import tracemalloc

    import numpy as np

    from pizarra.operators import models

    rng = np.random.default_rng(8)
    pts = rng.integers(0, 4, (20_000, 3)).astype(float)
    centers = np.vstack([rng.integers(0, 4, (9, 3)), [[1, 1, 1], [1, 1, 1]]]).astype(float)
    dist = ((pts[:, None, :] - centers[None, :, :]) ** 2).sum(axis=2)
    columns = np.ascontiguousarray(pts.T)
    tracemalloc.start()
    lab, best = models._nearest(columns, centers)
    assert tracemalloc.get_traced_memory()[1] < dist.nbytes
    tracemalloc.stop()
    assert (lab == dist.argmin(axis=1)).all() and (best == dist.min(axis=1)).all()


def test_boosting_passes_have_a_task_a_core(spark, monkeypatch):
    cores = spark.sparkContext.defaultParallelism
    df = spark.range(5000).selectExpr("id AS i", "id % 7 AS x")
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    spark.conf.set(key, str(4 * cores))
    try:
        table = models.boosting_table(df, ["i"])
        assert table.rdd.getNumPartitions() == cores
        assert table.agg({"i": "sum", "x": "sum"}).first() == df.agg({"i": "sum", "x": "sum"}).first()
        monkeypatch.setattr(models, "BOOST_ROWS", 5000 // (2 * cores))          # many rows: more tasks
        assert 2 * cores <= models.boosting_table(df, ["i"]).rdd.getNumPartitions() <= 4 * cores
    finally:
        spark.conf.set(key, before)
