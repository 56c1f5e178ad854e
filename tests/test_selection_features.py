import numpy as np
import pytest
from pyspark.sql import functions as F

from pizarra.operators import features, partial_sums, profile, selection


def test_keys_have_the_order_of_the_doubles():
    x = np.array([-np.inf, -1e300, -2.5, -1e-310, -0.0, 0.0, 5e-324, 1.0, 1.0000000000000002, 1e300, np.inf, np.nan, -np.nan])
    k = selection.order_keys(x)
    assert (np.diff(k[:11].astype(object)) >= 0).all() and k[4] == k[5] and k[10] < k[11] == k[12]
    back = selection.key_values(k)
    assert np.array_equal(back[:11], x[:11]) and np.isnan(back[11:]).all()


@pytest.mark.parametrize("cells", [10_000_000, 1 << 16])      # all prefixes in one job, or one a job
def test_order_statistics_match_a_sort(spark, monkeypatch, cells):
    monkeypatch.setattr(partial_sums, "MAX_CELLS", cells)
    rng = np.random.default_rng(cells)
    a = np.concatenate([rng.normal(0, 1e5, 150), np.full(150, 3.25), rng.integers(-3, 3, 100).astype(float)])
    rows = [(float(v), int(i % 7) if i % 5 else None, None) for i, v in enumerate(a)]
    df = spark.createDataFrame(rows, "a double, `b.c` int, z double").repartition(5).checkpoint()
    got = selection.order_statistics(df, ["a", "b.c", "z"], lambda n: [0, 1, n // 3, n - 1, n + 5])
    b = np.sort([r[1] for r in rows if r[1] is not None])
    for (n, found), want in zip(got, (np.sort(a), b, np.zeros(0))):
        assert n == len(want) and found == {r: float(want[r]) for r in (0, 1, n // 3, n - 1) if 0 <= r < n}


def test_describe_by_selection(spark):
    rng = np.random.default_rng(1)
    rows = [(float(v), int(v * 10), None) for v in rng.normal(5, 2, 333)] + [(None, 3, None), (float(-1e9), None, None)]
    df = spark.createDataFrame(rows, "x double, `y.z` int, none double")
    got = {r["column"]: r for r in profile.describe(df).collect()}
    assert set(got) == {"x", "y.z"}                            # a column without values has no row
    for name, i in (("x", 0), ("y.z", 1)):
        v = np.array([r[i] for r in rows if r[i] is not None], float)
        r = got[name]
        assert r["count"] == len(v) and r["min"] == v.min() and r["max"] == v.max()
        assert np.allclose([r["mean"], r["std"], r["p25"], r["p50"], r["p75"]], [v.mean(), v.std(ddof=1), *np.quantile(v, [0.25, 0.5, 0.75])])
    about = {r["column"]: r for r in profile.describe(df, ["x"], approximate=True).collect()}
    assert about["x"]["p50"] == pytest.approx(got["x"]["p50"], abs=0.2)
    plan = profile.describe(df, ["x"])._jdf.queryExecution().toString()
    assert "Sort" not in plan and "rangepartitioning" not in plan


def test_sketches_merge_upward(spark):
    df = spark.range(40_000).select((F.col("id") % 4).alias("g"), (F.col("id") % 9).alias("d"), (F.col("id") % 9_000).cast("string").alias("v"))
    fine = profile.distinct_sketches(df.unionByName(df.limit(5).withColumn("v", F.lit(None).cast("string"))), ["g", "d"], "v")
    assert fine.count() == 36
    up = {r.g: r.n for r in profile.sketch_counts(profile.merge_sketches(fine, ["g"])).collect()}
    exact = {r.g: r.n for r in profile.count_distinct_per_group(df, ["g"], "v", "n").collect()}
    assert all(abs(up[g] - n) <= 0.02 * n for g, n in exact.items()) and len(up) == 4


@pytest.mark.parametrize("bound", [100_000, 10])              # a broadcast code table, or a salted join
def test_wide_one_hot(spark, monkeypatch, bound):
    monkeypatch.setattr(features, "MAX_BROADCAST_CODES", bound)
    n = 50_000 if bound > 10 else 500
    df = spark.range(n + 300).select("id", F.when(F.col("id") < n, F.format_string("v%07d", F.col("id"))).alias("a.b"),
                                     F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, "x").alias("c"))
    fit = features.fit_sparse_one_hot(df, ["a.b", "c"])
    assert fit.width == n + 2
    wrong = fit.transform(df).where(
        F.col("ones") != F.array_compact(F.array(F.when(F.col("id") < n, F.col("id")),
                                                 F.when(F.col("id") % 3 == 0, n).when(F.col("id") % 3 == 1, n + 1).cast("long"))))
    assert wrong.isEmpty() and fit.transform(df).count() == n + 300
    unseen = spark.createDataFrame([(0, "nobody", None), (1, "v0000002", "hot")], "id long, `a.b` string, c string")
    assert [r.ones for r in fit.transform(unseen).orderBy("id").collect()] == [[], [2, n]]
    vec = [r.features for r in fit.vectors(unseen).orderBy("id").collect()]
    assert [v.size for v in vec] == [n + 2] * 2 and [sorted(v.indices.tolist()) for v in vec] == [[], [2, n]]
    coded = fit.labels.transform(unseen).drop("c")
    assert [r.c for r in fit.labels.inverse(coded, {"c": "c_code"}).orderBy("id").collect()] == [None, "hot"]
