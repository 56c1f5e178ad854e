import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from pizarra.operators import profile, reshape
from pizarra.operators.ordering import CUM, POS, with_running_totals


@pytest.fixture(scope="module")
def frame():
    rng = np.random.default_rng(7)
    n = 3000
    return pd.DataFrame({
        "g": rng.integers(0, 5, n), "u": rng.integers(0, 200, n),
        "kind": rng.choice(["e", "s", "z"], n), "v": np.round(rng.normal(10, 3, n), 2),
    })


def test_running_totals_many_partitions(spark, frame):
    df = spark.createDataFrame(frame).repartition(13)
    out = with_running_totals(df, [F.col("g"), F.col("u"), F.col("v"), F.col("kind")], weight_col="v",
                              num_partitions=11).toPandas()
    ref = frame.sort_values(["g", "u", "v", "kind"]).reset_index(drop=True)
    out = out.sort_values(POS).reset_index(drop=True)
    assert list(out[POS]) == list(range(len(frame)))
    assert np.allclose(out[CUM].to_numpy(), ref["v"].cumsum().to_numpy())


def test_describe_matches_pandas(spark, frame):
    df = spark.createDataFrame(frame)
    got = profile.describe(df, ["v", "u"]).toPandas().set_index("column")
    ref = frame[["v", "u"]].astype(float).describe()
    for c in ["v", "u"]:
        assert got.loc[c, "count"] == ref.loc["count", c]
        for ours, theirs in [("mean", "mean"), ("std", "std"), ("min", "min"), ("p25", "25%"), ("p50", "50%"),
                             ("p75", "75%"), ("max", "max")]:
            assert got.loc[c, ours] == pytest.approx(ref.loc[theirs, c], rel=1e-12)


def test_pivot_mean_matches_pivot_table(spark, frame):
    df = spark.createDataFrame(frame)
    got = reshape.pivot_mean(df, ["g", "u"], "kind", "v", ["e", "s"]).toPandas()
    ref = pd.pivot_table(frame[frame.kind.isin(["e", "s"])], index=["g", "u"], columns="kind",
                         values="v").reset_index()
    m = got.merge(ref, on=["g", "u"], suffixes=("", "_ref"))
    assert len(m) == len(ref) == len(got)
    for c in ["e", "s"]:
        assert np.allclose(m[c].fillna(-1), m[c + "_ref"].fillna(-1))


def test_melt_matches_pandas(spark, frame):
    wide = frame.groupby(["g"]).agg(a=("v", "sum"), b=("u", "sum")).reset_index()
    got = reshape.melt(spark.createDataFrame(wide), ["g"], ["a", "b"]).toPandas()
    ref = wide.melt(id_vars="g", var_name="variable", value_name="value")
    key = ["g", "variable"]
    assert got.sort_values(key).reset_index(drop=True).astype(float, errors="ignore").equals(
        ref.sort_values(key).reset_index(drop=True).astype(float, errors="ignore"))


def test_value_counts_and_nulls(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "s string")
    assert [tuple(r) for r in profile.value_counts(df, "s").collect()] == [("a", 2), ("b", 1)]
    assert profile.null_profile(df).first()["n_null"] == 1


def test_ordered_split_sizes(spark, frame):
    df = spark.createDataFrame(frame.drop_duplicates(["g", "u"]))
    train, test = reshape.ordered_split(df, ["g", "u"], 0.8)
    n = df.count()
    assert train.count() == int(n * 0.8) and test.count() == n - int(n * 0.8)
    assert train.agg(F.max(F.struct("g", "u"))).first()[0] < test.agg(F.min(F.struct("g", "u"))).first()[0]


def test_pivot_unique_refuses_duplicates(spark):
    df = spark.createDataFrame([(1, "a", 1.0), (1, "a", 2.0)], "i long, c string, v double")
    with pytest.raises(ValueError):
        reshape.pivot_unique(df, "i", "c", "v", ["a"])


def test_running_totals_split_a_hot_value(spark):
    # two thirds of the rows share one value: the numbering must still spread
    # them over several partitions and number every row exactly once
    rows = [(1.0,)] * 2000 + [(float(i),) for i in range(2, 1002)]
    df = spark.createDataFrame(rows, "v double").repartition(5)
    out = with_running_totals(df, [F.col("v")], num_partitions=4)
    sizes = out.rdd.glom().map(len).collect()
    assert max(sizes) < 2000
    assert sorted(r[POS] for r in out.select(POS).collect()) == list(range(3000))


def test_histogram_matches_numpy(spark):
    x = np.random.default_rng(4).integers(0, 97, 1000).astype(float)
    df = spark.createDataFrame([(float(v),) for v in x], "v double")
    got = {r.bin: r.n for r in profile.histogram(df, "v", 10).collect()}
    counts, _ = np.histogram(x, bins=10)
    assert [got.get(i, 0) for i in range(10)] == counts.tolist()


def test_grouping_sets_means_match_pandas(spark):
    rng = np.random.default_rng(8)
    pdf = pd.DataFrame({"u": rng.integers(0, 20, 400), "c": rng.integers(0, 7, 400), "r": rng.integers(0, 5, 400)})
    out = profile.grouped_means_nonzero(spark.createDataFrame(pdf), "u", "c", "r").toPandas()
    nz = pdf[pdf.r != 0]
    users = out[out.u.notna() & out.c.isna()].set_index("u")["mean_rating"]
    items = out[out.c.notna() & out.u.isna()].set_index("c")["mean_rating"]
    total = out[out.u.isna() & out.c.isna()]["mean_rating"].iloc[0]
    assert np.allclose(users.sort_index().to_numpy(), nz.groupby("u").r.mean().sort_index().to_numpy())
    assert np.allclose(items.sort_index().to_numpy(), nz.groupby("c").r.mean().sort_index().to_numpy())
    assert total == pytest.approx(nz.r.mean())


def test_sparsity_of_an_empty_table(spark):
    from pizarra.operators import profile

    assert profile.sparsity(spark.createDataFrame([], "u long, c long"), "u", "c").first()["sparsity"] is None


def test_sum_duplicates_and_filled_row_means(spark):
    from pizarra.operators import reshape

    df = spark.createDataFrame([(1, 10, 2.0), (1, 10, 3.0), (1, 11, 1.0), (2, 10, 4.0)], "u long, c long, r double")
    assert {(r.u, r.c): r.r for r in reshape.sum_duplicates(df, ["u", "c"], "r").collect()} == {(1, 10): 5.0, (1, 11): 1.0, (2, 10): 4.0}
    means = reshape.filled_row_means(reshape.centre_by_row_mean(df, "u", "r"), "u", "c", "centred").collect()
    assert {r.u: (r.row_mean, r.filled_mean) for r in means} == {1: (2.0, 0.0), 2: (4.0, 0.0)}
