"""Mean silhouette with the Euclidean distance itself, exact, from pairs of point blocks.

Every point needs its distance to every other one, so the work is quadratic in the
points.  No pair of points is ever a row: a task gets two blocks of bounded size and sends, for
each of their points and each cluster, the sum of the distances.  A point is copied once per
block, and points x clusters sums per block are added up.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pizarra.operators.clean import qcol
from pizarra.operators.stats import MAX_CLUSTERS, as_double_array
from pizarra.session import ensure_checkpoint_dir

BLOCK_POINTS = 8192
_TILE = 512
_CLOSE = 1e-6      # squared distances below this share of the squared norms are taken from the differences


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    na, nb = (a * a).sum(axis=1), (b * b).sum(axis=1)
    norms = na[:, None] + nb[None, :]
    sq = norms - 2 * (a @ b.T)
    i, j = np.nonzero(sq <= _CLOSE * norms)     # cancelled: the products say nothing here
    if len(i):
        sq[i, j] = ((a[i] - b[j]) ** 2).sum(axis=1)
    return np.sqrt(np.maximum(sq, 0.0))


def _cluster_sums(a: np.ndarray, b: np.ndarray, lab_a: np.ndarray, lab_b: np.ndarray, k: int, same: bool):
    """Per point of ``a`` (and of ``b``) and cluster: the sum of its distances to the other side."""
    left, right = np.zeros((len(a), k)), np.zeros((len(b), k))
    member_a, member_b = np.eye(k)[lab_a], np.eye(k)[lab_b]
    for i in range(0, len(a), _TILE):
        for j in range(0, len(b), _TILE):
            d = _distances(a[i:i + _TILE], b[j:j + _TILE])
            left[i:i + _TILE] += d @ member_b[j:j + _TILE]
            if not same:
                right[j:j + _TILE] += d.T @ member_a[i:i + _TILE]
    return left, right


def silhouette_euclid(df: DataFrame, features: str, label: str, block_points: int = BLOCK_POINTS) -> DataFrame:
    """``silhouette`` and ``n_points``: the mean over all points of (b - a) / max(a, b).

    a is the mean distance to the other points of the own cluster, b the smallest mean distance
    to another cluster; a point alone in its cluster, or one that coincides with all, scores 0.
    Rows without label or features are no points.  With fewer than two clusters it is null.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    pts = df.select(as_double_array(features).alias("x"), qcol(label).alias("lab")).na.drop()
    sizes = pts.groupBy("lab").count().limit(MAX_CLUSTERS + 1).collect()
    if len(sizes) > MAX_CLUSTERS:
        raise ValueError(f"{label!r} has more than {MAX_CLUSTERS} values")
    if len(sizes) < 2:
        n = sum(r["count"] for r in sizes)
        return spark.range(1).select(F.lit(None).cast("double").alias("silhouette"), F.lit(n).cast("long").alias("n_points"))
    sizes = sorted(sizes, key=lambda r: r["lab"])
    k, total = len(sizes), sum(r["count"] for r in sizes)
    code = F.create_map(*[c for i, r in enumerate(sizes) for c in (F.lit(r["lab"]), F.lit(i))])
    numbered = pts.select(F.monotonically_increasing_id().alias("pid"), "x", F.element_at(code, F.col("lab")).alias("own")).checkpoint(eager=True)

    # blocks are bounded; below the bound there are as many as give every core a pair of them
    cores, nb = max(1, spark.sparkContext.defaultParallelism), max(1, math.ceil(total / block_points))
    while nb * (nb + 1) // 2 < cores and nb < total:
        nb += 1
    block = F.pmod(F.xxhash64("pid"), F.lit(nb)).cast("int")
    dealt = numbered.withColumn("b", block).withColumn("o", F.explode(F.sequence(F.lit(0), F.lit(nb - 1)))).select(
        "pid", "x", "own", "b", F.least("b", "o").alias("lo"), F.greatest("b", "o").alias("hi"))

    def sums(group: pa.Table) -> pa.Table:
        lo, hi = group.column("lo")[0].as_py(), group.column("hi")[0].as_py()
        x = group.column("x").combine_chunks()
        x = x.flatten().to_numpy(zero_copy_only=False).reshape(len(group), -1)
        pid, own, b = (group.column(c).to_numpy() for c in ("pid", "own", "b"))
        first, second = np.flatnonzero(b == lo), np.flatnonzero(b == hi)
        left, right = _cluster_sums(x[first], x[second], own[first], own[second], k, lo == hi)
        sides = [(first, left)] if lo == hi else [(first, left), (second, right)]
        rows = np.concatenate([s for s, _ in sides])
        return pa.table({"pid": np.repeat(pid[rows], k), "own": np.repeat(own[rows], k),
                         "cluster": np.tile(np.arange(k, dtype=np.int32), len(rows)), "s": np.concatenate([v for _, v in sides]).ravel()})

    parts = dealt.groupBy("lo", "hi").applyInArrow(sums, "pid long, own int, cluster int, s double")
    n = F.element_at(F.array(*[F.lit(float(r["count"])) for r in sizes]), F.col("cluster") + 1)
    mine = F.col("cluster") == F.col("own")
    per_point = parts.groupBy("pid", "own", "cluster").agg(F.sum("s").alias("s")).withColumn("n", n).groupBy("pid").agg(
        F.max(F.when(mine, F.try_divide(F.col("s"), F.col("n") - 1))).alias("a"), F.min(F.when(~mine, F.col("s") / F.col("n"))).alias("b"))
    score = F.coalesce(F.try_divide(F.col("b") - F.col("a"), F.greatest("a", "b")), F.lit(0.0))   # a is null for a point alone
    return per_point.agg(F.avg(score).alias("silhouette"), F.count(F.lit(1)).cast("long").alias("n_points"))
