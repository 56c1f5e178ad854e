"""Aggregations and profiling.

All of these are hash aggregates with a map-side partial step, so a hot key
costs one partial row per map task, never a whole group in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pizarra.functions.scalar import round_half_even
from pizarra.operators.clean import qcol
from pizarra.operators.selection import quantiles as exact_quantiles
from pizarra.session import ensure_checkpoint_dir

NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NUMERIC)]


def value_counts(df: DataFrame, col: str, name: str = "count") -> DataFrame:
    """``Series.value_counts``: nulls ignored, most frequent first."""
    return (
        df.filter(qcol(col).isNotNull())
        .groupBy(qcol(col))
        .agg(F.count(F.lit(1)).alias(name))
        .orderBy(F.col(name).desc(), qcol(col).asc())
    )


def row_value_counts(df: DataFrame, cols: Sequence[str] | None = None, name: str = "count") -> DataFrame:
    """``DataFrame.value_counts()``: frequency of whole rows without nulls."""
    cols = list(cols or df.columns)
    return df.select([qcol(c) for c in cols]).na.drop().groupBy([qcol(c) for c in cols]).agg(
        F.count(F.lit(1)).alias(name)
    )


def count_distinct_per_group(df: DataFrame, group: Sequence[str], col: str, name: str,
                             approximate: bool = False, rsd: float = 0.01) -> DataFrame:
    """``groupby(g)[c].nunique()`` / ``COUNT(DISTINCT c)``.

    Exact: Spark rewrites it into a dedup on (group, col) with partial
    aggregation, then a count per group.  ``approximate=True`` uses
    HyperLogLog++ for very large groups.
    """
    agg = F.approx_count_distinct(qcol(col), rsd) if approximate else F.count_distinct(qcol(col))
    return df.groupBy([qcol(g) for g in group]).agg(agg.cast("long").alias(name))


def distinct_totals(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``len(col.unique())`` per column: null counts as one value."""
    aggs = []
    for c in cols:
        aggs.append(
            (F.count_distinct(qcol(c)) + F.max(qcol(c).isNull().cast("int"))).cast("long").alias(f"n_{c}")
        )
    return df.agg(*aggs)


def mean_per_group(df: DataFrame, group: Sequence[str], col: str, name: str) -> DataFrame:
    return df.groupBy([qcol(g) for g in group]).agg(F.avg(qcol(col)).alias(name))


def null_profile(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Nulls per column in one pass, returned long: (column, n_null)."""
    cols = list(cols or df.columns)
    wide = df.agg(*[F.sum(qcol(c).isNull().cast("long")).alias(c) for c in cols])
    return wide.unpivot([], cols, "column", "n_null").withColumn(
        "n_null", F.coalesce(F.col("n_null"), F.lit(0)).cast("long")
    )


def column_info(df: DataFrame) -> DataFrame:
    """``DataFrame.info()``: type and non-null count per column, plus the row count."""
    cols = df.columns
    wide = df.agg(F.count(F.lit(1)).alias("__rows"), *[F.count(qcol(c)).alias(c) for c in cols])
    types = F.create_map(*[x for c in df.schema.fields for x in (F.lit(c.name), F.lit(c.dataType.simpleString()))])
    pos = F.create_map(*[x for i, c in enumerate(cols) for x in (F.lit(c), F.lit(i))])
    return (
        wide.unpivot(["__rows"], cols, "column", "non_null")
        .select(
            F.element_at(pos, F.col("column")).cast("long").alias("position"),
            "column",
            F.element_at(types, F.col("column")).alias("dtype"),
            F.col("non_null").cast("long").alias("non_null"),
            F.col("__rows").cast("long").alias("n_rows"),
        )
    )


def describe(df: DataFrame, cols: Sequence[str] | None = None,
             quantiles: Sequence[float] = (0.25, 0.5, 0.75), approximate: bool = False,
             accuracy: int = 10000) -> DataFrame:
    """``DataFrame.describe()`` long: one row per column with count, mean,
    sample std, min, exact linear-interpolated quantiles, max.

    Quantiles are exact at any size, from radix histograms
    (:mod:`pizarra.operators.selection`): the columns are written once, and
    nothing of them is sorted or shuffled.
    """
    cols = list(cols or numeric_columns(df))
    ensure_checkpoint_dir(df.sparkSession)
    narrow = df.select([qcol(c).cast("double").alias(c) for c in cols])
    if not approximate:
        narrow = narrow.checkpoint(eager=True)
    # one pass: a row of partial aggregates per task, then one row per column
    x = [qcol(c) for c in cols]
    stats = [F.struct(F.lit(c).alias("column"), F.count(v).cast("long").alias("count"), F.avg(v).alias("mean"), F.stddev_samp(v).alias("std"),
                      F.min(v).alias("min"), F.max(v).alias("max")) for c, v in zip(cols, x)]
    basic = narrow.agg(F.array(*stats).alias("s")).select(F.inline("s")).where(F.col("count") > 0)
    names = [f"p{int(round(q * 100))}" for q in quantiles]
    if approximate:
        # one pass, bounded memory per group (Greenwald-Khanna sketch);
        # not interpolated, so it can differ from the exact quartiles
        told = narrow.agg(F.array(*[F.struct(F.lit(c).alias("column"), F.percentile_approx(v, list(quantiles), accuracy).alias("q"))
                                    for c, v in zip(cols, x)]).alias("s")).select(F.inline("s"))
        return basic.join(told, "column").select(*basic.columns, *[F.col("q")[i].alias(n) for i, n in enumerate(names)])
    rows = [(c, *q) for c, q in zip(cols, exact_quantiles(narrow, cols, quantiles))]
    schema = "column string, " + ", ".join(f"{x} double" for x in names)
    return basic.join(F.broadcast(df.sparkSession.createDataFrame(rows, schema)), "column")


def distinct_sketches(df: DataFrame, group: Sequence[str], col: str, name: str = "sketch", lg_k: int = 16) -> DataFrame:
    """A HyperLogLog sketch of ``col`` per group: a column that can be kept and merged upward
    (:func:`merge_sketches`).  The error is about ``1.04 / sqrt(2 ** lg_k)``; null values don't count."""
    return df.groupBy([qcol(g) for g in group]).agg(F.hll_sketch_agg(qcol(col), lg_k).alias(name))


def merge_sketches(sketches: DataFrame, group: Sequence[str], name: str = "sketch") -> DataFrame:
    """Sketches of finer groups as one per coarser group, without their rows."""
    return sketches.groupBy([qcol(g) for g in group]).agg(F.hll_union_agg(qcol(name)).alias(name))


def sketch_counts(sketches: DataFrame, name: str = "sketch", out: str = "n") -> DataFrame:
    """The sketches' estimates in place of the sketches."""
    return sketches.withColumn(out, F.hll_sketch_estimate(qcol(name))).drop(name)


def sparsity(ratings: DataFrame, user: str, item: str, digits: int = 3) -> DataFrame:
    """Share of empty cells of the user x item grid, without building it (null
    for an empty table)."""
    return ratings.agg(
        F.count_distinct(qcol(user), qcol(item)).alias("_pairs"),
        F.count_distinct(qcol(user)).alias("_users"),
        F.count_distinct(qcol(item)).alias("_items"),
    ).select(
        round_half_even(F.lit(1.0) - F.try_divide(F.col("_pairs"), F.col("_users") * F.col("_items")), digits).alias("sparsity")
    )


def occupancy(ratings: DataFrame, item: str, name: str = "n_ratings") -> DataFrame:
    """Filled cells per item (per column of the pivot)."""
    return ratings.groupBy(qcol(item)).agg(F.count(F.lit(1)).cast("long").alias(name))


def histogram(df: DataFrame, col: str, bins: int = 10) -> DataFrame:
    """Equal-width histogram between min and max (``Series.hist`` data).

    Bin i covers [lo + i*w, lo + (i+1)*w); the max falls in the last bin.
    """
    # global bounds as scalar subqueries: evaluated once, no join needed
    lo = df.agg(F.min(qcol(col)).cast("double")).scalar()
    hi = df.agg(F.max(qcol(col)).cast("double")).scalar()
    x = qcol(col).cast("double")
    width = (hi - lo) / F.lit(float(bins))
    raw = F.when(width == 0, F.lit(0)).otherwise(F.floor((x - lo) / width))
    b = F.least(raw, F.lit(bins - 1)).cast("long")
    binned = df.filter(qcol(col).isNotNull()).select(b.alias("bin"), (lo + width * b).alias("bin_start"))
    return binned.groupBy("bin", "bin_start").agg(F.count(F.lit(1)).cast("long").alias("n"))


def grouped_means_nonzero(ratings: DataFrame, user: str, item: str, rating: str) -> DataFrame:
    """User, item and global mean of the non-zero ratings in one pass
    (``GROUPING SETS ((user), (item), ())``)."""
    nz = ratings.filter(qcol(rating) != 0)
    return nz.groupingSets([[qcol(user)], [qcol(item)], []], qcol(user), qcol(item)).agg(
        F.avg(qcol(rating)).alias("mean_rating"),
        F.count(F.lit(1)).cast("long").alias("n_ratings"),
        F.grouping_id().alias("level"),
    )


def corr_matrix(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Pearson correlation of every numeric pair, one aggregate pass, long output."""
    cols = list(cols or numeric_columns(df))
    aggs = []
    pairs = []
    for i, a in enumerate(cols):
        for b in cols[i:]:
            name = f"{i}|{cols.index(b)}"
            pairs.append((a, b, name))
            aggs.append(F.corr(qcol(a).cast("double"), qcol(b).cast("double")).alias(name))
    wide = df.agg(*aggs)
    stacked = wide.unpivot([], [p[2] for p in pairs], "pair", "corr")
    names = F.create_map(*[x for a, b, n in pairs for x in (F.lit(n), F.array(F.lit(a), F.lit(b)))])
    half = stacked.select(F.element_at(names, F.col("pair")).alias("ab"), "corr").select(
        F.col("ab")[0].alias("col_a"), F.col("ab")[1].alias("col_b"), "corr"
    )
    mirror = half.filter(F.col("col_a") != F.col("col_b")).select(
        F.col("col_b").alias("col_a"), F.col("col_a").alias("col_b"), "corr"
    )
    return half.unionByName(mirror)
