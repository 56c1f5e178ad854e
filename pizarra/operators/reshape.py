"""Reshape, set and ordered operators."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pizarra.operators.clean import qcol
from pizarra.operators.ordering import POS, with_running_totals


def pivot_mean(df: DataFrame, index: Sequence[str], column: str, values: str,
               pivot_values: Sequence[Any]) -> DataFrame:
    """``pivot_table(index, columns, values)`` with the default mean.

    The pivot values are passed in, so each cell is a conditional average
    in one hash aggregate on the index (one shuffle, with map-side partial
    aggregation) instead of ``pivot``'s two-step plan.  Rows whose value is
    null are dropped first, so an index whose cells would all be null
    disappears, as in pandas.
    """
    src = df.filter(qcol(values).isNotNull() & qcol(column).isin(list(pivot_values)))
    cells = [F.avg(F.when(qcol(column) == F.lit(v), qcol(values))).alias(str(v)) for v in pivot_values]
    return src.groupBy([qcol(c) for c in index]).agg(*cells)


def assert_unique(df: DataFrame, keys: Sequence[str]) -> None:
    """Fail like ``DataFrame.pivot`` does when a cell would get two values."""
    dup = df.groupBy([qcol(k) for k in keys]).count().filter(F.col("count") > 1).limit(1).count()
    if dup:
        raise ValueError(f"index contains duplicate entries for {list(keys)}, cannot reshape")


def pivot_unique(df: DataFrame, index: str, column: str, values: str, pivot_values: Sequence[Any],
                 check: bool = True) -> DataFrame:
    """``DataFrame.pivot``: one value per cell, duplicates are an error."""
    if check:
        assert_unique(df, [index, column])
    cells = [F.first(F.when(qcol(column) == F.lit(v), qcol(values)), ignorenulls=True).alias(str(v))
             for v in pivot_values]
    return df.filter(qcol(column).isin(list(pivot_values))).groupBy(qcol(index)).agg(*cells)


def sum_duplicates(df: DataFrame, keys: Sequence[str], values: str, name: str | None = None) -> DataFrame:
    """Sparse-matrix build: duplicate cells add up (kept long)."""
    return df.groupBy([qcol(k) for k in keys]).agg(F.sum(qcol(values)).alias(name or values))


def centre_by_row_mean(ratings: DataFrame, row: str, value: str, name: str = "centred") -> DataFrame:
    """Rating minus the row (user) mean over the row's present cells.

    The mean comes from an aggregate joined back on the row key instead of
    a window, so a user with many rows never has to sit sorted in one task.
    """
    means = ratings.groupBy(qcol(row)).agg(F.avg(qcol(value)).alias("_row_mean"))
    return ratings.join(means, row).withColumn(name, qcol(value) - F.col("_row_mean")).withColumnRenamed(
        "_row_mean", "row_mean"
    )


def filled_row_means(centred: DataFrame, row: str, column: str, value: str, name: str = "filled_mean") -> DataFrame:
    """Mean of each row of the wide table with its empty cells as 0: the sum of the
    row's present cells over the number of columns.  Keeps ``row_mean``."""
    n_columns = centred.agg(F.count_distinct(qcol(column))).scalar()
    return centred.groupBy(qcol(row)).agg(F.first("row_mean").alias("row_mean"), (F.sum(qcol(value)) / n_columns).alias(name))


def melt(df: DataFrame, id_vars: Sequence[str], value_vars: Sequence[str], var_name: str = "variable",
         value_name: str = "value") -> DataFrame:
    return df.unpivot(list(id_vars), list(value_vars), var_name, value_name)


def append(*dfs: DataFrame) -> DataFrame:
    out = dfs[0]
    for d in dfs[1:]:
        out = out.unionByName(d)
    return out


def top_k_per_group(df: DataFrame, group: Sequence[str], score: str, k: int,
                    tie_break: Sequence[str] = (), descending: bool = True) -> DataFrame:
    """Best ``k`` rows per group with an explicit tie order.

    ``row_number() <= k`` is planned with a per-partition group limit before
    the shuffle (k is small), so a hot group ships ``k`` rows per map task.
    """
    order = [qcol(score).desc_nulls_last() if descending else qcol(score).asc_nulls_last()]
    order += [qcol(c).asc() for c in tie_break]
    w = Window.partitionBy([qcol(g) for g in group]).orderBy(*order)
    return df.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def first_keys(df: DataFrame, key: str, n: int) -> DataFrame:
    """The ``n`` smallest distinct keys (top-n: at most ``n`` rows leave each task)."""
    return df.select(qcol(key)).distinct().orderBy(qcol(key)).limit(n)


def block_slice(df: DataFrame, row_key: str, col_key: str, n_rows: int, n_cols: int) -> DataFrame:
    """``iloc[:n_rows, :n_cols]`` of the pivot, kept long: cells whose row is
    among the first ``n_rows`` row keys and column among the first ``n_cols``.

    The two key lists are bounded by the requested sizes, so they are
    broadcast.
    """
    rows = first_keys(df, row_key, n_rows)
    cols = first_keys(df, col_key, n_cols)
    return df.join(F.broadcast(rows), row_key, "left_semi").join(F.broadcast(cols), col_key, "left_semi")


def ordered_split(df: DataFrame, order: Sequence[str], fraction: float = 0.8) -> tuple[DataFrame, DataFrame]:
    """First ``floor(fraction * n)`` rows in key order vs the rest.

    Positions come from a distributed range sort with partition offsets,
    never from one global window.
    """
    numbered = with_running_totals(df, [qcol(c).asc_nulls_last() for c in order])
    n = numbered.count()  # reads the checkpointed numbering, not the input plan
    cut = int(n * fraction)
    train = numbered.filter(F.col(POS) < cut).drop(POS)
    test = numbered.filter(F.col(POS) >= cut).drop(POS)
    return train, test


def ordered_split_flag(df: DataFrame, order: Sequence[str], fraction: float = 0.8,
                       name: str = "is_train") -> DataFrame:
    """Same split as one frame with a boolean column."""
    numbered = with_running_totals(df, [qcol(c).asc_nulls_last() for c in order])
    n = numbered.count()  # reads the checkpointed numbering, not the input plan
    cut = F.floor(F.lit(n) * F.lit(float(fraction)))
    return numbered.withColumn(name, F.col(POS) < cut)
