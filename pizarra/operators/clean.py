"""Projection, cleaning and filter operators."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pizarra.functions.scalar import ne_keep_nulls


def qcol(name: str) -> Column:
    """Column by name, safe for names such as ``%_E1`` or with accents."""
    return F.col("`" + name.replace("`", "``") + "`")


def project(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.select([qcol(c) for c in cols])


def project_by_position(df: DataFrame, positions: Sequence[int]) -> DataFrame:
    names = df.columns
    return df.select([qcol(names[i]) for i in positions])


def drop_columns(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    return df.drop(*cols)


def rename(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(mapping))


def set_header(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return df.toDF(*names)


def with_constant(df: DataFrame, name: str, value: Any) -> DataFrame:
    return df.withColumn(name, F.lit(value))


def filter_eq(df: DataFrame, col: str, value: Any) -> DataFrame:
    return df.filter(qcol(col) == F.lit(value))


def filter_ne_keep_nulls(df: DataFrame, col: str, value: Any) -> DataFrame:
    """``df[df[col] != value]``: rows where ``col`` is null are kept."""
    return df.filter(ne_keep_nulls(qcol(col), value))


def filter_ge(df: DataFrame, col: str, value: Any) -> DataFrame:
    return df.filter(qcol(col) >= F.lit(value))


def filter_in(df: DataFrame, conditions: Mapping[str, Sequence[Any]]) -> DataFrame:
    """AND of ``col IN (...)`` tests; each becomes a pushed-down ``In`` filter."""
    cond = None
    for col, values in conditions.items():
        c = qcol(col).isin(list(values))
        cond = c if cond is None else cond & c
    return df if cond is None else df.filter(cond)


def dedup_rows(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    return df.dropDuplicates(list(subset)) if subset else df.dropDuplicates()


def distinct_projection(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return project(df, cols).distinct()


def duplicate_count(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``df.duplicated(keys).sum()``: rows beyond the first of each key.

    Null keys compare equal, as in pandas; ``groupBy`` already groups nulls
    together.  Partial aggregation runs map-side, so a hot key costs one row
    per map task in the shuffle.
    """
    per_key = df.groupBy([qcol(k) for k in keys]).count()
    return per_key.agg(F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).cast("long").alias("n_duplicates"))


def drop_nulls(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    return df.na.drop(how="any", subset=list(subset) if subset else None)


def fill_nulls(df: DataFrame, values: Mapping[str, Any]) -> DataFrame:
    """Per-column constant fill that keeps each column's type."""
    return df.withColumns({c: F.coalesce(qcol(c), F.lit(v).cast(df.schema[c].dataType)) for c, v in values.items()})


def sort_values(df: DataFrame, cols: Sequence[str], ascending: bool | Sequence[bool] = True,
                tie_break: Sequence[str] = ()) -> DataFrame:
    """pandas ``sort_values``: nulls last in both directions, explicit ties."""
    if isinstance(ascending, bool):
        ascending = [ascending] * len(cols)
    order = [qcol(c).asc_nulls_last() if a else qcol(c).desc_nulls_last() for c, a in zip(cols, ascending)]
    order += [qcol(c).asc_nulls_last() for c in tie_break]
    return df.orderBy(*order)


def head(df: DataFrame, n: int, order: Sequence[Column] | None = None) -> DataFrame:
    """First ``n`` rows; with an order so the answer is repeatable."""
    return (df.orderBy(*order) if order else df).limit(n)


def capped_per_class(df: DataFrame, class_col: str, n: int, order_cols: Sequence[str]) -> DataFrame:
    """``TOP(n)`` per class, made repeatable with an explicit order.

    The position inside the class comes from the distributed numbering of
    :mod:`pizarra.operators.ordering`, so no class is ever sorted in one
    task.  ``order_cols`` should make the order total.
    """
    from pizarra.operators.ordering import GROUP_POS, with_group_positions

    placed = with_group_positions(df, qcol(class_col), [qcol(c).asc_nulls_last() for c in order_cols])
    return placed.filter(F.col(GROUP_POS) < n).select(*[F.col(f"`{c}`") for c in df.columns])
