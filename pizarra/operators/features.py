"""Feature preparation.

Scalers and one-hot layouts collect per-column statistics or checked category
lists to the driver, the way ``pyspark.ml`` models hold their parameters;
applying them is a projection with literals that stays in whole-stage codegen.
Label codes stay a table and are joined.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pizarra.operators.clean import qcol


@dataclass
class ScalerFit:
    center: dict[str, float]
    scale: dict[str, float]

    def transform(self, df: DataFrame, suffix: str = "") -> DataFrame:
        cols = {}
        for c in self.center:
            cols[c + suffix] = (qcol(c).cast("double") - F.lit(self.center[c])) / F.lit(self.scale[c])
        return df.withColumns(cols)


def fit_standard(df: DataFrame, cols: Sequence[str]) -> ScalerFit:
    """Mean and population std per column; a constant column scales by 1, and a
    column without values stays null."""
    aggs = []
    for c in cols:
        aggs += [F.avg(qcol(c)).alias(f"m_{c}"), F.stddev_pop(qcol(c)).alias(f"s_{c}")]
    row = df.agg(*aggs).first()
    center = {c: float(row[f"m_{c}"] or 0.0) for c in cols}
    scale = {c: (float(row[f"s_{c}"]) if row[f"s_{c}"] else 1.0) for c in cols}
    return ScalerFit(center, scale)


def fit_min_max(df: DataFrame, cols: Sequence[str]) -> ScalerFit:
    """Min and range per column; a constant column maps to 0, and a column
    without values stays null."""
    aggs = []
    for c in cols:
        aggs += [F.min(qcol(c)).alias(f"lo_{c}"), F.max(qcol(c)).alias(f"hi_{c}")]
    row = df.agg(*aggs).first()
    center = {c: float(row[f"lo_{c}"] or 0.0) for c in cols}
    scale = {}
    for c in cols:
        rng = float(row[f"hi_{c}"] or 0.0) - float(row[f"lo_{c}"] or 0.0)
        scale[c] = rng if rng != 0 else 1.0
    return ScalerFit(center, scale)


def standardise(df: DataFrame, cols: Sequence[str], suffix: str = "") -> DataFrame:
    return fit_standard(df, cols).transform(df, suffix)


def min_max(df: DataFrame, cols: Sequence[str], suffix: str = "") -> DataFrame:
    return fit_min_max(df, cols).transform(df, suffix)


# Code tables of so many rows at most are broadcast (some MB); others are joined by a salted key.
MAX_BROADCAST_CODES = 100_000
_SALTS = 64


def _with_code(df: DataFrame, key: Column, table: DataFrame, on: str, take: str, name: str, n: int) -> DataFrame:
    """Left join of ``take`` from a code table of ``n`` rows.  A label that a third of the rows share is dealt to many tasks."""
    side = table.select(F.col(on).alias("_on"), F.col(take).alias(name))
    if n <= MAX_BROADCAST_CODES:
        return df.join(F.broadcast(side), key == F.col("_on"), "left").drop("_on")
    dealt = side.withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1))))
    salted = df.withColumn("_salt", F.pmod(F.monotonically_increasing_id(), F.lit(_SALTS)).cast("int"))
    return salted.join(dealt, (key == F.col("_on")) & (F.col("_salt") == F.col("_part")), "left").drop("_on", "_part", "_salt")


@dataclass
class LabelFit:
    """Per column a table ``label, code`` and its number of rows; nothing of it is held on the driver."""

    codes: dict[str, DataFrame]
    sizes: dict[str, int]

    def transform(self, df: DataFrame, suffix: str = "_code") -> DataFrame:
        """Code = position in the sorted label list; unseen or null -> null."""
        for c, table in self.codes.items():
            df = _with_code(df, qcol(c).cast("string"), table, "label", "code", c + suffix, self.sizes[c])
        return df

    def inverse(self, df: DataFrame, code_cols: dict[str, str]) -> DataFrame:
        """Codes back to labels (``inverse_transform``)."""
        for c, code_col in code_cols.items():
            named = _with_code(df, qcol(code_col).cast("long"), self.codes[c], "code", "label", "_label", self.sizes[c])
            df = named.withColumn(c, F.col("_label")).drop("_label")
        return df


def fit_labels(df: DataFrame, cols: Sequence[str]) -> LabelFit:
    """Distinct values per column in code-point order (``LabelEncoder``),
    numbered by a distributed sort; nulls have no code."""
    from pizarra.operators.ordering import POS, with_running_totals

    def codes(c):
        labels = df.select(qcol(c).cast("string").alias("label")).where("label is not null").distinct()
        return with_running_totals(labels, [F.col("label")]).select("label", F.col(POS).alias("code"))

    tables = {c: codes(c) for c in cols}
    return LabelFit(tables, {c: t.count() for c, t in tables.items()})


@dataclass
class SparseOneHot:
    """One-hot encoding of columns with any number of categories: rows hold the positions of their ones."""

    labels: LabelFit

    @property
    def width(self) -> int:
        return sum(self.labels.sizes.values())

    def transform(self, df: DataFrame, name: str = "ones") -> DataFrame:
        """``df`` with an ascending array of positions below ``width``: the columns' categories stand one column after
        the other, each in code-point order.  A null or unseen value has no position."""
        out, start, at = self.labels.transform(df, "__pos"), 0, []
        for c, n in self.labels.sizes.items():
            at.append(F.col(f"`{c}__pos`") + start)
            start += n
        return out.withColumn(name, F.array_compact(F.array(*at))).drop(*[f"{c}__pos" for c in self.labels.sizes])

    def vectors(self, df: DataFrame, name: str = "features") -> DataFrame:
        """``df`` with the ones as a sparse ``ml`` vector of ``width``."""
        from pyspark.ml.feature import OneHotEncoder, VectorAssembler

        sizes = list(self.labels.sizes.items())
        pos, hot = [f"_pos{i}" for i in range(len(sizes))], [f"_hot{i}" for i in range(len(sizes))]
        # a value without a code takes one more place, which the encoder drops
        coded = self.labels.transform(df, "__pos").withColumns(
            {p: F.coalesce(F.col(f"`{c}__pos`"), F.lit(n)).cast("double") for p, (c, n) in zip(pos, sizes)}).drop(*[f"{c}__pos" for c, _ in sizes])
        top = df.sparkSession.range(1).select(*[F.lit(float(n)).alias(p) for p, (_, n) in zip(pos, sizes)])
        encoder = OneHotEncoder(inputCols=pos, outputCols=hot, dropLast=True).fit(top)
        return VectorAssembler(inputCols=hot, outputCol=name).transform(encoder.transform(coded)).drop(*pos, *hot)


def fit_sparse_one_hot(df: DataFrame, cols: Sequence[str]) -> SparseOneHot:
    return SparseOneHot(fit_labels(df, cols))


# A one-hot layout has a column per category, so the count is checked first.
MAX_CATEGORIES = 10_000


@dataclass
class OneHotFit:
    categories: dict[str, list[str]]

    def columns(self) -> list[str]:
        return [f"{c}_{v}" for c, vals in self.categories.items() for v in vals]

    def transform(self, df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
        """``get_dummies``: one 0/1 column per (column, category) seen at fit;
        a null or unseen value gives all zeros; the same columns at scoring."""
        out: list[Column] = [qcol(k) for k in keep]
        for c, vals in self.categories.items():
            for v in vals:
                out.append(F.when(qcol(c).cast("string") == F.lit(v), 1).otherwise(0).alias(f"{c}_{v}"))
        return df.select(*out)


def fit_one_hot(df: DataFrame, cols: Sequence[str]) -> OneHotFit:
    """Sorted category list per column; a column of more than
    ``MAX_CATEGORIES`` values is refused before its values are read."""
    counts = df.agg(*[F.count_distinct(qcol(c)).alias(f"n{i}") for i, c in enumerate(cols)]).first()
    for i, c in enumerate(cols):
        if counts[f"n{i}"] > MAX_CATEGORIES:
            raise ValueError(f"column {c!r} has {counts[f'n{i}']} categories; one-hot encoding takes {MAX_CATEGORIES} at most")
    lists = df.agg(*[F.array_sort(F.collect_set(qcol(c).cast("string"))).alias(f"v{i}") for i, c in enumerate(cols)]).first()
    return OneHotFit({c: list(lists[f"v{i}"]) for i, c in enumerate(cols)})


def hash_split(df: DataFrame, key: Sequence[str], fraction: float = 0.8, seed: int = 0,
               stratify: str | None = None, name: str = "is_train") -> DataFrame:
    """Seeded 80/20 split, optionally stratified.

    Rows are ordered by the MD5 of key and seed, then by the key; the first
    ``fraction`` of each stratum in that order is train.  Positions come
    from the distributed numbering, so no stratum is sorted in a single task;
    without strata a row's global position decides and nothing is joined.
    """
    from pizarra.operators.ordering import GROUP_N, GROUP_POS, POS, with_group_positions, with_running_totals

    text = F.concat_ws("|", *[qcol(k).cast("string") for k in key], F.lit(str(seed)))
    order = [F.md5(text.cast("binary")), *[qcol(k).asc_nulls_last() for k in key]]
    if stratify is None:
        numbered = with_running_totals(df, order)
        cut = int(numbered.count() * float(fraction))  # reads the checkpointed numbering
        return numbered.withColumn(name, F.col(POS) < cut).drop(POS)
    placed = with_group_positions(df, qcol(stratify), order)
    return placed.withColumn(name, F.col(GROUP_POS) < F.floor(F.col(GROUP_N) * F.lit(float(fraction)))).drop(GROUP_POS, GROUP_N)
