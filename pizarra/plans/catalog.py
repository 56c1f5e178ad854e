"""Registry of the named queries exposed through ``__spark_entry__``.

Each query is a function ``(spark, sf_dir) -> DataFrame`` over the stand-in
tables, optionally paired with DuckDB SQL computing the same answer (the
correctness oracle).  Double columns listed in ``settle`` are rounded half
to even at 6 decimals on both sides, with the same arithmetic, so that
summation order cannot change the compared values.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SETTLE_DIGITS = 6
GUARD_DIGITS = 3


def settle_col(c):
    """Round half-even to 6 decimals in two steps (9, then 6 decimals).

    The first step absorbs summation-order noise, so an exact decimal tie
    at the 7th digit rounds the same way however the sum was ordered.
    """
    hi = float(10 ** (SETTLE_DIGITS + GUARD_DIGITS))
    guard = float(10 ** GUARD_DIGITS)
    lo = float(10 ** SETTLE_DIGITS)
    return F.rint(F.rint(c.cast("double") * F.lit(hi)) / F.lit(guard)) / F.lit(lo)


def settle_sql(name: str) -> str:
    hi = f"CAST({10 ** (SETTLE_DIGITS + GUARD_DIGITS)} AS DOUBLE)"
    guard = f"CAST({10 ** GUARD_DIGITS} AS DOUBLE)"
    lo = f"CAST({10 ** SETTLE_DIGITS} AS DOUBLE)"
    return f'round_even(round_even(CAST("{name}" AS DOUBLE) * {hi}, 0) / {guard}, 0) / {lo}'


@dataclass
class Query:
    name: str
    fn: Callable[[SparkSession, str], DataFrame]
    sql: str | None
    settle: tuple[str, ...] = field(default_factory=tuple)
    doc: str = ""

    def run(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        df = self.fn(spark, sf_dir)
        if self.settle:
            df = df.withColumns({c: settle_col(F.col(f"`{c}`")) for c in self.settle})
        return df

    def oracle(self) -> str | None:
        if self.sql is None:
            return None
        if not self.settle:
            return self.sql
        parts = ", ".join(f'{settle_sql(c)} AS "{c}"' for c in self.settle)
        return f"SELECT * REPLACE ({parts}) FROM ({self.sql}) AS settled"


REGISTRY: dict[str, Query] = {}


def register(name: str, sql: str | None = None, settle: Sequence[str] = ()):
    def deco(fn):
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = Query(name, fn, sql, tuple(settle), (fn.__doc__ or "").strip())
        return fn
    return deco


def load_all() -> dict[str, Query]:
    # importing the modules fills the registry
    from pizarra.plans import queries_basic, queries_models, queries_recommend, queries_stats  # noqa: F401
    return REGISTRY
