"""Scalar column functions that keep the reference's null and rounding rules.

Every function returns a ``Column`` built from ``pyspark.sql.functions`` so it
stays inside whole-stage codegen; none of them is a Python UDF.
"""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def ne_keep_nulls(col: str | Column, value: Any) -> Column:
    """``col != value`` where a null ``col`` passes (pandas mask semantics)."""
    return ~_c(col).eqNullSafe(F.lit(value))


def round_half_even(col: str | Column, digits: int = 0) -> Column:
    """Round half to even on ``x * 10^d`` like NumPy's ``round``.

    ``F.round`` rounds half up and ``F.bround`` rounds the decimal value, so
    both disagree with NumPy on binary halves such as 0.575 or 8.345.
    """
    scale = float(10 ** digits)
    if digits == 0:
        return F.rint(_c(col))
    return F.rint(_c(col) * F.lit(scale)) / F.lit(scale)


def to_numeric(col: str | Column) -> Column:
    """Text to double, null where it does not parse (``errors='coerce'``).

    ``try_cast`` also accepts Java float suffixes (``1d``, ``2f``) and turns
    ``nan`` into NaN; both become null here.
    """
    text = F.trim(_c(col).cast("string"))
    low = F.lower(text)
    parsed = F.when(low.isin("inf", "+inf", "infinity", "+infinity"), F.lit(float("inf"))).when(
        low.isin("-inf", "-infinity"), F.lit(float("-inf"))
    ).when(text.rlike("[dDfF]$"), F.lit(None).cast("double")).otherwise(
        text.try_cast("double")
    )
    return F.nanvl(parsed, F.lit(None).cast("double"))


def try_ratio(num: str | Column, den: str | Column) -> Column:
    """Division that yields null on a zero denominator instead of failing."""
    return F.try_divide(_c(num).cast("double"), _c(den).cast("double"))


def recode(col: str | Column, mapping: Mapping[Any, Any], default: Any = None) -> Column:
    """Nested ``np.where`` as one CASE: first matching key wins, else default.

    A null input matches no key and takes the default, as ``np.where`` does.
    """
    c = _c(col)
    expr = None
    for key, val in mapping.items():
        expr = F.when(c == F.lit(key), F.lit(val)) if expr is None else expr.when(c == F.lit(key), F.lit(val))
    if expr is None:
        return F.lit(default)
    return expr.otherwise(F.lit(default))


def code_map(col: str | Column, mapping: Mapping[Any, Any]) -> Column:
    """``Series.map(dict)``: null where the key is missing."""
    if not mapping:
        return F.lit(None)
    pairs = []
    for k, v in mapping.items():
        pairs.extend([F.lit(k), F.lit(v)])
    return F.try_element_at(F.create_map(*pairs), _c(col))


def day_text(col: str | Column) -> Column:
    """``FORMAT(ts, 'yyyy-MM-dd')``."""
    return F.date_format(_c(col), "yyyy-MM-dd")


def upper_key(col: str | Column) -> Column:
    """Normalised text key for name matching across systems."""
    return F.upper(_c(col))
