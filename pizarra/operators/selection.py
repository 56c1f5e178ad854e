"""Exact order statistics by radix histograms: no sort, no exchange of rows.

Doubles become 64-bit keys of the same order.  A pass counts the next 16 bits of the keys that
agree with the prefixes found so far; the histogram says in which cell a wanted rank lies.
After four passes the key is known.  Only counts move.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
from pyspark.sql import DataFrame

from pizarra.operators import partial_sums
from pizarra.operators.clean import qcol

_BITS = 16
_CELLS = 1 << _BITS
_SIGN = np.uint64(1 << 63)


def order_keys(values: np.ndarray) -> np.ndarray:
    """64-bit keys in the order of the doubles; NaN is above all, both zeros are equal."""
    values = np.where(np.isnan(values), np.nan, values + 0.0)
    bits = values.view(np.uint64)
    return np.where(bits & _SIGN, ~bits, bits | _SIGN)


def key_values(keys: np.ndarray) -> np.ndarray:
    keys = np.asarray(keys, np.uint64)
    return np.where(keys & _SIGN, keys & ~_SIGN, ~keys).view(np.float64)


def _histograms(df: DataFrame, prefixes: list[list[int]], shift: int) -> list[dict[int, np.ndarray]]:
    """Per column and prefix: counts of the 16 bits at ``shift`` of the keys whose higher bits are the prefix.
    Prefixes are counted in as many jobs as the bound on a sum asks for."""
    jobs = [(c, p) for c, ps in enumerate(prefixes) for p in ps]
    most = max(1, partial_sums.MAX_CELLS // _CELLS)
    found: dict[tuple[int, int], np.ndarray] = {}
    for a in range(0, len(jobs), most):
        part = jobs[a:a + most]

        def work(batches, part=part):
            out = np.zeros((len(part), _CELLS))
            for batch in batches:
                keys = {c: order_keys(batch.column(c).drop_null().to_numpy(zero_copy_only=False)) for c in {c for c, _ in part}}
                for row, (c, p) in enumerate(part):
                    k = keys[c]
                    if shift + _BITS < 64:
                        k = k[k >> np.uint64(shift + _BITS) == np.uint64(p)]
                    out[row] += np.bincount((k >> np.uint64(shift) & np.uint64(_CELLS - 1)).astype(np.int64), minlength=_CELLS)
            return out.ravel()

        counts = partial_sums.summed(df, work, len(part) * _CELLS).reshape(len(part), _CELLS)
        found.update(zip(part, counts))
    return [{p: found[c, p] for p in ps} for c, ps in enumerate(prefixes)]


def order_statistics(df: DataFrame, cols: Sequence[str], ranks: Callable[[int], Sequence[int]]) -> list[tuple[int, dict[int, float]]]:
    """Per column: how many non-null values it has, and its ``ranks(n)``-th smallest ones (from 0), by rank.

    ``df`` is read four times, so it should be a scan or a written table.
    """
    values = df.select([qcol(c).cast("double").alias(f"c{i}") for i, c in enumerate(cols)])
    # per column: wanted rank -> (prefix so far, rank among the keys with this prefix)
    at: list[dict[int, tuple[int, int]]] = [{} for _ in cols]
    sizes = [0] * len(cols)
    for shift in range(64 - _BITS, -1, -_BITS):
        first = shift == 64 - _BITS
        prefixes = [[0] if first else sorted({p for p, _ in ranks_at.values()}) for ranks_at in at]
        counts = _histograms(values, prefixes, shift)
        for c in range(len(cols)):
            if first:
                sizes[c] = int(counts[c][0].sum())
                at[c] = {r: (0, r) for r in ranks(sizes[c]) if 0 <= r < sizes[c]}
            below = {p: np.cumsum(h) for p, h in counts[c].items()}
            for r, (p, k) in at[c].items():
                cell = int(np.searchsorted(below[p], k, side="right"))
                at[c][r] = ((p << _BITS) | cell, k - (int(below[p][cell - 1]) if cell else 0))
    return [(n, {r: float(key_values(np.array([p], np.uint64))[0]) for r, (p, _) in found.items()}) for n, found in zip(sizes, at)]


def quantiles(df: DataFrame, cols: Sequence[str], qs: Sequence[float]) -> list[list[float | None]]:
    """Per column the quantiles with linear interpolation (null for a column without values)."""
    def around(n: int) -> list[int]:
        return [r for q in qs for r in (int(float(q) * (n - 1)), min(int(float(q) * (n - 1)) + 1, n - 1))] if n else []

    out = []
    for n, value in order_statistics(df, cols, around):
        row = []
        for q in qs:
            h = float(q) * (n - 1)
            lo = value[int(h)] if n else None
            row.append(None if not n else lo + (value[min(int(h) + 1, n - 1)] - lo) * (h - int(h)))
        out.append(row)
    return out

