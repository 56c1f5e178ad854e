"""L2 logistic regression by Newton steps, with a certificate of its optimum.

A step is one aggregate over the rows: loss, gradient and the matrix of second derivatives as sums,
of (features + 1) squared numbers; the driver solves the small system.  The objective is
``sum(logloss) + l2 / 2 * |w|^2`` with the intercept free, that of ``LogisticRegression(C=1/l2)``.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pizarra.operators.clean import qcol
from pizarra.operators.models import encoded_features
from pizarra.operators.partial_sums import summed

MAX_STEPS = 100
SLICE = 1 << 15


@dataclass
class Optimum:
    coefficients: np.ndarray
    intercept: float
    n_rows: int
    n_positive: int
    gradient: float      # the largest component of the mean objective's gradient, over all rows
    steps: int


def _sums(rows: DataFrame, w: np.ndarray) -> tuple[float, np.ndarray, np.ndarray, int, int]:
    """Loss, gradient and second derivatives of the data part at ``w`` (the intercept last), rows and positive rows."""
    d = len(w)
    sent = rows.sparkSession.sparkContext.broadcast(w)

    def work(batches):
        at, out = sent.value, np.zeros(3 + d + d * d)
        for batch in batches:
            y_all = batch.column(1).to_numpy(zero_copy_only=False)
            x_all = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(len(y_all), d - 1)
            for a in range(0, len(y_all), SLICE):
                x, y = np.hstack([x_all[a:a + SLICE], np.ones((len(y_all[a:a + SLICE]), 1))]), y_all[a:a + SLICE]
                z = x @ at
                p = np.where(z >= 0, 1 / (1 + np.exp(-np.abs(z))), np.exp(-np.abs(z)) / (1 + np.exp(-np.abs(z))))
                out[0] += (np.logaddexp(0.0, z) - y * z).sum()
                out[1] += len(y)
                out[2] += y.sum()
                out[3:3 + d] += x.T @ (p - y)
                out[3 + d:] += (x.T @ (x * (p * (1 - p))[:, None])).ravel()
        return out

    total = summed(rows, work, 3 + d + d * d)
    sent.destroy()
    return total[0], total[3:3 + d], total[3 + d:].reshape(d, d), round(total[1]), round(total[2])


def logistic_newton(df: DataFrame, features: str, label: str, l2: float = 1.0, tolerance: float = 1e-9) -> Optimum:
    """Fit on the rows of ``df`` (an array column of doubles, a 0/1 label), which should be a written table.

    Ends when the gradient of the mean objective, taken over all rows, is below ``tolerance`` in every
    component beside the mean size of its feature, or no longer gets smaller.  Rows without features or label are left out.
    """
    rows = df.select(qcol(features).alias("x"), qcol(label).cast("double").alias("y")).na.drop()
    width = rows.select(F.size("x").alias("n")).agg(F.min("n"), F.max("n")).first()
    if width[0] is None or width[0] != width[1]:
        raise ValueError("a fit needs rows, all with equally many features")
    w = np.zeros(width[0] + 1)
    pull = np.full(len(w), float(l2))
    pull[-1] = 0.0
    best, step, halved = None, np.zeros(len(w)), 0
    for k in range(MAX_STEPS):
        loss, g, h, n, pos = _sums(rows, w + step)
        at = w + step
        value, g, h = loss + 0.5 * (pull * at * at).sum(), g + pull * at, h + np.diag(pull)
        if best is not None and value > best[0] + 1e-9 * abs(best[0]) and halved < 30:
            step, halved = step / 2, halved + 1       # too far: half way back
            continue
        gradient = np.abs(g).max() / n
        if best is not None and gradient >= best[1] and abs(value - best[0]) <= 1e-9 * abs(best[0]):
            break                                     # rounding is all that is left
        w, halved, best = at, 0, (value, gradient, n, pos, k)
        scale = 1 / np.sqrt(np.maximum(np.diag(h), 1e-300))
        if (np.abs(g) * scale).max() / np.sqrt(n) <= tolerance:
            break
        step = -scale * np.linalg.solve(h * scale[:, None] * scale[None, :], scale * g)
    _, gradient, n, pos, k = best
    return Optimum(w[:-1], float(w[-1]), n, pos, float(gradient), k + 1)


def gradient_at(df: DataFrame, features: str, label: str, coefficients: np.ndarray, intercept: float, l2: float = 1.0) -> tuple[float, int, int]:
    """The certificate: the largest component of the mean objective's gradient over all rows of ``df``,
    its rows and its positive rows.  The objective is strictly convex, so 0 is the optimum and nothing else is."""
    rows = df.select(qcol(features).alias("x"), qcol(label).cast("double").alias("y")).na.drop()
    w = np.append(coefficients, intercept)
    _, g, _, n, pos = _sums(rows, w)
    return float(np.abs(g + l2 * np.append(coefficients, 0.0)).max() / max(n, 1)), n, pos


def probability(features: str, fit: Optimum) -> Column:
    """Probability of label 1 as a column expression."""
    terms = F.zip_with(qcol(features), F.array(*[F.lit(float(c)) for c in fit.coefficients]), lambda a, b: a * b)
    return 1 / (1 + F.exp(-(F.aggregate(terms, F.lit(0.0), lambda acc, v: acc + v) + F.lit(fit.intercept))))


def encoded_rows(df: DataFrame, categorical: list[str], numeric: list[str], label: str) -> DataFrame:
    """``x array<double>`` (the pipeline's layout) and ``y``."""
    model = Pipeline(stages=encoded_features(categorical, numeric)).fit(df)
    return model.transform(df).select(vector_to_array("features").alias("x"), qcol(label).cast("double").alias("y"))

