"""Toxicity by multiple-instance learning: sentences are the instances of a document.

A sentence's probability is a logistic function of its hashed words and word
beginnings; the document's is their noisy-or, 1 - prod(1 - p).  Only document
labels are needed to fit it, and the fitted sentence scores then locate the
offending sentences.
"""

from __future__ import annotations

import zlib

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pizarra.llm.common import arrow_rows, col, fresh, id_text, ship_code, slices, through, written
from pizarra.llm.hashing import NOT_ALNUM, byte_set, span_hashes, word_spans

BITS = 22
PREFIXES = (3, 4, 5, 6)         # bytes of a word's beginning that are features besides the word
FIT_ROWS = 1500                 # labelled rows of each class that the fit may take (documented bound)
TEXT_ROWS = 64                  # fit texts that a task takes in at a time
DRIVER_HITS = 1 << 22           # chosen features in the fit's sentences that the driver sums up; more are summed in tasks
STEPS, RATE = 150, 0.1
MIN_RATIO = 16.0
SHRINK = 1e-4
SENTENCE_END = byte_set(b".!?\n")


def _features(data: np.ndarray, off: np.ndarray):
    """Word spans' first sentence-wise features: ``(feat, sent, sent_row)`` where
    ``feat`` is (words, kinds) and ``sent`` the sentence of each word."""
    s, e, first = word_spans(data, off, NOT_ALNUM)
    kinds = [span_hashes(data, s, e, lower=True)]
    for k in PREFIXES:
        kinds.append(span_hashes(data, s, np.minimum(e, s + k), lower=True) + np.uint64(k))
    feat = np.stack([(h >> np.uint64(64 - BITS)).astype(np.int32) for h in kinds], axis=1)
    ends = np.zeros(len(data) + 1, np.int64)
    np.cumsum(SENTENCE_END[data], out=ends[1:])
    row = np.repeat(np.arange(len(off) - 1), np.diff(first))
    mark = ends[s] if len(s) else np.empty(0, np.int64)
    new = np.ones(len(s), bool)
    if len(s) > 1:
        new[1:] = (mark[1:] != mark[:-1]) | (row[1:] != row[:-1])
    return feat, np.cumsum(new) - 1, row[new], s, e, new


def _softplus(z):
    return np.logaddexp(0.0, z)


def is_held_out(ids) -> np.ndarray:
    return np.array([x is not None and zlib.crc32(str(x).encode()) % 5 == 0 for x in ids], bool)


class Model:
    """Weights of the chosen features (none negative) and the sentence bias."""

    def __init__(self, ids: np.ndarray, w: np.ndarray, b: float):
        self.ids, self.w, self.b = ids, w, b
        self.table = np.zeros(1 << BITS, np.float32)
        self.table[ids] = w

    def __reduce__(self):
        return Model, (self.ids, self.w, self.b)

    def sentences(self, data, off):
        feat, sent, rows, s, e, new = _features(data, off)
        z = np.bincount(sent, weights=self.table[feat].sum(axis=1), minlength=len(rows))[:len(rows)] + self.b
        return z, rows, s, e, new

    def scores(self, data, off) -> np.ndarray:
        """Noisy-or score of each row; a row without sentences has 0."""
        z, rows, *_ = self.sentences(data, off)
        return _noisy_or(z, rows, len(off) - 1)


def _noisy_or(z, rows, n):
    return -np.expm1(-np.bincount(rows, weights=_softplus(z), minlength=n)[:n])


def _never(b: float) -> Model:
    return Model(np.empty(0, np.int64), np.empty(0, np.float32), b)


def _count(counts: np.ndarray, data: np.ndarray, off: np.ndarray, y: np.ndarray) -> None:
    """Add to ``counts`` (class, feature) the rows of each class that have each feature."""
    feat, sent, rows, *_ = _features(data, off)
    for k in range(feat.shape[1]):
        has = np.unique(rows[sent] << BITS | feat[:, k])
        for c in (0, 1):
            np.add.at(counts[c], has[y[has >> BITS] == c] & ((1 << BITS) - 1), 1)


def _choose(f: np.ndarray, clean: np.ndarray, toxic: np.ndarray, neg: int, pos: int) -> tuple[np.ndarray, np.ndarray]:
    """The features whose document counts speak for label 1 (likelihood ratio of
    ``MIN_RATIO`` or more), and their log odds."""
    f, clean, toxic = f[toxic > 0], clean[toxic > 0].astype(float), toxic[toxic > 0].astype(float)
    odds = np.log((toxic + 0.25) / (pos + 0.5)) - np.log((clean + 0.25) / (neg + 0.5))
    share = (toxic + clean) / (pos + neg)
    ratio = 2 * (toxic * np.log(np.maximum(toxic, 1e-9) / (pos * share)) + clean * np.log(np.maximum(clean, 1e-9) / (neg * share)))
    chosen = (odds > 0) & (ratio >= MIN_RATIO)
    return f[chosen], odds[chosen]


def _hits(data: np.ndarray, off: np.ndarray, ids: np.ndarray):
    """All that the fit needs of each row: the number of its sentences without chosen
    features, and for each chosen feature its sentence (those with any are numbered
    through all rows) and its place in ``ids``; ``rows`` has the row of each such sentence."""
    feat, sent, rows, *_ = _features(data, off)
    n, place = len(off) - 1, np.full(1 << BITS, -1, np.int32)
    place[ids] = np.arange(len(ids))
    feat = place[feat]
    word, kind = np.nonzero(feat >= 0)
    some, at = np.unique(sent[word], return_inverse=True)
    plain = np.bincount(rows, minlength=n) - np.bincount(rows[some], minlength=n)
    return plain, rows[some], at, feat[word, kind]


def _sums(y, weight, plain, rows, at, place, w, b) -> tuple[np.ndarray, float]:
    """Gradient of the weighted loss over the rows of ``_hits``, by weight and bias."""
    n = len(y)
    z = np.clip(np.bincount(at, weights=w[place], minlength=len(rows)) + b, -30, 30)
    flat = float(np.clip(b, -30, 30))
    total = np.bincount(rows, weights=_softplus(z), minlength=n) + plain * _softplus(flat)     # -log(1 - p)
    # d loss / d total: 1 for label 0, -(1 - p) / p for label 1
    slope = np.where(y == 1, -1.0 / np.maximum(np.expm1(np.minimum(total, 50.0)), 1e-4), 1.0) * weight
    slope = np.where(plain + np.bincount(rows, minlength=n) > 0, slope, 0.0)
    dz = slope[rows] / (1.0 + np.exp(-z))
    return np.bincount(place, weights=dz[at], minlength=len(w)), dz.sum() + (slope * plain).sum() / (1.0 + np.exp(-flat))


def _adam(ids: np.ndarray, odds: np.ndarray, sums: Callable, steps: int, rate: float) -> Model:
    """Weights, kept at 0 or above, and the bias by full-batch Adam over ``sums(w, b)``."""
    w, b = 0.3 * odds, -6.0
    m, v, mb, vb = np.zeros_like(w), np.zeros_like(w), 0.0, 0.0
    for t in range(1, steps + 1):
        g, gb = sums(w, b)
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        mb, vb = 0.9 * mb + 0.1 * gb, 0.99 * vb + 0.01 * gb * gb
        c1, c2, step = 1 - 0.9 ** t, 1 - 0.99 ** t, rate * (1 - (t - 1) / steps)
        s = step / (np.sqrt(v / c2) + 1e-5)
        w = np.maximum(w - s * (m / c1) - s * SHRINK, 0.0)
        b -= step * (mb / c1) / (np.sqrt(vb / c2) + 1e-8)
    used = w > 0
    return Model(ids[used], w[used].astype(np.float32), float(b))


_HITS = "id long, h long, y int, plain long, size long, ends binary, place binary"


def _hit_rows(table: pa.Table):
    """The arguments of ``_sums`` from rows of ``_HITS``, but for the weights of the rows."""
    y, plain, n = (table.column(c).to_numpy().astype(np.int64) for c in ("y", "plain", "size"))
    ends = [np.frombuffer(x, np.int32) for x in table.column("ends").to_pylist()]      # of each sentence with hits
    rows = np.repeat(np.arange(len(y)), [len(x) for x in ends])
    size = np.concatenate([np.diff(x, prepend=0) for x in ends]) if ends else np.empty(0, np.int64)
    place = np.frombuffer(b"".join(table.column("place").to_pylist()), np.int32)
    return y, plain, rows, np.repeat(np.arange(len(rows)), size), place


def _fit_sample(sample: DataFrame, steps: int = STEPS, rate: float = RATE) -> Model:
    """Fit on all of ``sample (id, h, y, text)``, texts whole.  They stay in the tasks: the driver
    gets feature counts (at most ``2 ** BITS``), and of the sentences no more than
    ``DRIVER_HITS`` chosen features, or else a sum of gradients from each task and step."""
    spark = sample.sparkSession
    n = {r["y"]: r["count"] for r in sample.groupBy("y").count().collect()}
    neg, pos = n.get(0, 0), n.get(1, 0)
    if pos == 0 or neg == 0:
        return _never(-20.0 if pos == 0 else 0.0)

    def count(batches):
        counts = np.zeros((2, 1 << BITS), np.int32)
        for batch in batches:
            for rows, data, off in slices(batch, 1):
                _count(counts, data, off, rows.column(0).to_numpy())
        f = np.flatnonzero(counts.any(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(f), pa.array(counts[0, f].astype(np.int64)), pa.array(counts[1, f].astype(np.int64))], names=["f", "clean", "toxic"])

    def choose(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays(list(map(pa.array, _choose(*(c.to_numpy() for c in batch.columns), neg, pos))), names=["f", "odds"])

    with arrow_rows(spark, TEXT_ROWS):
        counted = written(sample.select("y", "text").mapInArrow(count, "f long, clean long, toxic long"), "counts")
    chosen = counted.groupBy("f").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")).where("toxic > 0").mapInArrow(
        choose, "f long, odds double").toArrow().sort_by("f")
    ids, odds = chosen.column("f").to_numpy(), chosen.column("odds").to_numpy()
    shared = spark.sparkContext.broadcast(ids)

    def hit(batches):
        for batch in batches:
            for rows, data, off in slices(batch, 3):
                plain, row, at, place = _hits(data, off, shared.value)
                k = len(off) - 1
                first = np.searchsorted(row, np.arange(k + 1))                  # sentences of each row
                cut = np.searchsorted(at, np.arange(len(row) + 1))              # hits of each sentence
                ends = [(cut[i + 1:j + 1] - cut[i]).astype(np.int32).tobytes() for i, j in zip(first, first[1:])]
                places = [place[cut[i]:cut[j]].astype(np.int32).tobytes() for i, j in zip(first, first[1:])]
                size = np.diff(cut[first])
                yield pa.RecordBatch.from_arrays([*rows.columns[:3], pa.array(plain), pa.array(size), pa.array(ends, pa.binary()), pa.array(places, pa.binary())],
                                                 names=["id", "h", "y", "plain", "size", "ends", "place"])

    with arrow_rows(spark, TEXT_ROWS):
        hits = written(sample.select("id", "h", "y", "text").mapInArrow(hit, _HITS), "hits")
    share = np.array([0.5 / neg, 0.5 / pos])
    if hits.agg(F.sum(F.col("size") + 1)).first()[0] <= DRIVER_HITS:
        rows = _hit_rows(hits.toArrow().sort_by([("id", "ascending"), ("h", "ascending")]))
        return _adam(ids, odds, lambda w, b: _sums(rows[0], share[rows[0]], *rows[1:], w, b), steps, rate)

    def sums(w, b):
        now = spark.sparkContext.broadcast((w, b))

        def part(batches):
            g, gb = np.zeros(len(w)), 0.0
            for batch in batches:
                rows = _hit_rows(pa.Table.from_batches([batch]))
                x, xb = _sums(rows[0], share[rows[0]], *rows[1:], *now.value)
                g, gb = g + x, gb + xb
            yield pa.RecordBatch.from_arrays([pa.array([g.tobytes()], pa.binary()), pa.array([gb])], names=["g", "gb"])

        with arrow_rows(spark, TEXT_ROWS):
            parts = list(hits.mapInArrow(part, "g binary, gb double").toLocalIterator())
        now.destroy()
        return sum(np.frombuffer(r["g"]) for r in parts), sum(r["gb"] for r in parts)

    return _adam(ids, odds, sums, steps, rate)


def fit_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 label_col: str = "toxic", fit_rows: int = FIT_ROWS) -> Model:
    """Fit on at most ``fit_rows`` labelled rows of each class, those with the
    smallest hash of their id, and never on a row whose crc32(id as text) mod 5
    is 0; the texts of these rows are read whole.  Null labels and ids are left out; a row
    of either table that repeats counts once.  Without both classes the model scores
    everything 0 (or, with toxic rows only, 0.5 and up for texts with words)."""
    ship_code(docs.sparkSession)
    texts = id_text(docs, id_col, text_col)
    y = labels.select(col(id_col).cast("long").alias("id"), col(label_col).cast("int").alias("y")).where(
        "id is not null and y in (0, 1) and crc32(cast(cast(id as string) as binary)) % 5 <> 0").groupBy("id").agg(F.max("y").alias("y"))
    chosen = [y.where(F.col("y") == c).orderBy(F.xxhash64("id"), "id").limit(fit_rows) for c in (0, 1)]
    rows = chosen[0].unionByName(chosen[1])  # at most 2 * fit_rows ids: a bounded broadcast
    sample = texts.join(F.broadcast(rows), "id").select("id", F.xxhash64("text").alias("h"), "y", "text").dropDuplicates(["id", "text"])
    return _fit_sample(written(sample, "fit"))


def with_score(docs: DataFrame, model: Model, text_col: str = "text") -> tuple[DataFrame, str]:
    """``docs`` and its score in a new column; that column's name."""
    name = fresh("toxicity", docs.columns)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def scored(batch, first):
        for rows, data, off in slices(batch, first):
            yield rows, [pa.array(sent.value.scores(data, off))]

    return through(docs, [col(text_col).cast("string")], scored, [(name, "double")]), name


def toxicity_report(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id, held_out, score, predicted`` and the most
    offending sentence's ``start`` and ``end`` byte with its own score (null
    without words).  Null and empty texts score 0; a null id isn't held out.
    """
    model = fit_toxicity(docs, labels, id_col, text_col)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def judged(batches):
        m = sent.value
        for batch in batches:
            for rows, data, off in slices(batch, 1):
                n = len(off) - 1
                z, row, s, e, new = m.sentences(data, off)
                score = _noisy_or(z, row, n)
                a = np.full(n, -1)
                order = np.lexsort((z, row))          # the last of each row is its largest
                a[row[order]] = order
                at = np.flatnonzero(new)
                last = np.append(at[1:], len(s)) - 1
                some = a >= 0
                lo, hi, top = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n)
                lo[some] = s[at[a[some]]] - off[:-1][some]
                hi[some] = e[last[a[some]]] - off[:-1][some]
                top[some] = -np.expm1(-_softplus(z[a[some]]))
                ids = rows.column(0)
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(is_held_out(ids.to_pylist())), pa.array(score), pa.array((score >= 0.5).astype(np.int32)),
                     pa.array(lo, mask=~some), pa.array(hi, mask=~some), pa.array(top, mask=~some)],
                    names=["doc_id", "held_out", "score", "predicted", "start", "end", "sentence_score"])

    return id_text(docs, id_col, text_col).mapInArrow(
        judged, "doc_id long, held_out boolean, score double, predicted int, start long, end long, sentence_score double")


def drop_toxic(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               threshold: float = 0.5) -> DataFrame:
    """``docs`` without the rows that score ``threshold`` or more."""
    scored, name = with_score(docs, fit_toxicity(docs, labels, id_col, text_col), text_col)
    return scored.where(F.col(name) < threshold).drop(name)
