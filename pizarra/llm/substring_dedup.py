"""Substring dedup: a count-min prefilter, then exact grouping of repeated windows.

A window of 50 words is stood for by its anchor, the run of 25 words in it with the
smallest hash, so equal windows have equal anchors and a window is no more
frequent than its anchor.  The first pass counts the anchors of each partition into
count-min rows, which are merged; the second pass keeps only windows whose anchor
is estimated to occur twice or more, and groups exactly those.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pizarra.llm.common import id_text, ship_code, slices
from pizarra.llm.hashing import gram_hashes, gram_starts, keyed, mix, span_hashes, stream, word_spans
from pizarra.llm.packed import FLUSH, SCHEMA, bucket_of, buckets_for, by_bucket, join, pack
from pizarra.llm.sketch import cells_for, count_cells, repeated

WINDOW = 50
SKETCH_ROWS = 2


def _anchors(words: np.ndarray, starts: np.ndarray, window: int) -> np.ndarray:
    """Of each window: its anchor's hash."""
    half = max(1, window // 2)
    grams = gram_hashes(words, half)
    span = window - half + 1                      # anchors that a window holds
    # sliding minimum over blocks of `span`: suffix minimum of one, prefix minimum of the next
    pad = -len(grams) % span
    top = np.iinfo(np.uint64).max
    g = np.concatenate([grams, np.full(pad + span, top, np.uint64)]).reshape(-1, span)
    suffix = np.minimum.accumulate(g[:, ::-1], axis=1)[:, ::-1].ravel()
    prefix = np.minimum.accumulate(g, axis=1).ravel()
    return np.minimum(suffix[starts], prefix[starts + span - 1])


def _windows(data, off, window: int):
    """Word hashes, each row's first word, window starts and window anchors."""
    s, e, first = word_spans(data, off)
    words = span_hashes(data, s, e, lower=False)
    at = gram_starts(first, window)
    anchors = _anchors(words, at, window) if len(at) else np.empty(0, np.uint64)
    return words, first, at, anchors


def _anchor_keys(window: int, text_index: int):
    def keys(batch):
        for rows, data, off in slices(batch, text_index):
            _, first, at, anchors = _windows(data, off, window)
            if not len(at):
                continue
            row = np.searchsorted(first, at, side="right") - 1
            # one count for each occurrence: a run of windows with the same anchor is one
            new = np.ones(len(at), bool)
            new[1:] = (anchors[1:] != anchors[:-1]) | (row[1:] != row[:-1])
            yield anchors[new]
    return keys


#: a window's occurrence: its two hashes, the document's id and text, the word it starts at
_SEEN = np.dtype([("key", np.uint64), ("check", np.uint32), ("id", np.int64), ("text", np.uint64), ("pos", np.int32)])
_LATER = np.dtype([("id", np.int64), ("text", np.uint64), ("pos", np.int32)])


def _split_later(seen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The occurrences in each window's smallest document, and the others."""
    order = np.lexsort((seen["id"], seen["check"], seen["key"]))
    s = seen[order]
    new = np.ones(len(s), bool)
    new[1:] = (s["key"][1:] != s["key"][:-1]) | (s["check"][1:] != s["check"][:-1])
    first = s["id"][np.flatnonzero(new)][np.cumsum(new) - 1]
    lead = np.empty(len(s), bool)
    lead[order] = s["id"] == first
    return seen[lead], seen[~lead][list(_LATER.names)].astype(_LATER)


def covered_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """Rows ``id, text_hash, starts, ends``: the runs of words covered by a window
    whose word sequence also starts in a document with a smaller id.

    Words are ``[^\\x20\\x09-\\x0D]+``, unchanged; windows don't cross documents and
    are judged on the input.  Rows with a null id are neither judged nor counted;
    rows that repeat an id are one document, judged by each row's own text.  Texts
    shorter than a window, and empty tables, give no rows.

    A map task settles what repeats within it and sends each window's smallest
    document only, so a passage that a third of all documents share arrives once a
    task; occurrences that are known to be later go straight on to their document.
    """
    spark = docs.sparkSession
    ship_code(spark)
    slim = id_text(docs, id_col, text_col).where(F.col("id").isNotNull())
    chars = slim.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    words = int(chars // 6) + 1                          # about six bytes a word
    cells = cells_for(words * 4 // window)               # some four anchors in two windows
    sent = spark.sparkContext.broadcast(count_cells(slim, _anchor_keys(window, 1), SKETCH_ROWS, cells))
    n = buckets_for(slim, words // 4)

    def send(seen: np.ndarray):
        lead, later = _split_later(seen)
        yield pack(lead, bucket_of(lead["key"], n))
        # buckets below 0 are documents: what is settled already
        yield pack(later, -1 - bucket_of(keyed(later["id"], 3), n))

    def suspects(batches):
        held, size = [], 0
        for batch in batches:
            for rows, data, off in slices(batch, 1):
                words, first, at, anchors = _windows(data, off, window)
                keep = repeated(sent.value, anchors, cells) if len(at) else np.empty(0, bool)
                if not keep.any():
                    continue
                at = at[keep]
                row = np.searchsorted(first, at, side="right") - 1
                seen = np.empty(len(at), _SEEN)
                seen["key"] = gram_hashes(words, window)[at]
                with np.errstate(over="ignore"):
                    seen["check"] = (gram_hashes(mix(words + stream(7, 1)[0]), window)[at] >> np.uint64(32)).astype(np.uint32)
                seen["id"] = rows.column(0).to_numpy(zero_copy_only=False)[row]
                seen["text"] = _text_hashes(data, off)[row]
                seen["pos"] = at - first[row]
                held.append(seen)
                size += len(seen)
                if size >= FLUSH:
                    yield from send(np.concatenate(held))
                    held, size = [], 0
        if held:
            yield from send(np.concatenate(held))

    def settle(bucket: int, blobs: list[bytes]):
        later = join(blobs, _LATER) if bucket < 0 else _split_later(join(blobs, _SEEN))[1]
        yield pack(later, bucket_of(keyed(later["id"], 3), n))

    def cover(_: int, blobs: list[bytes]):
        later = join(blobs, _LATER)
        if not len(later):
            return
        later = later[np.lexsort((later["pos"], later["text"], later["id"]))]
        new = np.ones(len(later), bool)
        new[1:] = (later["id"][1:] != later["id"][:-1]) | (later["text"][1:] != later["text"][:-1])
        run = new.copy()
        run[1:] |= later["pos"][1:] > later["pos"][:-1] + window
        a = np.flatnonzero(run)
        b = np.append(a[1:], len(later)) - 1
        starts, ends = later["pos"][a].astype(np.int32), later["pos"][b].astype(np.int32) + window
        docs_at = np.flatnonzero(new)
        cut = np.append(np.searchsorted(a, docs_at), len(a)).astype(np.int32)
        yield pa.RecordBatch.from_arrays(
            [pa.array(later["id"][docs_at]), pa.array(later["text"][docs_at].view(np.int64)),
             pa.ListArray.from_arrays(cut, pa.array(starts)), pa.ListArray.from_arrays(cut, pa.array(ends.astype(np.int32)))],
            names=["id", "text_hash", "starts", "ends"])

    sent_on = slim.mapInArrow(suspects, SCHEMA)
    return by_bucket(by_bucket(sent_on, settle, SCHEMA), cover, "id long, text_hash long, starts array<int>, ends array<int>")


def _text_hashes(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    out = np.zeros(len(off) - 1, np.uint64)
    full = np.flatnonzero(np.diff(off) > 0)
    out[full] = span_hashes(data, off[:-1][full], off[1:][full], lower=False)
    return out


def _removal(data, off, starts, ends):
    """Word spans, each row's first word, and which words are covered."""
    s, e, first = word_spans(data, off)
    edge = np.zeros(len(s) + 1, np.int64)
    for r, (a, b) in enumerate(zip(starts, ends)):
        if a is not None:
            edge[first[r] + np.asarray(a, np.int64)] += 1
            np.add.at(edge, first[r] + np.asarray(b, np.int64), -1)
    return s, e, first, np.cumsum(edge[:-1]) > 0


def substring_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
                     keep_text: bool = False) -> DataFrame:
    """One row per document: ``doc_id, n_words, n_removed, kept_sha256`` (of the kept
    words, joined by one space) and, if asked for, ``kept_text``."""
    slim = id_text(docs, id_col, text_col)
    covered = covered_words(docs, id_col, text_col, window)

    def hashed(batches):
        for batch in batches:
            for rows, data, off in slices(batch, 1):
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), rows.column(1), pa.array(_text_hashes(data, off).view(np.int64))], names=["id", "text", "text_hash"])

    def cut(batches):
        for batch in batches:
            for rows, data, off in slices(batch, 1):
                s, e, first, gone = _removal(data, off, rows.column(2).to_pylist(), rows.column(3).to_pylist())
                raw, n, removed, sha, texts = data.tobytes(), [], [], [], []
                s, e = s.tolist(), e.tolist()
                for r in range(len(first) - 1):
                    a, b = int(first[r]), int(first[r + 1])
                    keep = np.flatnonzero(~gone[a:b]) + a
                    text = b" ".join([raw[s[w]:e[w]] for w in keep.tolist()])
                    n.append(b - a)
                    removed.append(b - a - len(keep))
                    sha.append(hashlib.sha256(text).hexdigest())
                    if keep_text:
                        texts.append(text.decode())
                cols = [rows.column(0), pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(sha, pa.string())]
                yield pa.RecordBatch.from_arrays(
                    cols + [pa.array(texts, pa.string())] * keep_text, names=["doc_id", "n_words", "n_removed", "kept_sha256", "kept_text"][:4 + keep_text])

    joined = slim.mapInArrow(hashed, "id long, text string, text_hash long").join(
        covered.hint("shuffle_hash"), ["id", "text_hash"], "left").select("id", "text", "starts", "ends")
    return joined.mapInArrow(cut, "doc_id long, n_words long, n_removed long, kept_sha256 string" + ", kept_text string" * keep_text)
