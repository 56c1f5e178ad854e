"""Packed shuffles: fixed-width entries travel as a few binary rows per task and bucket.

Entries are parallel numpy arrays (a numpy structure).  A map task sends one
binary row for each bucket and flush; the reduce side gets the entries of one
bucket at a time, so its memory is a bucket's, whatever the number of partitions.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from pizarra.llm.common import release, shuffle_partitions

FLUSH = 1 << 20           # entries that a map task holds before it sends them
PER_BUCKET = 1 << 19      # entries that a bucket is meant to hold
SCHEMA = "bucket long, data binary"
_ARROW = pa.schema([("bucket", pa.int64()), ("data", pa.binary())])


def buckets_for(df: DataFrame, entries: int) -> int:
    return max(shuffle_partitions(df.sparkSession), int(entries // PER_BUCKET) + 1)


def bucket_of(keys: np.ndarray, n: int) -> np.ndarray:
    """Bucket by the upper 32 bits of well-mixed keys."""
    return ((keys >> np.uint64(32)) * np.uint64(n) >> np.uint64(32)).astype(np.int64)


def pack(entries: np.ndarray, bucket: np.ndarray) -> pa.RecordBatch:
    """One binary row for each bucket; entries keep their order within it.  Fields
    stand one after the other, which compresses better than whole entries."""
    order = np.argsort(bucket, kind="stable")
    entries, bucket = entries[order], bucket[order]
    cut = np.flatnonzero(np.diff(bucket)) + 1
    at = np.concatenate([[0], cut]) if len(bucket) else np.empty(0, np.int64)
    data = [b"".join(part[f].tobytes() for f in entries.dtype.names) for part in np.split(entries, cut)] if len(bucket) else []
    return pa.RecordBatch.from_arrays([pa.array(bucket[at.astype(np.int64)], pa.int64()), pa.array(data, pa.binary())], schema=_ARROW)


def unpack(data: bytes, dtype: np.dtype) -> np.ndarray:
    n = len(data) // dtype.itemsize
    out, at = np.empty(n, dtype), 0
    for f in dtype.names:
        size = n * dtype[f].itemsize
        out[f] = np.frombuffer(data, dtype[f], n, at)
        at += size
    return out


def join(blobs: list[bytes], dtype: np.dtype) -> np.ndarray:
    return np.concatenate([unpack(b, dtype) for b in blobs])


def by_bucket(df: DataFrame, process: Callable[[int, list[bytes]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """Rows of ``SCHEMA`` meet by bucket; ``process`` gets a bucket and its blobs."""

    def stream(batches):
        now, held = None, []
        for batch in batches:
            for b, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                if held and b != now:
                    yield from process(now, held)
                    held = []
                    release()
                now = b
                held.append(data.as_py())
        if held:
            yield from process(now, held)
        del held
        release()

    return (df.repartition(shuffle_partitions(df.sparkSession), "bucket").sortWithinPartitions("bucket")
            .mapInArrow(stream, schema))
