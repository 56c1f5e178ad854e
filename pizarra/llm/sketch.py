"""Count-min rows merged across partitions, for "seen at least twice?" tests.

Each task counts its keys into cells and sends the touched cells, packed, with
counts cut at 2 (a cut sum still says "two or more").  Cells are merged by block of
the row; what comes back is one bit per cell: count of two or more.  An estimate never falls
short, so nothing that repeats is lost; a full sketch only prunes less.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from pizarra.llm.common import shuffle_partitions
from pizarra.llm.hashing import mix, stream

MAX_CELLS = 1 << 30          # the bits are broadcast: 128 MB a row at most
BLOCK_CELLS = 1 << 20


def cells_for(keys: int) -> int:
    """Cells a row: a power of two, eight a key, within ``MAX_CELLS``."""
    n = 1 << 20
    while n < 8 * keys and n < MAX_CELLS:
        n *= 2
    return n


def cell(keys: np.ndarray, row: int, cells: int) -> np.ndarray:
    return (mix(keys ^ stream(101, row + 1)[row]) & np.uint64(cells - 1)).astype(np.int64)


def count_cells(df: DataFrame, keys_of, rows: int, cells: int) -> list[np.ndarray]:
    """``keys_of(batch)`` yields arrays of 64-bit keys.  The merged rows as packed bits."""

    def counted(batches):
        n_blocks = -(-cells // BLOCK_CELLS)
        for batch in batches:
            out = {"row": [], "block": [], "cells": []}
            parts = list(keys_of(batch))
            keys = np.concatenate(parts) if parts else np.empty(0, np.uint64)
            for r in range(rows if len(keys) else 0):
                at, n = np.unique(cell(keys, r, cells), return_counts=True)
                packed = ((at % BLOCK_CELLS) * 2 + (n > 1)).astype(np.uint32)
                cut = np.searchsorted(at, np.arange(n_blocks + 1) * BLOCK_CELLS)
                for b in np.flatnonzero(np.diff(cut)).tolist():
                    out["row"].append(r)
                    out["block"].append(b)
                    out["cells"].append(packed[cut[b]:cut[b + 1]].tobytes())
            yield pa.RecordBatch.from_pydict(out, schema=pa.schema(
                [("row", pa.int32()), ("block", pa.int32()), ("cells", pa.binary())]))

    def merged(batches):
        sums: dict = {}
        for batch in batches:
            for r, b, packed in zip(*(c.to_pylist() for c in batch.columns)):
                x = np.frombuffer(packed, np.uint32)
                s = sums.setdefault((r, b), np.zeros(BLOCK_CELLS, np.uint8))
                at = x >> 1
                s[at] = np.minimum(s[at] + 1 + (x & 1), 2)
        for (r, b), s in sums.items():
            yield pa.RecordBatch.from_pydict({"row": [r], "block": [b], "bits": [np.packbits(s == 2).tobytes()]}, schema=pa.schema(
                [("row", pa.int32()), ("block", pa.int32()), ("bits", pa.binary())]))

    blocks = (df.mapInArrow(counted, "row int, block int, cells binary")
              .repartition(shuffle_partitions(df.sparkSession), "row", "block")
              .mapInArrow(merged, "row int, block int, bits binary"))
    bits = [np.zeros(max(cells, BLOCK_CELLS) // 8, np.uint8) for _ in range(rows)]
    for x in blocks.toLocalIterator():  # bounded by rows * MAX_CELLS / 8 bytes
        a = x["block"] * (BLOCK_CELLS // 8)
        bits[x["row"]][a:a + BLOCK_CELLS // 8] = np.frombuffer(x["bits"], np.uint8)
    return bits


def repeated(bits: list[np.ndarray], keys: np.ndarray, cells: int) -> np.ndarray:
    """Whether each key's estimate is two or more."""
    out = np.ones(len(keys), bool)
    for r, row in enumerate(bits):
        at = cell(keys, r, cells)
        out &= (row[at >> 3] >> (7 - (at & 7)).astype(np.uint8) & 1).astype(bool)
    return out
