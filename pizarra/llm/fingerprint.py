"""Document fingerprints: a quartile digest of hashed byte triplets.

Byte triplets at a few fixed spreads are hashed into buckets; each bucket's count
is coded by the quartile it falls in (2 bits), after a header with the length
on a log scale and a checksum.  Digests are compared by a bounded difference
score: a step of one or two quartiles costs as much, opposite ends cost more.
Likeness is beside the worst that the occupied buckets allow, so short texts, which
occupy few, aren't alike for the empty ones.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pizarra.llm.common import id_text, ship_code, shuffle_partitions, slices, text_buffers
from pizarra.llm.hashing import mix

BUCKETS = 256
#: distances of a triplet's second and third byte from its first
SPREADS = ((5, 11), (7, 17), (1, 2))   # the last also where a text is too short for the others
OPPOSITE = 6            # cost of the lowest against the highest quartile
LENGTH_COST = 4         # cost of each step of the length code
WORST = BUCKETS * OPPOSITE // 4   # a difference of so much or more has likeness 0, also among short texts' few buckets
CHUNK = 1 << 20


def bucket_counts(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Triplet counts of each row, (rows, BUCKETS).  Spreads beyond a row's end don't count."""
    n = len(off) - 1
    out = np.zeros(n * BUCKETS, np.int64)
    row = np.repeat(np.arange(n, dtype=np.int64), np.diff(off))
    wide = data.astype(np.uint32)
    for k, (i, j) in enumerate(SPREADS):
        m = len(data) - j
        for a in range(0, max(m, 0), CHUNK):
            b = min(a + CHUNK, m)
            x = wide[a:b] | wide[a + i:b + i] << np.uint32(8) | wide[a + j:b + j] << np.uint32(16)
            x = (x + np.uint32(k << 24)) * np.uint32(0x9E3779B1)
            x = ((x ^ (x >> np.uint32(15))) * np.uint32(0x85EBCA77)) >> np.uint32(24)
            same = row[a:b] == row[a + j:b + j]
            at = row[a:b][same] * BUCKETS + x[same]
            if len(at):
                lo = int(at[0] // BUCKETS) * BUCKETS     # rows stand in order
                c = np.bincount(at - lo)
                out[lo:lo + len(c)] += c
    return out.reshape(n, BUCKETS)


def length_code(n_bytes: np.ndarray) -> np.ndarray:
    """Four steps a doubling."""
    return np.minimum(np.round(4 * np.log2(np.maximum(n_bytes, 0) + 1.0)), 255).astype(np.uint8)


def digests(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """(rows, 2 + BUCKETS) codes: length, checksum, quartile of each bucket."""
    counts = bucket_counts(data, off)
    n = len(counts)
    out = np.zeros((n, 2 + BUCKETS), np.uint8)
    if n == 0:
        return out
    ranked = np.sort(counts, axis=1)
    cuts = ranked[:, [BUCKETS // 4 - 1, BUCKETS // 2 - 1, 3 * BUCKETS // 4 - 1]]
    for k in range(3):
        out[:, 2:] += (counts > cuts[:, k:k + 1]).astype(np.uint8)
    out[:, 0] = length_code(np.diff(off))
    weights = mix(np.arange(BUCKETS, dtype=np.uint64)) | np.uint64(1)
    with np.errstate(over="ignore"):
        out[:, 1] = (mix((counts.astype(np.uint64) * weights).sum(axis=1)) >> np.uint64(56)).astype(np.uint8)
    return out


def to_hex(codes: np.ndarray) -> list[str]:
    q = codes[:, 2:].reshape(len(codes), BUCKETS // 4, 4)
    packed = q[:, :, 0] | q[:, :, 1] << 2 | q[:, :, 2] << 4 | q[:, :, 3] << 6
    return [r.tobytes().hex() for r in np.concatenate([codes[:, :2], packed], axis=1)]


def from_hex(digest: str) -> np.ndarray:
    raw = np.frombuffer(bytes.fromhex(digest), np.uint8)
    q = np.stack([raw[2:] >> s & 3 for s in (0, 2, 4, 6)], axis=1).ravel()
    return np.concatenate([raw[:2], q])


def difference(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Bounded difference score of paired digests (rows of codes), 0 to ``WORST``."""
    d = np.abs(a[:, 2:].astype(np.int16) - b[:, 2:])
    score = np.where(d == 3, OPPOSITE, d).sum(axis=1)
    step = np.abs(a[:, 0].astype(np.int64) - b[:, 0])
    return np.minimum(score + LENGTH_COST * np.maximum(step - 1, 0) + (a[:, 1] != b[:, 1]), WORST)


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    occupied = (a[:, 2:] > 0).sum(axis=1) + (b[:, 2:] > 0).sum(axis=1)
    worst = np.clip(OPPOSITE * occupied, 1, WORST)
    return 1.0 - np.minimum(difference(a, b), worst) / worst


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``doc_id, fingerprint``.  A null text is the empty
    one; equal texts have equal fingerprints; texts of less than three bytes have no
    triplet and are told apart by length only."""
    ship_code(docs.sparkSession)

    def hashed(batches):
        for batch in batches:
            for rows, data, off in slices(batch, 1):
                yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(to_hex(digests(data, off)), pa.string())], names=["doc_id", "fingerprint"])

    return id_text(docs, id_col, text_col).mapInArrow(hashed, "doc_id long, fingerprint string")


def _edited(texts: list[str], nexts: list[str]) -> list[str]:
    return [t[:len(t) - len(t) // 3] + x[:len(t) // 3] for t, x in zip(texts, nexts)]


def edit_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document, with its text's fingerprint, that of an edited text,
    and how near the two and the next document's are.

    The next document is the one after it by descending id (equal ids: by text;
    null ids last); after the last comes the first.  The edited text has its last
    third of code points (rounded down) replaced by as many from the next
    document's beginning, or all it has.  A single document is its own next.

    Documents are dealt to ranges of ids; each range also gets a copy of the next
    range's first id, so one pass over sorted ranges sees every pair of neighbours.
    """
    spark = docs.sparkSession
    ship_code(spark)
    slim = id_text(docs, id_col, text_col).withColumn("lost", F.col("id").isNull().cast("int")).withColumn("id", F.coalesce("id", F.lit(-(1 << 63)).cast("long")))
    n = shuffle_partitions(spark)
    # range bounds: as many numbers as there are partitions, from the ids alone
    cuts = slim.agg(F.percentile_approx("id", [i / n for i in range(1, n)] or [0.5], 10 * n)).first()[0] or []
    cuts = sorted(set(cuts), reverse=True)
    bounds = F.array(*[F.lit(c).cast("long") for c in cuts]) if cuts else F.array().cast("array<bigint>")
    part = F.size(F.filter(bounds, lambda c: c > F.col("id")))
    heads = {r["p"]: r["h"] for r in slim.select(part.alias("p"), "id").groupBy("p").agg(F.max("id").alias("h")).collect()}
    order = sorted(heads)
    # the part before, for the ids that begin a part
    before = {heads[p]: order[i - 1] for i, p in enumerate(order)}
    head_map = F.create_map(*[x for h, p in before.items() for x in (F.lit(h).cast("long"), F.lit(p))]) if before else F.create_map(F.lit(0).cast("long"), F.lit(0))
    dealt = slim.select("id", "lost", "text", part.alias("p"), F.try_element_at(head_map, "id").alias("q")).select(
        "id", "lost", "text", "p", F.explode(F.when(F.col("q").isNull(), F.array(F.struct(F.col("p").alias("part"), F.lit(0).alias("copy"))))
                                     .otherwise(F.array(F.struct(F.col("p").alias("part"), F.lit(0).alias("copy")), F.struct(F.col("q").alias("part"), F.lit(1).alias("copy"))))).alias("to"))
    ranged = (dealt.select(F.col("to.part").alias("part"), F.col("to.copy").alias("copy"), "id", "lost", "text")
              .repartition(n, "part").sortWithinPartitions("part", "copy", F.col("id").desc(), "text"))

    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]

    def batch_of(rows):
        ids, texts, nexts = zip(*rows)
        edited = _edited(texts, nexts)
        a, b, c = (digests(*text_buffers(pa.array(x, pa.large_string()))) for x in (texts, edited, nexts))
        return pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.array([len(t) for t in texts], pa.int64()),
             pa.array([hashlib.sha256(t.encode()).hexdigest() for t in edited], pa.string()),
             pa.array(to_hex(a), pa.string()), pa.array(to_hex(b), pa.string()), pa.array(likeness(a, b)), pa.array(likeness(a, c))], names=names)

    def paired(batches):
        held, size, last = [], 0, None               # last: the row that waits for its next
        for batch in batches:
            for i in range(batch.num_rows):
                part, copy, i_, lost, text = (batch.column(k)[i].as_py() for k in range(5))
                if last is not None:
                    if last[0] == part:
                        held.append((last[1], last[2], text))
                        size += len(last[2]) + len(text)
                    last = None
                if not copy:
                    last = (part, None if lost else i_, text)
                if size > 4 << 20 or len(held) >= 2000:
                    yield batch_of(held)
                    held, size = [], 0
        if held:
            yield batch_of(held)

    return ranged.mapInArrow(paired, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")
