"""URL filter: a sorted array of 64-bit xxhash digests, probed by binary search.

The rule list becomes one block of bytes: sorted digests, string offsets, the
rules' full strings and their verdicts.  Each task process maps that block from
a private, unlinked file, so its pages are shared and evictable, and probes whole
columns of candidate strings at once; a digest hit counts only if the stored
string is equal.
"""

from __future__ import annotations

import mmap
import tempfile
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame

from pizarra.llm.common import col, ship_code

#: The block is broadcast, so its size is bounded; a longer list must be split by the caller.
MAX_BLOCK_BYTES = 256 << 20
_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def _digest(b: bytes) -> int:
    return xxhash.xxh64_intdigest(b)


def digest_block(rules: Iterable[tuple[str, str, str]], digest=_digest) -> bytes:
    """Rules ``(verdict, host, path)`` as one block.  Equal rules: the last one
    wins; verdicts are ``allow`` or ``block``."""
    verdicts = {}
    for verdict, host, path in rules:
        if verdict not in ("allow", "block"):
            raise ValueError(f"unknown verdict {verdict!r}")
        verdicts[(host + path).encode()] = (verdict == "block", len(host.encode()))
    strings = sorted(verdicts, key=lambda b: (digest(b), b))
    keys = np.array([digest(b) for b in strings], np.uint64)
    ends = np.cumsum([0, *map(len, strings)]).astype(np.int64)
    hosts = np.array([verdicts[b][1] for b in strings], np.int64)
    block = np.array([verdicts[b][0] for b in strings], np.int64)
    out = b"".join([np.int64(len(strings)).tobytes(), keys.tobytes(), ends.tobytes(), hosts.tobytes(), block.tobytes(), *strings])
    if len(out) > MAX_BLOCK_BYTES:
        raise ValueError(f"rule list of {len(out)} bytes exceeds {MAX_BLOCK_BYTES}; split it")
    return out


class DigestArray:
    """Memory-mapped view of a block."""

    def __init__(self, block: bytes, digest=_digest):
        with tempfile.TemporaryFile() as f:
            f.write(block)
            f.flush()
            self._map = mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ)
        m = int(np.frombuffer(self._map, np.int64, 1)[0])
        at = 8
        self.keys = np.frombuffer(self._map, np.uint64, m, at)
        self.ends = np.frombuffer(self._map, np.int64, m + 1, at := at + 8 * m)
        self.hosts = np.frombuffer(self._map, np.int64, m, at := at + 8 * (m + 1))
        self.block = np.frombuffer(self._map, np.int64, m, at := at + 8 * m)
        self._strings, self._digest = at + 8 * m, digest
        path = np.diff(self.ends) - self.hosts
        self.path_bytes = sorted(set(path.tolist()))

    def string(self, i: int) -> bytes:
        return self._map[self._strings + int(self.ends[i]):self._strings + int(self.ends[i + 1])]

    def probe(self, candidates: list[bytes]) -> np.ndarray:
        """Index of each candidate's rule, or -1."""
        out = np.full(len(candidates), -1, np.int64)
        if not len(self.keys) or not candidates:
            return out
        want = np.fromiter(map(self._digest, candidates), np.uint64, len(candidates))
        at = np.searchsorted(self.keys, want)
        while True:  # equal digests of different strings stand side by side
            live = np.flatnonzero((out < 0) & (at < len(self.keys)))
            live = live[self.keys[at[live]] == want[live]]
            if not len(live):
                return out
            for i in live.tolist():
                if self.string(at[i]) == candidates[i]:
                    out[i] = at[i]
            at[live] += 1


def split_url(url: str | None) -> tuple[str, str]:
    """Host (A-Z lower-cased) and path; both empty without ``://``."""
    b = (url or "").encode("utf-8", "surrogatepass")
    i = b.find(b"://")
    if i < 0:
        return "", ""
    rest = b[i + 3:]
    stop = min((k for k in (rest.find(b"?"), rest.find(b"#")) if k >= 0), default=len(rest))
    rest = rest[:stop]
    slash = rest.find(b"/")
    host, path = (rest, b"") if slash < 0 else (rest[:slash], rest[slash:])
    return host.translate(_LOWER).decode("utf-8", "surrogatepass"), path.decode("utf-8", "surrogatepass")


def judge(urls: list[str | None], rules: DigestArray, default: str):
    """Hosts, paths, winning rules and verdicts of the urls."""
    hosts, paths = zip(*map(split_url, urls)) if urls else ((), ())
    candidates: list[bytes] = []
    owner: list[int] = []
    for i, (h, p) in enumerate(zip(hosts, paths)):
        hb, pb = h.encode("utf-8", "surrogatepass"), p.encode("utf-8", "surrogatepass")
        at = 0
        while hb and at >= 0:
            for n in rules.path_bytes:
                if n <= len(pb):
                    candidates.append(hb[at:] + pb[:n])
                    owner.append(i)
            at = hb.find(b".", at) + 1 or -1
    hit = rules.probe(candidates)
    best: list[int] = [-1] * len(urls)
    size = np.diff(rules.ends)
    for c in np.flatnonzero(hit >= 0).tolist():
        r, i = int(hit[c]), owner[c]
        # the stored string must also split into host and path where the url does
        if len(candidates[c]) - rules.hosts[r] in rules.path_bytes and candidates[c][rules.hosts[r]:] == \
                paths[i].encode("utf-8", "surrogatepass")[:len(candidates[c]) - rules.hosts[r]] and \
                (best[i] < 0 or size[r] > size[best[i]]):
            best[i] = r
    names = [None if r < 0 else rules.string(r).decode() for r in best]
    verdicts = [default if r < 0 else ("block" if rules.block[r] else "allow") for r in best]
    return hosts, paths, names, verdicts


def url_verdicts(pages: DataFrame, rules: Iterable[tuple[str, str, str]], id_col: str = "page_id",
                 url_col: str = "url", default: str = "allow") -> DataFrame:
    """One row per page: id, host, path, the rule that wins and its verdict.

    A rule fits its host and all subdomains of it if the path starts with the
    rule's path; the longest rule (host and path together) wins.  A url that no
    stored rule fits isn't in the array: it gets ``default``.  A null url, or one
    without ``://``, has an empty host and path and fits no rule.  Null ids and
    repeated rows give a row each; an empty table gives none.
    """
    spark = pages.sparkSession
    ship_code(spark)
    sent = spark.sparkContext.broadcast(digest_block(rules))

    def judged(batches):
        array = DigestArray(sent.value)
        for batch in batches:
            hosts, paths, names, verdicts = judge(batch.column(1).to_pylist(), array, default)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(hosts, pa.string()), pa.array(paths, pa.string()),
                 pa.array(names, pa.string()), pa.array(verdicts, pa.string())],
                names=["page_id", "host", "path", "rule", "verdict"])

    return pages.select(col(id_col).cast("long").alias("page_id"), col(url_col).cast("string").alias("url")).mapInArrow(
        judged, "page_id long, host string, path string, rule string, verdict string")
