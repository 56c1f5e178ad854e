"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment.

The n-grams of the benchmark's items are counted over the whole corpus; each item
keeps those that are rare beside its others, so an item that leaked into very many
documents, whole or edited, keeps its seeds, while phrases that everybody uses are none.  Documents
that hold a seed are aligned locally, word by word, with the item around it; the
score, as a share of a full match, tells copies and edited copies from chance.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pizarra.llm.common import col, id_text, ship_code, slices, text_buffers, through
from pizarra.llm.hashing import NOT_ALNUM, gram_hashes, gram_starts, span_hashes, word_spans

SEED_WORDS = 3
MIN_WORDS = 5             # shorter items can't be told from chance and aren't searched
THRESHOLD = 0.5
MATCH, MISMATCH, GAP = 2, -1, -1
RARE_FACTOR = 4           # a seed occurs at most so many times as often as the rarer three quarters of its item's,
RARE_SHARE, RARE_COUNT = 1e-4, 50   # plus this share of the number of documents and this count
BLOCK_BYTES = 4 << 20     # a larger benchmark is searched in blocks of about so much text
BATCH = 256               # alignments worked out side by side,
MAX_CELLS = 1 << 20       # within so many words of their windows
FILTER_BITS = 22


def _words(data, off):
    s, e, first = word_spans(data, off, NOT_ALNUM)
    return span_hashes(data, s, e, lower=True), first


class Items:
    """One block of items: word hashes, and their n-grams with places."""

    def __init__(self, ids: np.ndarray, data: np.ndarray, off: np.ndarray):
        words, first = _words(data, off)
        use = np.flatnonzero(np.diff(first) >= MIN_WORDS)
        self.ids = ids[use]
        self.words = [words[first[i]:first[i + 1]] for i in use]
        self.grams = [gram_hashes(w, SEED_WORDS) for w in self.words]
        self.known = np.unique(np.concatenate(self.grams)) if self.grams else np.empty(0, np.uint64)
        self.chosen = self.known

    def choose(self, counts: np.ndarray, n_docs: int) -> None:
        """Keep each item's rare n-grams; ``counts`` are those of ``known``."""
        seeds, item, place = [], [], []
        for i, g in enumerate(self.grams):
            c = counts[np.searchsorted(self.known, g)]
            rare = np.flatnonzero(c <= RARE_FACTOR * np.quantile(c, 0.75) + RARE_SHARE * n_docs + RARE_COUNT)
            seeds.append(g[rare])
            item.append(np.full(len(rare), i))
            place.append(rare)
        if seeds:
            seeds, item, place = map(np.concatenate, (seeds, item, place))
            order = np.argsort(seeds, kind="stable")
            self.seeds, self.item, self.place = seeds[order], item[order], place[order]
            self.chosen = np.unique(self.seeds)

    def lookup(self, grams: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Those of ``at`` whose n-gram is chosen."""
        if not hasattr(self, "_filter"):
            self._filter = np.zeros(1 << FILTER_BITS, bool)
            self._filter[(self.chosen & np.uint64((1 << FILTER_BITS) - 1)).astype(np.int64)] = True
        at = at[self._filter[(grams[at] & np.uint64((1 << FILTER_BITS) - 1)).astype(np.int64)]]
        k = np.minimum(np.searchsorted(self.chosen, grams[at]), len(self.chosen) - 1)
        return at[self.chosen[k] == grams[at]]

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k != "_filter"}


def align(items: list[np.ndarray], windows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Best local alignment score of each pair, and the window word after its end."""
    c, m, n = len(items), max(map(len, items)), max(map(len, windows))
    a, b = np.zeros((c, m), np.uint64), np.ones((c, n), np.uint64)
    ok = np.zeros((c, n), bool)
    for i, (x, w) in enumerate(zip(items, windows)):
        a[i, :len(x)], b[i, :len(w)], ok[i, :len(w)] = x, w, True
    h = np.zeros((c, n + 1), np.int32)
    slope = GAP * np.arange(n + 1, dtype=np.int32)
    best, end = np.zeros(c, np.int32), np.zeros(c, np.int64)
    for i in range(m):
        sub = np.where((a[:, i:i + 1] == b) & ok, MATCH, MISMATCH).astype(np.int32)
        cur = np.zeros_like(h)
        cur[:, 1:] = np.maximum(np.maximum(h[:, :-1] + sub, h[:, 1:] + GAP), 0)
        cur = np.maximum.accumulate(cur - slope, axis=1) + slope       # gaps along the window
        h = cur
        top = h.max(axis=1)
        better = top > best
        best[better], end[better] = top[better], h[better].argmax(axis=1)
    return best, end


def scan(items: Items, data: np.ndarray, off: np.ndarray, threshold: float):
    """Yields ``(row, item, score, start, end)``: the best alignment of each item in each
    row that reaches the threshold, with its word span in the row."""
    if not len(items.chosen):
        return
    words, first = _words(data, off)
    at = gram_starts(first, SEED_WORDS)
    if not len(at):
        return
    at = items.lookup(gram_hashes(words, SEED_WORDS), at)
    if not len(at):
        return
    grams = gram_hashes(words, SEED_WORDS)[at]
    lo, hi = np.searchsorted(items.seeds, grams, "left"), np.searchsorted(items.seeds, grams, "right")
    n = hi - lo
    hit = np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
    where = np.repeat(at, n)
    item, begin = items.item[hit], where - items.place[hit]       # where the item would begin
    row = np.searchsorted(first, where, side="right") - 1
    order = np.lexsort((begin, item, row))
    row, item, begin = row[order], item[order], begin[order]
    size = np.array([len(w) for w in items.words])[item]
    # seeds of an item that lie within its length of each other share a window
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (item[1:] != item[:-1]) | (begin[1:] - begin[:-1] > size[1:])
    a = np.flatnonzero(new)
    b = np.append(a[1:], len(row)) - 1
    low = np.maximum(begin[a] - size[a] // 2, first[row[a]])
    high = np.minimum(begin[b] + size[a] + size[a] // 2, first[row[a] + 1])
    best: dict[tuple[int, int], tuple] = {}
    for i in range(0, len(a), BATCH):
        part = slice(i, i + BATCH)
        its = [items.words[k] for k in item[a[part]]]
        wins = [words[x:y] for x, y in zip(low[part], high[part])]
        # windows of like sizes are padded together
        for group in _alike(wins):
            score, end = align([its[g] for g in group], [wins[g] for g in group])
            for g, s, e in zip(group, score.tolist(), end.tolist()):
                share = s / (MATCH * len(its[g]))
                if share < threshold:
                    continue
                _, back = align([its[g][::-1]], [wins[g][:e][::-1]])
                r, k = int(row[a[i + g]]), int(item[a[i + g]])
                start = int(low[i + g] - first[r])
                found = (share, start + e - int(back[0]), start + e)
                if (r, k) not in best or (-found[0], found[1]) < (-best[r, k][0], best[r, k][1]):
                    best[r, k] = found
    for (r, k), (share, start, end) in best.items():
        yield r, k, share, start, end


def _alike(windows) -> list[list[int]]:
    order = sorted(range(len(windows)), key=lambda i: len(windows[i]))
    out: list[list[int]] = []
    for i in order:
        n = len(windows[i])
        if out and n <= 2 * len(windows[out[-1][0]]) + 16 and n * (len(out[-1]) + 1) <= MAX_CELLS:
            out[-1].append(i)
        else:
            out.append([i])
    return out


def item_blocks(docs: DataFrame, benchmark: DataFrame, text_col: str, item_id: str, item_text: str):
    """The benchmark, block by block, with seeds chosen by counts over all of ``docs``."""
    spark = docs.sparkSession
    ship_code(spark)
    bench = id_text(benchmark, item_id, item_text).where("id is not null")
    size = bench.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = int(size // BLOCK_BYTES) + 1
    slim = docs.select(F.coalesce(col(text_col).cast("string"), F.lit("")).alias("text"))
    for k in range(n):
        rows = bench.where(F.pmod(F.xxhash64("id", "text"), F.lit(n)) == k).toArrow().combine_chunks()  # bounded by the block size
        items = Items(rows.column(0).to_numpy(), *text_buffers(pc.utf8_lower(rows.column(1))))
        if not len(items.known):
            continue
        sent = spark.sparkContext.broadcast(items)

        def count(batches):
            items = sent.value
            for batch in batches:
                total = np.zeros(len(items.known), np.int64)
                for _, data, off in slices(batch, 0, fold=True):
                    words, first = _words(data, off)
                    at = gram_starts(first, SEED_WORDS)
                    if len(at):
                        grams = gram_hashes(words, SEED_WORDS)
                        total += np.bincount(np.searchsorted(items.known, grams[items.lookup(grams, at)]), minlength=len(total))
                seen = np.flatnonzero(total)
                yield pa.RecordBatch.from_arrays([pa.array(np.append(seen, -1)), pa.array(np.append(total[seen], batch.num_rows))], names=["gram", "n"])

        counts = np.zeros(len(items.known), np.int64)
        n_docs = 0
        summed = slim.mapInArrow(count, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n")).toArrow()  # a row for each n-gram of the block
        for g, c in zip(summed.column(0).to_pylist(), summed.column(1).to_pylist()):
            if g < 0:
                n_docs = c
            else:
                counts[g] = c
        items.choose(counts, n_docs)
        yield spark.sparkContext.broadcast(items)


def contamination_report(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                         item_id: str = "item_id", item_text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """One row for each document and item that it holds a copy or an edited copy of:
    ``doc_id, item_id, score`` (1: every word in order) and the copy's ``start_word`` and
    ``end_word``.

    Words are runs of letters, digits and non-ASCII characters of the text in lower case.
    Documents without a copy have no row.  Null texts are empty; items with a null id
    or fewer than ``MIN_WORDS`` words aren't searched; rows that repeat an id give a row
    each; items of one id and different texts are items of their own.
    """
    slim = id_text(docs, id_col, text_col)
    schema = "doc_id long, item_id long, score double, start_word long, end_word long"
    out = None
    for sent in item_blocks(docs, benchmark, text_col, item_id, item_text):
        def search(batches, sent=sent):
            items = sent.value
            for batch in batches:
                for rows, data, off in slices(batch, 1, fold=True):
                    found = sorted(scan(items, data, off, threshold))
                    ids = rows.column(0).to_pylist()
                    cols = zip(*found) if found else ([], [], [], [], [])
                    r, k, share, start, end = map(list, cols)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([ids[x] for x in r], pa.int64()), pa.array([int(items.ids[x]) for x in k], pa.int64()),
                         pa.array(share, pa.float64()), pa.array(start, pa.int64()), pa.array(end, pa.int64())],
                        names=["doc_id", "item_id", "score", "start_word", "end_word"])
        part = slim.mapInArrow(search, schema)
        out = part if out is None else out.unionByName(part)
    return docs.sparkSession.createDataFrame([], schema) if out is None else out


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_id: str = "item_id",
                      item_text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without the rows that hold a copy of an item; all columns stay."""
    out = docs
    for sent in item_blocks(docs, benchmark, text_col, item_id, item_text):
        def clean(batch, first, sent=sent):
            for rows, data, off in slices(batch, first, fold=True):
                keep = np.ones(rows.num_rows, bool)
                keep[[f[0] for f in scan(sent.value, data, off, threshold)]] = False
                yield rows.filter(pa.array(keep)), []
        out = through(out, [col(text_col).cast("string")], clean)
    return out
