"""Source divergence audit: how the term shares of a language's sources differ.

Tasks cut texts into terms, pack them by length, sort them and count runs
(:mod:`pizarra.llm.term_packing`); what is counted within a task meets by term.  A
reduce task knows all sources of its terms and keeps those of enough documents.

For ``pair``, f is summed over all kept terms, also those that neither source has.
Absent terms all have the group's smallest share, so the sum over all of them is a product,
and only a term's own sources meet in a join; the rest comes from
each source's histogram of shares.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pizarra.llm import term_packing as tp
from pizarra.llm.common import col, release, ship_code, shuffle_partitions, slices, written
from pizarra.llm.hashing import byte_set, mix, row_of, word_spans
from pizarra.llm.packed import PER_BUCKET, bucket_of

MIN_DOCS = 3
TOP_TERMS = 200
HOLD = 1 << 20             # partial counts that a map task holds before it sends them
HOT_SOURCES = 512          # a term of more sources is joined in blocks of as many
SCALE = 1_000_000_000
_SEP = byte_set(bytes(range(0x41)) + bytes(range(0x5B, 0x61)) + bytes(range(0x7B, 0x80)))
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SENT = "bucket long, kind int, m int, langs array<string>, sources array<string>, data binary"
_SENT_ARROW = pa.schema([("bucket", pa.int64()), ("kind", pa.int32()), ("m", pa.int32()), ("langs", pa.list_(pa.string())),
                         ("sources", pa.list_(pa.string())), ("data", pa.binary())])
_KEPT = "tid long, first boolean, lang string, source string, term string, n long, lang_n long, n_sources int"


class _Counts:
    """Partial counts of one kind of term: per (term, group) occurrences and documents."""

    def __init__(self, kind: int):
        self.kind, self.parts, self.size = kind, [], 0

    def add(self, key, group, n, d):
        self.parts.append((key, group, n, d))
        self.size += len(group)

    def merged(self):
        """All parts as one, by term and group."""
        key = tp.joined(self.kind, [p[0] for p in self.parts])
        group, n, d = (np.concatenate([p[i] for p in self.parts]) for i in (1, 2, 3))
        order = tp.term_order(self.kind, key, group)
        key, group, n, d = tp.take(self.kind, key, order), group[order], n[order], d[order]
        new = tp.changes(self.kind, key)
        new[1:] |= group[1:] != group[:-1]
        at = np.flatnonzero(new)
        return tp.take(self.kind, key, at), group[at], np.add.reduceat(n, at), np.add.reduceat(d, at)

    def settle(self):
        part = self.merged()
        self.parts, self.size = [part], len(part[1])


def _slice_counts(rows: pa.RecordBatch, data: np.ndarray, off: np.ndarray, code_of: dict):
    """Per kind: keys, groups, occurrences and documents of a slice's terms."""
    groups = np.array([code_of.setdefault(g, len(code_of)) for g in zip(rows.column(0).to_pylist(), rows.column(1).to_pylist())], np.uint32)
    data = _LOWER[data]
    starts, ends, first = word_spans(data, off, _SEP)
    if not len(starts):
        return
    # documents in the order of their groups: then a term's documents, and its groups, are runs
    by_group = np.argsort(groups, kind="stable")
    place = np.empty(len(groups), np.uint32)
    place[by_group] = np.arange(len(groups), dtype=np.uint32)
    doc, group_at = place[row_of(first)], groups[by_group]
    for kind, mine, key in tp.pack_terms(data, starts, ends):
        minor = doc[mine]
        order = tp.term_order(kind, key, minor)
        key, minor = tp.take(kind, key, order), minor[order]
        group = group_at[minor]
        term = tp.changes(kind, key)
        new, doc_new = term.copy(), term
        new[1:] |= group[1:] != group[:-1]
        doc_new[1:] |= minor[1:] != minor[:-1]
        at = np.flatnonzero(new)
        n = np.diff(np.append(at, len(new))).astype(np.int64)
        yield kind, tp.take(kind, key, at), group[at], n, np.add.reduceat(doc_new.astype(np.int64), at)


def _sent(counts: _Counts, codes: list[tuple[str, str]], lang_hash: np.ndarray, n_buckets: int):
    """Rows of ``_SENT``: per bucket the counts, with the groups that occur in them."""
    key, group, n, d = counts.merged()
    bucket = bucket_of(mix(tp.key_hash(counts.kind, key) ^ lang_hash[group]), n_buckets)
    order = np.argsort(bucket, kind="stable")
    cut = np.append(np.flatnonzero(np.diff(bucket[order], prepend=-1)), len(order))
    out = {f.name: [] for f in _SENT_ARROW}
    for a, b in zip(cut[:-1].tolist(), cut[1:].tolist()):
        at = order[a:b]
        used, local = np.unique(group[at], return_inverse=True)
        out["bucket"].append(int(bucket[at[0]]))
        out["kind"].append(counts.kind)
        out["m"].append(b - a)
        out["langs"].append([codes[g][0] for g in used.tolist()])
        out["sources"].append([codes[g][1] for g in used.tolist()])
        out["data"].append(tp.key_bytes(counts.kind, tp.take(counts.kind, key, at)) + local.astype(np.uint32).tobytes()
                           + n[at].tobytes() + d[at].tobytes())
    yield pa.RecordBatch.from_pydict(out, schema=_SENT_ARROW)


def _counter(n_buckets: int):
    def run(batches):
        code_of: dict[tuple[str, str], int] = {}
        held: dict[int, _Counts] = {}

        def send():
            codes = list(code_of)
            lang_hash = np.array([xxhash.xxh64_intdigest(lang) for lang, _ in codes], np.uint64)
            for c in held.values():
                yield from _sent(c, codes, lang_hash, n_buckets)
            held.clear()
            code_of.clear()

        for batch in batches:
            for rows, data, off in slices(batch, 2):
                for kind, *part in _slice_counts(rows, data, off, code_of):
                    held.setdefault(kind, _Counts(kind)).add(*part)
                if sum(c.size * tp.width(c.kind) for c in held.values()) >= HOLD * 8:
                    for c in held.values():
                        c.settle()
                    if sum(c.size * tp.width(c.kind) for c in held.values()) >= HOLD * 4:
                        yield from send()
        yield from send()
        release()
    return run


def _reducer(min_docs: int):
    """Rows of ``_KEPT``: all sources of each term that enough documents of its language have."""

    def settle(serial: int, blobs):
        codes: dict[tuple[str, str], int] = {}
        decoded = []
        for kind, m, langs, sources, data in blobs:
            local = [codes.setdefault(g, len(codes)) for g in zip(langs, sources)]
            w = tp.width(kind) * m
            group = np.array(local, np.uint32)[np.frombuffer(data, np.uint32, m, w)]
            counts = np.frombuffer(data, np.int64, 2 * m, w + 4 * m) if (w + 4 * m) % 8 == 0 else np.frombuffer(data[w + 4 * m:], np.int64, 2 * m)
            decoded.append((kind, tp.key_from(kind, data, m), group, counts[:m], counts[m:]))
        # group numbers in the order of their languages: a term's rows of one language are a run
        names = list(codes)
        by_lang = sorted(range(len(names)), key=lambda i: names[i])
        rank = np.empty(len(names), np.uint32)
        rank[by_lang] = np.arange(len(names), dtype=np.uint32)
        names = [names[i] for i in by_lang]
        langs = pa.array([x for x, _ in names], pa.string())
        sources = pa.array([x for _, x in names], pa.string())
        lang_code = np.unique(np.array([x for x, _ in names], object), return_inverse=True)[1]
        by_kind: dict[int, _Counts] = {}
        for kind, key, group, n, d in decoded:
            by_kind.setdefault(kind, _Counts(kind)).add(key, rank[group], n, d)
        for kind, c in sorted(by_kind.items()):
            key, group, n, d = c.merged()
            new = tp.changes(kind, key)
            new[1:] |= lang_code[group[1:]] != lang_code[group[:-1]]
            at = np.flatnonzero(new)
            size = np.diff(np.append(at, len(new)))
            keep = np.add.reduceat(d, at) >= min_docs
            lang_n = np.repeat(np.add.reduceat(n, at), size)
            rows = np.flatnonzero(np.repeat(keep, size))
            if not len(rows):
                continue
            tid = np.repeat(np.arange(len(at)), size)[rows] + serial
            serial += len(at)
            first = np.zeros(len(new), bool)
            first[at] = True
            where = pa.array(group[rows].astype(np.int64))
            term = pa.array(tp.texts(kind, tp.take(kind, key, rows)), pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays(
                [pa.array(tid), pa.array(first[rows]), langs.take(where), sources.take(where), term, pa.array(n[rows]),
                 pa.array(lang_n[rows]), pa.array(np.repeat(size, size)[rows].astype(np.int32))],
                names=["tid", "first", "lang", "source", "term", "n", "lang_n", "n_sources"])

    def run(batches):
        now, held = None, []
        # term numbers are the task's own: its partition above, a running number below
        serial = TaskContext.get().partitionId() << 40

        def close():
            nonlocal serial
            for out in settle(serial, held):
                serial = int(out.column(0)[-1].as_py()) + 1
                yield out
            held.clear()
            release()

        for batch in batches:
            for b, *row in zip(*(c.to_pylist() for c in batch.columns)):
                if held and b != now:
                    yield from close()
                now = b
                held.append(row)
        if held:
            yield from close()
    return run


def source_terms(docs: DataFrame, lang_col: str = "lang", source_col: str = "source", text_col: str = "text",
                 min_docs: int = MIN_DOCS) -> DataFrame:
    """Per language, kept term and source that has it: ``tid`` (the term's number), ``first`` (true in one
    row of each term), ``lang, source, term, n, lang_n`` (occurrences in the source and in the language), ``n_sources``."""
    slim = _slim(docs, lang_col, source_col, text_col)
    ship_code(docs.sparkSession)
    n = shuffle_partitions(docs.sparkSession)
    size = slim.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    # some ten bytes a term and its blank, no two of which are the same at worst
    buckets = max(n, int(size // 10 // PER_BUCKET) + 1)
    return (slim.mapInArrow(_counter(buckets), _SENT).repartition(n, "bucket").sortWithinPartitions("bucket")
            .mapInArrow(_reducer(min_docs), _KEPT))


def _slim(docs: DataFrame, lang_col: str, source_col: str, text_col: str) -> DataFrame:
    names = {"lang": lang_col, "source": source_col, "text": text_col}
    return docs.select(*[F.coalesce(col(c).cast("string"), F.lit("")).alias(k) for k, c in names.items()])


def _share(n: Column, total: Column) -> Column:
    """``1 + floor(SCALE * (n + 1) / total)``, exact beyond 64 bits."""
    wide = (n + 1).cast("decimal(20,0)") * F.lit(SCALE).cast("decimal(10,0)")
    return F.call_function("div", wide, total.cast("decimal(20,0)")) + 1


def _gap(p: Column, q: Column) -> Column:
    """``floor((p - q) ** 2 / q)``; shares are at most ``SCALE + 1``, so the square has 60 bits."""
    return F.call_function("div", (p - q) * (p - q), q)


def divergence(docs: DataFrame, lang_col: str = "lang", source_col: str = "source", text_col: str = "text",
               min_docs: int = MIN_DOCS, top_terms: int = TOP_TERMS) -> DataFrame:
    """``lang, source, part, item, value, rank``.

    Part ``pair``: each other source of the language, with the sum of f over all kept
    terms.  Part ``term``: the ``top_terms`` terms by which the source stands out from its language.
    Each row is a document, repeated ones too; null language, source and text are empty strings; only the three
    columns are read.  A language without kept terms has pairs of value 0.
    An empty table gives no rows.
    """
    spark = docs.sparkSession
    salts = shuffle_partitions(spark)
    kept = written(source_terms(docs, lang_col, source_col, text_col, min_docs), "source-terms")
    slim = _slim(docs, lang_col, source_col, text_col).select("lang", "source")
    per_group = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    per_lang = kept.where("first").groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum("lang_n").alias("lang_total"))
    groups = slim.distinct().join(per_group, ["lang", "source"], "left").join(per_lang, "lang", "left").na.fill(0, ["total", "v", "lang_total"])
    groups = written(groups.withColumn("gid", F.monotonically_increasing_id()).withColumn(
        "p0", F.when(F.col("v") > 0, _share(F.lit(0), F.col("total") + F.col("v")))), "source-groups")

    shares = kept.join(groups, ["lang", "source"]).select(
        "tid", "gid", "lang", "source", "term", "n_sources", "p0", _share(F.col("n"), F.col("total") + F.col("v")).alias("p"),
        _share(F.col("lang_n"), F.col("lang_total") + F.col("v")).alias("q"))
    shares = written(shares, "source-shares")
    by_value = Window.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc("item"))
    terms = shares.where("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"),
                                         _gap(F.col("p"), F.col("q")).alias("value"))
    terms = terms.withColumn("rank", F.row_number().over(by_value)).where(F.col("rank") <= top_terms)

    # terms that two sources share, in blocks of sources where there are very many
    blocks = F.ceil(F.col("n_sources") / F.lit(float(HOT_SOURCES))).cast("long")
    a = shares.select("tid", F.pmod("gid", blocks).alias("salt"), F.col("gid").alias("ga"), F.col("p").alias("pa"), F.col("p0").alias("za"))
    b = shares.select("tid", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)).alias("salt"), F.col("gid").alias("gb"),
                      F.col("p").alias("pb"), F.col("p0").alias("zb"))

    def both(p, q, z_p, z_q):
        return _gap(p, q) - _gap(p, z_q) - _gap(z_p, q) + _gap(z_p, z_q)

    pa_, pb_, za, zb = (F.col(x) for x in ("pa", "pb", "za", "zb"))
    met = a.join(b, ["tid", "salt"]).where("ga < gb").groupBy("ga", "gb").agg(
        F.sum(both(pa_, pb_, za, zb)).alias("ab"), F.sum(both(pb_, pa_, zb, za)).alias("ba"))

    # what a source's own terms add beside each other source of the language
    other = groups.select("lang", F.col("gid").alias("gb"), F.col("p0").alias("zb"),
                          F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"))
    spread = F.pmod(F.xxhash64("ga", "pa"), F.lit(salts)).cast("int")
    hist = shares.groupBy("lang", F.col("gid").alias("ga"), F.col("p0").alias("za"), F.col("p").alias("pa")).agg(F.count(F.lit(1)).alias("k"))
    own = hist.withColumn("salt", spread).join(other, ["lang", "salt"]).where("ga <> gb").groupBy("ga", "gb").agg(
        F.sum(F.col("k") * (_gap(pa_, zb) - _gap(za, zb))).alias("ab"), F.sum(F.col("k") * (_gap(zb, pa_) - _gap(zb, za))).alias("ba"))
    base = groups.select("lang", "v", F.col("gid").alias("ga"), F.col("p0").alias("za")).withColumn(
        "salt", F.pmod(F.xxhash64("ga"), F.lit(salts)).cast("int")).join(other, ["lang", "salt"]).where("ga <> gb").select(
        "ga", "gb", F.when(F.col("v") > 0, F.col("v") * _gap(za, zb)).otherwise(0).alias("value"))
    sums = base
    for part in (met, own):
        sums = sums.unionByName(part.select("ga", "gb", F.col("ab").alias("value"))).unionByName(
            part.select(F.col("gb").alias("ga"), F.col("ga").alias("gb"), F.col("ba").alias("value")))
    name = groups.select(F.col("gid").alias("ga"), "lang", "source")
    pairs = sums.groupBy("ga", "gb").agg(F.sum("value").alias("value")).join(name, "ga").join(
        name.select(F.col("ga").alias("gb"), F.col("source").alias("item")), "gb")
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", "value").withColumn("rank", F.row_number().over(by_value))
    return pairs.unionByName(terms)
