"""N-gram join, decontamination, WARC, SentencePiece, toxicity and pipeline."""

import collections
import gzip
import hashlib
import random
import re
import string

import duckdb
import numpy as np
import pyarrow as pa
import pytest

import __spark_entry__ as E
import corpus_pipeline
from pizarra.llm import decontamination as dc
from pizarra.llm import ngram_join as nj
from pizarra.llm import sentencepieces as sp
from pizarra.llm import sketch
from pizarra.llm import toxicity as tx
from pizarra.llm import warc
from pizarra.llm.common import scratch_path, text_buffers
from pizarra.llm.components import components
from pizarra.llm.hashing import stream
from tests.conftest import SF_SMALL

UPPER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


# ---------------------------------------------------------------- 2: n-gram join

def shingles(t):
    w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(UPPER))
    return frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def linked_by_hand(rows):
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if rows[i][0] is not None and rows[j][0] is not None and a and 100 * len(a & b) >= 80 * len(a | b):
                root[find(i)] = find(j)
    low = collections.defaultdict(list)
    for i, (d, _) in enumerate(rows):
        if d is not None:
            low[find(i)].append(d)
    return sorted(((d, len(sets[i]), None if d is None else min(low[find(i)])) for i, (d, _) in enumerate(rows)), key=str)


def near_copies(rng, base, n, edits):
    out = []
    for _ in range(n):
        w = list(base)
        for _ in range(rng.randrange(edits + 1)):
            k = rng.randrange(len(w))
            w[k:k + 1] = rng.choice([[f"e{rng.randrange(999)}"], [], [w[k], f"i{rng.randrange(999)}"]]) if len(w) > 1 else w[k:k + 1]
        out.append(" ".join(w))
    return out


@pytest.mark.parametrize("words,edits", [(7, 1), (14, 2), (40, 3), (300, 12)])
def test_ngram_join_matches_all_pairs(docs_of, words, edits):
    rng = random.Random(words)
    texts = []
    for _ in range(12):
        texts += near_copies(rng, [f"w{rng.randrange(60)}" for _ in range(words)], 8, edits)
    ids = rng.sample(range(1000), len(texts))
    rows = list(zip(ids, texts)) + [(2000, None), (2001, ""), (2002, "one TWO three"), (2003, "One two\tthree"), (2004, "one two"),
                                    (None, texts[0]), (ids[0], texts[0]), (ids[1], "another text of this id"), (2005, "z " * 30_000)]
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in nj.linked_documents(docs_of(rows)).collect()), key=str)
    assert got == linked_by_hand(rows)


def test_links_that_no_pivot_sees_are_found(docs_of):
    # a chain: neighbours are similar, others aren't, so components hang on single links
    base = [f"w{i}" for i in range(400)]
    rows = [(i, " ".join(base[6 * i:6 * i + 100])) for i in range(50)]
    got = nj.linked_documents(docs_of(rows)).collect()
    assert {r.component_id for r in got} == {0} == {c for _, _, c in linked_by_hand(rows)}


def test_rounds_go_on_where_blocks_exceed_their_size(docs_of, monkeypatch):
    # families of texts of likeness 0.79 to each other, which sketches don't rule out, and a few links among them
    rows = []
    for f in range(3):
        for i in range(16):
            w = [f"f{f}w{k}" for k in range(200)]
            for k in (5 + 5 * i, 100 + 5 * i, 197):
                w[k] = f"e{i}x{k}"
            rows.append((100 * f + i, " ".join(w)))
            if i % 8 == 0:
                w[190] = "other"
                rows.append((100 * f + i + 50, " ".join(w)))
    left, crossing = [], nj._crossing

    def watched(*args):
        found = crossing(*args)
        left.append(found.where("grp is not null").count())
        return found

    monkeypatch.setattr(nj, "_crossing", watched)
    monkeypatch.setattr(nj, "BLOCK", 1)
    monkeypatch.setattr(nj, "NEAR", 1)
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in nj.linked_documents(docs_of(rows)).collect()), key=str)
    assert got == linked_by_hand(rows) and len({c for _, _, c in got}) == 48
    assert left[0] > 0 and left[-1] == 0                 # at the end no group has pairs that weren't compared


def test_what_travels_is_small(spark, docs_of, monkeypatch):
    assert nj._SIGN.itemsize == 13                       # of a signature: 40 bits of its key, and its set
    slim = docs_of([(1, "a b c d e f"), (2, "g h i j k l")]).select("doc_id", "text").toDF("id", "text")
    texts = nj._texts_of(slim, spark.createDataFrame([(1,), (2,)], "doc_id long"))
    assert sorted((r.doc_id, r.text) for r in texts.collect()) == [(1, "a b c d e f"), (2, "g h i j k l")]
    # the blocks of a later turn: one shuffle has the members, whoever reads them
    monkeypatch.setattr(nj, "BLOCK", 2)
    groups = spark.createDataFrame([(5, [1, 2, 3, 4, 5, 6])], "grp long, members array<long>")
    roots = spark.createDataFrame([], "node long, root long")
    sketch = bytearray(nj.parity_sketch(stream(7, 40)))
    info = spark.createDataFrame([(i, i, 40, sketch) for i in range(1, 7)], "node long, doc_id long, n long, sketch binary")
    found = nj._crossing(groups, roots, info, spark.createDataFrame([], "u long, v long"), 1)
    assert {(r.u, r.v) for r in found.where("u is not null").collect()} >= {(i, j) for i in range(1, 7) for j in range(i + 1, 7)}
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    folded = [line for line in plan.splitlines() if "collect_list(" in line and "sketch" in line]
    assert len(folded) == 3 and len({re.sub(r"#\d+L?", "", line).lstrip(" :+-") for line in folded}) == 1


def test_every_similar_pair_shares_a_signature():
    rng = np.random.default_rng(4)
    missed = tried = 0
    for size in [4, 5, 6, 8, 9, 10, 11, 13, 17, 23, 40, 77, 150, 400, 1500]:
        for _ in range(40):
            pool = stream(int(rng.integers(1 << 60)), size * 2)
            d = int(rng.integers(0, 2 * size // 9 + 1))
            cut = int(rng.integers(0, d + 1))
            a, b = pool[:size], np.concatenate([pool[cut:size], pool[size:size + d - cut]])
            shared = size - cut
            if not nj.similar(len(a), len(b), shared) or d == 0:
                continue
            tried += 1
            both = [set(nj.signatures(np.sort(x), np.array([0, len(x)]))[0].tolist()) for x in (a, b)]
            missed += not both[0] & both[1]
    assert tried > 200 and missed == 0


def test_sketches_rule_out_no_similar_pair():
    rng = np.random.default_rng(5)
    for _ in range(200):
        n, d = int(rng.integers(5, 900)), int(rng.integers(0, 60))
        pool = stream(int(rng.integers(1 << 60)), n + d)
        a, b = pool[:n], pool[d:]
        x, y = (np.frombuffer(nj.parity_sketch(s), np.uint8) for s in (a, b))
        size = min(len(x), len(y))
        apart = int(np.bitwise_count(nj._fold(x, size) ^ nj._fold(y, size)).sum())
        assert apart <= len(a) + len(b) - 2 * max(n - d, 0)


def test_components_of_random_graphs(spark):
    rng = random.Random(1)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(i, i + 1) for i in range(1000, 1060)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    root = {x: x for e in edges for x in e}
    for _ in range(100):
        for u, v in edges:
            root[u] = root[v] = min(root[u], root[v])
    assert got == {k: v for k, v in root.items() if k != v}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_near_copies_go_and_others_stay(docs_of):
    text = " ".join(f"w{i}" for i in range(60))
    d = docs_of([(3, text), (1, text + " more"), (2, "something else entirely is written here"), (None, text), (4, None), (5, "")])
    out = nj.drop_near_copies(d)
    assert out.columns == d.columns and {r.doc_id for r in out.collect()} == {1, 2, None, 4, 5}
    assert nj.linked_documents(docs_of([])).count() == 0


# ---------------------------------------------------------------- sketch

def test_count_min_never_falls_short(spark):
    keys = stream(9, 5000)
    often = np.concatenate([keys, keys[:700]])
    df = spark.createDataFrame([(i,) for i in range(4)], "k long").repartition(4)
    bits = sketch.count_cells(df, lambda b: [often[int(k)::4] for k in b.column(0).to_pylist()], 2, 1 << 20)
    rep = sketch.repeated(bits, keys, 1 << 20)
    assert rep[:700].all() and rep[700:].mean() < 0.01


# ---------------------------------------------------------------- 4: decontamination

def test_alignment_matches_the_textbook_recurrence():
    rng = random.Random(6)
    pairs = [([rng.randrange(1, 6) for _ in range(rng.randrange(1, 15))], [rng.randrange(1, 6) for _ in range(rng.randrange(1, 25))]) for _ in range(60)]
    best, _ = dc.align([np.array(a, np.uint64) for a, _ in pairs], [np.array(b, np.uint64) for _, b in pairs])
    for (a, b), got in zip(pairs, best.tolist()):
        h = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                h[i + 1][j + 1] = max(0, h[i][j] + (dc.MATCH if x == y else dc.MISMATCH), h[i][j + 1] + dc.GAP, h[i + 1][j] + dc.GAP)
        assert got == max(map(max, h))


def test_contamination_finds_copies_and_edited_copies_only(spark, docs_of):
    rng = random.Random(7)
    items = [(i, " ".join(f"b{rng.randrange(400)}" for _ in range(30))) for i in range(20)]
    prose = lambda n: " ".join(f"p{rng.randrange(3000)}" for _ in range(n))
    edited = items[2][1].split()
    edited[4], edited[11:12], edited[20] = "changed", [], "too"
    rows = [(1, prose(50) + " " + items[0][1].upper() + "! " + prose(9)), (2, prose(80)), (3, items[1][1]), (4, prose(5) + "\n" + " ".join(edited)),
            (5, prose(30) + " " + " ".join(items[3][1].split()[:6])), (6, None), (7, ""), (8, items[4][1] + ". " + items[5][1]), (9, prose(40_000) + items[6][1])]
    rows += [(100 + i, items[7][1]) for i in range(300)] + [(1, "same id, clean")]
    bench = spark.createDataFrame([(*x, 1) for x in items] + [(99, None, 1), (98, "too short", 1), (None, items[0][1], 1)], "item_id long, text string, score int")
    got = {(r.doc_id, r.item_id): r for r in dc.contamination_report(docs_of(rows), bench).collect()}
    assert set(got) == {(1, 0), (3, 1), (4, 2), (8, 4), (8, 5), (9, 6)} | {(100 + i, 7) for i in range(300)}
    assert got[1, 0].score == 1 and (got[1, 0].start_word, got[1, 0].end_word) == (50, 80) and 0.6 < got[4, 2].score < 1
    clean = dc.drop_contaminated(docs_of(rows), bench)
    assert sorted(str(r.doc_id) for r in clean.collect()) == sorted(map(str, [1, 2, 5, 6, 7])) and clean.columns == docs_of([]).columns
    assert dc.contamination_report(docs_of([]), bench).count() == 0
    assert dc.contamination_report(docs_of(rows), bench.limit(0)).count() == 0


def test_benchmark_blocks_find_the_same(spark, docs_of, monkeypatch):
    items = [(i, " ".join(f"b{i}_{k}" for k in range(12))) for i in range(9)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    docs = docs_of([(i, "a b c " + t) for i, t in items])
    monkeypatch.setattr(dc, "BLOCK_BYTES", 200)
    assert {(r.doc_id, r.item_id) for r in dc.contamination_report(docs, bench).collect()} == {(i, i) for i, _ in items}
    assert dc.drop_contaminated(docs, bench).count() == 0


# ---------------------------------------------------------------- 5: WARC

PAGE = "<p>" + "x" * 200 + "</p>"
PAGES = [(4, "http://www.a.org/x?y", PAGE, "k"), (2, "http://a.org/x", PAGE, "k"), (9, "https://B.com/é", PAGE, "k"), (5, None, None, "k"), (6, "", "", "k"),
         (7, "http://a.org/x", "small", "k"), (8, "http://c.net", "small", "k"), (4, "http://www.a.org/x?y", PAGE, "k"), (None, "http://n.org/", PAGE, "k"),
         (10, "http://a.org/x", "é" * 100 + "\r\n\r\nWARC/1.1", "k"), (11, "http://big.org/", "y" * 2_000_000, "k")]


def test_warc_round_trip(spark):
    df = spark.createDataFrame(PAGES, "page_id long, url string, html string, key string")
    got = sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in warc.archive_report(df).collect()), key=str)
    want = []
    for i, _, h, _ in PAGES:
        b = (h or "").encode()
        same = [j for j, _, x, _ in PAGES if j is not None and x == h]
        old = i is not None and len(b) >= 100 and min(same) < i
        want.append((i, len(b), hashlib.sha256(b).hexdigest(), "revisit" if old else "response", min(same) if old else None))
    assert got == sorted(want, key=str)
    assert warc.archive_report(df.limit(0)).count() == 0


def test_warc_lookup_and_plain_gzip_reading(spark):
    df = spark.createDataFrame([(i, f"http://h{i % 7}.org/p{i % 50}", f"page {i} " * 20) for i in range(400)], "page_id long, url string, html string")
    folder = scratch_path(spark, "warc-test")
    captures = warc.write_archives(df, folder)
    index = warc.write_index(captures, f"{folder}-index", block_lines=16)
    keys = spark.createDataFrame([(warc.url_key("http://h3.org/p3"),), ("org,zz)/",), (None,), (warc.url_key("http://h0.org/p0"),), ("",)], "key string")
    found = warc.lookup(index, f"{folder}-index", keys)
    assert {r.page_id for r in found.collect()} == {i for i in range(400) if (i % 7, i % 50) in ((3, 3), (0, 0))}
    assert warc.read_captures(found, folder).count() == found.count()
    file = captures.first()["file"]
    raw = gzip.decompress(warc.export_bytes(folder, file).read())      # all members, one after the other
    assert raw.count(b"WARC/1.1\r\n") == captures.where(captures.file == file).count()


def test_archive_report_finds_captures_by_lookup(spark, monkeypatch):
    df = spark.createDataFrame([(i, f"http://h{i % 7}.org/p{i % 50}", f"page {i} " * 20) for i in range(400)], "page_id long, url string, html string")
    looked, lookup = [], warc.lookup
    monkeypatch.setattr(warc, "lookup", lambda *a: looked.append(a) or lookup(*a))
    assert sorted(r.page_id for r in warc.archive_report(df).collect()) == list(range(400)) and len(looked) == 1
    index, folder, captures = looked[0]
    rows = lambda x: sorted(map(tuple, x.select("key", "page_id", "file", "offset", "length").collect()))
    assert rows(lookup(index, folder, captures)) == rows(warc.all_captures(index, folder)) == rows(captures)


def test_url_keys():
    assert warc.url_key("http://www.A.org/x?y") == "org,a,www)/x?y" and warc.url_key(None) == ")" and warc.url_key("a.b#c") == "b,a)#c"


# ---------------------------------------------------------------- 6: SentencePiece

@pytest.fixture(scope="module")
def pieces():
    with open(sp.MODEL, "rb") as f:
        return sp.Pieces(f.read())


TEXTS = ["Hello  world\n\nab", "▁x y", " a", "\tq", "é漢字😀", "", "a" * 500 + "é" * 300 + " " * 90, "\n", "﻿x\x00y", "w " * 30_000, "漢" * 100]


def test_pieces_decode_without_loss_here_and_in_the_library(pieces):
    import sentencepiece
    lib = sentencepiece.SentencePieceProcessor(model_file=sp.MODEL)
    data, off = text_buffers(pa.array(TEXTS))
    ids, cut = sp.encode_rows(pieces, np.arange(len(TEXTS)), data, off, 0)
    back, back_off = sp.decode_rows(pieces, ids, cut)
    for i, t in enumerate(TEXTS):
        x = ids[cut[i]:cut[i + 1]].tolist()
        assert back[back_off[i]:back_off[i + 1]].tobytes().decode() == t == lib.decode(x)


def test_samples_follow_the_lattice_distribution(pieces):
    n, vocab = 40_000, {b: i for i, b in enumerate(pieces.bytes) if len(b) > 1 or i > 258}
    data, off = text_buffers(pa.array(["there"] * n))
    ids, cut = sp.encode_rows(pieces, np.arange(n), data, off, 1)
    seen = collections.Counter(tuple(ids[cut[i]:cut[i + 1]].tolist()) for i in range(n))

    def paths(s):
        if not s:
            yield (), 1.0
        for k in range(1, len(s) + 1):
            if s[:k] in vocab:
                for rest, p in paths(s[k:]):
                    yield (vocab[s[:k]], *rest), p * pieces.weight[vocab[s[:k]]]

    exact = dict(paths(b" there"))
    total = sum(exact.values())
    assert set(seen) <= set(exact) and len(exact) > 20
    assert sum(abs(seen[k] / n - p / total) for k, p in exact.items()) / 2 < 0.01


def test_samples_depend_on_seed_and_key_only(spark, docs_of):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(50, None), (None, "no key")]
    run = lambda parts, seed: {(r.doc_id, r.text): r.ids_ for r in sp.with_pieces(docs_of(rows).repartition(parts), seed=seed)[0].collect()}
    a, b, c = run(1, 3), run(5, 3), run(5, 4)
    assert a == b and a != c and a[50, None] == [] and a[5, ""] == []
    out = sp.decode(sp.with_pieces(docs_of(rows))[0], "ids_")
    assert {(r.doc_id, r.decoded) for r in out.collect()} == {(i, t or "") for i, t in rows}
    assert sp.piece_report(docs_of([])).count() == 0 and sp.piece_report(docs_of(rows)).where("not lossless").count() == 0


# ---------------------------------------------------------------- 9: toxicity

def test_noisy_or_learns_from_document_labels_and_locates_sentences(docs_of, labels_of):
    rng = random.Random(9)
    sentence = lambda: " ".join(f"w{rng.randrange(500)}" for _ in range(8)) + "."
    rows, labels = [], []
    for i in range(500):
        s = [sentence() for _ in range(rng.randrange(1, 12))]
        if i % 5 == 0:
            s[rng.randrange(len(s))] = f"w1 you {rng.choice(['grubling', 'snotfish'])}{rng.choice(['', 's', 'en'])} w2."
        rows.append((i, " ".join(s)))
        labels.append((i, int(i % 5 == 0), "t"))
    rows += [(1000, None), (1001, ""), (None, "w1 snotfish."), (1002, "w3 " * 30_000), (0, "repeats an id")]
    labels += [(0, 1, "t"), (None, 1, "t"), (3, None, "t")]
    got = tx.toxicity_report(docs_of(rows), labels_of(labels)).collect()
    assert len(got) == len(rows)
    truth = dict((i, y) for i, y, _ in labels if i not in (0, None))
    held = [r for r in got if r.held_out and r.doc_id in truth]
    assert len(held) > 50 and all(r.predicted == truth[r.doc_id] for r in held)
    text = {(i, t) for i, t in rows}
    for r in held:
        if r.predicted:
            t = next(x for i, x in text if i == r.doc_id)
            assert re.search("grubling|snotfish", t.encode()[r.start:r.end].decode())
    by = {r.doc_id: r for r in got}
    assert by[1000].score == by[1001].score == 0 and by[1000].start is None and by[1002].predicted == 0 and not by[None].held_out
    d = docs_of(rows)
    kept = tx.drop_toxic(d, labels_of(labels))
    assert kept.columns == d.columns and 0 < kept.count() < len(rows)


@pytest.mark.parametrize("bound", [1 << 22, 0])
def test_long_clean_documents_are_fitted_whole(docs_of, labels_of, monkeypatch, bound):
    # thousands of sentences each; the second sentence is in all of both classes, so it says nothing
    monkeypatch.setattr(tx, "DRIVER_HITS", bound)       # 0: gradients are summed in tasks
    rng = random.Random(10)
    rows, labels = [], []
    for i in range(80):
        s = [f"plain{rng.randrange(50)} of s{rng.randrange(9)}." for k in range(2500)]
        s[1] = "we borrow books."
        if i % 2:
            s[rng.randrange(2, len(s))] = "you snotfish."
        rows.append((i, " ".join(s)))
        labels.append((i, i % 2, "t"))
    rows += [(100, "plain1 of s1. " * 5000), (101, "plain1 of s1. you snotfish."), (102, "we borrow books.")]
    model = tx.fit_toxicity(docs_of(rows), labels_of(labels))
    data, off = text_buffers(pa.array([t for _, t in rows]))
    assert (model.scores(data, off) >= 0.5).tolist() == [bool(i % 2) for i in range(80)] + [False, True, False]


def test_the_fit_brings_no_texts_to_the_driver(docs_of, labels_of, monkeypatch):
    # texts without sentence ends, which are one sentence each however long
    rows = [(i, f"plain{i} of it " * 20_000 + ("snotfish" if i % 2 else "")) for i in range(30)]
    frame, seen = type(docs_of(rows)), []
    collect = frame.toArrow

    def watched(df):
        seen.append(collect(df))
        return seen[-1]

    monkeypatch.setattr(frame, "toArrow", watched)
    model = tx.fit_toxicity(docs_of(rows), labels_of([(i, i % 2, "t") for i in range(30)]))
    assert len(model.ids) and sum(x.nbytes for x in seen) < 100_000 < sum(len(x) for _, x in rows) // 50


def test_toxicity_without_labels_or_rows(docs_of, labels_of):
    assert {r.predicted for r in tx.toxicity_report(docs_of([(1, "a b."), (2, None)]), labels_of([])).collect()} == {0}
    assert tx.toxicity_report(docs_of([]), labels_of([(1, 1, "t")])).count() == 0


# ---------------------------------------------------------------- queries and pipeline

def test_all_eleven_are_registered_and_sql_matches_on_the_small_tables(spark):
    names = [n for n in E.queries() if re.match(r"op\d+_|pipeline$", n)]
    assert sorted(names, key=lambda n: int(re.sub(r"\D", "", n) or 0)) == ["pipeline"] + sorted((n for n in names if n != "pipeline"), key=lambda n: int(re.findall(r"\d+", n)[0]))
    assert len(names) == 14
    con = duckdb.connect()
    for t in ("documents", "pages", "labels", "benchmark", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    for name, sql in E.oracle_sql().items():
        if re.match(r"op\d+_", name):
            got = E.queries()[name](spark, SF_SMALL)
            cols = sorted(got.columns)
            want = con.sql(f"SELECT {', '.join(cols)} FROM ({sql})").fetchall()
            assert sorted(map(str, map(tuple, got.select(*cols).collect()))) == sorted(map(str, want)), name


def test_pipeline_stages_match_plain_python(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    extra = spark.createDataFrame([(10**6, None, "en", "s", 0), (10**6 + 1, "", None, None, None)], docs.schema)
    docs = docs.unionByName(extra)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {r.doc_id: r.text for r in docs.collect()}
        docs = corpus_pipeline.written(stage(spark, docs, SF_SMALL), name)
        after = {r.doc_id: r for r in docs.collect()}
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"] and set(after) <= set(before) and {10**6, 10**6 + 1} <= set(after)
        if name == "line_dedup":
            assert set(after) == set(before) and all(r.n_chars == len(r.text) for r in after.values() if r.text is not None)
        else:
            assert all(r.text == before[i] for i, r in after.items())
        if name == "ngram_join":
            assert sorted(after) == sorted(i for i, _, c in linked_by_hand(list(before.items())) if c == i)
    out = corpus_pipeline.STAGES[-1][1](spark, docs, SF_SMALL)
    back = sp.decode(out, "ids").collect()
    assert {r.doc_id: r.decoded for r in back} == {i: r.text or "" for i, r in after.items()}
