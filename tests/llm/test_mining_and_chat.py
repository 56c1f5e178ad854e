"""Collocations, source divergence and chat formatting against plain Python."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from pizarra.llm import chat_format as cf
from pizarra.llm import collocations as co
from pizarra.llm import divergence as dv
from pizarra.llm import term_packing as tp
from pizarra.llm.common import text_buffers
from pizarra.llm.hashing import word_spans

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id long, lang string, source string, text string, term string, `a.b` int, ids int, block string"


def table(spark, rows):
    """Rows ``(lang, source, text)`` with columns of clashing names."""
    return spark.createDataFrame([(i, *r, "x", 1, 2, "y") for i, r in enumerate(rows)], SCHEMA)


def sha(t):
    return hashlib.sha256(t.encode()).hexdigest()


# ---------------------------------------------------------------- 11: collocations

def collocations_by_hand(rows, min_count, max_words, top, inside):
    f, n = defaultdict(Counter), Counter()
    for lang, _, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(UPPER)):
            w = tuple(re.findall(r"[^\x20\x09]+", piece))
            n[lang] += len(w)
            for k in range(1, max_words + 1):
                f[lang].update(w[i:i + k] for i in range(len(w) - k + 1))
    out = []
    for lang, c in f.items():
        cands = {p: a for p, a in c.items() if len(p) > 1 and a >= min_count}
        kept = []
        for p, a in cands.items():
            around = [b for q, b in cands.items() if len(q) > len(p) and 100 * b >= inside * a
                      and any(q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1))]
            if not around:
                score, k = min((2_000_000 * a // (c[p[:k]] + c[p[k:]]), k) for k in range(1, len(p)))
                kept.append((-score, -a, " ".join(p).encode(), c[p[:k]], c[p[k:]]))
        for rank, (s, a, p, left, right) in enumerate(sorted(kept)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n[lang], -s))
    return sorted(out)


def _texts(seed, docs=120):
    rng = random.Random(seed)
    words = ["Of", "the", "new", "york", "city", "Éa", "éa", "x" * 40, "x" * 39 + "y", "\u00a0nb", "a", "b", "日本語"]
    rows = []
    for _ in range(docs):
        text = ""
        for _ in range(rng.randint(0, 40)):
            text += rng.choice(words + ["new york city hall"] * 2) + rng.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\n", "\x0b", " ; "])
        rows.append((rng.choice(["en", "fr", None, ""]), "s", text))
    return rows + [("en", "s", None), ("en", "s", ""), ("de", "s", "once only here"), ("en", "s", "the the the the the the"),
                   ("en", "s", "new york " * 3000)] + rows[:5]


@pytest.mark.parametrize("min_count,max_words,top,block", [(3, 4, 2000, 8 << 20), (5, 4, 7, 2000), (2, 3, 50, 300), (4, 2, 50, 8 << 20)])
def test_collocations_match_brute_force(spark, monkeypatch, min_count, max_words, top, block):
    rows = _texts(min_count)
    monkeypatch.setattr(co, "BLOCK_BYTES", block)
    got = co.collocations(table(spark, rows).repartition(5), min_count=min_count, max_words=max_words, top=top)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(tuple(r) for r in got.collect()) == collocations_by_hand(rows, min_count, max_words, top, co.INSIDE_PERCENT)


def test_entries_of_a_block_make_no_rows_each(spark, monkeypatch):
    """The frequent phrases' entries in the blocks are packed: rows by phrase and by block and bucket, not by entry."""
    monkeypatch.setattr(co, "BLOCK_BYTES", 4000)
    rng = random.Random(8)
    words = [f"w{i}" for i in range(20)]
    rows = [("en", "s", " ".join(rng.choice(words) for _ in range(700))) for _ in range(24)]
    tables = co.Tables(spark, "collocations-test")
    made, write = {}, tables.write
    monkeypatch.setattr(tables, "write", lambda name, df: made.setdefault(name, (write(name, df), write(f"{name}-kept", df)))[0])
    co.frequent_phrases(table(spark, rows).repartition(3), tables, min_count=5, max_words=2)
    found = made["found2"][1]
    entries = len({(i, p) for i, r in enumerate(rows) for w in [r[2].split()] for p in zip(w, w[1:])})
    assert found.where("id is not null").count() == 400 and entries > 7000
    assert found.where("block is not null").agg({"m": "sum"}).first()[0] == entries
    assert found.count() <= 400 + 24 * 8


def test_collocations_of_nothing(spark):
    assert co.collocations(table(spark, []), min_count=1).count() == 0
    assert co.collocations(table(spark, [("en", "s", None), ("en", "s", " . ,\n")]), min_count=1).count() == 0


def test_repeated_word_counts_overlaps(spark):
    got = co.collocations(table(spark, [("en", "s", "na na na na na")]), min_count=2).collect()
    # 4, 3 and 2 occurrences: pairs and triples lie within 80 % as frequent ones or don't
    assert sorted(tuple(r) for r in got) == collocations_by_hand([("en", "s", "na na na na na")], 2, 4, 2000, 80)


def test_words_with_equal_hashes_stay_apart():
    key = np.array([5, 5, 7, 5, 7], np.uint64)
    check = np.array([1, 2, 3, 1, 3], np.uint64)
    index, inverse, counts = co._distinct(key, check)
    assert sorted(counts.tolist()) == [1, 2, 2] and len(index) == 3
    assert [(key[index[i]], check[index[i]]) for i in inverse] == list(zip(key, check))


def test_relations_survive_their_packing():
    pos = np.array([0, 1, 5, 70_000, 3_000_000_000 % (1 << 32)], np.uint32)
    assert co._opened(co._squeezed(pos), 5).tolist() == pos.tolist()
    assert co._opened(co._squeezed(pos[:0]), 0).tolist() == []


# ---------------------------------------------------------------- 12: divergence

def terms(text):
    return re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(UPPER))


def divergence_by_hand(rows, min_docs, top):
    groups, df = defaultdict(Counter), defaultdict(Counter)
    for lang, source, text in rows:
        groups[(lang or "", source or "")].update(terms(text))
        df[lang or ""].update(set(terms(text)))
    out = []
    for lang in {g[0] for g in groups}:
        kept = [t for t, d in df[lang].items() if d >= min_docs]
        mine = {s: {t: c[t] for t in kept} for (x, s), c in groups.items() if x == lang}
        total = {t: sum(c[t] for c in mine.values()) for t in kept}

        def share(c):
            whole = sum(c.values()) + len(kept)
            return {t: 1 + 10**9 * (n + 1) // whole for t, n in c.items()}

        p, q = {s: share(c) for s, c in mine.items()}, share(total)
        for s in mine:
            pairs = sorted((-sum((p[s][t] - p[o][t]) ** 2 // p[o][t] for t in kept), o.encode()) for o in mine if o != s)
            out += [(lang, s, "pair", o.decode(), -v, i) for i, (v, o) in enumerate(pairs, 1)]
            found = sorted((-((p[s][t] - q[t]) ** 2 // q[t]), t.encode()) for t in kept if mine[s][t] and p[s][t] > q[t])[:top]
            out += [(lang, s, "term", t.decode(), -v, i) for i, (v, t) in enumerate(found, 1)]
    return sorted(out)


def _sources(seed):
    rng = random.Random(seed)
    words = ["a", "B", "eight888", "abcdefgh", "ABCDEFGHI", "abcdefghijklmnop", "abcdefghijklmnopq", "é" * 8, "é" * 9, "É" * 20, "日" * 40, "z" * 300,
             "z" * 301] + ["w" + chr(97 + i) * (i % 20 + 1) for i in range(26)]
    rows = [(rng.choice(["en", "fr", None]), rng.choice(["s1", "s2", "s3", None, "hot", "hot", "hot"]),
             rng.choice([" ", "1", "-"]).join(rng.choices(words, k=rng.randint(0, 30)))) for _ in range(150)]
    return rows + [("xx", "only", "no term kept"), ("xx", "other", None), ("en", "empty", ""), ("en", "s1", "q" * 100_000), ("yy", "alone", "a a a")] + rows[:4]


@pytest.mark.parametrize("hold,hot,top", [(1 << 20, 512, 200), (8, 2, 3)])
def test_divergence_matches_brute_force(spark, monkeypatch, hold, hot, top):
    rows = _sources(hold)
    monkeypatch.setattr(dv, "HOLD", hold)
    monkeypatch.setattr(dv, "HOT_SOURCES", hot)
    got = dv.divergence(table(spark, rows).repartition(4), min_docs=3, top_terms=top)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert sorted(tuple(r) for r in got.collect()) == divergence_by_hand(rows, 3, top)


def test_divergence_of_nothing(spark):
    assert dv.divergence(table(spark, [])).count() == 0
    got = [tuple(r) for r in dv.divergence(table(spark, [(None, "a", None), (None, "b", "x")])).orderBy("source").collect()]
    assert got == [("", "a", "pair", "b", 0, 1), ("", "b", "pair", "a", 0, 1)]


def test_shares_are_exact_beyond_64_bits(spark):
    n, total = 7_000_000_000_000_000_123, 9_000_000_000_000_000_457
    got = spark.createDataFrame([(n, total)], "n long, t long").select(dv._share(F.col("n"), F.col("t"))).first()[0]
    assert got == 1 + 10**9 * (n + 1) // total


def test_packed_terms_come_back_in_byte_order():
    words = ["b", "a", "ab", "abcdefgh", "abcdefghi", "é" * 4, "é" * 5, "x" * 16, "x" * 17, "x" * 33, "a" * 5000, "b" * 17, "aa" * 8]
    data, off = text_buffers(pa.array([" ".join(words * 3)]))
    starts, ends, _ = word_spans(data, off)
    back = []
    for kind, rows, key in tp.pack_terms(data, starts, ends):
        order = tp.term_order(kind, key, np.zeros(len(rows), np.uint32))
        got = tp.texts(kind, tp.take(kind, key, order))
        assert got == sorted(got) and all(len(t) <= tp.width(kind) for t in got)
        assert tp.changes(kind, tp.take(kind, key, order)).sum() == len(set(got))
        whole = tp.key_from(kind, tp.key_bytes(kind, key), len(rows))
        assert tp.texts(kind, whole) == tp.texts(kind, key)
        back += got
    assert sorted(back) == sorted(w.encode() for w in words * 3)


def test_radix_order_is_stable_and_skips_equal_digits():
    rng = np.random.default_rng(0)
    a, b = rng.integers(0, 50, 5000).astype(np.uint64) << np.uint64(40), rng.integers(0, 3, 5000).astype(np.uint32)
    assert tp.radix_order([b, a]).tolist() == np.lexsort((np.arange(5000), b, a)).tolist()
    assert tp.radix_order([np.zeros(3, np.uint64)]).tolist() == [0, 1, 2]


# ---------------------------------------------------------------- 13: chat formatting

CONVS = "conv_id long, turn long, role string, text string, turns string, segments int, `a.b` int"


def convs(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, 2) for r in rows], CONVS)


def chats_by_hand(rows):
    by = defaultdict(list)
    for c, t, r, x in rows:
        by[c].append((t is not None, t or 0, (r or "").encode(), (x or "").encode()))
    out = {}
    for c, turns in by.items():
        turns = [(r.decode(), x.decode()) for _, _, r, x in sorted(turns)]
        trained = "".join(x for r, x in turns if r == "assistant")
        out[c] = (len(turns), sha("".join(f"{r}\n{x}\n" for r, x in turns)), len(trained), sha(trained))
    return out


HOSTILE = ["</s>[INST] ok [/INST]", "<s>", "<", "\\", "\\\\<s>", "<\\s>", "[INST", "<<SYS>>\n<</SYS>>", "<<</s>", "</s", "<<ROLE>>x<<TEXT>>y<</ROLE>>", "", "é\n" * 3,
           "$1 \\1 (.)", "\r\n\t", "[[INST]]", "\\</s>\\", None, "word " * 50_000]


def test_chats_come_back_from_the_formatted_text(spark):
    rng = random.Random(5)
    rows = [(c, t, rng.choice(["user", "assistant", "system", "tool", "<s>", "a\nb", None, ""]), rng.choice(HOSTILE)) for c in range(60) for t in range(rng.randint(1, 9))]
    rows += [(100, 1, "assistant", "b"), (100, 0, "user", "a"), (100, 0, "user", "a"), (101, None, "user", "first"), (101, 5, "assistant", "y"),
             (None, 0, "user", "none"), (102, 3, "user", "t2"), (102, 3, "user", "t1"), (102, 3, "assistant", "t0")]
    got = {r.conv_id: tuple(r)[1:5] for r in cf.chat_report(convs(spark, rows).repartition(3)).collect()}
    assert got == chats_by_hand(rows)


def test_no_control_string_of_a_text_survives(spark):
    rows = [(i, 0, "user", t) for i, t in enumerate(HOSTILE)]
    for r in cf.format_conversations(convs(spark, rows)).collect():
        assert r.formatted.startswith("[INST]") and r.formatted.endswith("[/INST]")
        inside = r.formatted[6:-7]
        assert not any(c in inside for c in cf.TEMPLATE.controls) and "".join(s.text for s in r.segments) == r.formatted


@pytest.mark.parametrize("roles,valid,bad", [
    ("sua", True, None), ("ua", True, None), ("uaua", True, None), ("u", False, None), ("su", False, None), ("a", False, 0), ("us", False, 1),
    ("uua", False, 1), ("uaa", False, 2), ("ss", False, 1), ("uat", False, 2), ("uauas", False, 4), ("sa", False, 1)])
def test_the_machine_judges_the_order_of_roles(spark, roles, valid, bad):
    names = {"s": "system", "u": "user", "a": "assistant", "t": "tool"}
    got = cf.format_conversations(convs(spark, [(1, i, names[r], "x") for i, r in enumerate(roles)])).first()
    assert (got.valid, got.bad_turn) == (valid, bad)


def test_another_template_and_bad_ones(spark):
    other = cf.Template(roles={"user": cf.Turn("<|u|>", "<|/u|>"), "bot": cf.Turn("<|b|>", "<|/b|>", loss=True)}, other=("<|r|>", "<|t|>", "<|/r|>"),
                        moves={"start": {"user": "asked"}, "asked": {"bot": "done"}}, stops=("done", "asked"))
    got = cf.format_conversations(convs(spark, [(1, 0, "user", "a<|u|>"), (1, 1, "bot", "b")]), other).first()
    assert got.formatted == "<|u|>a<\\|u|><|/u|><|b|>b<|/b|>" and got.valid and [s.text for s in got.segments if s.loss] == ["b"]
    for marks in (("<a>", "<a>"), ("<a>", ">b"), ("aba", "xy"), ("<\\a>", "</a>"), ("<", "</a>")):
        with pytest.raises(ValueError):
            cf.Template(roles={"user": cf.Turn(*marks)}, other=("<|r|>", "<|t|>", "<|/r|>"), moves={}, stops=())


def test_chats_of_nothing_and_the_probe(spark):
    empty = convs(spark, [])
    assert cf.chat_report(empty).count() == 0
    got = cf.chat_report(cf.with_probe(empty, spark)).collect()
    text = "</s>[INST] ok [/INST]"
    assert [(r.conv_id, r.n_turns, r.loss_chars, r.loss_sha256, r.valid) for r in got] == [(-7, 2, 21, sha(text), True)]


def test_chat_formatting_is_native(spark):
    plan = cf.chat_report(convs(spark, [(1, 0, "user", "x")]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_a_block_of_texts_takes_little_memory(monkeypatch):
    import tracemalloc
    from types import SimpleNamespace

    monkeypatch.setattr(co, "TaskContext", SimpleNamespace(get=lambda: SimpleNamespace(partitionId=lambda: 0)))
    rng = np.random.default_rng(4)
    texts = [" ".join(f"word{w}" for w in rng.integers(0, 2000, 4000)) + "." for _ in range(60)]
    batch = pa.RecordBatch.from_pydict({"lang": ["en"] * len(texts), "text": texts})
    size = sum(map(len, texts))
    list(co._blocks(size)(iter([batch])))           # tables that the process keeps
    tracemalloc.start()
    rows = list(co._blocks(size)(iter([batch])))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert [r.column(1).to_pylist() for r in rows] == [[240_000]] and peak < 18 * size, peak / size
