"""Line dedup, substring dedup, fingerprints, licence scan and url filter against plain Python."""

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from pizarra.llm import fingerprint as fp
from pizarra.llm import license_scan as ls
from pizarra.llm import line_dedup as ld
from pizarra.llm import substring_dedup as sd
from pizarra.llm import url_filter as uf
from pizarra.llm.common import text_buffers
from pizarra.llm.hashing import gram_hashes, span_hashes, word_spans

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
BLANKS = " \t\n\x0b\x0c\r"
LONG = "word " * 30_000


def sha(t):
    return hashlib.sha256(t.encode()).hexdigest()


# ---------------------------------------------------------------- hashing

def test_words_and_hashes_match_python():
    texts = ["", "a  b\tC\x0bé x", " lead", "trail ", "Éa éa", "x" * 700_000 + " y", "\n\n"]
    data, off = text_buffers(pa.array(texts + [None]))
    s, e, first = word_spans(data, off)
    raw = data.tobytes()
    got = [[raw[s[i]:e[i]].decode() for i in range(first[r], first[r + 1])] for r in range(len(texts) + 1)]
    assert got == [re.findall(r"[^\x20\x09-\x0D]+", t) for t in texts] + [[]]
    h = span_hashes(data, s, e, lower=True)
    flat = [w.translate(UPPER) for r in got for w in r]
    seen = {}
    for w, x in zip(flat, h.tolist()):
        assert seen.setdefault(w, x) == x
    assert len(set(seen.values())) == len(seen)


@pytest.mark.parametrize("n", [3, 50])
def test_gram_hashes_depend_on_the_words_only(n):
    rng = np.random.default_rng(1)
    w = rng.integers(0, 3, 4000).astype(np.uint64)
    g = gram_hashes(w, n)
    seen = {}
    for i in range(len(g)):
        assert seen.setdefault(tuple(w[i:i + n]), g[i]) == g[i]
    assert len(set(seen.values())) == len(seen)


# ---------------------------------------------------------------- 7: lines

def lines_by_hand(rows):
    first = {}
    key = lambda x: x.strip(BLANKS).translate(UPPER)
    for i, t in rows:
        if i is not None:
            for x in (t or "").split("\n"):
                if len(key(x)) >= 10:
                    first[key(x)] = min(first.get(key(x), i), i)
    out = []
    for i, t in rows:
        x = (t or "").split("\n")
        kept = [y for y in x if i is None or first.get(key(y), i) == i]
        out.append((i, len(x), len(x) - len(kept), sha("\n".join(kept))))
    return sorted(out, key=str)


LINE_ROWS = [
    (3, "A common line here\nown line of three\n\n  a COMMON line here \x0b"), (1, "a common line here\nshort\nshort\na common line here"),
    (2, "short\nA Common Line Here\nÉcole normale sup\nlast line is mine"), (5, "école normale sup\nÉcole normale sup"), (4, None), (6, ""),
    (None, "a common line here\nshort"), (7, LONG + "\na common line here"), (8, LONG.strip()), (9, "own line of three"), (9, "own line of three"),
    (9, "x\nown line of three\nown line of three\ny"), (10, "\n\n\n"),
]


def test_line_dedup_matches_plain_python(docs_of):
    got = ld.line_report(docs_of(LINE_ROWS)).collect()
    assert sorted(((r.doc_id, r.n_lines, r.n_dropped, r.kept_sha256) for r in got), key=str) == lines_by_hand(LINE_ROWS)


def test_line_dedup_hot_line_and_few_salts(docs_of):
    rows = [(i, f"the line that everybody has\nbut this is line {i % 40}\nown {i}") for i in range(300)]
    maps = {r["id"]: r["runs"] for r in ld.keep_bitmaps(docs_of(rows), salts=3).collect()}
    assert 0 not in maps and maps[7] == [0, 1] and maps[41] == [0, 2]


def test_line_dedup_keeps_columns_and_takes_empty_tables(docs_of):
    d = docs_of(LINE_ROWS)
    out = ld.drop_repeated_lines(d)
    assert out.columns == d.columns and out.count() == len(LINE_ROWS)
    assert ld.line_report(docs_of([])).count() == 0


# ---------------------------------------------------------------- 10: substrings

def substrings_by_hand(rows, n):
    words = [(i, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t in rows]
    first = {}
    for i, w in words:
        for k in range(len(w) - n + 1 if i is not None else 0):
            g = tuple(w[k:k + n])
            first[g] = min(first.get(g, i), i)
    out = []
    for i, w in words:
        gone = set()
        for k in range(len(w) - n + 1 if i is not None else 0):
            if first[tuple(w[k:k + n])] < i:
                gone |= set(range(k, k + n))
        kept = [x for k, x in enumerate(w) if k not in gone]
        out.append((i, len(w), len(gone), sha(" ".join(kept))))
    return sorted(out, key=str)


@pytest.mark.parametrize("window", [2, 7, 50])
def test_substring_dedup_matches_plain_python(docs_of, window):
    rng = random.Random(window)
    passages = [[rng.choice("abcdefgh") + str(rng.randrange(40)) for _ in range(rng.randrange(5, 140))] for _ in range(8)]
    rows = []
    for i in range(60):
        w = []
        for _ in range(rng.randrange(4)):
            w += rng.choice(passages)[rng.randrange(4):] + [f"u{rng.randrange(10**6)}" for _ in range(rng.randrange(30))]
        rows.append((i * 3 % 61, "  ".join(w)))
    same = " ".join(passages[0] + passages[1])
    rows += [(100, None), (101, ""), (None, same), (102, same), (103, same), (103, same), (103, "new " + same), (104, "z " * 20_000), (105, "z " * 300)]
    got = sd.substring_report(docs_of(rows), window=window).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got), key=str) == substrings_by_hand(rows, window)


def test_substring_dedup_when_the_sketch_is_full(docs_of, monkeypatch):
    monkeypatch.setattr(sd, "repeated", lambda bits, keys, cells: np.ones(len(keys), bool))
    rows = [(i, " ".join(f"w{(i % 3) * 10 + k}" for k in range(70))) for i in range(9)]
    got = sd.substring_report(docs_of(rows), keep_text=True).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got), key=str) == substrings_by_hand(rows, 50)
    assert {r.kept_text for r in got if r.n_removed == r.n_words} == {""}


def test_substring_dedup_takes_an_empty_table(docs_of):
    assert sd.substring_report(docs_of([])).count() == 0


# ---------------------------------------------------------------- 3: fingerprints

def test_edit_report_matches_plain_python(docs_of):
    rng = random.Random(3)
    rows = [(i * 7 % 101, "".join(rng.choice("abcdé 漢\n") for _ in range(rng.randrange(400)))) for i in range(101)]
    rows += [(200, None), (201, ""), (202, "ab"), (203, LONG), (50, "tie b"), (None, "no id")]
    got = fp.edit_report(docs_of(rows)).collect()
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1] or ""))
    want = []
    for k, (i, t) in enumerate(order):
        t, x = t or "", order[(k + 1) % len(order)][1] or ""
        third = len(t) // 3
        want.append((i, len(t), sha(t[:len(t) - third] + x[:third])))
    assert sorted(((r.doc_id, r.n_chars, r.edited_sha256) for r in got), key=str) == sorted(want, key=str)
    plain = {(r.doc_id, r.fingerprint) for r in fp.fingerprints(docs_of(rows)).collect()}
    assert {(r.doc_id, r.fingerprint) for r in got} == plain
    for r in got:
        a, b = fp.from_hex(r.fingerprint)[None], fp.from_hex(r.edited_fingerprint)[None]
        assert r.near_edited == pytest.approx(float(fp.likeness(a, b)[0])) and 0 <= r.near_next <= 1


def test_fingerprint_counts_match_a_loop_and_tell_edits_from_strangers():
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("etaoinshrdlu") for _ in range(rng.randrange(2, 9)))
    texts = [" ".join(word() for _ in range(300)) for _ in range(30)] + ["", "x", "same text", "same text"]
    data, off = text_buffers(pa.array(texts))
    counts = fp.bucket_counts(data, off)
    for r in (0, 30, 32):
        n = len(texts[r].encode())
        assert counts[r].sum() == sum(max(n - j, 0) for _, j in fp.SPREADS)
    codes = fp.digests(data, off)
    assert fp.to_hex(codes)[32] == fp.to_hex(codes)[33] and (fp.from_hex(fp.to_hex(codes)[0]) == codes[0]).all()
    edited = fp._edited(texts[:30], texts[1:31])
    b = fp.digests(*text_buffers(pa.array(edited)))
    near, far = fp.likeness(codes[:30], b), fp.likeness(codes[:29], codes[1:30])
    assert near.min() > far.max() and fp.likeness(codes, codes).min() == 1


@pytest.mark.parametrize("n", [3, 5, 8, 11, 12, 14, 17, 30])
def test_short_texts_are_told_apart(n):
    rng = random.Random(n)
    texts = ["".join(rng.choice("etaoinshrdlucmfw") for _ in range(n)) for _ in range(200)]
    data, off = text_buffers(pa.array(texts))
    assert (fp.bucket_counts(data, off).sum(axis=1) > 0).all()
    codes = fp.digests(data, off)
    near = fp.likeness(codes[:-1], codes[1:])
    assert (fp.likeness(codes, codes) == 1).all() and near.mean() < 0.3
    assert len(set(fp.to_hex(codes))) > (150 if n > 4 else 80)


def test_fingerprints_of_one_row_and_none(docs_of):
    (r,) = fp.edit_report(docs_of([(5, "abcdef")])).collect()
    assert r.edited_sha256 == sha("abcdab") and r.near_next == 1
    assert fp.edit_report(docs_of([])).count() == 0


# ---------------------------------------------------------------- 1: licences

def test_license_scan_finds_notices_and_leaves_prose_alone(docs_of):
    mit = ls.TEMPLATES[0][1]
    wrapped = "\n".join(" ".join(mit.split()[i:i + 11]) for i in range(0, len(mit.split()), 11))
    rows = [(1, "some prose\n  RELEASED under the MIT license!\nmore"), (2, "intro\n\nCopyright (c) 2020 Someone\n" + wrapped + "\n\nother words"),
            (3, "The license under the released."), (4, None), (5, ""), (6, "MIT"), (7, mit), (8, LONG), (1, "same id, no licence")]
    got = sorted(((r.doc_id, r.license, r.unit) for r in ls.license_report(docs_of(rows)).collect()), key=str)
    assert got == sorted([(1, "MIT", "line"), (1, None, None), (2, "MIT", "paragraph"), (3, None, None), (4, None, None), (5, None, None),
                          (6, None, None), (7, "MIT", "line"), (8, None, None)], key=str)
    assert ls.license_report(docs_of([])).count() == 0


def broken(text, *starts):
    """The text wrapped as in real files, with a blank line before each of ``starts``."""
    for s in starts:
        assert s in text
        text = text.replace(s, "\n\n" + s)
    return "\n\n".join("\n".join(" ".join(p.split()[i:i + 11]) for i in range(0, len(p.split()), 11)) for p in text.split("\n\n"))


def test_license_scan_finds_licences_of_several_paragraphs_inside_longer_texts(docs_of):
    text = {n: t for n, t in ls.TEMPLATES[::-1]}
    mit = broken(ls.TEMPLATES[0][1], "The above copyright notice and", 'THE SOFTWARE IS PROVIDED "AS IS"')
    bsd = broken(text["BSD-3-Clause"], "1. Redis", "2. Redis", "3. Neither", "THIS SOFTWARE")
    apache = broken(text["Apache-2.0"], "http", "Unless")
    gpl = broken(ls._GPL_NOTICE.format(3), "This program is distributed")
    prose = lambda k: "\n\n".join(" ".join(f"word{k}x{i}x{j}" for j in range(75)) for i in range(4))
    around = lambda t, k: f"{prose(k)}\n\nCopyright (c) 2020 Someone\n\n{t}\n\n{prose(k + 50)}"
    header = "".join(f"# {x}\n" if x else "#\n" for x in mit.split("\n")) + "\nimport os\n\n" + prose(9)
    rows = [(1, around(mit, 1)), (2, around(bsd, 2)), (3, around(apache, 3)), (4, around(gpl, 4)), (5, header), (6, prose(6))]
    rows += [(10 + i, around(t, 10 + i)) for i, (_, t) in enumerate(ls.full_texts())]
    got = {r.doc_id: r for r in ls.license_report(docs_of(rows)).collect()}
    assert [got[i].license for i in range(1, 7)] == ["MIT", "BSD-3-Clause", "Apache-2.0", "GPL-3.0", "MIT", None]
    assert all(got[i].dice == 1 and got[i].unit == "paragraphs" for i in range(1, 6))
    assert [got[10 + i].license for i in range(len(ls.full_texts()))] == [n for n, _ in ls.full_texts()]


def test_best_run_of_paragraphs_matches_all_runs():
    rng = random.Random(5)
    words = [f"w{i}" for i in range(8)]
    some = lambda a, b: " ".join(rng.choice(words) for _ in range(rng.randrange(a, b)))
    templates = [(f"t{i}", some(3, 25)) for i in range(15)]
    part = lambda w, i, n: " ".join(w[i:i + n])
    texts = []
    for _ in range(300):
        w = rng.choice(templates)[1].split()
        ps = [part(w, i, 3) for i in range(0, len(w), 3)] + [some(1, 4)]
        texts.append("\n\n".join([some(1, 9), some(1, 9), *ps, *rng.sample(ps, 2)][rng.randrange(4):]))
    data, off = text_buffers(pa.array(texts))
    got = {(r, n): round(d, 9) for r, n, d, k in ls.matches(data, off, ls.template_bigrams(templates), 0.6) if k == "paragraphs"}
    grams = lambda t: {tuple(t.split()[i:i + 2]) for i in range(len(t.split()) - 1)}
    want, single = {}, {}
    for r, t in enumerate(texts):
        ps = t.split("\n\n")
        for n, x in templates:
            b = grams(x)
            for i in range(len(ps)):
                for j in range(i + 1, len(ps) + 1):
                    a = grams(" ".join(ps[i:j]))
                    d = round(2 * len(a & b) / (len(a) + len(b)), 9)
                    if d >= 0.6:
                        best = single if j == i + 1 else want
                        best[r, n] = max(best.get((r, n), 0), d)
    more = {k: d for k, d in want.items() if d > single.get(k, 0)}      # where a run is the better unit
    assert len(more) > 50 and {k: got.get(k) for k in more} == more
    assert all(d <= want[k] for k, d in got.items())


def test_size_bounds_prune_nothing_that_reaches_the_threshold():
    rng = random.Random(2)
    words = [f"w{i}" for i in range(9)]
    templates = [(f"t{i}", " ".join(rng.choice(words) for _ in range(rng.randrange(3, 30)))) for i in range(20)]
    texts = [" ".join(rng.choice(words) for _ in range(rng.randrange(1, 40))) for _ in range(200)] + [t for _, t in templates]
    known = ls.template_bigrams(templates)
    data, off = text_buffers(pa.array(texts))
    got = {(r, n, round(d, 9)) for r, n, d, k in ls.matches(data, off, known, 0.5) if k == "text"}
    grams = lambda t: {tuple(t.split()[i:i + 2]) for i in range(len(t.split()) - 1)}
    want = set()
    for r, t in enumerate(texts):
        for n, x in templates:
            a, b = grams(t), grams(x)
            d = 2 * len(a & b) / (len(a) + len(b)) if a else 0
            if d >= 0.5:
                want.add((r, n, round(d, 9)))
    assert got == want


# ---------------------------------------------------------------- 8: urls

def test_url_verdicts(spark):
    rules = [("block", "example.org", "/es/"), ("allow", "org", "/"), ("block", "b.org", "/a"), ("allow", "x.b.org", "/a")]
    cases = [("http://example.org/es/1", "example.org/es/", "block"), ("https://WWW.Example.ORG/es/?q", "example.org/es/", "block"),
             ("http://myexample.org/es/", "org/", "allow"), ("http://example.org", None, "allow"), ("http://x.b.org/abc", "x.b.org/a", "allow"),
             ("http://y.b.org/abc#/", "b.org/a", "block"), ("no scheme.org/es/", None, "allow"), (None, None, "allow"), ("", None, "allow"),
             ("http://é.org/ü", "org/", "allow"), ("ftp://example.org?x/es/", None, "allow"), ("http://org/", "org/", "allow")]
    df = spark.createDataFrame([(i, u, "v") for i, (u, _, _) in enumerate(cases)] + [(None, "http://a.com/", "v")], "page_id long, url string, verdict string")
    got = {r.page_id: (r.rule, r.verdict) for r in uf.url_verdicts(df, rules).collect()}
    assert got == {i: (r, v) for i, (_, r, v) in enumerate(cases)} | {None: (None, "allow")}
    assert uf.url_verdicts(df.limit(0), rules).count() == 0 and uf.url_verdicts(df, []).where("rule is not null").count() == 0


def test_digest_collisions_are_told_apart_by_the_full_strings():
    same = lambda b: 7
    rules = [("block", f"h{i}.org", "/") for i in range(5)]
    array = uf.DigestArray(uf.digest_block(rules, digest=same), digest=same)
    hit = array.probe([b"h3.org/", b"h9.org/", b"h0.org/"])
    assert [array.string(i) if i >= 0 else None for i in hit] == [b"h3.org/", None, b"h0.org/"]


def test_rules_are_checked(monkeypatch):
    with pytest.raises(ValueError):
        uf.digest_block([("maybe", "a.org", "/")])
    monkeypatch.setattr(uf, "MAX_BLOCK_BYTES", 10)
    with pytest.raises(ValueError):
        uf.digest_block([("block", "a.org", "/")])
