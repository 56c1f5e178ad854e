"""SentencePiece encoding by forward filtering and backward sampling; lossless decoding.

A text, with a space put before it, is cut into units that begin at a space, at a
line feed, after one, or where a unit has ``UNIT_BYTES`` bytes; no piece crosses
these cuts.  The lattice of a unit has an edge for every piece of the vocabulary,
and byte edges for characters that no piece spells.  Forward filtering sums the
weights of all paths to each position, once for each distinct unit; backward
sampling draws, for every occurrence, the last edge into each position from its end,
with random numbers that depend only on the seed, the row's key and the position.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pizarra.llm.common import col, fresh, ship_code, slices, through
from pizarra.llm.hashing import keyed, mix, span_hashes

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
UNIT_BYTES = 48
WORK_BYTES = 2 << 20
SPACE, LINE = 0x20, 0x0A


class Pieces:
    """A vocabulary as a byte trie with piece ids and weights.

    ``alpha`` sharpens (above 1) or flattens the weights.  With ``zipf`` a piece
    weighs as its rank by score says, 1 / (rank + 1), which suits merge-ordered (BPE)
    vocabularies, whose scores aren't log probabilities; else it weighs exp(score).
    """

    def __init__(self, proto: bytes, alpha: float = 1.0, zipf: bool = True):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_proto=proto)
        n = sp.vocab_size()
        score = np.array([sp.get_score(i) for i in range(n)])
        self.byte_id = np.full(256, -1, np.int32)
        self.bytes: list[bytes] = [b""] * n
        words = []
        for i in range(n):
            if sp.is_byte(i):
                self.byte_id[int(sp.id_to_piece(i)[3:5], 16)] = i
                self.bytes[i] = bytes([int(sp.id_to_piece(i)[3:5], 16)])
            elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
                self.bytes[i] = sp.id_to_piece(i).replace("▁", " ").encode()
                words.append(i)
        if (self.byte_id < 0).any():
            raise ValueError("the vocabulary must have all 256 byte pieces")
        words_at = np.array(words, np.int64)
        if zipf:
            rank = np.empty(n)
            rank[words_at[np.argsort(-score[words_at], kind="stable")]] = np.arange(len(words))
            weight = (rank[words_at] + 1.0) ** -alpha
        else:
            weight = np.exp(alpha * score[words_at])
        self.weight = np.zeros(n)
        self.weight[words_at] = weight / weight.sum()
        self.weight[words_at] = np.maximum(self.weight[words_at], 1e-6)
        self.weight[self.byte_id] = 1e-6
        nodes: dict[int, int] = {}
        piece = [-1]
        for i in words:
            at = 0
            for b in self.bytes[i]:
                key = at << 8 | b
                at = nodes.get(key, 0)
                if not at:
                    at = nodes[key] = len(piece)
                    piece.append(-1)
            piece[at] = i
        self.keys = np.array(sorted(nodes), np.int64)
        self.next = np.array([nodes[k] for k in self.keys.tolist()], np.int64)
        self.piece = np.array(piece, np.int32)
        # the first two bytes by table, the others by binary search
        self.first = np.zeros(256, np.int64)
        top = self.keys < 256
        self.first[self.keys[top]] = self.next[top]
        self.second = np.zeros(1 << 16, np.int64)
        for b in range(256):
            if self.first[b]:
                a, z = np.searchsorted(self.keys, [self.first[b] << 8, self.first[b] + 1 << 8])
                self.second[b << 8 | (self.keys[a:z] & 255)] = self.next[a:z]
        self.size = np.array([len(b) for b in self.bytes], np.int64)
        self.start = np.concatenate([[0], np.cumsum(self.size)])[:-1]
        self.flat = np.frombuffer(b"".join(self.bytes), np.uint8)

    def step(self, node: np.ndarray, byte: np.ndarray) -> np.ndarray:
        key = node << 8 | byte
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.next[at], 0)


def _unit_starts(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    cut = (data == SPACE) | (data == LINE)
    cut[1:] |= data[:-1] == LINE
    cut[off[:-1][off[:-1] < len(data)]] = True
    starts = np.flatnonzero(cut)
    ends = np.append(starts[1:], len(data))
    long = np.flatnonzero(ends - starts > UNIT_BYTES)
    if not len(long):
        return starts
    more = []
    for a, b in zip(starts[long].tolist(), ends[long].tolist()):
        a += UNIT_BYTES
        while a < b:
            while data[a] & 0xC0 == 0x80:      # not inside a character
                a -= 1
            more.append(a)
            a += UNIT_BYTES
    return np.sort(np.concatenate([starts, np.array(more, np.int64)]))


class _Lattice:
    """Edges of distinct units, by their end, with cumulative choice probabilities."""

    def __init__(self, v: Pieces, data: np.ndarray, starts: np.ndarray, ends: np.ndarray):
        size = ends - starts
        base = np.concatenate([[0], np.cumsum(size + 1)])
        self.base, self.size = base[:-1], size
        pos = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
        unit = np.repeat(np.arange(len(size)), size)
        at = starts[unit] + pos                       # byte of each position
        left = size[unit] - pos
        here = self.base[unit] + pos
        a, b, ids = [], [], []
        whole = np.zeros(len(at), bool)               # characters that a piece spells
        lead = data[at]
        width = np.where(lead < 0x80, 1, np.where(lead >= 0xF0, 4, np.where(lead >= 0xE0, 3, 2)))
        live, node = np.arange(len(at)), v.first[lead]
        for n in range(1, UNIT_BYTES + 1):
            on = node > 0
            live, node = live[on], node[on]
            if not len(live):
                break
            found = v.piece[node]
            hit = found >= 0
            k = live[hit]
            a.append(here[k])
            b.append(here[k] + n)
            ids.append(found[hit])
            if n <= 4:
                whole[k[width[k] == n]] = True
            more = left[live] > n
            live = live[more]
            byte = data[at[live] + n].astype(np.int64)
            node = v.second[lead[live].astype(np.int64) << 8 | byte] if n == 1 else v.step(node[more], byte)
        # byte edges: every byte of a character that no piece spells
        head = (lead & 0xC0) != 0x80
        head |= pos == 0
        char = np.cumsum(head) - 1
        k = np.flatnonzero(~whole[head][char])
        a.append(here[k])
        b.append(here[k] + 1)
        ids.append(v.byte_id[lead[k]])
        a, b, ids = np.concatenate(a), np.concatenate(b), np.concatenate(ids)
        order = np.argsort(b, kind="stable")          # merges sorted runs
        self.a, b, self.ids = a[order], b[order], ids[order]
        w = v.weight[self.ids]
        new = np.append(True, b[1:] != b[:-1]) if len(b) else np.empty(0, bool)
        self.first = np.flatnonzero(new)              # first edge into each position that has any
        sizes = np.diff(np.append(self.first, len(b)))
        end = b[self.first]
        self.group_of = np.zeros(int(base[-1]), np.int64)
        self.group_of[end] = np.arange(len(end))
        # forward filtering, one distance from the start after the other over all units at once
        distance = np.zeros(int(base[-1]), np.int64)
        distance[here + 1] = pos + 1
        by = np.argsort(distance[end].astype(np.uint8), kind="stable")
        cut = np.searchsorted(distance[end][by], np.arange(1, int(size.max(initial=0)) + 2))
        alpha = np.zeros(int(base[-1]))
        alpha[self.base] = 1.0
        path = np.empty(len(w))
        for p in range(len(cut) - 1):
            g = by[cut[p]:cut[p + 1]]
            if not len(g):
                continue
            n = sizes[g]
            at_edge = np.cumsum(n) - n
            e = np.arange(int(n.sum())) - np.repeat(at_edge - self.first[g], n)
            path[e] = alpha[self.a[e]] * w[e]
            alpha[end[g]] = np.add.reduceat(path[e], at_edge)
        # running probability of the edges into a position
        share = path / np.repeat(np.maximum(alpha[end], 1e-300), sizes)
        run = np.cumsum(share)
        self.run = run - np.repeat(run[self.first] - share[self.first], sizes)
        self.run[self.first + sizes - 1] = 2.0


def encode_rows(v: Pieces, keys: np.ndarray, data: np.ndarray, off: np.ndarray, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Sampled piece ids of all rows, one after the other, and each row's offsets in them."""
    full = np.diff(off) > 0
    data = np.insert(data, off[:-1][full], SPACE)
    off = off + np.concatenate([[0], np.cumsum(full)])
    out = np.full(len(data), -1, np.int32)
    if len(data):
        starts = _unit_starts(data, off)
        ends = np.append(starts[1:], len(data))
        hashes = span_hashes(data, starts, ends, lower=False)
        _, one, which = np.unique(hashes, return_index=True, return_inverse=True)
        lat = _Lattice(v, data, starts[one], ends[one])
        by_unit = np.argsort(which, kind="stable")      # neighbours in memory are drawn together
        which, starts = which[by_unit], starts[by_unit]
        row = np.searchsorted(off, starts, side="right") - 1
        row_seed = keyed(keys, seed)[row]
        place, base = starts - off[row], lat.base[which]
        pos = lat.size[which]
        while len(starts):
            r = mix(row_seed ^ mix((place + pos).astype(np.uint64) ^ np.uint64(0x5851F42D4C957F2D)))
            draw = (r >> np.uint64(11)).astype(np.float64) * 2.0 ** -53
            e = lat.first[lat.group_of[base + pos]]
            behind = np.flatnonzero(lat.run[e] <= draw)
            while len(behind):
                e[behind] += 1
                behind = behind[lat.run[e[behind]] <= draw[behind]]
            pos = lat.a[e] - base
            out[starts + pos] = lat.ids[e]
            on = pos > 0
            starts, place, base, row_seed, pos = starts[on], place[on], base[on], row_seed[on], pos[on]
    taken = np.concatenate([[0], np.cumsum(out >= 0)])
    return out[out >= 0], taken[off]


def decode_rows(v: Pieces, ids: np.ndarray, cut: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all rows and their offsets; the space put before is taken off."""
    size = v.size[ids]
    total = np.concatenate([[0], np.cumsum(size)])
    at = np.arange(int(total[-1])) - np.repeat(total[:-1], size) + np.repeat(v.start[ids], size)
    flat, off = v.flat[at], total[cut]
    keep = np.ones(len(flat), bool)
    keep[off[:-1][np.diff(off) > 0]] = False
    return flat[keep], off - np.concatenate([[0], np.cumsum(np.diff(off) > 0)])


_LOADED: dict = {}


def _pieces(proto: bytes, alpha: float, zipf: bool) -> Pieces:
    key = (hashlib.sha256(proto).digest(), alpha, zipf)
    if key not in _LOADED:
        _LOADED[key] = Pieces(proto, alpha, zipf)
    return _LOADED[key]


def with_pieces(docs: DataFrame, model: str = MODEL, id_col: str = "doc_id", text_col: str = "text", seed: int = 0,
                alpha: float = 1.0, zipf: bool = True, proof: bool = False) -> tuple[DataFrame, str]:
    """``docs`` and a new column with the sampled piece ids; that column's name.

    The same seed, row key and text give the same ids in any partitioning.  Rows
    that repeat a key draw the same numbers.  A null key counts as a key of its own;
    null and empty texts have no ids.  ``model`` is a path on the driver; its bytes are
    sent to the tasks.  With ``proof``, ``decoded_sha256`` and ``lossless`` follow, from
    decoding the ids again.
    """
    spark = docs.sparkSession
    ship_code(spark)
    with open(model, "rb") as f:
        sent = spark.sparkContext.broadcast(f.read())
    name = fresh("ids", docs.columns)

    def encoded(batch, first):
        v = _pieces(sent.value, alpha, zipf)
        for rows, data, off in slices(batch, first + 1, WORK_BYTES):
            keys = rows.column(first).fill_null(-(1 << 63)).to_numpy(zero_copy_only=False)
            ids, cut = encode_rows(v, keys, data, off, seed)
            out = [pa.ListArray.from_arrays(pa.array(cut.astype(np.int32)), pa.array(ids))]
            if proof:
                out += [pa.array(x) for x in _proof(v, ids, cut, data, off)]
            yield rows, out

    extra = [(name, "array<int>")] + [("decoded_sha256", "string"), ("lossless", "boolean")] * proof
    return through(docs, [col(id_col).cast("long"), col(text_col).cast("string")], encoded, extra), name


def _proof(v: Pieces, ids: np.ndarray, cut: np.ndarray, data: np.ndarray, off: np.ndarray):
    back, back_off = decode_rows(v, ids, cut)
    raw, true = back.tobytes(), data.tobytes()
    sha, same = [], []
    for a, b, c, d in zip(back_off[:-1].tolist(), back_off[1:].tolist(), off[:-1].tolist(), off[1:].tolist()):
        sha.append(hashlib.sha256(raw[a:b]).hexdigest())
        same.append(raw[a:b] == true[c:d])
    return sha, same


def piece_report(docs: DataFrame, model: str = MODEL, id_col: str = "doc_id", text_col: str = "text", seed: int = 0) -> DataFrame:
    """One row per document: its sampled ids, their number, the SHA-256 of the text
    decoded from them, and whether that is the text itself."""
    slim = docs.select(col(id_col).cast("long").alias("doc_id"), col(text_col).alias("text"))
    out, ids = with_pieces(slim, model, "doc_id", "text", seed, proof=True)
    return out.select("doc_id", F.size(ids).cast("long").alias("n_pieces"), ids, "decoded_sha256", "lossless")


def decode(encoded: DataFrame, ids_col: str, model: str = MODEL) -> DataFrame:
    """``encoded`` with a column of the decoded texts (null ids: null)."""
    spark = encoded.sparkSession
    ship_code(spark)
    with open(model, "rb") as f:
        sent = spark.sparkContext.broadcast(f.read())

    def decoded(batch, first):
        v = _pieces(sent.value, 1.0, True)
        lists = batch.column(first)
        n = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        ids = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        data, off = decode_rows(v, ids, np.concatenate([[0], np.cumsum(n)]))
        raw, valid = data.tobytes(), lists.is_valid().to_pylist()
        texts = [raw[a:b].decode("utf-8", "replace") if ok else None for a, b, ok in zip(off[:-1].tolist(), off[1:].tolist(), valid)]
        yield batch, [pa.array(texts, pa.string())]

    return through(encoded, [col(ids_col)], decoded, [(fresh("decoded", encoded.columns), "string")])
