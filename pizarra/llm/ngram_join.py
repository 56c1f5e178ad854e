"""N-gram Jaccard join with PartEnum signatures.

Sets of shingles with a Jaccard similarity of 0.8 or more differ in at most a
ninth of their summed sizes.  Sizes are cut into bands; a pair's tag is the
larger set's band, so a set signs for its own band and the next.  For a tag whose
sets differ in at most ``k`` elements, the feature domain is cut into ``n1`` parts of
two halves each: some part has at most one difference, so one half of it (a subset
of the second-level partitions) is equal in both sets, and its elements are the
signature they share.

Signatures of empty halves say nothing and aren't sent.  A set can afford as many
parts with an empty half as ``n1`` exceeds what the differences can spoil; a set with
more signs again with the domain cut anew, and so on.  Both sets of a pair
sign at every level up to the lesser of theirs, where one of them has enough full
halves, so the pair still shares a signature.  Sets that fail at all levels send
the empty halves of the last as well.  No pair is lost.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pizarra.llm.common import arrow_rows, col, fresh, id_text, ship_code, shuffle_partitions, slices, written
from pizarra.llm.components import components
from pizarra.llm.hashing import gram_hashes, keyed, mix, span_hashes, stream, word_spans
from pizarra.llm.packed import SCHEMA, by_bucket, bucket_of, pack, unpack

WORDS = 5
LEVELS = 8
FLUSH = 1 << 20          # signatures, or pairs to compare, that a task holds before it sends them
PER_BUCKET = 1 << 20     # signatures a bucket is meant to hold
GROUP_CHUNK = 4096       # members of a shared signature in one row
BLOCK_ROWS, SET_ROWS = 32, 1000   # pairs of blocks, and sets, that a task takes in at a time
BLOCK = 512              # members compared with as many others at a time
NEAR, MORE = 2, 16       # likeliest partners that a set is compared with at first; so many times as many each turn
SALTS = 16               # tasks that a group's members are dealt to
FILTER_BITS = 1 << 27    # of the broadcast filter: 16 MB; a fuller one only lets more through

_U = np.uint64
_SIGN = np.dtype([("low", np.uint32), ("mid", np.uint8), ("node", _U)])   # a key's lower 40 bits: of the others a bucket's keys have most in common


def _bands(top: int) -> np.ndarray:
    """First sizes of the bands: from ``l`` to ``l / 0.8``."""
    out = [1]
    while out[-1] <= top:
        out.append(out[-1] * 5 // 4 + 1)
    return np.array(out, np.int64)


BANDS = _bands(1 << 40)


def shingle_sets(data: np.ndarray, off: np.ndarray, words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of each row, sorted, one row after the other, and offsets."""
    s, e, first = word_spans(data, off)
    w = span_hashes(data, s, e, lower=True)
    grams = gram_hashes(w, words)
    parts, sizes = [], np.zeros(len(off) - 1, np.int64)
    lo, hi = first[:-1].tolist(), first[1:].tolist()
    for r, (a, b) in enumerate(zip(lo, hi)):
        if b - a >= words:
            x = np.unique(grams[a:b - words + 1])
        elif b > a:
            x = mix(gram_hashes(w[a:b], b - a) + _U(b - a))
        else:
            continue
        parts.append(x)
        sizes[r] = len(x)
    return (np.concatenate(parts) if parts else np.empty(0, _U)), np.concatenate([[0], np.cumsum(sizes)])


def set_nodes(elements: np.ndarray, cut: np.ndarray) -> np.ndarray:
    """64-bit digest of each set (0 for the empty set): what tells sets apart."""
    size = np.diff(cut)
    full = np.flatnonzero(size)
    out = np.zeros(len(size), _U)
    if len(full):
        with np.errstate(over="ignore"):
            sums = np.add.reduceat(mix(elements + stream(31, 1)[0]), cut[full])
            out[full] = mix(sums ^ mix(size[full].astype(_U))) | _U(1)
    return out


def _sums(cells: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    """Sums of 64-bit values by cell, modulo 2**64, from two exact float sums."""
    low = np.bincount(cells, (values & _U(0xFFFFFFFF)).astype(np.float64), n).astype(_U)
    high = np.bincount(cells, (values >> _U(32)).astype(np.float64), n).astype(_U)
    with np.errstate(over="ignore"):
        return low + (high << _U(32))


def signatures(elements: np.ndarray, cut: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Signature keys of all sets, and the set each belongs to."""
    size = np.diff(cut)
    keys, owners = [], []
    own = np.searchsorted(BANDS, size, side="right") - 1
    for ahead in (0, 1):
        tag = own + ahead
        top = BANDS[tag + 1] - 1                                # largest size of the tag
        partner = np.minimum(top, size * 5 // 4)                # largest set this one can pair with
        k = 2 * top // 9
        use = (size > 0) & (k > 0) & (partner >= BANDS[tag])
        spoilt = (size + partner) // 9 // 2
        n1 = k // 2 + 2 + k // 12
        live = np.flatnonzero(use)
        for level in range(LEVELS):
            if not len(live):
                break
            n = size[live]
            base = np.concatenate([[0], np.cumsum(2 * n1[live])])
            at = np.repeat(cut[:-1][live] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
            x = elements[at]
            with np.errstate(over="ignore"):
                x = mix(x + stream(41, LEVELS)[level])
            set_of = np.repeat(np.arange(len(live)), n)
            part = ((x >> _U(32)) * n1[live].astype(_U)[set_of] >> _U(32)).astype(np.int64)
            half = (x & _U(1)).astype(np.int64)
            cell = base[set_of] + 2 * part + half
            total = int(base[-1])
            full = np.bincount(cell, minlength=total) > 0
            content = _sums(cell, mix(x), total)
            owner = np.repeat(np.arange(len(live)), 2 * n1[live])
            number = np.arange(total) - base[owner]
            thin = np.bincount(owner[::2], ~(full[::2] & full[1::2]), len(live)).astype(np.int64)
            weak = thin > n1[live] - 1 - spoilt[live]
            send = full | weak[owner] if level == LEVELS - 1 else full
            o = owner[send]
            with np.errstate(over="ignore"):
                where = (tag[live][o].astype(_U) << _U(48)) + (_U(level) << _U(40)) + number[send].astype(_U)
                keys.append(mix(content[send] ^ mix(where + stream(43, 1)[0])))
            owners.append(live[o])
            live = live[weak]
    if not keys:
        return np.empty(0, _U), np.empty(0, np.int64)
    return np.concatenate(keys), np.concatenate(owners)


def sketch_bytes(n: int) -> int:
    """A cell or more an element: a power of two, 256 at least."""
    return 1 << max(8, (n - 1).bit_length()) - 3


def parity_sketch(elements: np.ndarray) -> bytes:
    """Parities of the numbers of elements in cells.  The parities in which two sets
    differ are no more than the elements in which they do."""
    cells = 8 * sketch_bytes(len(elements))
    odd = np.bincount((elements >> _U(20)).astype(np.int64) & (cells - 1), minlength=cells) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def _fold(sketch: np.ndarray, size: int) -> np.ndarray:
    """A sketch of fewer cells, ``size`` bytes: cells whose low bits agree are one."""
    return np.bitwise_xor.reduce(sketch.reshape(-1, size), axis=0)


_TABLE = "kind int, doc_id long, n_shingles long, node long, grp long, members array<long>, sketch binary"
_ROW = pa.schema([("kind", pa.int32()), ("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("node", pa.int64()),
                  ("grp", pa.int64()), ("members", pa.list_(pa.int64())), ("sketch", pa.binary())])
_DOC = np.dtype([("id", np.int64), ("null", np.uint8), ("n", np.int64), ("node", _U)])


def _pack_docs(d: np.ndarray, sketches: list[bytes], n_buckets: int) -> pa.RecordBatch:
    """Documents by bucket: their number, their entries, and their sets' sketches."""
    bucket = bucket_of(keyed(d["id"], 1), n_buckets)
    order = np.argsort(bucket, kind="stable")
    parts = [x for x in np.split(order, np.flatnonzero(np.diff(bucket[order])) + 1) if len(x)]
    data = [b"".join([np.int64(len(x)).tobytes(), d[x].tobytes(), *(sketches[i] for i in x.tolist())]) for x in parts]
    return pa.RecordBatch.from_pydict({"bucket": [-1 - int(bucket[x[0]]) for x in parts], "data": data}, schema=pa.schema([("bucket", pa.int64()), ("data", pa.binary())]))


def _unpack_docs(blob: bytes) -> tuple[np.ndarray, list[bytes]]:
    n = int(np.frombuffer(blob, np.int64, 1)[0])
    d, at, sketches = np.frombuffer(blob, _DOC, n, 8), 8 + n * _DOC.itemsize, []
    for k in d["n"].tolist():
        size = sketch_bytes(k) if k else 0
        sketches.append(blob[at:at + size])
        at += size
    return d, sketches


def _signed(slim: DataFrame, n_buckets: int) -> DataFrame:
    """Documents (kind 0: id, set size, set, sketch) and groups (kind 1: sets that share
    a signature, in ``node`` the first of them), from one pass over the texts."""

    def send(held: list, docs: list, sketches: list):
        if docs:
            yield pack(*(np.concatenate(z) for z in zip(*held)))
            yield _pack_docs(np.concatenate(docs), sketches, n_buckets)

    def sign(batches):
        held, docs, sketches, count = [], [], [], 0
        for batch in batches:
            for rows, data, off in slices(batch, 1):
                elements, cut = shingle_sets(data, off)
                node = set_nodes(elements, cut)
                d = np.zeros(len(node), _DOC)
                ids = rows.column(0)
                d["id"], d["null"] = ids.fill_null(0).to_numpy(zero_copy_only=False), ids.is_null().to_numpy(zero_copy_only=False)
                d["n"], d["node"] = np.diff(cut), node
                docs.append(d)
                ends = cut.tolist()
                sketches += [parity_sketch(elements[a:b]) if b > a else b"" for a, b in zip(ends, ends[1:])]
                # each set of the slice signs once
                valid = np.flatnonzero((d["null"] == 0) & (node != 0))
                use = np.zeros(len(node), bool)
                use[valid[np.unique(node[valid], return_index=True)[1]]] = True
                at = np.repeat(use, np.diff(cut))
                kept = np.flatnonzero(use)
                keys, owner = signatures(elements[at], np.concatenate([[0], np.cumsum(np.diff(cut)[kept])]))
                x = np.empty(len(keys), _SIGN)
                x["low"], x["mid"], x["node"] = keys & _U(0xFFFFFFFF), keys >> _U(32) & _U(0xFF), node[kept][owner]
                held.append((x, bucket_of(keys, n_buckets)))
                count += len(x)
                if count >= FLUSH:
                    yield from send(held, docs, sketches)
                    held, docs, sketches, count = [], [], [], 0
        yield from send(held, docs, sketches)

    def gather(bucket: int, blobs: list[bytes]):
        if bucket < 0:
            for d, sketches in map(_unpack_docs, blobs):
                n = len(d)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.zeros(n, np.int32)), pa.array(d["id"], mask=d["null"] == 1), pa.array(d["n"]), pa.array(d["node"].view(np.int64)),
                     pa.nulls(n, pa.int64()), pa.nulls(n, pa.list_(pa.int64())), pa.array(sketches, pa.binary())], schema=_ROW)
            return
        x = np.concatenate([unpack(b, _SIGN) for b in blobs])
        key = x["mid"].astype(_U) << _U(32) | x["low"]
        order = np.argsort(key)
        key = key[order]
        twin = np.append(key[1:] == key[:-1], False)
        twin[1:] |= twin[:-1].copy()
        key, nodes = key[twin], x["node"][order[twin]]
        order = np.lexsort((nodes, key))
        key, nodes = key[order], nodes[order]
        new = np.append(True, (key[1:] != key[:-1]) | (nodes[1:] != nodes[:-1]))[:len(key)]
        key, nodes = key[new], nodes[new]
        if not len(key):
            return
        first = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        size = np.diff(np.append(first, len(key)))
        many = size > 1
        nodes, size = nodes[np.repeat(many, size)], size[many]
        if not len(nodes):
            return
        # equal groups of several keys go on once; long groups in chunks that name the group and its first member
        start = np.cumsum(size) - size
        with np.errstate(over="ignore"):
            name = mix(np.add.reduceat(mix(nodes), start) ^ size.astype(_U))   # equal groups have equal names
        _, one = np.unique(name, return_index=True)
        lists, names, leads = [], [], []
        signed = nodes.view(np.int64)
        for g in one.tolist():
            a, b = int(start[g]), int(start[g] + size[g])
            for c in range(a, b, GROUP_CHUNK):
                lists.append(signed[c:min(c + GROUP_CHUNK, b)])
                names.append(name[g])
                leads.append(signed[a])
        cut = np.concatenate([[0], np.cumsum([len(x) for x in lists])])
        n = len(lists)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.ones(n, np.int32)), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()), pa.array(np.array(leads, np.int64)),
             pa.array(np.array(names, _U).view(np.int64)),
             pa.ListArray.from_arrays(pa.array(cut.astype(np.int32)), pa.array(np.concatenate(lists))), pa.nulls(n, pa.binary())], schema=_ROW)

    return by_bucket(slim.mapInArrow(sign, SCHEMA), gather, _TABLE)


def _filter_of(ids: DataFrame) -> np.ndarray:
    """A bit for each document id, packed: bounded by ``FILTER_BITS``."""
    blocks = ids.select(F.expr(f"doc_id & {FILTER_BITS - 1}").alias("at")).groupBy(F.expr("at div 32768").alias("block")).agg(
        F.bitmap_construct_agg(F.expr("at % 32768")).alias("bits"))
    out = np.zeros(FILTER_BITS // 8, np.uint8)
    for r in blocks.toLocalIterator():
        out[r["block"] * 4096:(r["block"] + 1) * 4096] = np.frombuffer(r["bits"], np.uint8)
    return out


def _texts_of(slim: DataFrame, ids: DataFrame) -> DataFrame:
    """``node, doc_id, text`` of the documents in ``ids`` and a few others: the filter
    spares all other texts the work and the shuffle.  A text travels as it is: it compresses, the hashes
    of its set, eight bytes a word, don't."""
    bits = slim.sparkSession.sparkContext.broadcast(_filter_of(ids))

    def compute(batches):
        for batch in batches:
            at = batch.column(0).to_numpy(zero_copy_only=False) & (FILTER_BITS - 1)
            batch = batch.filter(pa.array((bits.value[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)))
            for rows, data, off in slices(batch, 1):
                yield pa.RecordBatch.from_arrays([pa.array(set_nodes(*shingle_sets(data, off)).view(np.int64)), *rows.columns],
                                                 names=["node", "doc_id", "text"])

    return slim.where("id is not null").mapInArrow(compute, "node long, doc_id long, text string")


def similar(a: int, b: int, shared: int) -> bool:
    return 100 * shared >= 80 * (a + b - shared)


def _verified(pairs: DataFrame, info: DataFrame, slim: DataFrame) -> DataFrame:
    """Those of ``pairs (u, v)`` whose sets are similar.  The sets of all ``v`` meet their
    ``u`` in sorted runs, so a task holds a slice of texts and one set; a ``u`` of very many is dealt by a salt."""
    n = shuffle_partitions(pairs.sparkSession)
    salted = pairs.withColumn("salt", F.pmod(F.xxhash64("v"), F.lit(n)).cast("int"))
    roles = salted.select(F.col("v").alias("node"), F.col("u").alias("run"), "salt", F.lit(1).alias("role")).unionByName(
        salted.select(F.col("u").alias("node"), F.col("u").alias("run"), "salt", F.lit(0).alias("role")).distinct())
    roles = written(roles.join(info.select("node", "doc_id"), "node"), "roles")
    texts = _texts_of(slim, roles.select("doc_id").distinct())
    met = texts.join(roles.hint("shuffle_hash"), ["node", "doc_id"]).repartition(n, "run", "salt").sortWithinPartitions("run", "salt", "role")

    def compare(batches):
        run, held = None, None
        for batch in batches:
            u, v = [], []
            for rows, data, off in slices(batch, 4):
                elements, cut = shingle_sets(data, off)
                ends = cut.tolist()
                for key, salt, role, node, a, b in zip(*(rows.column(k).to_pylist() for k in range(4)), ends, ends[1:]):
                    x = elements[a:b]
                    if not role:
                        run, held = (key, salt), x
                    elif (key, salt) == run:
                        at = np.minimum(np.searchsorted(held, x), len(held) - 1)
                        if similar(len(held), len(x), int((held[at] == x).sum())):
                            u.append(key)
                            v.append(node)
            yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["u", "v"])

    return met.select("run", "salt", "role", "node", "text").mapInArrow(compare, "u long, v long")


def _plausible(pairs: DataFrame, info: DataFrame) -> DataFrame:
    """Those of ``pairs (u, v)`` that sizes and sketches allow."""
    side = info.select("node", "n", "sketch")
    met = pairs.join(side.toDF("u", "n1", "s1"), "u").join(side.toDF("v", "n2", "s2"), "v")

    def allow(batches):
        for batch in batches:
            keep = []
            for n1, n2, s1, s2 in zip(*(batch.column(k).to_pylist() for k in range(2, 6))):
                a, b = np.frombuffer(s1, np.uint8), np.frombuffer(s2, np.uint8)
                size = min(len(a), len(b))
                apart = int(np.bitwise_count(_fold(a, size) ^ _fold(b, size)).sum())
                keep.append(9 * apart <= n1 + n2 and 5 * min(n1, n2) >= 4 * max(n1, n2))
            yield pa.RecordBatch.from_arrays(batch.columns[:2], names=["u", "v"]).filter(pa.array(keep, pa.bool_()))

    return met.select("u", "v", "n1", "n2", "s1", "s2").mapInArrow(allow, "u long, v long")


def _crossing(groups: DataFrame, roots: DataFrame, info: DataFrame, tried: DataFrame, turn: int) -> DataFrame:
    """Pairs of sets that share a group, aren't in one component yet, haven't been tried and whose
    sketches and sizes allow the similarity (``u, v``), and the groups that have more (``grp``).

    A group's sets are dealt to blocks of about ``BLOCK``.  Turn 0 compares each block with
    itself, turn 1 also with the next one, turn 2 with those up to 3 further, and so on; of each set the likeliest
    in the other block, ``NEAR`` when two blocks first meet and ``MORE`` times as many each turn.
    """
    member = groups.select("grp", F.explode("members").alias("node")).distinct()
    placed = member.join(roots, "node", "left").select("grp", "node", F.coalesce("root", "node").alias("root"))
    split = placed.groupBy("grp").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.count(F.lit(1)).alias("members")).where("lo < hi")
    split = written(split.select("grp", F.ceil(F.col("members") / BLOCK).cast("int").alias("nb")), "split")
    salt = F.pmod(F.xxhash64("node"), F.lit(SALTS)).cast("int")
    dealt = split.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    rows = placed.withColumn("salt", salt).join(dealt, ["grp", "salt"]).join(info.select("node", "n", "sketch"), "node")
    done = tried.select(F.col("u").alias("node"), "v").unionByName(tried.select(F.col("v").alias("node"), F.col("u").alias("v"))).groupBy(
        "node").agg(F.collect_list("v").alias("done"))
    rows = rows.join(done, "node", "left").withColumn("done", F.coalesce("done", F.array().cast("array<long>")))
    rows = rows.withColumn("block", F.pmod(F.xxhash64("node"), F.col("nb")).cast("int"))
    blocks = rows.groupBy("grp", "block").agg(F.collect_list(F.struct("node", "root", "n", "sketch", "done")).alias("x"),
                                              F.min("root").alias("lo"), F.max("root").alias("hi"), F.first("nb").alias("nb"))
    if turn:                              # three readers of one shuffle: through this no filter or choice of columns makes it three
        blocks = blocks.mapInArrow(lambda batches: batches, blocks.schema)
    both = blocks.where("lo < hi").select("grp", F.lit(0).alias("step"), "x", F.col("x").alias("y"))
    far = (1 << turn) - 1                 # the farthest block of this turn; half the circle meets all
    if far:
        step = F.explode(F.sequence(F.lit(1), F.least(F.lit(far), F.floor(F.col("nb") / 2).cast("int")))).alias("step")
        left = blocks.where("nb > 1").select("grp", "x", "lo", "hi", "block", "nb", step).select(
            "grp", "x", "lo", "hi", "step", F.pmod(F.col("block") + F.col("step"), F.col("nb")).alias("block"))
        other = blocks.where("nb > 1").select("grp", "block", F.col("x").alias("y"), F.col("lo").alias("lo2"), F.col("hi").alias("hi2"))
        both = both.unionByName(left.join(other, ["grp", "block"]).where("least(lo, lo2) < greatest(hi, hi2)").select("grp", "step", "x", "y"))
    met = F.when(F.col("step") == 0, 0).otherwise(F.ceil(F.log2(F.col("step") + 1))).cast("int")
    near = F.least(F.lit(NEAR) * F.pow(F.lit(MORE), F.lit(turn) - met), F.lit(1 << 30)).cast("int")

    def rows(u, v, more):
        u, v = (np.concatenate(z) if z else np.empty(0, np.int64) for z in (u, v))
        pairs = np.unique(np.stack([u, v], axis=1), axis=0)
        n, m = len(pairs), len(more)
        return pa.RecordBatch.from_arrays(
            [pa.concat_arrays([pa.array(pairs[:, 0]), pa.nulls(m, pa.int64())]), pa.concat_arrays([pa.array(pairs[:, 1]), pa.nulls(m, pa.int64())]),
             pa.concat_arrays([pa.nulls(n, pa.int64()), pa.array(more, pa.int64())])], names=["u", "v", "grp"])

    def compare(batches):
        for batch in batches:
            u, v, more, held = [], [], [], 0
            for grp, step, near, x, y in zip(*(batch.column(k) for k in range(5))):
                a, b, cut = _allowed(_members(x.values), _members(y.values), step.as_py() == 0, near.as_py())
                u.append(a)
                v.append(b)
                held += len(a)
                if cut:
                    more.append(grp.as_py())
                if held >= FLUSH:
                    yield rows(u, v, more)
                    u, v, more, held = [], [], [], 0
            yield rows(u, v, more)

    found = both.select("grp", "step", near.alias("near"), "x", "y").mapInArrow(compare, "u long, v long, grp long")
    none = F.lit(None).cast("long")
    return found.unionByName(split.where(F.floor(F.col("nb") / 2) > far).select(none.alias("u"), none.alias("v"), "grp"))


def _merged(roots: DataFrame, links: DataFrame) -> DataFrame:
    """``roots`` after more links: these become edges between roots, few beside the nodes."""
    known = roots.select(F.col("node").alias("at"), F.col("root").alias("to"))
    for side in ("u", "v"):
        links = links.join(known, F.col(side) == F.col("at"), "left").withColumn(side, F.coalesce("to", side)).drop("at", "to")
    stars = components(written(links.where("u <> v").distinct(), "edges"))
    lifted = stars.select(F.col("node").alias("root"), F.col("root").alias("to"))
    moved = roots.join(lifted, "root", "left").select("node", F.coalesce("to", "root").alias("root"))
    return written(moved.unionByName(stars), "roots")


def _members(x: pa.StructArray):
    node, root, n = (x.field(k).to_numpy(zero_copy_only=False) for k in range(3))
    owner = np.repeat(np.arange(len(node)), pc.list_value_length(x.field(4)).to_numpy(zero_copy_only=False))
    return node, root, n, [np.frombuffer(b, np.uint8) for b in x.field(3).to_pylist()], (owner, x.field(4).flatten().to_numpy())


def _folded(sketches: list[np.ndarray], width: int) -> np.ndarray:
    """The sketches at one width, as rows of 64-bit words."""
    out = np.empty((len(sketches), width), np.uint8)
    for i, s in enumerate(sketches):
        out[i] = s if len(s) == width else _fold(s, width)
    return out.view(_U)


def _allowed(x, y, same: bool, near: int) -> tuple[np.ndarray, np.ndarray, bool]:
    """The pairs to compare of two blocks, each set with its ``near`` likeliest, and
    whether a set has more."""
    (a, ra, na, sa, (owner, partner)), (b, rb, nb, sb, _) = x, y
    width = min(map(len, sa + sb))
    wa, wb = _folded(sa, width), _folded(sb, width)
    total = na[:, None] + nb[None, :]
    far = np.iinfo(np.int32).max
    apart = np.full((len(a), len(b)), far, np.int32)
    step = max(1, (1 << 20) // (len(b) * wa.shape[1]))
    for i in range(0, len(a), step):
        d = np.bitwise_count(wa[i:i + step, None, :] ^ wb[None, :, :]).sum(axis=2, dtype=np.int32)
        ok = (ra[i:i + step, None] != rb[None, :]) & (9 * d <= total[i:i + step])
        ok &= 9 * np.minimum(na[i:i + step, None], nb[None, :]) >= 4 * total[i:i + step]       # the smaller has 4/5 of the larger
        apart[i:i + step] = np.where(ok, d, far)
    order = np.argsort(b)
    at = np.minimum(np.searchsorted(b[order], partner), len(b) - 1)
    hit = b[order][at] == partner
    apart[owner[hit], order[at[hit]]] = far                # tried already
    us, vs, cut = [], [], False
    for m, p, q in ((apart, a, b), (apart.T, b, a))[:1 if same else 2]:      # both sides choose
        n = (m < far).sum(axis=1)
        if not n.any():
            break
        if n.max() > near:
            cut = True
            pick = np.argpartition(m, near - 1, axis=1)[:, :near]
            i, j = np.repeat(np.arange(len(m)), near), pick.ravel()
            hit = m[i, j] < far
            i, j = i[hit], j[hit]
        else:
            i, j = np.nonzero(m < far)
        us.append(np.minimum(p[i], q[j]))
        vs.append(np.maximum(p[i], q[j]))
    empty = np.empty(0, np.int64)
    return (np.concatenate(us), np.concatenate(vs), cut) if us else (empty, empty, cut)


def linked_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id, n_shingles, component_id``, the last the smallest
    id that links lead to.

    Sets that are equal are one set from the start.  First every set is compared with
    the set that leads most groups (sets with a common signature) it is in.  Then, in
    turns, each set is compared with its likeliest partners among those it shares a group
    with and isn't connected to by then; pairs that sizes or sketches rule out never are.
    A turn looks within blocks of a group and between blocks ever further apart, and what it links
    is one component in the next.  The turns end only when no group has a pair left to
    compare (at last every one is), so very many near copies of each other cost
    some comparisons each, not all pairs, and yet no link between components is missed.

    A null text is empty; an empty set links with nothing.  Rows with a null id have a
    null component and link nothing; rows that repeat an id are judged each by its text.
    Sets are told apart by a 64-bit digest.
    """
    spark = docs.sparkSession
    ship_code(spark)
    slim = id_text(docs, id_col, text_col)
    chars = slim.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_buckets = max(shuffle_partitions(spark), int(chars // 6 * 0.6 // PER_BUCKET) + 1)   # 0.6 signatures a word
    with arrow_rows(spark, SET_ROWS):
        signed = written(_signed(slim, n_buckets), "signatures")
    people = signed.where("kind = 0").select("doc_id", "n_shingles", "node")
    groups = signed.where("kind = 1").select("grp", F.col("node").alias("u"), "members")
    led = groups.select("u", F.explode("members").alias("v")).where("u <> v").groupBy("u", "v").agg(F.count(F.lit(1)).alias("w"))
    best = written(led.groupBy("v").agg(F.max_by("u", F.struct("w", "u")).alias("u")).select("u", "v"), "led")
    # of each set in a group: a document that has it, and what rules pairs out
    nodes = best.select(F.explode(F.array("u", "v")).alias("node")).unionByName(groups.select(F.col("u").alias("node"))).distinct()
    sized = signed.where("kind = 0 and doc_id is not null").select("node", "doc_id", F.col("n_shingles").alias("n"), "sketch")
    info = written(sized.join(nodes, "node").groupBy("node").agg(
        F.min("doc_id").alias("doc_id"), F.first("n").alias("n"), F.first("sketch").alias("sketch")), "info")
    first = written(_plausible(best, info), "pairs")
    with arrow_rows(spark, SET_ROWS):
        one = written(_verified(first, info, slim), "links")
    tried, turn = first.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")), 0
    roots = components(one)
    while True:
        with arrow_rows(spark, BLOCK_ROWS):
            found = written(_crossing(groups, roots, info, tried, turn), "crossing")
        rest = written(found.where("u is not null").select("u", "v").distinct(), "pairs")
        if not rest.isEmpty():
            with arrow_rows(spark, SET_ROWS):
                new = written(_verified(rest, info, slim), "links")
            if not new.isEmpty():
                roots = _merged(roots, new)
            tried = tried.unionByName(rest)
        more = found.where("grp is not null").select("grp").distinct()
        if more.isEmpty():
            break
        groups = written(groups.join(more, "grp", "left_semi"), "groups")
        turn += 1
    placed = people.join(roots, "node", "left").withColumn("root", F.when(F.col("node") != 0, F.coalesce("root", "node")))
    least = placed.where("root is not null and doc_id is not null").groupBy("root").agg(F.min("doc_id").alias("component_id"))
    return placed.join(least, "root", "left").select(
        "doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"))


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one document of each component, that with the smallest id; rows
    that repeat it stay.  Rows with a null id stay."""
    k = fresh("_key", docs.columns)
    found = linked_documents(docs, id_col, text_col).where("component_id < doc_id").select(F.col("doc_id").alias(k)).distinct()
    return docs.join(found.hint("shuffle_hash"), col(id_col).cast("long") == F.col(k), "left_anti")
