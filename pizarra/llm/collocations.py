"""Phrase collocation mining by relations of occurrences (SETM).

The relation of length k holds where each frequent k-word phrase occurs: piece and
position, sorted, which one integer says (positions run on through the pieces, with a gap
between two pieces).  It is a table of blocks, one row each.  A step

* merge-joins the relation with itself at adjacent positions: the phrases of k + 1 words whose
  first and last k words are frequent, one count for each block;
* groups these counts by phrase over all blocks and keeps the frequent phrases;
* semi-joins the occurrences with the frequent phrases and writes the next relation.

A phrase is known by the numbers of its first and its last k words, so no text is compared after the
single words; its own number names its entry in the first block that has it.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pizarra.llm.common import Tables, arrow_rows, col, release, ship_code, shuffle_partitions, slices
from pizarra.llm.hashing import byte_set, mix, row_of, span_hashes, word_spans
from pizarra.llm.packed import bucket_of

MIN_COUNT = 30
MAX_WORDS = 4
TOP = 2000
INSIDE_PERCENT = 80        # a phrase goes if a longer one around it has this share of its occurrences
BLOCK_BYTES = 8 << 20      # text of a block; a longer text is a block by itself
HOLD = 1 << 21             # counts of candidates that a task holds before it sends them
PER_BUCKET = 1 << 20       # counts that meet in a bucket, at most
_CODE_BITS, _SERIAL_BITS = 30, 13
_PIECE = byte_set(b".,;:!?\n\x0b\x0c\r")
_SEP = _PIECE | byte_set(b" \t")
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_U = np.uint64
_WORDS = "block long, m int, pos binary, code binary, langs array<string>, words array<string>, counts array<long>"
_RELATION = "block long, m int, pos binary, code binary, ids array<long>"
_SENT = "bucket long, m int, data binary"
_FOUND = "block long, m int, data binary, id long, a long, id1 long, id2 long"
_ENTRY_BYTES = 12          # of a frequent phrase in a block: its code there and its number


def _squeezed(a: np.ndarray) -> bytes:
    """A uint32 array, its bytes by place, compressed."""
    return pa.compress(np.ascontiguousarray(a.astype(np.uint32).view(np.uint8).reshape(-1, 4).T).tobytes(), codec="zstd", asbytes=True)


def _opened(data: bytes, n: int) -> np.ndarray:
    raw = pa.decompress(data, 4 * n, codec="zstd", asbytes=True)
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(4, n).T).view(np.uint32).ravel()


def _positions(data: np.ndarray, m: int) -> np.ndarray:
    return np.cumsum(_opened(data, m), dtype=np.int64)


def _distinct(key: np.ndarray, check: np.ndarray):
    """Like ``np.unique`` with index, inverse and counts, by both arrays."""
    _, index, inverse, counts = np.unique(key, return_index=True, return_inverse=True, return_counts=True)
    if (check[index][inverse] == check).all():
        return index, inverse, counts
    order = np.lexsort((check, key))
    new = np.ones(len(key), bool)
    new[1:] = (key[order][1:] != key[order][:-1]) | (check[order][1:] != check[order][:-1])
    inverse = np.empty(len(key), np.int64)
    inverse[order] = np.cumsum(new) - 1
    return order[new], inverse, np.diff(np.append(np.flatnonzero(new), len(key)))


def _blocks(block_bytes: int):
    """Rows of ``_WORDS``: the occurrences of all words of a block of texts."""
    def run(batches):
        task, serial = TaskContext.get().partitionId(), 0
        if task >= 1 << (63 - _CODE_BITS - _SERIAL_BITS):
            raise ValueError(f"partition {task}: too many partitions to number the blocks")
        at8 = np.array([0] + [(1 << 64) - (1 << (64 - 8 * i)) for i in range(1, 9)], _U)
        for batch in batches:
            for rows, data, off in slices(batch, 1, block_bytes):
                data = _LOWER[data]
                starts, ends, first = word_spans(data, off, _SEP)
                if not len(starts):
                    continue
                if serial >= 1 << _SERIAL_BITS or len(starts) >= 1 << _CODE_BITS:
                    raise ValueError("a partition has too many blocks, or a text too many words, to be numbered")
                row = row_of(first)
                piece = np.searchsorted(np.flatnonzero(_PIECE[data]), starts)      # nothing wider than a byte for each byte of text
                new = np.zeros(len(starts), bool)
                new[1:] = (piece[1:] != piece[:-1]) | (row[1:] != row[:-1])
                pos = _squeezed(1 + new.astype(np.uint32))
                del piece, new
                langs = rows.column(0).to_pylist()
                names = {x: i for i, x in enumerate(dict.fromkeys(langs))}
                lang = np.array([names[x] for x in langs], _U)[row]
                size = ends - starts
                # the hash decides, its check makes sure: both ends of the word, its length and language
                buf = np.concatenate([np.zeros(8, np.uint8), data, np.zeros(8, np.uint8)])
                at = np.ndarray((len(buf) - 7,), ">u8", buf, strides=(1,))
                head = at[starts + 8].astype(_U) & at8[np.minimum(size, 8)]
                tail = at[ends].astype(_U) * (size > 8)
                check = mix(head ^ mix(tail ^ mix(size.astype(_U) ^ (lang << _U(40)))))
                del row, size, buf, at, head, tail
                key = mix(span_hashes(data, starts, ends, lower=False) ^ mix(lang + _U(1)))
                index, code, counts = _distinct(key, check)
                del key, check
                m, code = len(starts), _squeezed(code)
                starts, ends, lang = starts[index], ends[index], lang[index]
                raw = data.tobytes()
                words = [raw[a:b] for a, b in zip(starts.tolist(), ends.tolist())]
                by_lang = pa.array(list(names), pa.string()).take(pa.array(lang.astype(np.int64)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([(task << _SERIAL_BITS) + serial], pa.int64()), pa.array([m], pa.int32()),
                     pa.array([pos], pa.binary()), pa.array([code], pa.binary()),
                     _one_list(by_lang), _one_list(pa.array(words, pa.binary()).cast(pa.string())), _one_list(pa.array(counts.astype(np.int64)))],
                    names=["block", "m", "pos", "code", "langs", "words", "counts"])
                serial += 1
                release()
    return run


def _one_list(values: pa.Array) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def _adjacent(pos: np.ndarray, code: np.ndarray):
    """The merge join at adjacent positions: which occurrences begin a longer phrase, and the
    pair of codes that it is made of."""
    at = np.flatnonzero(pos[1:] == pos[:-1] + 1)
    return at, (code[at].astype(_U) << _U(32)) | code[at + 1].astype(_U)


def _rows(batches, columns: int):
    for batch in batches:
        yield from zip(*(batch.column(i).to_pylist() if i < 4 else list(batch.column(i)) for i in range(columns)))


def _candidates(n_buckets: int):
    """Rows of ``_SENT``: the phrases that the relations of blocks extend to, with their counts there."""
    def send(held: list):
        id1, id2, ref, n = (np.concatenate(x) for x in zip(*held))
        bucket = bucket_of(mix(mix(id1.view(_U)) ^ id2.view(_U)), n_buckets)
        order = np.lexsort((id2, id1, bucket))          # runs of equal words pack well
        cols, bucket = [c[order] for c in (id1, id2, ref, n)], bucket[order]
        cut = np.append(np.flatnonzero(np.diff(bucket, prepend=-1)), len(bucket)).tolist()
        yield pa.RecordBatch.from_arrays(
            [pa.array(bucket[cut[:-1]]), pa.array(np.diff(cut).astype(np.int32)),
             pa.array([_packed([c[a:b] for c in cols]) for a, b in zip(cut, cut[1:])], pa.binary())], names=["bucket", "m", "data"])
        release()

    def run(batches):
        held, size = [], 0
        for block, m, pos, code, ids in _rows(batches, 5):
            ids = ids.values.to_numpy(zero_copy_only=False)
            _, pair = _adjacent(_positions(pos, m), _opened(code, m))
            pair, n = np.unique(pair, return_counts=True)
            if not len(pair):
                continue
            ref = (block << _CODE_BITS) + np.arange(len(pair), dtype=np.int64)
            held.append((ids[(pair >> _U(32)).astype(np.int64)], ids[(pair & _U(0xFFFFFFFF)).astype(np.int64)], ref, n.astype(np.int64)))
            size += len(pair)
            if size >= HOLD:
                yield from send(held)
                held, size = [], 0
        if held:
            yield from send(held)
    return run


def _packed(cols: list[np.ndarray]) -> bytes:
    """64-bit columns, their bytes by place, compressed."""
    return pa.compress(b"".join(c.view(np.uint8).reshape(-1, 8).T.tobytes() for c in cols), codec="zstd", asbytes=True)


def _unpacked(data: bytes, m: int) -> np.ndarray:
    raw = np.frombuffer(pa.decompress(data, 4 * 8 * m, codec="zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(raw.reshape(4, 8, m).transpose(0, 2, 1)).view(np.int64).reshape(4, m)


def _entries(code: np.ndarray, ids: np.ndarray) -> bytes:
    """Codes in a block and the phrases' numbers, their bytes by place, compressed."""
    raw = np.vstack([code.astype(np.int32).view(np.uint8).reshape(-1, 4).T, ids.astype(np.int64).view(np.uint8).reshape(-1, 8).T])
    return pa.compress(raw.tobytes(), codec="zstd", asbytes=True)


def _entries_of(parts: list[dict]) -> tuple[np.ndarray, np.ndarray]:
    """The entries of a block from all buckets: codes and numbers."""
    codes, ids = [], []
    for part in parts:
        m = part["m"]
        raw = np.frombuffer(pa.decompress(part["data"], _ENTRY_BYTES * m, codec="zstd", asbytes=True), np.uint8).reshape(_ENTRY_BYTES, m)
        codes.append(np.ascontiguousarray(raw[:4].T).view(np.int32).ravel())
        ids.append(np.ascontiguousarray(raw[4:].T).view(np.int64).ravel())
    return np.concatenate(codes), np.concatenate(ids)


def _frequent_pairs(min_count: int):
    """Rows of ``_FOUND``: the group counts of a bucket's phrases, and which are frequent.  A frequent
    phrase has one row with its number, count and parts; its entries in the blocks go packed, one row a block."""
    def settle(blobs: list):
        id1, id2, ref, n = np.concatenate(blobs, axis=1)
        order = np.lexsort((ref, id2, id1))
        id1, id2, ref, n = id1[order], id2[order], ref[order], n[order]
        new = np.append(True, (id1[1:] != id1[:-1]) | (id2[1:] != id2[:-1]))
        at = np.flatnonzero(new)
        size, total = np.diff(np.append(at, len(new))), np.add.reduceat(n, at)
        often = total >= min_count
        if not often.any():
            return
        lead, keep = at[often], np.repeat(often, size)
        whose, entry = np.repeat(ref[at], size)[keep], ref[keep]
        by_block = np.argsort(entry)
        whose, entry = whose[by_block], entry[by_block]
        block, code = entry >> _CODE_BITS, entry & ((1 << _CODE_BITS) - 1)
        cut = np.append(np.flatnonzero(np.diff(block, prepend=-1)), len(block)).tolist()
        n_blocks, n_leads = len(cut) - 1, len(lead)
        packed = [pa.array(block[cut[:-1]]), pa.array(np.diff(cut).astype(np.int32)),
                  pa.array([_entries(code[a:b], whose[a:b]) for a, b in zip(cut, cut[1:])], pa.binary())]
        names = ["block", "m", "data", "id", "a", "id1", "id2"]
        yield pa.RecordBatch.from_arrays(packed + [pa.nulls(n_blocks, pa.int64())] * 4, names=names)
        yield pa.RecordBatch.from_arrays([pa.nulls(n_leads, x.type) for x in packed] + [
            pa.array(c) for c in (ref[lead], total[often], id1[lead], id2[lead])], names=names)
        release()

    def run(batches):
        now, held = None, []
        for batch in batches:
            for b, m, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                if held and b != now:
                    yield from settle(held)
                    held = []
                now = b
                held.append(_unpacked(data.as_buffer(), m))
        if held:
            yield from settle(held)
    return run


def _counted(relation: DataFrame, min_count: int) -> DataFrame:
    """The frequent phrases that are longer by one word, as :func:`_frequent` gives the words."""
    parts = shuffle_partitions(relation.sparkSession)
    entries = relation.agg(F.sum("m")).first()[0] or 0           # a block has no more candidates than occurrences
    buckets = max(parts, int(entries // PER_BUCKET) + 1)
    sent = relation.mapInArrow(_candidates(buckets), _SENT).repartition(parts, "bucket").sortWithinPartitions("bucket")
    return sent.mapInArrow(_frequent_pairs(min_count), _FOUND)


def _kept(pos: np.ndarray, code: np.ndarray, codes: np.ndarray, ids: np.ndarray):
    """The occurrences whose phrase is among the frequent ``codes``, with codes of their own."""
    order = np.argsort(codes)
    codes, ids = codes[order], ids[order]
    place = np.minimum(np.searchsorted(codes, code), len(codes) - 1)
    keep = codes[place] == code
    return pos[keep], place[keep], ids


def _semi_joined(extend: bool):
    """The next relation from a relation (``extend``: its merge join) and the block's frequent phrases:
    words by lists of codes and numbers, longer ones packed."""
    def run(batches):
        for block, m, pos, code, *found in _rows(batches, 5 if extend else 6):
            pos, code = _positions(pos, m), _opened(code, m)
            if extend:
                at, pair = _adjacent(pos, code)
                _, code = np.unique(pair, return_inverse=True)
                pos = pos[at]
                codes, new_ids = _entries_of(found[0].as_py())
            else:
                codes, new_ids = (x.values.to_numpy(zero_copy_only=False) for x in found)
            pos, code, ids = _kept(pos, code, codes, new_ids)
            yield pa.RecordBatch.from_arrays(
                [pa.array([block], pa.int64()), pa.array([len(pos)], pa.int32()), pa.array([_squeezed(np.diff(pos, prepend=0))], pa.binary()),
                 pa.array([_squeezed(code)], pa.binary()), _one_list(pa.array(ids))], names=["block", "m", "pos", "code", "ids"])
            release()
    return run


def _frequent(words: DataFrame, min_count: int) -> DataFrame:
    """The block entries ``ref`` of frequent words with the word's number ``id`` and count ``a``;
    the word itself stays in the one entry that names it."""
    whole = Window.partitionBy("lang", "word")
    lead = F.col("ref") == F.col("id")
    return (words.withColumn("a", F.sum("n").over(whole)).where(F.col("a") >= min_count).withColumn("id", F.min("ref").over(whole))
            .select("ref", "id", *[F.when(lead, F.col(k)).alias(k) for k in ("a", "lang", "word")]))


def _by_block(frequent: DataFrame) -> DataFrame:
    entry = F.struct(F.col("ref").bitwiseAND(F.lit((1 << _CODE_BITS) - 1)).cast("int").alias("code"), "id")
    return frequent.groupBy(F.shiftright("ref", _CODE_BITS).alias("block")).agg(F.collect_list(entry).alias("e")).select(
        "block", F.col("e.code").alias("codes"), F.col("e.id").alias("new_ids"))


def _packed_by_block(found: DataFrame) -> DataFrame:
    return found.where("block is not null").groupBy("block").agg(F.collect_list(F.struct("m", "data")).alias("entries"))


def frequent_phrases(docs: DataFrame, tables: Tables, lang_col: str = "lang", text_col: str = "text", min_count: int = MIN_COUNT,
                     max_words: int = MAX_WORDS) -> tuple[list[DataFrame], DataFrame]:
    """Tables of the frequent phrases of 1 to ``max_words`` words, and each language's number of words.

    Columns: ``id, lang, phrase, last`` (its last word), ``a``, ``heads`` and ``tails``: the
    occurrences of its first, and of its last, 1, 2, ... words; from two words on ``id1, id2``.
    """
    spark = docs.sparkSession
    ship_code(spark)
    slim = docs.select(F.coalesce(col(lang_col).cast("string"), F.lit("und")).alias("lang"),
                       F.coalesce(col(text_col).cast("string"), F.lit("")).alias("text"))
    blocks = tables.write("blocks", slim.mapInArrow(_blocks(BLOCK_BYTES), _WORDS))
    words = blocks.select("block", F.posexplode(F.arrays_zip("langs", "words", "counts")).alias("code", "w")).select(
        (F.shiftleft("block", _CODE_BITS) + F.col("code")).alias("ref"), F.col("w.langs").alias("lang"),
        F.col("w.words").alias("word"), F.col("w.counts").alias("n"))
    totals = tables.write("totals", words.groupBy("lang").agg(F.sum("n").alias("n")))
    found = tables.write("found1", _frequent(words, min_count))
    one = found.where("ref = id").select("id", "lang", F.col("word").alias("phrase"), F.col("word").alias("last"), "a",
                                         F.array("a").alias("heads"), F.array("a").alias("tails"))
    phrases, relation = [tables.write("phrases1", one)], blocks
    for k in range(2, max_words + 1):
        with arrow_rows(spark, 1):       # a row is a block
            by_block = _by_block(found) if k == 2 else _packed_by_block(found)
            joined = relation.select("block", "m", "pos", "code").join(by_block.hint("shuffle_hash"), "block")
            old = f"relation{k - 2}"
            relation = tables.write(f"relation{k - 1}", joined.select("block", "m", "pos", "code", *by_block.columns[1:]).mapInArrow(
                _semi_joined(extend=k > 2), _RELATION))
            tables.drop("blocks" if k == 2 else old, f"found{k - 1}")
            found = tables.write(f"found{k}", _counted(relation, min_count))
        before = phrases[-1]
        head = before.select(F.col("id").alias("id1"), "lang", F.col("phrase").alias("first_words"), "heads")
        tail = before.select(F.col("id").alias("id2"), "last", "tails")
        longer = found.where("id is not null").select("id", "id1", "id2", "a").join(head, "id1").join(tail, "id2").select(
            "id", "lang", F.concat_ws(" ", "first_words", "last").alias("phrase"), "last", "a",
            F.concat("heads", F.array("a")).alias("heads"), F.concat("tails", F.array("a")).alias("tails"), "id1", "id2")
        phrases.append(tables.write(f"phrases{k}", longer))
    tables.drop(f"relation{max_words - 1}", f"found{max_words}")
    return phrases, totals


def collocations(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", min_count: int = MIN_COUNT,
                 max_words: int = MAX_WORDS, top: int = TOP, inside_percent: int = INSIDE_PERCENT) -> DataFrame:
    """Per language the ``top`` phrases of 2 to ``max_words`` words by how tightly their
    loosest cut holds: ``lang, rank, phrase, a, l, r, n, score``.

    A null language is ``und``, a null text empty; each row is a document, repeated ones too;
    only the two columns are read.  A language without frequent phrases, and an empty table, give no rows.
    """
    tables = Tables(docs.sparkSession, "collocations")
    phrases, totals = frequent_phrases(docs, tables, lang_col, text_col, min_count, max_words)
    out = None
    for k in range(2, max_words + 1):
        # decimals: the products may pass 64 bits
        scaled = F.col("a").cast("decimal(20,0)") * F.lit(2_000_000).cast("decimal(7,0)")

        def cut(j, k=k, scaled=scaled):
            left, right = F.element_at("heads", j), F.element_at("tails", k - j)
            return F.struct(F.call_function("div", scaled, left.cast("decimal(20,0)") + right.cast("decimal(20,0)")).alias("score"),
                            j.alias("j"), left.alias("l"), right.alias("r"))

        loosest = F.array_min(F.array(*[cut(F.lit(j)) for j in range(1, k)]))
        mine = phrases[k - 1].select("id", "lang", "phrase", "a", loosest.alias("c"))
        if k < max_words:
            # every longer phrase around it holds one that is longer by one word and as frequent at least
            nxt = phrases[k]
            around = nxt.select(F.col("id1").alias("id"), F.col("a").alias("b")).unionByName(
                nxt.select(F.col("id2").alias("id"), F.col("a").alias("b"))).groupBy("id").agg(F.max("b").alias("b"))
            inside = F.col("b").cast("decimal(20,0)") * 100 >= F.col("a").cast("decimal(20,0)") * F.lit(inside_percent)
            mine = mine.join(around, "id", "left").where(~F.coalesce(inside, F.lit(False)))
        mine = mine.select("lang", "phrase", "a", F.col("c.l").alias("l"), F.col("c.r").alias("r"), F.col("c.score").alias("score"))
        out = mine if out is None else out.unionByName(mine)
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    ranked = out.withColumn("rank", F.row_number().over(best).cast("long")).where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
