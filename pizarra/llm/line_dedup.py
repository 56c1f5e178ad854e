"""Line dedup: first occurrences by a range-partitioned sort; keep bitmaps out.

DataFrame functions only.  The line hashes are range-partitioned and sorted by
(hash, document, position); a running window streams each key's rows and its
first row names the document that keeps the line.  The sort key has a salt
taken from the document, so a line that a third of all documents hold is dealt
to many tasks: whatever isn't first within its salt is dropped there and then,
and only the firsts of each (key, salt) meet again in a second, small round.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pizarra.llm.common import col, fresh, id_text, shuffle_partitions

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BLANKS = " \t\n\x0b\x0c\r"
MIN_CHARS = 10


def _ascii_lower(c: Column) -> Column:
    # lower() has a fast path for ASCII; other texts must keep their non-ASCII capitals
    return F.when(F.octet_length(c) == F.char_length(c), F.lower(c)).otherwise(F.translate(c, UPPER, LOWER))


def _lines(c: Column) -> Column:
    return F.split(c, "\n", -1)


def _text_key(c: Column) -> list[Column]:
    return [F.xxhash64(c), F.xxhash64(F.lit(1), c)]


def keep_bitmaps(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 min_chars: int = MIN_CHARS, salts: int | None = None) -> DataFrame:
    """Per row whose lines are partly dropped: ``id``, ``t1``/``t2`` (hashes of
    its text), ``n_dropped`` and ``runs``, the run-length compressed keep bitmap
    (lengths of alternating kept and dropped runs of lines, a kept run first;
    the lines after the last run are kept).

    A line's key is the line without ``[\\x20\\x09-\\x0D]`` at both ends, A-Z
    lower-cased.  A key of ``min_chars`` code points or more stays only in the
    smallest id that holds it, there in all its lines.  Rows not returned keep
    all their lines.  Rows with a null id are neither judged nor counted.  Rows
    that repeat an id are one document; each row has its own text's bitmap.
    An empty table gives no rows.
    """
    salts = salts or shuffle_partitions(docs.sparkSession)
    base = id_text(docs, id_col, text_col).where(F.col("id").isNotNull())
    key = _ascii_lower(F.btrim(F.col("line"), F.lit(BLANKS)))
    rows = (
        base.select("id", *[h.alias(f"t{i + 1}") for i, h in enumerate(_text_key(F.col("text")))],
                    F.posexplode(_lines(F.col("text"))).alias("pos", "line"))
        .select("id", "t1", "t2", "pos", key.alias("key"))
        .where(F.char_length("key") >= min_chars)
        .select(F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), F.col("key")).alias("h2"), "id", "t1", "t2", "pos",
                F.pmod(F.xxhash64("id"), F.lit(salts)).cast("int").alias("salt"))
    )

    def streamed(df: DataFrame, *by: str) -> DataFrame:
        order = Window.partitionBy(*by).orderBy("id", "pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        return df.repartitionByRange(*by).withColumn("lead", F.first("id").over(order) == F.col("id"))

    one = streamed(rows, "h1", "h2", "salt")
    two = streamed(one.where("lead").drop("salt", "lead"), "h1", "h2")
    row = ["id", "t1", "t2"]
    dropped = one.where(~F.col("lead")).select(*row, "pos").unionByName(two.where(~F.col("lead")).select(*row, "pos"))
    # runs of dropped positions; repeated rows give equal positions, which count once
    islands = (
        dropped.withColumn("island", F.col("pos") - F.dense_rank().over(Window.partitionBy(*row).orderBy("pos")))
        .groupBy(*row, "island").agg(F.min("pos").alias("a"), (F.max("pos") - F.min("pos") + 1).alias("n"))
        .groupBy(*row).agg(F.array_sort(F.collect_list(F.struct("a", "n"))).alias("gaps"), F.sum("n").alias("n_dropped"))
    )
    after = F.transform("gaps", lambda g: g["a"] + g["n"])
    runs = F.flatten(F.zip_with("gaps", F.concat(F.array(F.lit(0)), after), lambda g, end: F.when(
        g.isNotNull(), F.array(g["a"] - end, g["n"])).otherwise(F.array().cast("array<int>"))))
    return islands.select(*row, "n_dropped", runs.alias("runs"))


def kept_lines(text: Column, runs: Column) -> Column:
    """The text without the lines that the bitmap drops (null bitmap: all stay)."""
    lines = _lines(text)
    flags = F.flatten(F.transform(runs, lambda n, i: F.array_repeat(i % 2 == 0, n)))
    cut = F.concat(flags, F.array_repeat(F.lit(True), F.greatest(F.size(lines) - F.size(flags), F.lit(0))))
    kept = F.transform(F.filter(F.arrays_zip(lines.alias("l"), cut.alias("k")), lambda x: x["k"]), lambda x: x["l"])
    return F.when(runs.isNull(), text).otherwise(F.array_join(kept, "\n"))


def with_bitmaps(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 min_chars: int = MIN_CHARS) -> tuple[DataFrame, str, str]:
    """``docs`` with its own columns, the bitmap (null: all lines stay) and the
    number of dropped lines; also the names of these two columns."""
    runs, n = fresh("keep_runs", docs.columns), fresh("n_dropped", docs.columns)
    keys = [fresh(k, docs.columns) for k in ("_id", "_t1", "_t2")]
    maps = keep_bitmaps(docs, id_col, text_col, min_chars).select(
        *[F.col(c).alias(k) for c, k in zip(("id", "t1", "t2"), keys)], F.col("runs").alias(runs), F.col("n_dropped").alias(n))
    text = F.coalesce(col(text_col).cast("string"), F.lit(""))
    left = docs.withColumns(dict(zip(keys, [col(id_col).cast("long"), *_text_key(text)])))
    return left.join(maps.hint("shuffle_hash"), keys, "left").select(*[col(c) for c in docs.columns], runs, n), runs, n


def drop_repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                        min_chars: int = MIN_CHARS) -> DataFrame:
    """``docs`` with the repeated lines cut from its text (a null one stays null); the
    other columns stay."""
    out, runs, _ = with_bitmaps(docs, id_col, text_col, min_chars)
    return out.withColumn(text_col, kept_lines(col(text_col), F.col(runs))).select(*[col(c) for c in docs.columns])


def line_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, number of lines, of dropped lines, and the SHA-256 of the text that the keep bitmap leaves."""
    slim = id_text(docs, id_col, text_col)
    out, runs, n = with_bitmaps(slim, "id", "text")
    return out.select(
        F.col("id").alias("doc_id"), F.size(_lines(F.col("text"))).cast("long").alias("n_lines"),
        F.coalesce(F.col(n), F.lit(0)).cast("long").alias("n_dropped"),
        F.sha2(kept_lines(F.col("text"), F.col(runs)).cast("binary"), 256).alias("kept_sha256"))
