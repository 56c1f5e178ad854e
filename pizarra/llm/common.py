"""Shared helpers of the training-data operators: tables, scratch, Arrow plumbing.

Rules all operators keep, unless their docstring says otherwise:

* a null text counts as the empty text;
* only the named id and text columns are read, under internal names, so extra
  columns may have any name;
* rows are judged by id: rows that repeat an id are one result row each.
"""

from __future__ import annotations

import contextlib
import ctypes

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pizarra.session import ensure_checkpoint_dir, scratch_path, ship_code

SLICE_BYTES = 4 << 20    # text bytes that one vectorised step works on


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_code(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared checkpoint folder: cuts the lineage, and
    a lost executor loses nothing that was computed."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


class Tables:
    """Scratch tables by name, for jobs of several steps: a step's input can go once its output is written."""

    def __init__(self, spark: SparkSession, job: str):
        self.spark, self.job, self.paths = spark, job, {}

    def write(self, name: str, df: DataFrame) -> DataFrame:
        path = self.paths[name] = scratch_path(self.spark, f"{self.job}-{name}")
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        for name in names:
            path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.paths.pop(name))
            path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def fresh(name: str, taken) -> str:
    """``name``, with underscores added until no column in ``taken`` has it
    (case-insensitively, as Spark resolves names)."""
    low = {c.lower() for c in taken}
    while name.lower() in low:
        name += "_"
    return name


def col(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def id_text(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Two columns ``id`` (long) and ``text`` (null: empty)."""
    return df.select(col(id_col).cast("long").alias("id"),
                     F.coalesce(col(text_col).cast("string"), F.lit("")).alias("text"))


def through(docs: DataFrame, inputs: list[Column], work, extra: list[tuple[str, str]] = ()) -> DataFrame:
    """``docs`` passed through tasks with its own columns, whatever their names.

    ``work(batch, first)`` gets batches with the columns of ``docs`` and then, from
    column ``first`` on, ``inputs``; it yields ``(rows, arrays)``: which rows of the batch go on
    (a record batch of the same columns) and the arrays of the ``extra`` columns.
    """
    n, m = len(docs.columns), len(extra)
    names = [f"c{i}" for i in range(n)] + [f"e{i}" for i in range(m)]
    wide = docs.select(*[col(c).alias(f"c{i}") for i, c in enumerate(docs.columns)], *[x.alias(f"i{k}") for k, x in enumerate(inputs)])
    schema = T.StructType([T.StructField(x, f.dataType) for x, f in zip(names, docs.schema.fields)]
                          + [T.StructField(f"e{k}", T.DataType.fromDDL(t)) for k, (_, t) in enumerate(extra)])

    def run(batches):
        for batch in batches:
            for rows, arrays in work(batch, n):
                yield pa.RecordBatch.from_arrays(rows.columns[:n] + list(arrays), names=names)

    return wide.mapInArrow(run, schema).toDF(*docs.columns, *[x for x, _ in extra])


@contextlib.contextmanager
def arrow_rows(spark: SparkSession, n: int):
    """Batches of at most ``n`` rows for the Python work run inside: for rows that are large."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    old = spark.conf.get(key)
    spark.conf.set(key, str(n))
    try:
        yield
    finally:
        spark.conf.set(key, old)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


_TRIM = getattr(ctypes.CDLL(None), "malloc_trim", None)


def release() -> None:
    """Give freed memory back to the system: a worker process serves many tasks, and
    what one of them has freed should not stand against the executor's limit."""
    pa.default_memory_pool().release_unused()
    if _TRIM is not None:
        _TRIM(0)


def text_buffers(arr) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of an Arrow string column and its ``n + 1`` offsets into
    them; nulls are empty."""
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
    if arr.null_count:
        arr = pc.fill_null(arr, "")
    wide = pa.types.is_large_string(arr.type) or pa.types.is_large_binary(arr.type)
    n = len(arr)
    if n == 0:
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    _, off_buf, data_buf = arr.buffers()
    off = np.frombuffer(off_buf, np.int64 if wide else np.int32)[arr.offset:arr.offset + n + 1].astype(np.int64)
    data = np.frombuffer(data_buf, np.uint8) if data_buf is not None else np.empty(0, np.uint8)
    return data[off[0]:off[-1]], off - off[0]


def slices(batch: pa.RecordBatch, text_index: int, max_bytes: int = SLICE_BYTES, fold: bool = False):
    """The batch in runs of rows of at most ``max_bytes`` of text (one row may be
    longer): ``(rows, data, offsets)``; with ``fold`` the text is in lower case."""
    text = batch.column(text_index)
    data, off = text_buffers(pc.utf8_lower(text) if fold else text)
    i, n = 0, batch.num_rows
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + max_bytes, side="right")) - 1)
        yield batch.slice(i, j - i), data[off[i]:off[j]], off[i:j + 1] - off[i]
        i = j
    release()


__all__ = ["Tables", "arrow_rows", "release", "table", "through", "written", "fresh", "col", "id_text", "shuffle_partitions", "text_buffers", "slices",
           "ensure_checkpoint_dir", "scratch_path", "ship_code", "SLICE_BYTES"]
