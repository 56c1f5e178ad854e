"""Sources and sinks."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_delimited(spark: SparkSession, path: str, schema: T.StructType | str | None = None, sep: str = ";",
                   header: bool = True, names: Sequence[str] | None = None) -> DataFrame:
    """Delimited text scan.

    With ``header=False`` and ``names`` the columns are named and typed by
    the given schema; a short row is padded with nulls on the right
    (PERMISSIVE mode), which is how a header-less file with ragged rows reads.
    """
    reader = spark.read.option("sep", sep).option("header", header).option("mode", "PERMISSIVE")
    if schema is None and names is not None:
        schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    if schema is not None:
        reader = reader.schema(schema)
    else:
        reader = reader.option("inferSchema", True)
    return reader.csv(path)


RAW = "_raw_record"


def read_checked(spark: SparkSession, path: str, schema: T.StructType | str, sep: str = ";", header: bool = False,
                 pad_short: bool = True) -> tuple[DataFrame, DataFrame]:
    """A delimited scan that loses nothing: the good rows, and the rejected records with a reason.

    ``too many fields``: more than the schema has (a plain scan would cut them).  ``bad value``: a field that
    isn't of its column's type (a plain scan would make it null).  ``too few fields``: rejected
    only without ``pad_short``, else the row is padded with nulls.  Separators between double quotes
    are text, a backslash escapes a quote there; a record is one line.  ``rejected`` has ``record, reason, file``.
    """
    schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    n = len(schema.fields)
    rows = (spark.read.schema(T.StructType([*schema.fields, T.StructField(RAW, T.StringType())])).option("sep", sep).option("header", header)
            .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", RAW).csv(path))
    # the scan gives the raw record of every row that it could not read as it stands
    bare = F.regexp_replace(RAW, r'"(?:[^"\\]|\\.)*"', "")
    fields = F.char_length(bare) - F.char_length(F.replace(bare, F.lit(sep), F.lit(""))) + 1
    told = F.from_csv(F.col(RAW), ", ".join(f"f{i} string" for i in range(n)), {"sep": sep})
    bad = F.lit(False)
    for i, f in enumerate(schema.fields):
        bad = bad | (told[f"f{i}"].isNotNull() & F.col("`" + f.name.replace("`", "``") + "`").isNull())
    reason = (F.when(F.col(RAW).isNull(), F.lit(None)).when(fields > n, "too many fields").when(bad, "bad value")
              .when((fields < n) & F.lit(not pad_short), "too few fields"))
    marked = rows.withColumn("_reason", reason)
    kept = marked.where(F.col("_reason").isNull()).select(*["`" + f.name.replace("`", "``") + "`" for f in schema.fields])
    rejected = marked.where(F.col("_reason").isNotNull()).select(F.col(RAW).alias("record"), F.col("_reason").alias("reason"),
                                                                 F.input_file_name().alias("file"))
    return kept, rejected


def write_delimited(df: DataFrame, path: str, sep: str = ";", header: bool = True, mode: str = "overwrite") -> None:
    """CSV sink, one file per partition (no row index column)."""
    df.write.mode(mode).option("sep", sep).option("header", header).csv(path)


def read_table(spark: SparkSession, options: Mapping[str, str], query: str | None = None,
               table: str | None = None, partition_column: str | None = None,
               lower_bound: int | None = None, upper_bound: int | None = None,
               num_partitions: int | None = None) -> DataFrame:
    """Read from a database through JDBC.

    ``options`` holds url/user/password/driver (from configuration, never
    from code).  A ``table`` or a free-form ``query`` can be split over
    ``num_partitions`` parallel range queries on a numeric
    ``partition_column``; without one a query is read by one task.
    Filters and projections on the result are pushed into the database.
    """
    return spark.read.format("jdbc").options(
        **options, **table_options(query, table, partition_column, lower_bound, upper_bound, num_partitions)).load()


def table_options(query: str | None = None, table: str | None = None, partition_column: str | None = None,
                  lower_bound: int | None = None, upper_bound: int | None = None,
                  num_partitions: int | None = None) -> dict[str, str]:
    """The JDBC options that say what to read, and in how many ranges."""
    if (query is None) == (table is None):
        raise ValueError("give either a query or a table")
    if partition_column is None:
        return {"query": query} if query is not None else {"dbtable": table}
    if lower_bound is None or upper_bound is None:
        raise ValueError("a partitioned read needs the column's bounds")
    # a query can be split only as a derived table
    return {"dbtable": table if query is None else f"({query}) q", "partitionColumn": partition_column,
            "lowerBound": str(lower_bound), "upperBound": str(upper_bound), "numPartitions": str(num_partitions or 8)}


def replace_table(df: DataFrame, options: Mapping[str, str], table: str, batch_size: int = 10000) -> None:
    """Empty the target table and insert ``df`` (TRUNCATE + bulk INSERT).

    ``truncate=true`` keeps the table definition; each partition inserts in
    batches over its own connection.
    """
    (
        df.write.format("jdbc").options(**options).option("dbtable", table)
        .option("truncate", "true").option("batchsize", batch_size).mode("overwrite").save()
    )


CURRENT = "_CURRENT"


def replace_files(df: DataFrame, path: str, fmt: str = "parquet") -> str:
    """File-table variant of :func:`replace_table`: all rows change at once, or none does.

    The rows go to a version folder of their own below ``path``; a pointer file that names
    it is then renamed over the old pointer, which is the commit.  A job that
    fails before leaves the old rows in place, and a reader that has begun keeps the version
    it resolved (:func:`drop_old_versions` removes those).  Returns the version.
    """
    spark = df.sparkSession
    version = f"v-{uuid.uuid4().hex}"
    df.write.format(fmt).save(f"{path}/{version}")
    _point_to(spark, path, version)
    return version


def _point_to(spark: SparkSession, path: str, version: str) -> None:
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    fs_path, rename = jvm.org.apache.hadoop.fs.Path, jvm.org.apache.hadoop.fs.Options.Rename
    fresh, target = fs_path(f"{path}/{CURRENT}.{uuid.uuid4().hex}"), fs_path(f"{path}/{CURRENT}")
    out = target.getFileSystem(conf).create(fresh, False)
    out.write(bytearray(version.encode()))
    out.close()
    how = spark.sparkContext._gateway.new_array(rename, 1)
    how[0] = rename.OVERWRITE
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), conf).rename(fresh, target, how)


def current_version(spark: SparkSession, path: str) -> str:
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    target = jvm.org.apache.hadoop.fs.Path(f"{path}/{CURRENT}")
    stream = target.getFileSystem(conf).open(target)
    try:
        return jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def read_files(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """The rows that the last completed :func:`replace_files` wrote."""
    return spark.read.format(fmt).load(f"{path}/{current_version(spark, path)}")


def drop_old_versions(spark: SparkSession, path: str) -> int:
    """Delete the versions that the pointer doesn't name, also those of failed jobs; how many
    there were.  No reader may still be at them, and no writer at work."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    folder, now = jvm.org.apache.hadoop.fs.Path(path), current_version(spark, path)
    fs = folder.getFileSystem(conf)
    old = [f.getPath() for f in fs.listStatus(folder) if f.getPath().getName().startswith("v-") and f.getPath().getName() != now]
    for p in old:
        fs.delete(p, True)
    return len(old)


def save_model(model, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str):
    from pyspark.ml import PipelineModel

    return PipelineModel.load(path)
