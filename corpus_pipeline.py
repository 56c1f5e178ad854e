"""The training-data pipeline over ``documents``: each stage calls one operator of ``pizarra.llm``.

Every stage works on all that the one before it kept, written as Parquet and read
again.  All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pizarra.llm.common import table, written
from pizarra.llm.decontamination import drop_contaminated
from pizarra.llm.line_dedup import drop_repeated_lines
from pizarra.llm.ngram_join import drop_near_copies
from pizarra.llm.sentencepieces import with_pieces
from pizarra.llm.toxicity import drop_toxic


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score 0.5 or more go."""
    return drop_toxic(docs, table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated lines go from the texts; ``n_chars`` follows.  Every document stays."""
    return drop_repeated_lines(docs).withColumn("n_chars", F.char_length("text").cast("long")).select(*docs.columns)


def ngram_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents, that with the smallest id stays."""
    return drop_near_copies(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, also an edited one, go."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sampled piece ids in place of the text, from which it can be decoded without loss."""
    out, ids = with_pieces(docs)
    return out.select("doc_id", "lang", "source", "n_chars", F.size(ids).cast("long").alias("n_pieces"), F.col(ids).alias("ids"))


STAGES = [
    ("toxicity", toxicity),
    ("line_dedup", line_dedup),
    ("ngram_join", ngram_join),
    ("decontamination", decontamination),
    ("sentencepiece", sentencepiece),
]

#: The fitted scores, the alignment and the sampled pieces can't be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
