"""The queries ``opN_<name>`` over the whole intended tables, with their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pizarra.llm import oracles
from pizarra.llm.chat_format import chat_report, with_probe
from pizarra.llm.collocations import collocations
from pizarra.llm.common import table
from pizarra.llm.decontamination import contamination_report
from pizarra.llm.divergence import divergence
from pizarra.llm.fingerprint import edit_report
from pizarra.llm.license_scan import license_report
from pizarra.llm.line_dedup import line_report
from pizarra.llm.ngram_join import linked_documents
from pizarra.llm.sentencepieces import piece_report
from pizarra.llm.substring_dedup import substring_report
from pizarra.llm.toxicity import toxicity_report
from pizarra.llm.url_filter import url_verdicts
from pizarra.llm.warc import archive_report

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def oracle_sql() -> dict[str, str]:
    return {name: getattr(oracles, name.upper()) for name in QUERIES if hasattr(oracles, name.upper())}


@query
def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_report(table(spark, sf_dir, "documents"))


#: (verdict, host, path)
URL_RULES = [
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
]


@query
def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_verdicts(table(spark, sf_dir, "pages"), URL_RULES)


@query
def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_report(table(spark, sf_dir, "documents"))


@query
def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op3_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edit_report(table(spark, sf_dir, "documents"))


@query
def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive_report(table(spark, sf_dir, "pages"))


@query
def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_report(table(spark, sf_dir, "documents"))


@query
def op6_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_report(table(spark, sf_dir, "documents"))


@query
def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op2_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linked_documents(table(spark, sf_dir, "documents"))


@query
def op13_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_report(with_probe(table(spark, sf_dir, "conversations"), spark))


@query
def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


@query
def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence(table(spark, sf_dir, "documents"))
