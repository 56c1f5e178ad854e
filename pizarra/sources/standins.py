"""Stand-in inputs built from the synthetic tables in ``<sf_dir>/*.parquet``.

The reference reads its inputs from databases we do not have; each function
here maps one reference table onto the generated TPC-H-like tables so the
jobs run over data whose size grows with the scale factor.  Each builder is a
lazy plan: Catalyst prunes the columns a caller does not use and pushes its
filters into the parquet scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The activity names used as the two questionnaires, and the
# labels of the three completion states of the drop-out cohort.
ENTRY_ACTIVITY = "view"
EXIT_ACTIVITY = "click"
COMPLETION_BY_STATUS = {
    "F": "CULMINARON",
    "O": "AL MENOS UNA ACTIVIDAD",
    "P": "NINGUNA ACTIVIDAD",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _dims(spark: SparkSession, sf_dir: str) -> DataFrame:
    # nation (25 rows) and region (5 rows) are fixed-size dimensions, so
    # broadcasting them is safe at any scale factor.
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    return nation.join(F.broadcast(region), nation.n_regionkey == region.r_regionkey)


def activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Activity log: one graded activity per event.

    IDNUMBER stays text (the reference parses it with ``to_numeric``).
    """
    ev = table(spark, sf_dir, "events")
    return ev.select(
        F.col("event_id"),
        (F.get_json_object("props", "$.k").cast("int") % 20).alias("CURID"),
        F.col("user_id").cast("string").alias("IDNUMBER"),
        F.col("event_type").alias("NOMBRE_ACTIVIDAD"),
        F.col("value").alias("FINALGRADE"),
        F.col("ts").alias("FECHA_REALIZADA"),
    )


def roster(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Teacher traits: customer joined to its nation and region."""
    cust = table(spark, sf_dir, "customer")
    dims = _dims(spark, sf_dir)
    return cust.join(F.broadcast(dims), cust.c_nationkey == dims.n_nationkey).select(
        F.col("c_custkey").cast("string").alias("DNI"),
        F.col("r_name").alias("NIVEL"),
        F.col("c_mktsegment").alias("DESCRIPCION_CARGO"),
        F.col("n_name").alias("D_DPTO"),
        F.col("c_acctbal").alias("ESCALA_DOCENTE"),
        F.when(F.col("c_mktsegment") == "BUILDING", "Rural").otherwise("Urbana").alias("DAREACENSO"),
    )


def survey(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Survey answers: one answer per order line, null when the flag is 'N'."""
    li = table(spark, sf_dir, "lineitem")
    od = table(spark, sf_dir, "orders")
    j = li.join(od, li.l_orderkey == od.o_orderkey)
    return j.select(
        F.col("o_custkey").alias("USUARIO"),
        F.col("o_custkey").cast("string").alias("IDNUMBER"),
        F.col("l_suppkey").alias("CURID"),
        F.concat(F.lit("CURSO "), F.col("l_suppkey").cast("string")).alias("DES_CURSO"),
        F.when(F.col("l_returnflag") == "N", F.lit(None).cast("double"))
        .otherwise((F.lit(1) + F.col("l_quantity").cast("int") % 4).cast("double"))
        .alias("OPCION_ELEGIDA"),
    )


def cohort(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Drop-out cohort: one enrolment per order, traits from the roster."""
    od = table(spark, sf_dir, "orders")
    cust = table(spark, sf_dir, "customer")
    dims = _dims(spark, sf_dir)
    c = cust.join(F.broadcast(dims), cust.c_nationkey == dims.n_nationkey)
    status = F.col("o_orderstatus")
    completion = None
    for code, label in COMPLETION_BY_STATUS.items():
        completion = F.when(status == code, label) if completion is None else completion.when(status == code, label)
    escala = F.when(F.col("o_orderkey") % 9 == 8, F.lit("X")).otherwise((F.col("o_orderkey") % 9).cast("string"))
    return od.join(c, od.o_custkey == c.c_custkey).select(
        F.col("o_orderkey").alias("USUARIO"),
        F.month("o_orderdate").cast("long").alias("CURID"),
        F.col("o_custkey").alias("DNI_CARACTERIZADO"),
        completion.alias("CUMPLIMIENTO"),
        escala.alias("ESCALA"),
        F.col("c_mktsegment").alias("condicion_laboral"),
        F.col("r_name").alias("NIVEL"),
        F.col("o_orderpriority").alias("DAREACENSO"),
        (F.col("o_orderkey") % 101).cast("double").alias("Porc_act_realizada"),
        F.col("o_totalprice").alias("NOTA"),
        F.col("o_orderdate").alias("MAX_FECHA"),
    )


def activity_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Active days per (course, teacher): distinct ship days of the orders."""
    li = table(spark, sf_dir, "lineitem")
    od = table(spark, sf_dir, "orders")
    j = li.join(od, li.l_orderkey == od.o_orderkey)
    return (
        j.groupBy(F.month("o_orderdate").cast("long").alias("CURID"), F.col("o_custkey").alias("IDNUMBER"))
        .agg(F.count_distinct(F.to_date("l_shipdate")).alias("DIAS"))
    )


def enrolment_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_linestatus")
    od = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    pt = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    # A course offer is a part name; its id is the smallest part key with
    # that name, so both systems agree on the id of a name.
    offers = pt.groupBy("p_name").agg(F.min("p_partkey").alias("offer_id"))
    pt = pt.join(offers, "p_name")
    return li.join(od, li.l_orderkey == od.o_orderkey).join(pt, li.l_partkey == pt.p_partkey)


def enrolment_system_a(spark: SparkSession, sf_dir: str) -> DataFrame:
    """System 1 participants: open lines, course named by ``p_name``."""
    e = enrolment_lines(spark, sf_dir).filter(F.col("l_linestatus") == "O")
    return e.select(
        F.col("offer_id").alias("ID_OFERTA_FORMATIVA"),
        F.col("p_name").alias("NOMBRE"),
        F.col("o_custkey").cast("string").alias("USUARIO_DOCUMENTO"),
    )


def enrolment_system_b(spark: SparkSession, sf_dir: str) -> DataFrame:
    """System 2 participants: finished lines, course name in lower case."""
    e = enrolment_lines(spark, sf_dir).filter(F.col("l_linestatus") == "F")
    return e.select(
        F.col("offer_id").alias("CURID"),
        F.lower("p_name").alias("FULLNAME"),
        F.col("o_custkey").cast("string").alias("IDNUMBER"),
    )


def cluster_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings")


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Binary outcomes: ``quality`` as truth, ``toxic`` as the prediction."""
    return table(spark, sf_dir, "labels").select(
        "doc_id", F.col("quality").alias("y_true"), F.col("toxic").alias("y_pred")
    )
