"""Job-level compositions of the operators (the reference's five jobs)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pizarra.functions.scalar import code_map, recode, round_half_even, to_numeric, try_ratio
from pizarra.operators.clean import drop_nulls, fill_nulls, filter_in, filter_ne_keep_nulls
from pizarra.operators.joins import left_join
from pizarra.operators.profile import count_distinct_per_group
from pizarra.operators.reshape import pivot_mean
from pizarra.sources import standins as S

# Level and area codes of the score table, course length in
# weeks per course (by month here), the sentinel id and the excluded status.
LEVEL_CODES = {"AFRICA": 1, "AMERICA": 2, "ASIA": 3}
LEVEL_OTHER = 4
AREA_CODES = {"Rural": 1}
AREA_OTHER = 2
COURSE_WEEKS = {1: 28, 2: 28, 3: 41}
SENTINEL_ID = 10000000
EXCLUDED_STATUS = "NINGUNA ACTIVIDAD"


# J1: questionnaire scores per (course, teacher) ---------------------------------

def score_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entry and exit score per (course, teacher): mean grade, 0 when absent."""
    entry, exit_ = S.ENTRY_ACTIVITY, S.EXIT_ACTIVITY
    act = filter_in(S.activity(spark, sf_dir), {"NOMBRE_ACTIVIDAD": [entry, exit_]})
    act = drop_nulls(act.withColumn("IDNUMBER", to_numeric("IDNUMBER")), ["IDNUMBER"])
    pv = pivot_mean(act, ["CURID", "IDNUMBER"], "NOMBRE_ACTIVIDAD", "FINALGRADE", [entry, exit_])
    return fill_nulls(pv, {entry: 0.0, exit_: 0.0})


def scores_with_roster(spark: SparkSession, sf_dir: str) -> DataFrame:
    roster = S.roster(spark, sf_dir).withColumn("DNI", to_numeric("DNI"))
    return left_join(score_pivot(spark, sf_dir), roster, ["IDNUMBER"], ["DNI"])


def score_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score table with teacher traits: rows with any gap dropped, traits recoded."""
    t = scores_with_roster(spark, sf_dir)
    t = fill_nulls(t, {"ESCALA_DOCENTE": 0.0}).na.drop()
    return t.withColumns({
        "NIVEL": recode("NIVEL", LEVEL_CODES, LEVEL_OTHER),
        "DAREACENSO": recode("DAREACENSO", AREA_CODES, AREA_OTHER),
    })


# J2: drop-out cohort preparation ---------------------------------------------------

def cohort_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deduplicated cohort without the sentinel id and the excluded status."""
    c = S.cohort(spark, sf_dir).dropDuplicates()
    c = filter_ne_keep_nulls(c, "DNI_CARACTERIZADO", SENTINEL_ID)
    return filter_ne_keep_nulls(c, "CUMPLIMIENTO", EXCLUDED_STATUS)


def cohort_prepared(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cohort + course length, active days and the two shares (2 decimals)."""
    c = S.cohort(spark, sf_dir).withColumn("DURACION", code_map("CURID", COURSE_WEEKS))
    days = S.activity_days(spark, sf_dir)
    j = left_join(c, days, ["CURID", "DNI_CARACTERIZADO"], ["CURID", "IDNUMBER"])
    # the shared key appears once, as pd.merge does with a common name
    j = j.select([F.col(f"l.`{x}`") for x in c.columns] + [F.col("r.IDNUMBER"), F.col("r.DIAS")])
    return j.withColumns({
        "PORC_DIAS": round_half_even(try_ratio("DIAS", "DURACION"), 2),
        "Porc_act_realizada": round_half_even(F.col("Porc_act_realizada") / F.lit(100.0), 2),
    })


# J5: enrolment reconciliation ------------------------------------------------------

def reconcile_systems(a: DataFrame, b: DataFrame) -> DataFrame:
    """Teachers per course in both systems, matched by upper-case name.

    ``a``: (ID_OFERTA_FORMATIVA, NOMBRE, USUARIO_DOCUMENTO) participants of
    system 1; ``b``: (CURID, FULLNAME, IDNUMBER) of system 2.  VAL_1 is 1 when
    system 1 counts more distinct teachers, 2 when system 2 does, 3 when they
    agree; compared per matched course.
    """
    ca = count_distinct_per_group(a, ["ID_OFERTA_FORMATIVA", "NOMBRE"], "USUARIO_DOCUMENTO",
                                  "DOCENTE_x").withColumn("NOMBRE", F.upper("NOMBRE"))
    cb = count_distinct_per_group(b, ["CURID", "FULLNAME"], "IDNUMBER", "DOCENTE_y").withColumn(
        "FULLNAME", F.upper("FULLNAME"))
    m = ca.join(cb, ca.NOMBRE == cb.FULLNAME, "inner")
    val = F.when(F.col("DOCENTE_x") > F.col("DOCENTE_y"), 1).when(F.col("DOCENTE_x") < F.col("DOCENTE_y"), 2).otherwise(3)
    return m.select(
        F.col("ID_OFERTA_FORMATIVA").alias("OFERTA_ID"),
        F.col("NOMBRE").alias("OFERTA_NOMBRE"),
        F.col("DOCENTE_x").alias("OFERTA_DOCENTE"),
        "CURID",
        F.col("FULLNAME").alias("CAMPUS_NOMBRE"),
        F.col("DOCENTE_y").alias("CAMPUS_DOCENTE"),
        val.alias("VAL_1"),
    )


def reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Enrolment reconciliation over the two stand-in systems."""
    return reconcile_systems(S.enrolment_system_a(spark, sf_dir), S.enrolment_system_b(spark, sf_dir))


def reconcile_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three reports as counts per outcome code."""
    return reconcile(spark, sf_dir).groupBy("VAL_1").agg(F.count(F.lit(1)).cast("long").alias("n_courses"))
