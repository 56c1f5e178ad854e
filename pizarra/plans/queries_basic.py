"""Named queries: sources, cleaning, joins, profiling, reshape, scalars."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from pizarra.functions.scalar import code_map, day_text, recode, round_half_even, to_numeric
from pizarra.operators import clean, joins, profile, reshape
from pizarra.operators.ordering import POS, with_running_totals
from pizarra.operators.ratings import answers_filled, ratings
from pizarra.plans import jobs
from pizarra.plans import standin_sql as Q
from pizarra.plans.catalog import register
from pizarra.session import scratch_path
from pizarra.sources import io
from pizarra.sources import standins as S

# ---------------------------------------------------------------- J1 score table


@register("pivot_mean", settle=["view", "click"], sql=Q.with_(Q.ACTIVITY) + """
SELECT CURID, IDNUMBER,
       coalesce(avg(FINALGRADE) FILTER (WHERE NOMBRE_ACTIVIDAD = 'view'), 0) AS "view",
       coalesce(avg(FINALGRADE) FILTER (WHERE NOMBRE_ACTIVIDAD = 'click'), 0) AS "click"
FROM (SELECT CURID, TRY_CAST(trim(IDNUMBER) AS DOUBLE) AS IDNUMBER, NOMBRE_ACTIVIDAD, FINALGRADE
      FROM activity WHERE NOMBRE_ACTIVIDAD IN ('view', 'click'))
WHERE IDNUMBER IS NOT NULL AND FINALGRADE IS NOT NULL
GROUP BY CURID, IDNUMBER""")
def q_pivot_mean(spark, sf):
    """Entry/exit questionnaire mean per (course, teacher)."""
    return jobs.score_pivot(spark, sf)


_SCORES_SQL = """scores AS (
  SELECT CURID, IDNUMBER,
         coalesce(avg(FINALGRADE) FILTER (WHERE NOMBRE_ACTIVIDAD = 'view'), 0) AS "view",
         coalesce(avg(FINALGRADE) FILTER (WHERE NOMBRE_ACTIVIDAD = 'click'), 0) AS "click"
  FROM (SELECT CURID, TRY_CAST(trim(IDNUMBER) AS DOUBLE) AS IDNUMBER, NOMBRE_ACTIVIDAD, FINALGRADE
        FROM activity WHERE NOMBRE_ACTIVIDAD IN ('view', 'click'))
  WHERE IDNUMBER IS NOT NULL AND FINALGRADE IS NOT NULL
  GROUP BY CURID, IDNUMBER),
roster_n AS (SELECT TRY_CAST(trim(DNI) AS DOUBLE) AS DNI, NIVEL, DESCRIPCION_CARGO, D_DPTO,
                    ESCALA_DOCENTE, DAREACENSO FROM roster)"""


@register("roster_left_join", settle=["view", "click"],
          sql=Q.with_(Q.ACTIVITY, Q.ROSTER, _SCORES_SQL) + """
SELECT s.*, r.* FROM scores s LEFT JOIN roster_n r ON s.IDNUMBER = r.DNI""")
def q_roster_left_join(spark, sf):
    """Scores left-joined to teacher traits on differently named keys."""
    return jobs.scores_with_roster(spark, sf)


_SCORE_TABLE_BODY = """
SELECT CURID, IDNUMBER, "view", "click", DNI,
       CASE NIVEL WHEN 'AFRICA' THEN 1 WHEN 'AMERICA' THEN 2 WHEN 'ASIA' THEN 3 ELSE 4 END AS NIVEL,
       DESCRIPCION_CARGO, D_DPTO, coalesce(ESCALA_DOCENTE, 0) AS ESCALA_DOCENTE,
       CASE DAREACENSO WHEN 'Rural' THEN 1 ELSE 2 END AS DAREACENSO
FROM scores s JOIN roster_n r ON s.IDNUMBER = r.DNI
WHERE NIVEL IS NOT NULL AND DESCRIPCION_CARGO IS NOT NULL AND D_DPTO IS NOT NULL
  AND DAREACENSO IS NOT NULL"""
SCORE_TABLE_CTES = Q.with_(Q.ACTIVITY, Q.ROSTER, _SCORES_SQL) + ", score_table AS (" + _SCORE_TABLE_BODY + ")\n"


@register("score_table", settle=["view", "click"], sql=Q.with_(Q.ACTIVITY, Q.ROSTER, _SCORES_SQL) + _SCORE_TABLE_BODY)
def q_score_table(spark, sf):
    """J1 input: scores + traits, gaps dropped, level and area recoded."""
    return jobs.score_table(spark, sf)


@register("unmatched_ids", sql=Q.with_(Q.ROSTER, Q.COHORT) + """
SELECT count(*) AS n_unmatched FROM roster r
WHERE NOT EXISTS (SELECT 1 FROM cohort c WHERE CAST(c.DNI_CARACTERIZADO AS VARCHAR) = r.DNI)""")
def q_unmatched_ids(spark, sf):
    """Teachers of the roster without any enrolment (ids not found)."""
    coh = S.cohort(spark, sf).select(F.col("DNI_CARACTERIZADO").cast("string").alias("K"))
    return joins.unmatched_count(S.roster(spark, sf), coh, ["DNI"], ["K"])


# ---------------------------------------------------------------- sources


_CSV_COLS = ["USUARIO", "CURID", "CUMPLIMIENTO", "ESCALA", "Porc_act_realizada"]


@register("csv_roundtrip", sql=Q.with_(Q.COHORT) + """
SELECT USUARIO, CURID, CUMPLIMIENTO, ESCALA, Porc_act_realizada FROM cohort""")
def q_csv_roundtrip(spark, sf):
    """Cohort written as ';'-separated text with header, read back typed."""
    src = S.cohort(spark, sf).select(*_CSV_COLS)
    path = scratch_path(spark, "csv")
    io.write_delimited(src, path, sep=";")
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in src.schema.fields])
    return io.read_delimited(spark, path, schema=schema, sep=";")


@register("csv_headerless", sql=Q.with_(Q.COHORT) + """
SELECT CAST(USUARIO AS VARCHAR) AS USUARIO, CAST(CURID AS VARCHAR) AS CURID,
       CASE WHEN CUMPLIMIENTO = 'NINGUNA ACTIVIDAD' THEN NULL ELSE ESCALA END AS ESCALA
FROM cohort""")
def q_csv_headerless(spark, sf):
    """Header-less text with names given at read; short rows padded with nulls."""
    c = S.cohort(spark, sf)
    line = F.when(F.col("CUMPLIMIENTO") == "NINGUNA ACTIVIDAD",
                  F.concat_ws(";", F.col("USUARIO").cast("string"), F.col("CURID").cast("string"))).otherwise(
        F.concat_ws(";", F.col("USUARIO").cast("string"), F.col("CURID").cast("string"), F.col("ESCALA")))
    path = scratch_path(spark, "ragged")
    c.select(line.alias("value")).write.mode("overwrite").text(path)
    return io.read_delimited(spark, path, sep=";", header=False, names=["USUARIO", "CURID", "ESCALA"])


@register("replace_table", settle=["view", "click"],
          sql=Q.with_(Q.ACTIVITY, Q.ROSTER, _SCORES_SQL) + _SCORE_TABLE_BODY)
def q_replace_table(spark, sf):
    """Score table written over an existing file table, then read back."""
    path = scratch_path(spark, "table")
    first = S.roster(spark, sf).select("DNI")
    io.replace_files(first, path)
    io.replace_files(jobs.score_table(spark, sf), path)
    return io.read_files(spark, path)


@register("csv_quarantine", sql=Q.with_(Q.COHORT) + """,
m AS (SELECT CASE USUARIO % 7 WHEN 0 THEN 'too many fields' WHEN 2 THEN 'bad value' ELSE 'kept' END AS outcome,
             USUARIO, CASE WHEN USUARIO % 7 = 1 THEN NULL ELSE ESCALA END AS ESCALA FROM cohort)
SELECT outcome, count(*) AS n, CAST(sum(CASE WHEN outcome = 'kept' THEN USUARIO END) AS BIGINT) AS ids,
       count(CASE WHEN outcome = 'kept' THEN ESCALA END) AS n_escala FROM m GROUP BY outcome""")
def q_csv_quarantine(spark, sf):
    """Text with wide, short, quoted and unreadable rows: rows kept and rejected, by reason."""
    c = S.cohort(spark, sf)
    user, course = F.col("USUARIO").cast("string"), F.col("CURID").cast("string")
    kind = F.col("USUARIO") % 7
    line = (F.when(kind == 0, F.concat_ws(";", user, course, F.col("ESCALA"), F.lit("x")))
            .when(kind == 1, F.concat_ws(";", user, course))
            .when(kind == 2, F.concat_ws(";", user, F.lit("month"), F.col("ESCALA")))
            .when(kind == 3, F.concat(user, F.lit(";"), course, F.lit(';"a;'), F.col("ESCALA"), F.lit('"')))
            .otherwise(F.concat_ws(";", user, course, F.col("ESCALA"))))
    path = scratch_path(spark, "quarantine")
    c.select(line.alias("value")).write.text(path)
    kept, rejected = io.read_checked(spark, path, "USUARIO long, CURID long, ESCALA string")
    good = kept.agg(F.lit("kept").alias("outcome"), F.count(F.lit(1)).alias("n"), F.sum("USUARIO").alias("ids"), F.count("ESCALA").alias("n_escala"))
    none = F.lit(None).cast("long")
    return good.unionByName(rejected.groupBy(F.col("reason").alias("outcome")).agg(F.count(F.lit(1)).alias("n"), none.alias("ids"),
                                                                                   F.lit(0).cast("long").alias("n_escala")))


# ---------------------------------------------------------------- cleaning


@register("project", sql=Q.with_(Q.ACTIVITY) + """
SELECT CURID, IDNUMBER, FINALGRADE AS "%_E1" FROM activity""")
def q_project(spark, sf):
    """Column subset, one of them with a name that needs quoting."""
    act = clean.rename(S.activity(spark, sf), {"FINALGRADE": "%_E1"})
    return clean.project(act, ["CURID", "IDNUMBER", "%_E1"])


@register("filter_eq", sql=Q.with_(Q.SURVEY) + """
SELECT USUARIO, CURID FROM survey WHERE OPCION_ELEGIDA = 4""")
def q_filter_eq(spark, sf):
    return clean.filter_eq(S.survey(spark, sf), "OPCION_ELEGIDA", 4.0).select("USUARIO", "CURID")


@register("filter_ne_keep_nulls", sql=Q.with_(Q.SURVEY) + """
SELECT USUARIO, CURID, OPCION_ELEGIDA FROM survey WHERE OPCION_ELEGIDA IS DISTINCT FROM 2""")
def q_filter_ne_keep_nulls(spark, sf):
    """``!=`` that keeps unanswered rows (pandas mask semantics)."""
    return clean.filter_ne_keep_nulls(S.survey(spark, sf), "OPCION_ELEGIDA", 2.0).select(
        "USUARIO", "CURID", "OPCION_ELEGIDA")


@register("filter_ge", sql=Q.with_(Q.ACTIVITY) + """
SELECT event_id, FINALGRADE FROM activity WHERE FINALGRADE >= 10""")
def q_filter_ge(spark, sf):
    return clean.filter_ge(S.activity(spark, sf), "FINALGRADE", 10.0).select("event_id", "FINALGRADE")


@register("filter_in", sql=Q.with_(Q.ACTIVITY) + """
SELECT event_id, CURID, NOMBRE_ACTIVIDAD FROM activity
WHERE NOMBRE_ACTIVIDAD IN ('view', 'click', 'purchase') AND FINALGRADE >= 0""")
def q_filter_in(spark, sf):
    act = clean.filter_in(S.activity(spark, sf), {"NOMBRE_ACTIVIDAD": ["view", "click", "purchase"]})
    return clean.filter_ge(act, "FINALGRADE", 0.0).select("event_id", "CURID", "NOMBRE_ACTIVIDAD")


@register("dedup_rows", sql=Q.with_(Q.COHORT) + """
SELECT DISTINCT CURID, DNI_CARACTERIZADO, CUMPLIMIENTO FROM cohort""")
def q_dedup_rows(spark, sf):
    return clean.dedup_rows(S.cohort(spark, sf).select("CURID", "DNI_CARACTERIZADO", "CUMPLIMIENTO"))


@register("course_lookup", sql=Q.with_(Q.SURVEY) + """
SELECT l.CURID, l.DES_CURSO, c.n_answers
FROM (SELECT CURID, count(*) AS n_answers FROM survey GROUP BY CURID) c
LEFT JOIN (SELECT DISTINCT CURID, DES_CURSO FROM survey) l USING (CURID)""")
def q_course_lookup(spark, sf):
    """Distinct (course, title) lookup attached to per-course counts."""
    sv = S.survey(spark, sf)
    lookup = clean.distinct_projection(sv, ["CURID", "DES_CURSO"])
    counts = sv.groupBy("CURID").agg(F.count(F.lit(1)).alias("n_answers"))
    return counts.join(lookup, "CURID", "left").select("CURID", "DES_CURSO", "n_answers")


@register("duplicate_count", sql=Q.with_(Q.SURVEY) + """
SELECT CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS n_duplicates
FROM (SELECT count(*) AS n FROM survey GROUP BY IDNUMBER, CURID, OPCION_ELEGIDA)""")
def q_duplicate_count(spark, sf):
    """Answers repeating an earlier (teacher, course, answer); null equals null."""
    return clean.duplicate_count(S.survey(spark, sf), ["IDNUMBER", "CURID", "OPCION_ELEGIDA"])


@register("drop_nulls", sql=Q.with_(Q.SURVEY) + """
SELECT USUARIO, CURID, OPCION_ELEGIDA FROM survey WHERE OPCION_ELEGIDA IS NOT NULL""")
def q_drop_nulls(spark, sf):
    return clean.drop_nulls(S.survey(spark, sf).select("USUARIO", "CURID", "OPCION_ELEGIDA"))


@register("fill_nulls", sql=Q.with_(Q.SURVEY) + """
SELECT USUARIO, CURID, coalesce(OPCION_ELEGIDA, 3) AS OPCION_ELEGIDA FROM survey""")
def q_fill_nulls(spark, sf):
    return clean.fill_nulls(S.survey(spark, sf).select("USUARIO", "CURID", "OPCION_ELEGIDA"),
                            {"OPCION_ELEGIDA": 3})


@register("capped_per_class", sql=Q.with_(Q.COHORT) + """
SELECT CUMPLIMIENTO, USUARIO, NOTA FROM (
  SELECT *, row_number() OVER (PARTITION BY CUMPLIMIENTO ORDER BY USUARIO) AS rn FROM cohort)
WHERE rn <= 1000""")
def q_capped_per_class(spark, sf):
    """``TOP(1000)`` rows of each outcome class, by id (the cap is the feature)."""
    c = S.cohort(spark, sf).select("CUMPLIMIENTO", "USUARIO", "NOTA")
    return clean.capped_per_class(c, "CUMPLIMIENTO", 1000, ["USUARIO"])


@register("column_ops", sql=Q.with_(Q.COHORT) + """
SELECT DNI_CARACTERIZADO, CURID AS CURSO_MES, 1 AS DD FROM cohort""")
def q_column_ops(spark, sf):
    """Position-based projection, rename, drop and a constant column."""
    c = S.cohort(spark, sf)
    c = clean.project_by_position(c, [1, 2, 3])
    c = clean.drop_columns(c, ["CUMPLIMIENTO"])
    c = clean.rename(c, {"CURID": "CURSO_MES"})
    return clean.with_constant(c, "DD", 1)


# ---------------------------------------------------------------- joins


_DAYS_JOIN_SQL = """SELECT c.USUARIO, c.CURID, c.DNI_CARACTERIZADO, d.IDNUMBER, d.DIAS
FROM cohort c LEFT JOIN activity_days d ON c.CURID = d.CURID AND c.DNI_CARACTERIZADO = d.IDNUMBER"""


@register("activity_days_join", sql=Q.with_(Q.COHORT, Q.ACTIVITY_DAYS) + _DAYS_JOIN_SQL)
def q_activity_days_join(spark, sf):
    """Composite-key left join; the shared key appears once."""
    return jobs.cohort_prepared(spark, sf).select("USUARIO", "CURID", "DNI_CARACTERIZADO", "IDNUMBER", "DIAS")


@register("activity_share", sql=Q.with_(Q.COHORT, Q.ACTIVITY_DAYS) + """
SELECT c.USUARIO, c.CURID, d.DIAS,
       CASE c.CURID WHEN 1 THEN 28 WHEN 2 THEN 28 WHEN 3 THEN 41 END AS DURACION,
       round_even(CAST(d.DIAS AS DOUBLE) / CAST(CASE c.CURID WHEN 1 THEN 28 WHEN 2 THEN 28 WHEN 3 THEN 41 END
                  AS DOUBLE) * CAST(100 AS DOUBLE), 0) / CAST(100 AS DOUBLE) AS PORC_DIAS,
       round_even(c.Porc_act_realizada / CAST(100 AS DOUBLE) * CAST(100 AS DOUBLE), 0) / CAST(100 AS DOUBLE)
         AS Porc_act_realizada
FROM cohort c LEFT JOIN activity_days d ON c.CURID = d.CURID AND c.DNI_CARACTERIZADO = d.IDNUMBER""")
def q_activity_share(spark, sf):
    """Course length lookup, active-day share and percent -> share (2 decimals)."""
    return jobs.cohort_prepared(spark, sf).select("USUARIO", "CURID", "DIAS", "DURACION", "PORC_DIAS",
                                                  "Porc_act_realizada")


_ENRICH_SQL = """t1 AS (SELECT c_custkey AS DNI, c_nationkey + 20 AS EDAD FROM customer),
t2 AS (SELECT o_custkey AS DNI, count(*) AS TICKETS FROM orders WHERE o_orderpriority = '1-URGENT' GROUP BY o_custkey),
t3 AS (SELECT c_custkey AS DNI, c_acctbal AS PUNTAJE FROM customer)"""


def _enrich_tables(spark, sf):
    cust = S.table(spark, sf, "customer")
    t1 = cust.select(F.col("c_custkey").alias("DNI"), (F.col("c_nationkey") + 20).alias("EDAD"))
    t2 = (S.table(spark, sf, "orders").filter(F.col("o_orderpriority") == "1-URGENT")
          .groupBy(F.col("o_custkey").alias("DNI")).agg(F.count(F.lit(1)).alias("TICKETS")))
    t3 = cust.select(F.col("c_custkey").alias("DNI"), F.col("c_acctbal").alias("PUNTAJE"))
    return t1, t2, t3


@register("enrich_chain", sql=Q.with_(Q.COHORT, _ENRICH_SQL) + """
SELECT c.USUARIO, c.CURID, c.DNI_CARACTERIZADO, t1.DNI AS DNI_x, t1.EDAD, t2.DNI AS DNI_y, t2.TICKETS,
       t3.DNI, t3.PUNTAJE
FROM cohort c LEFT JOIN t1 ON c.DNI_CARACTERIZADO = t1.DNI
LEFT JOIN t2 ON c.DNI_CARACTERIZADO = t2.DNI
LEFT JOIN t3 ON t1.DNI = t3.DNI""")
def q_enrich_chain(spark, sf):
    """Three left joins on an id every table calls DNI: pandas suffix layout."""
    t1, t2, t3 = _enrich_tables(spark, sf)
    out = S.cohort(spark, sf).select("USUARIO", "CURID", "DNI_CARACTERIZADO")
    for table, key in ((t1, "DNI_CARACTERIZADO"), (t2, "DNI_CARACTERIZADO"), (t3, "DNI_x")):
        out = joins.merge(out, table, left_on=[key], right_on=["DNI"])
    return out


@register("group_overlap", sql=Q.with_(Q.COHORT) + """
SELECT DISTINCT a.CURID, a.DNI_CARACTERIZADO, 1 AS DD, 2 AS "DO"
FROM cohort a
WHERE a.CUMPLIMIENTO = 'CULMINARON' AND a.DNI_CARACTERIZADO IS DISTINCT FROM 10000000
  AND EXISTS (SELECT 1 FROM cohort b WHERE b.CUMPLIMIENTO = 'AL MENOS UNA ACTIVIDAD'
              AND b.CURID = a.CURID AND b.DNI_CARACTERIZADO = a.DNI_CARACTERIZADO)""")
def q_group_overlap(spark, sf):
    """(course, teacher) pairs present in both completion groups."""
    c = jobs.cohort_clean(spark, sf)
    done = clean.filter_eq(c, "CUMPLIMIENTO", "CULMINARON")
    some = clean.filter_eq(c, "CUMPLIMIENTO", "AL MENOS UNA ACTIVIDAD")
    both = joins.overlap_pairs(done, some, ["CURID", "DNI_CARACTERIZADO"])
    return both.withColumns({"DD": F.lit(1), "DO": F.lit(2)})


@register("day_key_left_join", sql=Q.with_(Q.ACTIVITY) + """
, done AS (SELECT DISTINCT CURID, IDNUMBER, strftime(FECHA_REALIZADA, '%Y-%m-%d') AS FECHA1
          FROM activity WHERE NOMBRE_ACTIVIDAD = 'purchase')
SELECT a.event_id, a.CURID, a.IDNUMBER, d.FECHA1
FROM activity a LEFT JOIN done d ON a.IDNUMBER = d.IDNUMBER AND a.CURID = d.CURID
     AND strftime(a.FECHA_REALIZADA, '%Y-%m-%d') = d.FECHA1
WHERE a.NOMBRE_ACTIVIDAD IN ('view', 'click')""")
def q_day_key_left_join(spark, sf):
    """Left join on (teacher, course, day text) to a completion view."""
    act = S.activity(spark, sf)
    done = (act.filter(F.col("NOMBRE_ACTIVIDAD") == "purchase")
            .select("CURID", "IDNUMBER", day_text("FECHA_REALIZADA").alias("FECHA1")).distinct())
    base = clean.filter_in(act, {"NOMBRE_ACTIVIDAD": ["view", "click"]}).withColumn(
        "_day", day_text("FECHA_REALIZADA"))
    j = base.join(done, (base.IDNUMBER == done.IDNUMBER) & (base.CURID == done.CURID) & (base._day == done.FECHA1),
                  "left")
    return j.select(base.event_id, base.CURID, base.IDNUMBER, done.FECHA1)


@register("semi_join", sql=Q.with_(Q.ACTIVITY, Q.ROSTER) + """
SELECT event_id, IDNUMBER, CURID FROM activity
WHERE IDNUMBER IN (SELECT DNI FROM roster WHERE NIVEL = 'ASIA')""")
def q_semi_join(spark, sf):
    """``IN (SELECT ...)`` as a left semi join."""
    asia = S.roster(spark, sf).filter(F.col("NIVEL") == "ASIA")
    return joins.semi_join(S.activity(spark, sf), asia, ["IDNUMBER"], ["DNI"]).select("event_id", "IDNUMBER", "CURID")


@register("reconcile", sql=Q.with_(Q.ENROL) + """
, a AS (SELECT ID_OFERTA_FORMATIVA, upper(NOMBRE) AS NOMBRE, count(DISTINCT USUARIO_DOCUMENTO) AS DOCENTE_x
        FROM enrol_a GROUP BY ID_OFERTA_FORMATIVA, NOMBRE),
b AS (SELECT CURID, upper(FULLNAME) AS FULLNAME, count(DISTINCT IDNUMBER) AS DOCENTE_y
      FROM enrol_b GROUP BY CURID, FULLNAME)
SELECT ID_OFERTA_FORMATIVA AS OFERTA_ID, NOMBRE AS OFERTA_NOMBRE, DOCENTE_x AS OFERTA_DOCENTE, CURID,
       FULLNAME AS CAMPUS_NOMBRE, DOCENTE_y AS CAMPUS_DOCENTE,
       CASE WHEN DOCENTE_x > DOCENTE_y THEN 1 WHEN DOCENTE_x < DOCENTE_y THEN 2 ELSE 3 END AS VAL_1
FROM a JOIN b ON a.NOMBRE = b.FULLNAME""")
def q_reconcile(spark, sf):
    """Enrolment counts of two systems matched by course name, compared per row."""
    return jobs.reconcile(spark, sf)


@register("reconcile_report", sql=Q.with_(Q.ENROL) + """
, a AS (SELECT upper(NOMBRE) AS NOMBRE, count(DISTINCT USUARIO_DOCUMENTO) AS x
        FROM enrol_a GROUP BY ID_OFERTA_FORMATIVA, NOMBRE),
b AS (SELECT upper(FULLNAME) AS FULLNAME, count(DISTINCT IDNUMBER) AS y FROM enrol_b GROUP BY CURID, FULLNAME)
SELECT CASE WHEN x > y THEN 1 WHEN x < y THEN 2 ELSE 3 END AS VAL_1, count(*) AS n_courses
FROM a JOIN b ON a.NOMBRE = b.FULLNAME GROUP BY 1""")
def q_reconcile_report(spark, sf):
    return jobs.reconcile_report(spark, sf)


# ---------------------------------------------------------------- scalar functions


@register("to_numeric", sql=Q.with_(Q.ACTIVITY) + """
, raw AS (SELECT event_id,
    CASE NOMBRE_ACTIVIDAD WHEN 'error' THEN IDNUMBER || 'd' WHEN 'signup' THEN ' ' || IDNUMBER || ' '
                          WHEN 'purchase' THEN IDNUMBER || 'e0' WHEN 'view' THEN 'x' || IDNUMBER
                          ELSE IDNUMBER END AS raw FROM activity)
SELECT event_id, raw,
       CASE WHEN regexp_matches(trim(raw), '[dDfF]$') THEN NULL ELSE TRY_CAST(trim(raw) AS DOUBLE) END AS IDNUMBER
FROM raw""")
def q_to_numeric(spark, sf):
    """Text ids with junk parsed to numbers, null where they do not parse."""
    act = S.activity(spark, sf)
    kind = F.col("NOMBRE_ACTIVIDAD")
    raw = (F.when(kind == "error", F.concat("IDNUMBER", F.lit("d")))
           .when(kind == "signup", F.concat(F.lit(" "), "IDNUMBER", F.lit(" ")))
           .when(kind == "purchase", F.concat("IDNUMBER", F.lit("e0")))
           .when(kind == "view", F.concat(F.lit("x"), "IDNUMBER"))
           .otherwise(F.col("IDNUMBER")))
    return act.select("event_id", raw.alias("raw")).withColumn("IDNUMBER", to_numeric("raw"))


@register("recode", sql=Q.with_(Q.COHORT) + """
SELECT USUARIO, CASE WHEN CUMPLIMIENTO = 'CULMINARON' THEN 0 ELSE 1 END AS target,
       CASE NIVEL WHEN 'AFRICA' THEN 1 WHEN 'AMERICA' THEN 2 WHEN 'ASIA' THEN 3 ELSE 4 END AS nivel
FROM cohort""")
def q_recode(spark, sf):
    """Binary and n-way recodes with a default branch."""
    c = S.cohort(spark, sf)
    return c.select("USUARIO", recode("CUMPLIMIENTO", {"CULMINARON": 0}, 1).alias("target"),
                    recode("NIVEL", jobs.LEVEL_CODES, jobs.LEVEL_OTHER).alias("nivel"))


@register("code_map", sql=Q.with_(Q.COHORT) + """
SELECT USUARIO, CURID, CASE CURID WHEN 1 THEN 28 WHEN 2 THEN 28 WHEN 3 THEN 41 END AS DURACION FROM cohort""")
def q_code_map(spark, sf):
    """Dictionary lookup: null where the key is missing."""
    c = S.cohort(spark, sf)
    return c.select("USUARIO", "CURID", code_map("CURID", jobs.COURSE_WEEKS).alias("DURACION"))


@register("round_half_even", sql="""
SELECT l_orderkey, l_linenumber,
       round_even(l_extendedprice / CAST(8 AS DOUBLE) * CAST(100 AS DOUBLE), 0) / CAST(100 AS DOUBLE) AS r2,
       round_even(l_extendedprice / CAST(8 AS DOUBLE), 0) AS r0
FROM lineitem""")
def q_round_half_even(spark, sf):
    """NumPy-style rounding (half to even on the scaled binary value)."""
    li = S.table(spark, sf, "lineitem")
    x = F.col("l_extendedprice") / F.lit(8.0)
    return li.select("l_orderkey", "l_linenumber", round_half_even(x, 2).alias("r2"), round_half_even(x, 0).alias("r0"))


@register("scalar_mix", sql="""
SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS DIA, upper(o_orderpriority || '-x') AS PRIORIDAD,
       CAST(o_custkey AS VARCHAR) AS DNI_TEXTO, CAST(trunc(o_totalprice) AS BIGINT) AS PRECIO_ENTERO
FROM orders""")
def q_scalar_mix(spark, sf):
    """Day text, upper case, casts to text and to integer."""
    od = S.table(spark, sf, "orders")
    return od.select(
        "o_orderkey",
        day_text("o_orderdate").alias("DIA"),
        F.upper(F.concat("o_orderpriority", F.lit("-x"))).alias("PRIORIDAD"),
        F.col("o_custkey").cast("string").alias("DNI_TEXTO"),
        F.col("o_totalprice").cast("long").alias("PRECIO_ENTERO"),
    )


# ---------------------------------------------------------------- profiling


@register("value_counts", sql=Q.with_(Q.COHORT) + """
SELECT CUMPLIMIENTO, count(*) AS "count" FROM cohort WHERE CUMPLIMIENTO IS NOT NULL GROUP BY 1""")
def q_value_counts(spark, sf):
    return profile.value_counts(S.cohort(spark, sf), "CUMPLIMIENTO")


@register("row_value_counts", sql=Q.with_(Q.COHORT) + """
SELECT CUMPLIMIENTO, NIVEL, count(*) AS "count" FROM cohort
WHERE CUMPLIMIENTO IS NOT NULL AND NIVEL IS NOT NULL GROUP BY 1, 2""")
def q_row_value_counts(spark, sf):
    return profile.row_value_counts(S.cohort(spark, sf), ["CUMPLIMIENTO", "NIVEL"])


@register("teachers_per_course", sql=Q.with_(Q.SURVEY) + """
SELECT DES_CURSO, count(DISTINCT IDNUMBER) AS n_teachers FROM survey GROUP BY 1""")
def q_teachers_per_course(spark, sf):
    return profile.count_distinct_per_group(S.survey(spark, sf), ["DES_CURSO"], "IDNUMBER", "n_teachers")


@register("distinct_totals", sql=Q.with_(Q.SURVEY) + """
SELECT count(DISTINCT USUARIO) + max(CASE WHEN USUARIO IS NULL THEN 1 ELSE 0 END) AS n_USUARIO,
       count(DISTINCT CURID) + max(CASE WHEN CURID IS NULL THEN 1 ELSE 0 END) AS n_CURID,
       count(DISTINCT OPCION_ELEGIDA) + max(CASE WHEN OPCION_ELEGIDA IS NULL THEN 1 ELSE 0 END)
         AS n_OPCION_ELEGIDA
FROM survey""")
def q_distinct_totals(spark, sf):
    """Distinct users, courses and answers; a null answer counts as a value."""
    return profile.distinct_totals(S.survey(spark, sf), ["USUARIO", "CURID", "OPCION_ELEGIDA"])


_FILLED = """filled AS (SELECT USUARIO, IDNUMBER, CURID, DES_CURSO,
                         CAST(coalesce(OPCION_ELEGIDA, 3) AS BIGINT) AS OPCION_ELEGIDA FROM survey)"""


@register("best_rated", settle=["mean_rating"], sql=Q.with_(Q.SURVEY, _FILLED) + """
SELECT CURID, mean_rating, row_number() OVER (ORDER BY mean_rating DESC, CURID) AS rank
FROM (SELECT CURID, avg(OPCION_ELEGIDA) AS mean_rating FROM filled GROUP BY CURID)""")
def q_best_rated(spark, sf):
    """Mean answer per course, sorted best first, with its rank."""
    f = answers_filled(S.survey(spark, sf))
    m = profile.mean_per_group(f, ["CURID"], "OPCION_ELEGIDA", "mean_rating")
    m = with_running_totals(m, [F.col("mean_rating").desc(), F.col("CURID")]).withColumn(POS, F.col(POS) + 1)
    return clean.sort_values(m.withColumnRenamed(POS, "rank"), ["mean_rating"], ascending=False, tie_break=["CURID"])


@register("best_rated_top5", settle=["mean_rating"], sql=Q.with_(Q.SURVEY) + """
, filled AS (SELECT CURID, CAST(coalesce(OPCION_ELEGIDA, 3) AS BIGINT) AS OPCION_ELEGIDA FROM survey)
SELECT CURID, avg(OPCION_ELEGIDA) AS mean_rating FROM filled GROUP BY CURID
ORDER BY mean_rating DESC, CURID LIMIT 5""")
def q_best_rated_top5(spark, sf):
    """The five best-rated courses (``head(5)`` of the sorted means; the limit is the report)."""
    f = answers_filled(S.survey(spark, sf))
    m = profile.mean_per_group(f, ["CURID"], "OPCION_ELEGIDA", "mean_rating")
    return clean.head(m, 5, [F.col("mean_rating").desc(), F.col("CURID").asc()])


_RATINGS2 = """ratings2 AS (SELECT CURID, IDNUMBER,
    round_even(avg(OPCION_ELEGIDA) * CAST(100 AS DOUBLE), 0) / CAST(100 AS DOUBLE) AS PUNTUACION
  FROM filled GROUP BY CURID, IDNUMBER)"""
_RATINGS0 = """ratings0 AS (SELECT CURID, USUARIO, CAST(round_even(avg(OPCION_ELEGIDA), 0) AS BIGINT) AS PUNTUACION
  FROM filled GROUP BY CURID, USUARIO)"""


@register("ratings", sql=Q.with_(Q.SURVEY, _FILLED, _RATINGS2) + "SELECT * FROM ratings2")
def q_ratings(spark, sf):
    """Mean answer per (course, teacher), 2 decimals half-even."""
    return ratings(S.survey(spark, sf))


@register("ratings_int", sql=Q.with_(Q.SURVEY, _FILLED, _RATINGS0) + "SELECT * FROM ratings0")
def q_ratings_int(spark, sf):
    """Integer ratings (0 decimals) keyed by the numeric user id."""
    return ratings(S.survey(spark, sf), user="USUARIO", digits=0)


@register("null_profile", sql=Q.with_(Q.SURVEY) + """
SELECT * FROM (
  SELECT 'USUARIO' AS "column", count(*) - count(USUARIO) AS n_null FROM survey UNION ALL
  SELECT 'IDNUMBER', count(*) - count(IDNUMBER) FROM survey UNION ALL
  SELECT 'CURID', count(*) - count(CURID) FROM survey UNION ALL
  SELECT 'DES_CURSO', count(*) - count(DES_CURSO) FROM survey UNION ALL
  SELECT 'OPCION_ELEGIDA', count(*) - count(OPCION_ELEGIDA) FROM survey)""")
def q_null_profile(spark, sf):
    return profile.null_profile(S.survey(spark, sf))


@register("column_info", sql=Q.with_(Q.COHORT) + """
, t AS (SELECT * FROM (VALUES
  (0, 'USUARIO', 'bigint'), (1, 'CURID', 'bigint'), (2, 'DNI_CARACTERIZADO', 'bigint'),
  (3, 'CUMPLIMIENTO', 'string'), (4, 'ESCALA', 'string'), (5, 'condicion_laboral', 'string'),
  (6, 'NIVEL', 'string'), (7, 'DAREACENSO', 'string'), (8, 'Porc_act_realizada', 'double'),
  (9, 'NOTA', 'double'), (10, 'MAX_FECHA', 'timestamp_ntz')) AS v(position, "column", dtype)),
nn AS (SELECT count(*) AS n_rows, count(USUARIO) AS c0, count(CURID) AS c1, count(DNI_CARACTERIZADO) AS c2,
              count(CUMPLIMIENTO) AS c3, count(ESCALA) AS c4, count(condicion_laboral) AS c5,
              count(NIVEL) AS c6, count(DAREACENSO) AS c7, count(Porc_act_realizada) AS c8,
              count(NOTA) AS c9, count(MAX_FECHA) AS c10 FROM cohort)
SELECT CAST(position AS BIGINT) AS position, "column", dtype,
       CASE position WHEN 0 THEN c0 WHEN 1 THEN c1 WHEN 2 THEN c2 WHEN 3 THEN c3 WHEN 4 THEN c4 WHEN 5 THEN c5
         WHEN 6 THEN c6 WHEN 7 THEN c7 WHEN 8 THEN c8 WHEN 9 THEN c9 ELSE c10 END AS non_null, n_rows
FROM t, nn""")
def q_column_info(spark, sf):
    """Type and non-null count per column, with the row count (``info``/``shape``)."""
    return profile.column_info(S.cohort(spark, sf))


@register("describe", settle=["mean", "std", "p25", "p50", "p75"], sql=Q.with_(Q.COHORT) + """
, long AS (UNPIVOT (SELECT CAST(CURID AS DOUBLE) AS CURID, Porc_act_realizada, NOTA FROM cohort)
           ON CURID, Porc_act_realizada, NOTA INTO NAME "column" VALUE value)
SELECT "column", count(value) AS "count", avg(value) AS mean, stddev_samp(value) AS std, min(value) AS min,
       quantile_cont(value, 0.25) AS p25, quantile_cont(value, 0.5) AS p50, quantile_cont(value, 0.75) AS p75,
       max(value) AS max
FROM long WHERE value IS NOT NULL GROUP BY 1""")
def q_describe(spark, sf):
    """count, mean, sample std, min, exact quartiles, max per numeric column."""
    return profile.describe(S.cohort(spark, sf), ["CURID", "Porc_act_realizada", "NOTA"])


@register("distinct_sketch", sql=Q.with_(Q.ACTIVITY) + """
SELECT CURID, count(DISTINCT CAST(FECHA_REALIZADA AS DATE)) AS n_days, true AS within FROM activity GROUP BY CURID""")
def q_distinct_sketch(spark, sf):
    """Teachers per course from sketches kept per course and day and merged; ``within``: 2 % of the exact count."""
    act = S.activity(spark, sf).withColumn("day", F.to_date("FECHA_REALIZADA"))
    path = scratch_path(spark, "sketches")
    profile.distinct_sketches(act, ["CURID", "day"], "IDNUMBER").write.parquet(path)
    daily = spark.read.parquet(path)
    told = profile.sketch_counts(profile.merge_sketches(daily, ["CURID"]))
    days = daily.groupBy("CURID").agg(F.count(F.lit(1)).alias("n_days"))
    exact = profile.count_distinct_per_group(act, ["CURID"], "IDNUMBER", "exact")
    return told.join(exact, "CURID").join(days, "CURID").select(
        "CURID", "n_days", (F.abs(F.col("n") - F.col("exact")) <= 0.02 * F.col("exact")).alias("within"))


@register("sparsity", sql=Q.with_(Q.SURVEY, _FILLED, _RATINGS2) + """
SELECT round_even((CAST(1 AS DOUBLE) - CAST(count(*) AS DOUBLE)
         / (CAST(count(DISTINCT IDNUMBER) AS DOUBLE) * CAST(count(DISTINCT CURID) AS DOUBLE)))
         * CAST(1000 AS DOUBLE), 0) / CAST(1000 AS DOUBLE) AS sparsity
FROM ratings2""")
def q_sparsity(spark, sf):
    """Share of empty cells in the teacher x course grid (3 decimals)."""
    return profile.sparsity(ratings(S.survey(spark, sf)), "IDNUMBER", "CURID")


@register("occupancy", sql=Q.with_(Q.SURVEY, _FILLED, _RATINGS2) + """
SELECT CURID, count(*) AS n_ratings FROM ratings2 GROUP BY CURID""")
def q_occupancy(spark, sf):
    """Filled cells per course of the rating grid."""
    return profile.occupancy(ratings(S.survey(spark, sf)), "CURID")


@register("occupancy_hist", settle=["bin_start"], sql=Q.with_(Q.SURVEY, _FILLED, _RATINGS2) + """
, occ AS (SELECT CAST(count(*) AS DOUBLE) AS x FROM ratings2 GROUP BY CURID),
b AS (SELECT min(x) AS lo, max(x) AS hi FROM occ),
w AS (SELECT lo, (hi - lo) / CAST(10 AS DOUBLE) AS width FROM b),
k AS (SELECT CAST(least(CASE WHEN width = 0 THEN 0 ELSE floor((x - lo) / width) END, 9) AS BIGINT) AS bin,
             lo, width FROM occ, w)
SELECT bin, lo + width * bin AS bin_start, count(*) AS n FROM k GROUP BY bin, lo, width""")
def q_occupancy_hist(spark, sf):
    """10-bin histogram of ratings per course."""
    occ = profile.occupancy(ratings(S.survey(spark, sf)), "CURID")
    return profile.histogram(occ, "n_ratings", 10)


@register("rating_averages", settle=["mean_rating"], sql=Q.with_(Q.SURVEY, _FILLED, _RATINGS0) + """
SELECT USUARIO, CURID, avg(PUNTUACION) AS mean_rating, count(*) AS n_ratings,
       CAST(GROUPING(USUARIO, CURID) AS BIGINT) AS "level"
FROM ratings0 WHERE PUNTUACION <> 0 GROUP BY GROUPING SETS ((USUARIO), (CURID), ())""")
def q_rating_averages(spark, sf):
    """User, course and global mean of non-zero ratings in one pass."""
    r = ratings(S.survey(spark, sf), user="USUARIO", digits=0)
    out = profile.grouped_means_nonzero(r, "USUARIO", "CURID", "PUNTUACION")
    return out.withColumn("level", F.col("level").cast("long"))


@register("corr_matrix", settle=["corr"], sql=Q.with_(Q.COHORT) + """
, c AS (SELECT CAST(CURID AS DOUBLE) AS a, Porc_act_realizada AS b, NOTA AS d FROM cohort),
p AS (SELECT corr(a, a) AS aa, corr(a, b) AS ab, corr(a, d) AS ad, corr(b, b) AS bb, corr(b, d) AS bd,
             corr(d, d) AS dd FROM c)
SELECT * FROM (
  SELECT 'CURID' AS col_a, 'CURID' AS col_b, aa AS corr FROM p UNION ALL
  SELECT 'CURID', 'Porc_act_realizada', ab FROM p UNION ALL SELECT 'Porc_act_realizada', 'CURID', ab FROM p UNION ALL
  SELECT 'CURID', 'NOTA', ad FROM p UNION ALL SELECT 'NOTA', 'CURID', ad FROM p UNION ALL
  SELECT 'Porc_act_realizada', 'Porc_act_realizada', bb FROM p UNION ALL
  SELECT 'Porc_act_realizada', 'NOTA', bd FROM p UNION ALL SELECT 'NOTA', 'Porc_act_realizada', bd FROM p UNION ALL
  SELECT 'NOTA', 'NOTA', dd FROM p)""")
def q_corr_matrix(spark, sf):
    """Pearson correlation of every pair of numeric columns (long form)."""
    return profile.corr_matrix(S.cohort(spark, sf), ["CURID", "Porc_act_realizada", "NOTA"])


# ---------------------------------------------------------------- reshape


@register("pivot_unique", sql=Q.with_(Q.ACTIVITY_DAYS) + """
SELECT IDNUMBER, """ + ", ".join(f'first(DIAS) FILTER (WHERE CURID = {m}) AS "{m}"' for m in range(1, 13)) + """
FROM activity_days GROUP BY IDNUMBER""")
def q_pivot_unique(spark, sf):
    """Active days per teacher with one column per course month; duplicates refused."""
    return reshape.pivot_unique(S.activity_days(spark, sf), "IDNUMBER", "CURID", "DIAS", list(range(1, 13)))


@register("sparse_sum", sql=Q.with_(Q.SURVEY, _FILLED) + """
SELECT IDNUMBER, CURID, CAST(sum(OPCION_ELEGIDA) AS BIGINT) AS total FROM filled GROUP BY IDNUMBER, CURID""")
def q_sparse_sum(spark, sf):
    """Sparse teacher x course build where duplicate cells add up."""
    f = answers_filled(S.survey(spark, sf))
    return reshape.sum_duplicates(f, ["IDNUMBER", "CURID"], "OPCION_ELEGIDA", "total").withColumn("total", F.col("total").cast("long"))


@register("centred_row_means", settle=["row_mean", "filled_mean"], sql=Q.with_(Q.SURVEY, _FILLED, _RATINGS2) + """
, c AS (SELECT IDNUMBER, PUNTUACION, PUNTUACION - avg(PUNTUACION) OVER (PARTITION BY IDNUMBER) AS centred FROM ratings2)
SELECT IDNUMBER, avg(PUNTUACION) AS row_mean,
       sum(centred) / (SELECT count(DISTINCT CURID) FROM ratings2) AS filled_mean
FROM c GROUP BY IDNUMBER""")
def q_centred_row_means(spark, sf):
    """Row means after centring, with empty cells counted as 0: all are 0 (the reference's check)."""
    r = ratings(S.survey(spark, sf))
    return reshape.filled_row_means(reshape.centre_by_row_mean(r, "IDNUMBER", "PUNTUACION"), "IDNUMBER", "CURID", "centred")


@register("centred_ratings", settle=["row_mean", "centred"], sql=Q.with_(Q.SURVEY, _FILLED, _RATINGS2) + """
SELECT CURID, IDNUMBER, PUNTUACION, avg(PUNTUACION) OVER (PARTITION BY IDNUMBER) AS row_mean,
       PUNTUACION - avg(PUNTUACION) OVER (PARTITION BY IDNUMBER) AS centred
FROM ratings2""")
def q_centred_ratings(spark, sf):
    """Rating minus the teacher's mean rating."""
    r = ratings(S.survey(spark, sf))
    return reshape.centre_by_row_mean(r, "IDNUMBER", "PUNTUACION").select(
        "CURID", "IDNUMBER", "PUNTUACION", "row_mean", "centred")


@register("melt", sql=Q.with_(Q.ACTIVITY, Q.ROSTER, _SCORES_SQL) + """
SELECT CURID, IDNUMBER, variable, round_even(value * CAST(1000 AS DOUBLE), 0) / CAST(1000 AS DOUBLE) AS value
FROM (UNPIVOT scores ON "view", "click" INTO NAME variable VALUE value)""")
def q_melt(spark, sf):
    """Wide scores back to long (course, teacher, activity, score to 3 decimals)."""
    long = reshape.melt(jobs.score_pivot(spark, sf), ["CURID", "IDNUMBER"], ["view", "click"])
    return long.withColumn("value", round_half_even("value", 3))


@register("union_classes", sql=Q.with_(Q.COHORT) + """
SELECT USUARIO, CUMPLIMIENTO, NOTA FROM cohort WHERE CUMPLIMIENTO = 'CULMINARON'
UNION ALL
SELECT USUARIO, CUMPLIMIENTO, NOTA FROM cohort WHERE CUMPLIMIENTO = 'NINGUNA ACTIVIDAD'""")
def q_union_classes(spark, sf):
    """Two class extracts appended (UNION ALL by name)."""
    c = S.cohort(spark, sf).select("USUARIO", "CUMPLIMIENTO", "NOTA")
    return reshape.append(clean.filter_eq(c, "CUMPLIMIENTO", "CULMINARON"),
                          clean.filter_eq(c, "CUMPLIMIENTO", "NINGUNA ACTIVIDAD"))


@register("topk_per_user", sql=Q.with_(Q.SURVEY, _FILLED, _RATINGS2) + """
SELECT CURID, IDNUMBER, PUNTUACION, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY IDNUMBER ORDER BY PUNTUACION DESC, CURID) AS rank FROM ratings2)
WHERE rank <= 3""")
def q_topk_per_user(spark, sf):
    """Three best-rated courses of each teacher (ties by course id)."""
    r = ratings(S.survey(spark, sf))
    return reshape.top_k_per_group(r, ["IDNUMBER"], "PUNTUACION", 3, ["CURID"]).withColumn(
        "rank", F.col("rank").cast("long"))


@register("block_slice", sql=Q.with_(Q.SURVEY, _FILLED, _RATINGS2) + """
SELECT * FROM ratings2
WHERE IDNUMBER IN (SELECT DISTINCT IDNUMBER FROM ratings2 ORDER BY IDNUMBER LIMIT 50)
  AND CURID IN (SELECT DISTINCT CURID FROM ratings2 ORDER BY CURID LIMIT 15)""")
def q_block_slice(spark, sf):
    """Cells of the first 50 teachers x first 15 courses in key order."""
    return reshape.block_slice(ratings(S.survey(spark, sf)), "IDNUMBER", "CURID", 50, 15)


@register("rating_distribution", sql=Q.with_(Q.SURVEY, _FILLED, _RATINGS0) + """
, o AS (SELECT *, row_number() OVER (ORDER BY CURID, USUARIO) - 1 AS pos, count(*) OVER () AS n FROM ratings0)
SELECT PUNTUACION, count(*) AS "count" FROM o WHERE pos < floor(CAST(n AS DOUBLE) * CAST(0.8 AS DOUBLE))
GROUP BY PUNTUACION""")
def q_rating_distribution(spark, sf):
    """Ratings per value in the ordered train part (data behind the count plot)."""
    r = ratings(S.survey(spark, sf), user="USUARIO", digits=0)
    train, _ = reshape.ordered_split(r, ["CURID", "USUARIO"], 0.8)
    return profile.value_counts(train, "PUNTUACION")


@register("ordered_split", sql=Q.with_(Q.SURVEY, _FILLED, _RATINGS0) + """
SELECT CURID, USUARIO, PUNTUACION,
       row_number() OVER (ORDER BY CURID, USUARIO) - 1 < floor(CAST((SELECT count(*) FROM ratings0) AS DOUBLE)
         * CAST(0.8 AS DOUBLE)) AS is_train
FROM ratings0""")
def q_ordered_split(spark, sf):
    """First 80 % of the ratings in (course, teacher) order is the train part."""
    r = ratings(S.survey(spark, sf), user="USUARIO", digits=0)
    return reshape.ordered_split_flag(r, ["CURID", "USUARIO"], 0.8).select("CURID", "USUARIO", "PUNTUACION",
                                                                           "is_train")
