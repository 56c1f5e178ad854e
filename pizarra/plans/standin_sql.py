"""DuckDB text of the stand-in tables, for the oracle SQL.

Each constant is one ``name AS (...)`` common table expression mirroring the
builder of the same name in ``pizarra.sources.standins``.
"""

ACTIVITY = """activity AS (
  SELECT event_id,
         CAST(json_extract_string(props, '$.k') AS INTEGER) % 20 AS CURID,
         CAST(user_id AS VARCHAR) AS IDNUMBER,
         event_type AS NOMBRE_ACTIVIDAD,
         value AS FINALGRADE,
         ts AS FECHA_REALIZADA
  FROM events)"""

ROSTER = """roster AS (
  SELECT CAST(c_custkey AS VARCHAR) AS DNI, r_name AS NIVEL, c_mktsegment AS DESCRIPCION_CARGO,
         n_name AS D_DPTO, c_acctbal AS ESCALA_DOCENTE,
         CASE WHEN c_mktsegment = 'BUILDING' THEN 'Rural' ELSE 'Urbana' END AS DAREACENSO
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""

SURVEY = """survey AS (
  SELECT o_custkey AS USUARIO, CAST(o_custkey AS VARCHAR) AS IDNUMBER, l_suppkey AS CURID,
         'CURSO ' || CAST(l_suppkey AS VARCHAR) AS DES_CURSO,
         CASE WHEN l_returnflag = 'N' THEN NULL
              ELSE CAST(1 + CAST(trunc(l_quantity) AS INTEGER) % 4 AS DOUBLE) END AS OPCION_ELEGIDA
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""

COHORT = """cohort AS (
  SELECT o_orderkey AS USUARIO, CAST(month(o_orderdate) AS BIGINT) AS CURID, o_custkey AS DNI_CARACTERIZADO,
         CASE o_orderstatus WHEN 'F' THEN 'CULMINARON' WHEN 'O' THEN 'AL MENOS UNA ACTIVIDAD'
                            WHEN 'P' THEN 'NINGUNA ACTIVIDAD' END AS CUMPLIMIENTO,
         CASE WHEN o_orderkey % 9 = 8 THEN 'X' ELSE CAST(o_orderkey % 9 AS VARCHAR) END AS ESCALA,
         c_mktsegment AS condicion_laboral, r_name AS NIVEL, o_orderpriority AS DAREACENSO,
         CAST(o_orderkey % 101 AS DOUBLE) AS Porc_act_realizada, o_totalprice AS NOTA, o_orderdate AS MAX_FECHA
  FROM orders JOIN customer ON o_custkey = c_custkey
       JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""

ACTIVITY_DAYS = """activity_days AS (
  SELECT CAST(month(o_orderdate) AS BIGINT) AS CURID, o_custkey AS IDNUMBER,
         count(DISTINCT CAST(l_shipdate AS DATE)) AS DIAS
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  GROUP BY ALL)"""

ENROL = """offers AS (SELECT p_name, min(p_partkey) AS offer_id FROM part GROUP BY p_name),
enrol_lines AS (
  SELECT l_linestatus, o_custkey, p_name, offer_id
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
       JOIN offers USING (p_name)),
enrol_a AS (
  SELECT offer_id AS ID_OFERTA_FORMATIVA, p_name AS NOMBRE, CAST(o_custkey AS VARCHAR) AS USUARIO_DOCUMENTO
  FROM enrol_lines WHERE l_linestatus = 'O'),
enrol_b AS (
  SELECT offer_id AS CURID, lower(p_name) AS FULLNAME, CAST(o_custkey AS VARCHAR) AS IDNUMBER
  FROM enrol_lines WHERE l_linestatus = 'F')"""

PREDICTIONS = """predictions AS (SELECT doc_id, quality AS y_true, toxic AS y_pred FROM labels)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"
