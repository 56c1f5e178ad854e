from pizarra.plans import jobs


def test_reconcile_codes_per_row(spark):
    a = spark.createDataFrame(
        [(1, "Curso X", "t1"), (1, "Curso X", "t2"), (1, "Curso X", "t2"), (2, "curso y", "t1"),
         (3, "Solo A", "t9")],
        "ID_OFERTA_FORMATIVA long, NOMBRE string, USUARIO_DOCUMENTO string")
    b = spark.createDataFrame(
        [(10, "curso x", "t1"), (20, "CURSO Y", "t1"), (20, "CURSO Y", "t3"), (30, "curso z", "t1")],
        "CURID long, FULLNAME string, IDNUMBER string")
    out = {r.OFERTA_NOMBRE: (r.OFERTA_DOCENTE, r.CAMPUS_DOCENTE, r.VAL_1)
           for r in jobs.reconcile_systems(a, b).collect()}
    # matched case-insensitively; compared row by row, not by the first row
    assert out == {"CURSO X": (2, 1, 1), "CURSO Y": (1, 2, 2)}


def test_score_table_smoke(spark):
    from tests.conftest import SF_SMALL

    t = jobs.score_table(spark, SF_SMALL)
    assert set(r.NIVEL for r in t.select("NIVEL").distinct().collect()) <= {1, 2, 3, 4}
    assert t.filter("view IS NULL OR click IS NULL").count() == 0
