import pandas as pd
from pyspark.sql import functions as F

from pizarra.operators import clean, joins


def test_same_named_keys_get_suffixes_and_lone_ones_keep_their_name(spark):
    people = spark.createDataFrame([("ana", 7), ("ben", 8)], "person string, badge long")
    rooms = spark.createDataFrame([(7, "attic")], "code long, room string")
    desks = spark.createDataFrame([(8, 3)], "code long, desk long")
    once = joins.merge(people, rooms, left_on=["badge"], right_on=["code"])
    assert once.columns == ["person", "badge", "code", "room"]
    twice = joins.merge(once, desks, left_on=["badge"], right_on=["code"])
    assert twice.columns == ["person", "badge", "code_x", "room", "code_y", "desk"]
    assert sorted(map(tuple, twice.collect())) == [("ana", 7, 7, "attic", None, None), ("ben", 8, None, None, 8, 3)]
    # the third table meets the suffixed key; its own key has no twin by then
    doors = spark.createDataFrame([(7, "red")], "code long, door string")
    thrice = joins.merge(twice, doors, left_on=["code_x"], right_on=["code"])
    assert thrice.columns == ["person", "badge", "code_x", "room", "code_y", "desk", "code", "door"]
    assert {r.person: r.door for r in thrice.collect()} == {"ana": "red", "ben": None}


def test_shared_key_once(spark):
    a = spark.createDataFrame([(1, 5)], "k long, a long")
    b = spark.createDataFrame([(1, 7)], "k long, b long")
    assert joins.merge(a, b, on=["k"]).columns == ["k", "a", "b"]


def test_null_keys_match_option(spark):
    a = spark.createDataFrame([(None, 1), (2, 2)], "k long, a long")
    b = spark.createDataFrame([(None, 9)], "k long, b long")
    sql_rules = joins.left_join(a, b, ["k"], ["k"]).filter(F.col("b").isNotNull()).count()
    pandas_rules = joins.left_join(a, b, ["k"], ["k"], null_keys="match").filter(F.col("b").isNotNull()).count()
    assert (sql_rules, pandas_rules) == (0, 1)


def test_duplicate_count_matches_pandas(spark):
    pdf = pd.DataFrame({"a": [1, 1, 1, 2, None, None], "b": ["x", "x", "y", "y", "z", "z"]})
    df = spark.createDataFrame(pdf.astype({"a": "float64"}))
    got = clean.duplicate_count(df, ["a", "b"]).first()[0]
    assert got == int(pdf.duplicated(["a", "b"]).sum())


def test_capped_per_class(spark):
    df = spark.createDataFrame([(c, i) for c in "ab" for i in range(10)], "c string, i long")
    out = clean.capped_per_class(df, "c", 3, ["i"]).collect()
    assert sorted((r.c, r.i) for r in out) == [(c, i) for c in "ab" for i in range(3)]


def test_fill_keeps_type(spark):
    df = spark.createDataFrame([(None,), (2,)], "x long")
    out = clean.fill_nulls(df, {"x": 3})
    assert out.schema["x"].dataType.simpleString() == "bigint"
    assert [r[0] for r in out.collect()] == [3, 2]


def test_capped_per_class_with_a_hot_and_a_null_class(spark):
    rows = [("a", i) for i in range(400)] + [("b", i) for i in range(3)] + [(None, i) for i in range(9)]
    df = spark.createDataFrame(rows, "c string, i long").repartition(5)
    out = clean.capped_per_class(df, "c", 7, ["i"]).collect()
    assert sorted((str(r.c), r.i) for r in out) == sorted([(c, i) for c in ("a", "None") for i in range(7)] + [("b", i) for i in range(3)])
