import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from pizarra.functions import code_map, ne_keep_nulls, recode, round_half_even, to_numeric, try_ratio


def test_round_half_even_matches_numpy(spark):
    vals = [0.125, 1.005, 0.575, 1.115, 8.345, 0.285, 2.675, 2.5, -0.125, 12.3456]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    got = [r[0] for r in df.select(round_half_even("x", 2)).collect()]
    assert got == [float(np.round(v, 2)) for v in vals]
    got0 = [r[0] for r in df.select(round_half_even("x", 0)).collect()]
    assert got0 == [float(np.round(v, 0)) for v in vals]


def test_ne_keeps_nulls(spark):
    df = spark.createDataFrame([(1,), (2,), (None,)], "x int")
    assert sorted(df.filter(ne_keep_nulls("x", 2)).collect(), key=str) == sorted(
        [(1,), (None,)], key=str)


@pytest.mark.parametrize("text,expected", [
    (" 12 ", 12.0), ("1e3", 1000.0), ("inf", math.inf), ("-7.5", -7.5),
    ("1d", None), ("2f", None), ("0x1A", None), ("1_000", None), ("", None), ("nan", None), (None, None),
])
def test_to_numeric(spark, text, expected):
    df = spark.createDataFrame([(text,)], "s string")
    assert df.select(to_numeric("s")).first()[0] == expected


def test_recode_and_map(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "s string")
    rc = [r[0] for r in df.select(recode("s", {"a": 1, "b": 2}, 9)).collect()]
    assert rc == [1, 2, 9]
    cm = [r[0] for r in df.select(code_map("s", {"a": 10})).collect()]
    assert cm == [10, None, None]


def test_try_ratio_zero(spark):
    df = spark.createDataFrame([(1, 0), (1, 2)], "a int, b int")
    assert [r[0] for r in df.select(try_ratio("a", "b")).collect()] == [None, 0.5]
