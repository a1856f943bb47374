"""Micro-goldens for the missing-value rules and scalar helpers (FIXTURES §4)."""


import pytest
from pyspark.sql import functions as F

from seqwise.functions import (
    argmax, closed_flag, encode_by_list, label_of, mmss_to_seconds, na_cumsum, na_sum, ne_keep_null, not_in,
    r_ifelse, recode, safe_ratio, signed_by_side,
)
from seqwise.functions.semantics import running


def test_g1_poisoned_sum(spark):
    df = spark.createDataFrame([(1, 1), (1, None), (1, 1), (2, 1)], "g int, down int")
    out = dict(df.groupBy("g").agg(na_sum(r_ifelse(F.col("down") == 1, 1, 0)).alias("s")).collect())
    assert out == {1: None, 2: 1}


def test_g2_poisoned_running_sum(spark):
    df = spark.createDataFrame([(1, 1, 1), (1, 2, None), (1, 3, 3)], "g int, o int, x int")
    w = running(["g"], ["o"])
    got = [r.c for r in df.select(na_cumsum("x", w).alias("c"), "o").orderBy("o").collect()]
    assert got == [1, None, None]


def test_g3_safe_ratio(spark):
    r = spark.range(1).select(safe_ratio(F.lit(0), F.lit(0)).alias("a"), safe_ratio(F.lit(1), F.lit(4)).alias("b")).first()
    assert r.a is None and r.b == 0.25


def test_ifelse_null_condition(spark):
    df = spark.createDataFrame([(None,), (1,), (2,)], "d int")
    got = [r.v for r in df.select(r_ifelse(F.col("d") == 1, 10, 20).alias("v")).collect()]
    assert got == [None, 10, 20]


def test_g6_attempt_rule(spark):
    from seqwise.functions import attempt_rule
    df = spark.createDataFrame([(1, 0), (1, 1), (0, 1), (None, 0)], "rush int, pass int")
    assert [r.v for r in df.select(attempt_rule("rush", "pass").alias("v")).collect()] == [0, 1, 0, None]
    assert [r.v for r in df.select(attempt_rule("rush", "pass", "intended").alias("v")).collect()] == [1, 0, 0, None]


def test_g12_label(spark):
    rows = [("run", None, 0), ("run", "left", 0), ("run", "left", 1), ("qb_spike", None, None), ("run", "left", None)]
    df = spark.createDataFrame(rows, "pt string, loc string, db int")
    got = [r.v for r in df.select(label_of("pt", "db", "loc").alias("v")).collect()]
    assert got == ["run_middle", "run_left", "pass", "pass", None]


def test_g15_duration(spark):
    df = spark.createDataFrame([("3:07",), (None,), ("x:1",)], "d string")
    assert [r.v for r in df.select(mmss_to_seconds("d").alias("v")).collect()] == [187, None, None]


def test_g16_roof(spark):
    df = spark.createDataFrame([("dome",), ("closed",), ("outdoors",), ("open",), (None,)], "r string")
    assert [r.v for r in df.select(closed_flag("r").alias("v")).collect()] == [1, 1, 0, 0, 0]


def test_g17_keep_null_filter(spark):
    df = spark.createDataFrame([(4,), (1,), (None,)], "down int")
    assert sorted(df.filter(ne_keep_null("down", 4)).collect(), key=lambda r: (r.down is not None, r.down)) == \
        sorted(spark.createDataFrame([(None,), (1,)], "down int").collect(), key=lambda r: (r.down is not None, r.down))


def test_not_in_never_null(spark):
    df = spark.createDataFrame([("a",), (None,), ("kickoff",)], "t string")
    assert [r.v for r in df.select(not_in("t", ["kickoff"]).alias("v")).collect()] == [True, True, False]


def test_recode_and_list_encode(spark):
    df = spark.createDataFrame([("run_left",), ("field_goal",), ("kickoff",)], "t string")
    got = [r.v for r in df.select(recode("t", {"run_left": "run", "field_goal": "fg"}).alias("v")).collect()]
    assert got == ["run", "fg", None]
    ok = spark.createDataFrame([("pass",), ("fg",)], "t string")
    assert [r.v for r in ok.select(encode_by_list("t", ["fg", "pass", "punt", "run"]).alias("v")).collect()] == [1, 0]
    with pytest.raises(Exception):
        df.select(encode_by_list("t", ["fg", "pass"])).collect()


def test_spread_sign(spark):
    df = spark.createDataFrame([(3, "away"), (3, "home")], "s int, side string")
    assert [r.v for r in df.select(signed_by_side("s", "side").alias("v")).collect()] == [-3.0, 3.0]


def test_argmax(spark):
    df = spark.createDataFrame([([0.1, 0.7, 0.2],)], "p array<double>")
    assert df.select(argmax("p").alias("v")).first().v == 1


def test_g9_half_even(spark):
    df = spark.createDataFrame([(2.5,), (0.5,), (-2.5,)], "x double")
    assert [r.v for r in df.select(F.bround("x", 0).alias("v")).collect()] == [2.0, 0.0, -2.0]
