"""Micro-goldens for operators and composites (FIXTURES §4) plus invariants."""

import math

import pytest
from pyspark.sql import functions as F

from seqwise.config import EventConfig
from seqwise.operators.aggregate import class_weights, first_k_per_group, null_audit, period_facts
from seqwise.operators.encode import apply_labels, fit_labels, minmax_scale
from seqwise.operators.impute import fill_by_group, group_quantile
from seqwise.operators.sequence import SequenceTooLong, pad, rolling_windows, to_sequences, windows
from seqwise.operators.split import rule_split, split_report
from seqwise.operators.window import fill_downup, number_within
from seqwise.plans.model import class_report, confusion, rmse_codes


def _facts_input(spark, flags, passes):
    rows = [(1, 2020, "2020-09-01", 1, i + 1, 1, p, 1 - p, None, g, 5, 100, 10)
            for i, (g, p) in enumerate(zip(flags, passes))]
    return spark.createDataFrame(rows, "posteam int, season int, game_date string, drive int, play_id int, down int, "
                                       "pass_attempt int, rush_attempt int, run_location string, goal_to_go int, "
                                       "wp int, epa bigint, wpa bigint")


def test_g4_g5_shadowed_sum(spark):
    cfg = EventConfig(neutral_lo=1, neutral_hi=9)
    a = period_facts(_facts_input(spark, [0, 1, 0], [1, 0, 0]), "posteam", cfg).first()
    assert a.gtg_pass == 1 and a.goal_to_go == 1
    b = period_facts(_facts_input(spark, [1, 1, 0], [1, 1, 0]), "posteam", cfg).first()
    assert b.gtg_pass == 0 and b.goal_to_go == 2


def test_scripted_first_k(spark):
    cfg = EventConfig(neutral_lo=1, neutral_hi=9, scripted_k=2)
    f = period_facts(_facts_input(spark, [0, 0, 0], [1, 0, 1]), "posteam", cfg).first()
    assert f.scripted == 2 and f.scripted_pass == 1


def test_first_k_uses_group_limit(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("g"), F.col("id").alias("o"))
    out = first_k_per_group(df, ["g"], ["o"], 2)
    assert sorted((r.g, r.o) for r in out.collect()) == [(0, 0), (0, 3), (1, 1), (1, 4), (2, 2), (2, 5)]
    assert "WindowGroupLimit" in out._jdf.queryExecution().executedPlan().toString()


def test_g7_quantile(spark):
    df = spark.createDataFrame([(1, 1.0), (1, 2.0), (1, 4.0), (1, None)], "g int, x double")
    assert group_quantile(df, ["g"], "x", 0.2, "q").first().q == pytest.approx(1.4)


def test_g8_fill_downup_both_levels(spark):
    rows = [(1, 1, 1, None), (1, 1, 2, "a"), (1, 2, 1, None), (1, 3, 1, "b"), (1, 3, 2, None)]
    df = spark.createDataFrame(rows, "k int, d int, p int, v string")
    for two in (True, False):
        got = [r.v for r in fill_downup(df, ["k"], ["d", "p"], "v", two_level=two).orderBy("d", "p").collect()]
        assert got == ["a", "a", "a", "b", "b"]


def test_number_within_two_level_matches_window(spark):
    df = spark.range(500).select((F.col("id") % 4).alias("k"), (F.col("id") % 37).alias("d"), F.col("id").alias("p"))
    a = {(r.k, r.p): r.n for r in number_within(df, ["k"], ["d", "p"], "n").collect()}
    b = {(r.k, r.p): r.n for r in number_within(df, ["k"], ["d", "p"], "n", two_level=False).collect()}
    assert a == b and sorted(v for (k, _), v in a.items() if k == 0) == list(range(1, 126))


def test_mean_fill_and_rounded(spark):
    df = spark.createDataFrame([(1, 1.0), (1, None), (1, 2.0), (2, 2.5), (2, None)], "g int, x double")
    got = sorted((r.g, r.x) for r in fill_by_group(df, ["g"], ["x"], "mean").collect())
    assert got == [(1, 1.0), (1, 1.5), (1, 2.0), (2, 2.5), (2, 2.5)]
    got = sorted((r.g, r.x) for r in fill_by_group(df, ["g"], ["x"], "rounded_mean").collect())
    assert (1, 2.0) in got and (2, 2.0) in got


def test_g13_split(spark):
    rows = [(2021, 4), (2020, 4), (2020, 2), (2021, 2), (2019, 7), (2022, 1), (2015, 1)]
    df = spark.createDataFrame(rows, "season int, week int")
    got = {(r.season, r.week): r.split for r in rule_split(df).collect()}
    assert got == {(2021, 4): "train", (2020, 4): "valid", (2020, 2): "train", (2021, 2): "valid",
                   (2019, 7): "train", (2022, 1): "test"}


def test_split_report(spark):
    df = spark.createDataFrame([("a", "train"), ("a", "train"), ("b", "valid"), ("c", "test")], "game_id string, split string")
    r = split_report(df).first()
    assert (r.training_games, r.test_games) == (4, 2) and r.validation_split == 0.5 and r.test_split == pytest.approx(1 / 3)


def test_g18_label_codes_missing_last(spark):
    df = spark.createDataFrame([("run",), ("fg",), ("punt",), ("pass",), (None,)], "t string")
    got = {r.t: r.t_encoded for r in apply_labels(df, fit_labels(df, "t"), "t").collect()}
    assert got == {"fg": 0, "pass": 1, "punt": 2, "run": 3, None: 4}


def test_g19_minmax_constant(spark):
    train = spark.createDataFrame([(3.0,), (3.0,)], "x double")
    apply = spark.createDataFrame([(3.0,), (5.0,), (None,)], "x double")
    assert [r.x for r in minmax_scale(apply, ["x"], fit_on=train).collect()] == [0.0, 2.0, None]


def test_g20_class_weights(spark):
    df = spark.createDataFrame([("a",)] * 60 + [("b",)] * 40, "y string")
    got = {r.y: r.weight for r in class_weights(df, "y").collect()}
    assert got["a"] == pytest.approx(100 / 120) and got["b"] == pytest.approx(100 / 80)


def _seq(spark, n):
    rows = [(1, i, float(i + 1), i % 2) for i in range(n)]
    return to_sequences(spark.createDataFrame(rows, "k int, o int, x double, y int"), ["k"], ["o"], ["x"], "y")


def test_g21_pad_sides(spark):
    s = _seq(spark, 2)
    assert pad(s, 4, "right").first().features == [[1.0], [2.0], [0.0], [0.0]]
    assert pad(s, 4, "left").first().features == [[0.0], [0.0], [1.0], [2.0]]


def test_g22_pad_too_long(spark):
    with pytest.raises(Exception):
        pad(_seq(spark, 5), 3).collect()
    rows = [(1, i, 1.0, 0) for i in range(5)]
    with pytest.raises(SequenceTooLong):
        to_sequences(spark.createDataFrame(rows, "k int, o int, x double, y int"), ["k"], ["o"], ["x"], "y", max_len=3)


@pytest.mark.parametrize("L,n,count,last_target", [(91, 15, 62, 76), (102, 15, 73, 87)])
def test_g23_window_count(spark, L, n, count, last_target):
    w = windows(pad(_seq(spark, 40), L, "right"), ["k"], n)
    idx = sorted(r.window_index for r in w.collect())
    assert len(idx) == count and idx[-1] + n == last_target


def test_windows_content(spark):
    w = windows(pad(_seq(spark, 6), 6, "right"), ["k"], 2).orderBy("window_index").collect()
    assert [r.window_index for r in w] == [0, 1, 2]
    assert w[1].features == [[2.0], [3.0]] and w[1].label == 1


def test_rolling_windows(spark):
    df = spark.createDataFrame([(1, i, float(i)) for i in range(5)], "k int, o int, x double")
    got = {r.o: r.features for r in rolling_windows(df, ["k"], ["o"], ["x"], 3).collect()}
    assert got == {3: [[0.0], [1.0], [2.0]], 4: [[1.0], [2.0], [3.0]]}


def test_g24_rmse_and_confusion(spark):
    pred = spark.createDataFrame([(0, 0), (1, 3), (3, 3)], "label int, prediction int")
    assert rmse_codes(pred).first().rmse == pytest.approx(math.sqrt(4 / 3))
    conf = {r.true_label: r for r in confusion(pred, [0, 1, 2, 3]).collect()}
    assert conf[1].pred_3 == 1 and conf[3].pred_3 == 1 and conf[0].pred_0 == 1
    rep = {r.cls: r for r in class_report(pred).collect()}
    assert rep["3"].precision == 0.5 and rep["3"].recall == 1.0 and rep["macro avg"].support == 3


def test_null_audit(spark):
    df = spark.createDataFrame([(1, None), (None, None)], "a int, b string")
    assert {r.column_name: r.n_null for r in null_audit(df).collect()} == {"a": 1, "b": 2}


def test_number_and_fill_equals_separate_ops(spark):
    from seqwise.operators.window import number_and_fill
    df = spark.range(400).select((F.col("id") % 3).alias("k"), (F.col("id") % 29).alias("d"), F.col("id").alias("p"),
                                 F.when(F.col("id") % 7 == 0, F.col("id")).alias("v"))
    a = {(r.k, r.p): (r.n, r.v) for r in number_and_fill(df, ["k"], ["d", "p"], "n", ["v"]).collect()}
    sep = fill_downup(number_within(df, ["k"], ["d", "p"], "n", two_level=False), ["k"], ["d", "p"], "v", two_level=False)
    b = {(r.k, r.p): (r.n, r.v) for r in sep.collect()}
    assert a == b


@pytest.mark.parametrize("q", [0.0, 0.2, 0.25, 0.5, 1.0])
def test_exact_quantiles_equal_percentile(spark, q):
    import random
    from seqwise.operators.quantile import exact_quantiles
    rnd = random.Random(3)
    rows = []
    for g, n in enumerate([1, 2, 7, 300, 3000]):
        for _ in range(n):
            a = rnd.choice([1.0, 2.0, 2.0, 3.0]) if g % 2 else rnd.random()
            b = None if rnd.random() < 0.1 else float(rnd.randint(0, 20))
            rows.append((g, a, b))
    rows.append((9, None, None))
    df = spark.createDataFrame(rows, "g int, a double, b double")
    got = {r["g"]: (r["__q_a"], r["__q_b"]) for r in exact_quantiles(df, ["g"], ["a", "b"], q).collect()}
    ref = {r.g: (r.a, r.b) for r in df.groupBy("g").agg(F.percentile("a", F.lit(q)).alias("a"),
                                                         F.percentile("b", F.lit(q)).alias("b")).collect()}
    assert {k: got.get(k, (None, None)) for k in ref} == ref


def test_small_side_broadcasts_only_under_bound(spark):
    from seqwise.operators._util import small_side
    big = spark.range(1000).withColumn("g", F.col("id") % 10)
    stats = big.groupBy("g").agg(F.count(F.lit(1)).alias("n"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        small = big.join(small_side(stats, max_rows=10), "g")
        large = big.join(small_side(stats, max_rows=5), "g")
        small.collect(), large.collect()
        assert "BroadcastHashJoin" in small._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" not in large._jdf.queryExecution().executedPlan().toString()
        assert small.count() == large.count() == 1000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def test_number_and_fill_with_a_hot_group(spark):
    """One group holds a third of the rows; results equal the plain window."""
    from seqwise.operators.window import number_and_fill
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 97 + 1).alias("k"),
        (F.col("id") % 50).alias("d"), F.col("id").alias("p"),
        F.when(F.col("id") % 11 == 0, F.col("id")).alias("v"))
    a = {r.p: (r.n, r.v) for r in number_and_fill(df, ["k"], ["d", "p"], "n", ["v"]).collect()}
    sep = fill_downup(number_within(df, ["k"], ["d", "p"], "n", two_level=False), ["k"], ["d", "p"], "v",
                      two_level=False)
    assert a == {r.p: (r.n, r.v) for r in sep.collect()}
    assert max(n for n, _ in a.values()) == 1000


def test_q16_padded_targets(spark):
    s = _seq(spark, 20)
    for side in ("right", "left"):
        p = pad(s, 40, side)
        keep = windows(p, ["k"], 5).count()
        flag = windows(p, ["k"], 5, padding="flag").collect()
        drop = windows(p, ["k"], 5, padding="drop").collect()
        assert keep == len(flag) == 40 - 10 + 1
        real = [r.window_index for r in flag if not r.target_is_pad]
        # a target is real for exactly the starts whose step i+5 holds one of the 20 events
        expect = [i for i in range(31) if (i + 5 < 20 if side == "right" else i + 5 >= 20)]
        assert sorted(real) == expect and len(drop) == len(expect)


def test_fills_never_read_a_group_to_its_end_for_every_row(spark):
    """No frame that ends with the group: its time is the square of the group's rows."""
    from seqwise.operators.scan import Scan, prefix_scan
    from seqwise.operators.window import fill_downup, number_and_fill
    i = F.col("id")
    df = spark.range(3_000).select((i % 3).alias("k"), F.when(i % 301 != 0, i * 7 % 50).alias("a"), (i * 11 % 13).alias("b"),
                                   i.alias("c"), F.when(i % 29 == 0, i).alias("v"))
    order = ["a", "b", "c"]
    made = [fill_downup(df, ["k"], order, "v"), fill_downup(df, ["k"], order, "v", two_level=False),
            number_and_fill(df, ["k"], order, "no", ["v"]).drop("no"),
            prefix_scan(df, ["k"], order, {"v": Scan("down_up", "v")}, 100)]
    for got in made:
        assert "unboundedfollowing" not in got._jdf.queryExecution().optimizedPlan().toString().lower()
        assert got.columns == df.columns and sorted(map(repr, got.collect())) == sorted(map(repr, made[1].collect()))
