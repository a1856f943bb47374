"""As-of joins on unequal times, bucketed padding, early stopping."""

import math
import random

import pytest
from pyspark.sql import functions as F

from seqwise.operators.join import asof_join
from seqwise.operators.sequence import bucket_lengths, length_histogram, number_steps, pad_steps, padding_report, step_windows
from seqwise.plans.model import Rounds, fit_rounds, stopping


# as-of join ---------------------------------------------------------------------

def sides(seed=5):
    rng = random.Random(seed)
    keys = [1] * 6 + [2, None, 3]
    left = [(rng.choice(keys), rng.choice([None, *range(0, 400, 3)]), i) for i in range(400)]
    times = rng.sample(range(400), 250)
    right = [(rng.choice(keys), t, rng.choice([None, "a", "b"]), t * 10) for t in times] + [(1, None, "no time", 0), (4, 5, "no event", 1)]
    return left, right


def brute_asof(left, right, equal, forward, tolerance):
    out = []
    for k, t, i in left:
        fits = [r for r in right if r[0] == k and r[1] is not None and t is not None
                and ((r[1] > t or equal and r[1] == t) if forward else (r[1] < t or equal and r[1] == t))]
        best = (min if forward else max)(fits, key=lambda r: r[1], default=None)
        if best is not None and tolerance is not None and abs(best[1] - t) > tolerance:
            best = None
        out.append((k, t, i, best and best[2], best and best[3]))
    return sorted(out, key=repr)


@pytest.mark.parametrize("equal, forward, tolerance, max_rows", [
    (True, False, None, 20), (False, False, 7, 20), (True, True, 7, 50), (False, True, None, 10_000)])
def test_asof_join_equals_brute_force(spark, equal, forward, tolerance, max_rows):
    left, right = sides()
    a = spark.createDataFrame(left, "k int, t int, i int")
    b = spark.createDataFrame(right, "k int, at int, v string, w int")
    got = asof_join(a, b, ["k"], "t", "at", {"state": "v", "other": "w"}, equal, forward, tolerance, max_rows)
    assert got.columns == ["k", "t", "i", "state", "other"]
    assert sorted(map(tuple, got.collect()), key=repr) == brute_asof(left, right, equal, forward, tolerance)


def test_asof_join_replaces_columns_and_forms_no_pairs(spark):
    left, right = sides()
    a = spark.createDataFrame(left, "k int, t int, v int")
    b = spark.createDataFrame(right, "k int, at int, v string, w int")
    got = asof_join(a, b, ["k"], "t", "at", {"v": "v"})
    assert got.columns == ["k", "t", "v"] and got.count() == len(left)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and "Window" in plan
    assert asof_join(a.limit(0), b, ["k"], "t", "at", {"v": "v"}).count() == 0
    assert asof_join(a, b.limit(0), ["k"], "t", "at", {"v": "v"}).filter("v IS NOT NULL").count() == 0


# padding -------------------------------------------------------------------------

def users(spark):
    """Many short keys, some of the same length, one long key."""
    sizes = {k: 3 + k % 17 for k in range(60)} | {100: 400, 101: 1}
    rows = [(k, i // 8, i, float(i + 1), i % 3) for k, m in sizes.items() for i in range(m)] + [(None, 0, 0, 1.0, 1)]
    return sizes, spark.createDataFrame(rows, "k int, d int, o int, x double, y int")


@pytest.mark.parametrize("factor", [1.1, 1.25, 2.0])
def test_pad_rows_stay_under_the_factor(spark, factor):
    sizes, df = users(spark)
    h = length_histogram(df, ["k"], factor)
    plan = bucket_lengths(h)
    assert set(plan) <= set(sizes.values()) and plan == sorted(plan) and plan[-1] == 400
    assert len(plan) <= math.log(400) / math.log(factor) + 1
    for n in sizes.values():
        assert n <= min(p for p in plan if p >= n) < factor * n or n in plan
    steps = number_steps(df, ["k"], ["d", "o"], ["x"], "y")
    per = {r.k: (r.n, r["length"], r.rows) for r in pad_steps(steps, ["k"], plan).groupBy("k", "n", "length").agg(F.count("*").alias("rows")).collect()}
    assert per == {k: (n, min(p for p in plan if p >= n), min(p for p in plan if p >= n)) for k, n in sizes.items()}
    report = {r.plan: r.pad_rows for r in padding_report(h).collect()}
    pads = sum(v[2] - v[0] for v in per.values())
    assert report == {"bucketed": pads, "longest": 400 * len(sizes) - sum(sizes.values())}
    assert pads < (factor - 1) * sum(sizes.values()) and pads * 10 < report["longest"]


def test_windows_of_events_are_those_of_exact_padding(spark):
    """Right padding: the windows with a real target are the same; exact mode is as it was."""
    _, df = users(spark)
    steps = number_steps(df, ["k"], ["d", "o"], ["x"], "y")
    plan = bucket_lengths(length_histogram(df, ["k"], 1.5))

    def bag(w):
        return sorted(map(repr, w.select("k", "window_index", "features", "label").collect()))
    exact = step_windows(pad_steps(steps, ["k"], 400), ["k"], 5, 400, truncate_tail=False, padding="drop")
    short = step_windows(pad_steps(steps, ["k"], plan), ["k"], 5, F.col("length"), truncate_tail=False, padding="drop")
    assert bag(short) == bag(exact)
    left = step_windows(pad_steps(steps, ["k"], plan, "left"), ["k"], 5, F.col("length"), truncate_tail=False, padding="drop")
    assert left.filter("k = 100").count() == 400 - 5
    assert "length" not in pad_steps(steps, ["k"], 400).columns
    with pytest.raises(Exception, match="longer than 10"):
        pad_steps(steps, ["k"], [5, 10]).collect()
    with pytest.raises(ValueError):
        length_histogram(df, ["k"], 1.0)


# early stopping --------------------------------------------------------------------

def by_hand(scores, patience, rounds):
    """The rule of the source: patience on the accuracy, the kept model by the loss."""
    best, wait, kept, early = -math.inf, 0, None, False
    for n, (loss, acc) in enumerate(scores[:rounds], 1):
        if loss is not None and (kept is None or loss < kept[1]):
            kept = (n, loss)
        if acc is not None and acc > best:
            best, wait = acc, 0
        else:
            wait += 1
            if wait >= patience:
                early = True
                break
    return n, kept[0] if kept else 1, kept[1] if kept else None, early


def test_stopping_follows_the_rule(spark):
    rng = random.Random(3)
    runs = {"falls": [(1.0 - k / 10, 0.5 + k / 100) for k in range(9)], "flat": [(1.0, 0.5)] * 30,
            "late": [(2.0 - k / 30, 0.5 if k < 4 else 0.6) for k in range(30)], "none": [(None, None)] * 7, "one": [(0.3, 0.9)]}
    runs |= {f"r{k}": [(rng.choice([None, rng.random()]), rng.choice([None, float("nan"), round(rng.random(), 1)])) for _ in range(rng.randint(1, 40))]
             for k in range(60)}
    rows = [(name, n, x, y) for name, s in runs.items() for n, (x, y) in enumerate(s, 1)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "run string, round int, valid_loss double, valid_accuracy double")
    for patience, rounds in ((5, 25), (1, 10), (3, 100)):
        got = {r.run: (r.stopped_at, r.best_round, r.best_loss, r.early) for r in stopping(df, ["run"], patience=patience, rounds=rounds).collect()}
        clean = {k: [(x, None if y is not None and math.isnan(y) else y) for x, y in s] for k, s in runs.items()}
        assert got == {k: by_hand(s, patience, rounds) for k, s in clean.items()}


def test_rounds_are_stored_and_resumed(spark, tmp_path):
    from pyspark.ml.feature import VectorAssembler
    df = spark.range(240).select((F.col("id") % 2).cast("double").alias("label"),
                                 ((F.col("id") % 2) * 2 - 1 + F.sin("id") / 2).alias("a"), F.cos("id").alias("b"))
    df = VectorAssembler(inputCols=["a", "b"], outputCol="vec").transform(df).cache()
    train, valid = df.filter("a < 10 AND pmod(cast(b * 1000 AS int), 3) <> 0"), df.filter("pmod(cast(b * 1000 AS int), 3) = 0")
    whole, run = fit_rounds(train, valid, str(tmp_path / "whole"), [2, 3, 2], rounds=4, patience=4, iterations=2)
    assert run.scores().count() == 4 == run.times().count()
    half = str(tmp_path / "half")
    fit_rounds(train, valid, half, [2, 3, 2], rounds=2, patience=4, iterations=2)
    assert Rounds(spark, half).scores().count() == 2
    again, resumed = fit_rounds(train, valid, half, [2, 3, 2], rounds=4, patience=4, iterations=2)
    a, b = ([(r.round, round(r.valid_loss, 6), r.valid_accuracy) for r in x.scores().orderBy("round").collect()] for x in (run, resumed))
    assert a == b and a[-1][1] < a[0][1]                          # each round goes on from the last
    assert [round(x, 6) for x in again.weights] == [round(x, 6) for x in whole.weights]
    best = min(a, key=lambda r: (r[1], r[0]))[0]
    assert run.verdict(4, 4).best_round == best
    third, _ = fit_rounds(train, valid, half, [2, 3, 2], rounds=4, patience=4, iterations=2)      # nothing left to do
    assert Rounds(spark, half).scores().count() == 4 and list(third.weights) == list(again.weights)
