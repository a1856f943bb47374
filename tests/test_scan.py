"""Prefix scans over ranges: equal to plain windows, and no task with a whole group."""

import duckdb
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from seqwise.operators._util import asc_last
from seqwise.operators.scan import MAX_RANGES, Scan, bounds_below, hot_ranges, prefix_scan, with_range
from seqwise.operators.window import cumulative_sums, fill_downup, number_within

SCANS = {"no": Scan("number"), "total": Scan("sum", "x"), "strict": Scan("poisoned", "y"), "high": Scan("max", "x"),
         "low": Scan("min", "x - 1"), "last": Scan("last", "x"), "next": Scan("next", "x"), "v": Scan("down_up", "v")}


def rows(spark, n=3_000):
    """A hot key, a hot NULL key, small keys; NULL order values, sparse values."""
    i = F.col("id")
    key = F.when(i % 3 == 0, 1).when(i % 3 == 1, F.lit(None)).otherwise((i % 40).cast("int") + 2)
    return spark.range(n).select(
        key.alias("k"), F.when(i % 501 != 0, (i * 7919) % n).alias("o"), i.alias("tie"),
        F.when(i % 5 == 0, i % 13).alias("x"), F.when((i % 3 != 0) | (i * 7919 % n < n // 2), i % 7).alias("y"),
        F.when(i % 11 == 0, F.concat(F.lit("v"), i)).alias("v"))


def plain_window(df, order):
    w = Window.partitionBy("k").orderBy(*asc_last(order))
    up = w.rowsBetween(Window.unboundedPreceding, 0)
    down = w.rowsBetween(0, Window.unboundedFollowing)
    n = F.count(F.lit(1)).over(up)
    return df.withColumns({
        "no": n, "total": F.sum("x").over(up), "strict": F.when(F.count("y").over(up) == n, F.sum("y").over(up)),
        "high": F.max("x").over(up), "low": F.min(F.col("x") - 1).over(up), "last": F.last("x", True).over(up),
        "next": F.first("x", True).over(down),
        "v": F.coalesce(F.last("v", True).over(up), F.first("v", True).over(down))})


def sorted_rows(df):
    return sorted(map(tuple, df.select(sorted(df.columns)).collect()), key=repr)


@pytest.mark.parametrize("max_rows", [7, 700, 10_000])
def test_scans_equal_the_plain_window(spark, max_rows):
    df = rows(spark)
    assert sorted_rows(prefix_scan(df, ["k"], ["o", "tie"], SCANS, max_rows)) == sorted_rows(plain_window(df, ["o", "tie"]))


@pytest.mark.parametrize("kind", ["string", "date", "timestamp", "decimal(12,3)"])
def test_ranges_follow_the_order_of_any_type(spark, kind):
    base = F.col("id") * 37 % 900
    o = {"string": F.concat(F.lit("é"), F.lpad(base.cast("string"), 4, "0")), "date": F.date_add(F.lit("2001-01-01").cast("date"), base.cast("int")),
         "timestamp": F.timestamp_seconds(base)}.get(kind, base.cast(kind))
    df = spark.range(900).select(F.lit(1).alias("k"), F.when(F.col("id") != 450, o).alias("o"))
    got = prefix_scan(df, ["k"], ["o"], {"no": Scan("number")}, 50)
    want = df.withColumn("no", F.row_number().over(Window.partitionBy("k").orderBy(F.col("o").asc_nulls_last())).cast("bigint"))
    assert sorted_rows(got) == sorted_rows(want)


def test_one_order_column_uses_ranges(spark, monkeypatch):
    """number_within, fill_downup and the running sums on a single order column, against SQL."""
    from seqwise.operators import scan
    monkeypatch.setattr(scan, "MAX_ROWS", 40)
    df = spark.range(500).select((F.col("id") % 2).cast("int").alias("k"), (F.col("id") * 313 % 500).alias("o"),
                                 F.when(F.col("id") % 9 == 0, F.col("id")).alias("v"))
    pdf = df.toPandas()                                                    # noqa: F841 - read by the SQL below
    con = duckdb.connect()
    con.register("t", pdf)
    w = "(partition by k order by o rows between {} and {})"
    up, down = w.format("unbounded preceding", "current row"), w.format("current row", "unbounded following")
    want = con.execute(f"select k, o, row_number() over (partition by k order by o), count(*) over (partition by k), "
                       f"coalesce(last_value(v ignore nulls) over {up}, first_value(v ignore nulls) over {down}) from t").fetchall()
    got = fill_downup(number_within(df, ["k"], ["o"], "no", total="n"), ["k"], ["o"], "v")
    assert sorted((r.k, r.o, r.no, r.n, int(r.v)) for r in got.collect()) == sorted((a, b, c, d, int(e)) for a, b, c, d, e in want)
    assert dict(number_within(df, ["k"], ["o"], "no").dtypes)["no"] == "int"
    sums = cumulative_sums(df, ["k"], ["o"], {"s": "o", "p": "v"}, poisoned=True)
    want = con.execute(f"select k, o, sum(o) over {up}, case when count(v) over {up} = count(*) over {up} then sum(v) over {up} end from t").fetchall()
    assert sorted(((r.k, r.o, r.s, r.p) for r in sums.collect()), key=repr) == sorted(
        ((a, b, int(c), None if d is None else int(d)) for a, b, c, d in want), key=repr)


def test_a_hot_key_of_ten_million_rows_is_no_task(spark):
    """No partition sorts more than a fiftieth of the key, without help of AQE."""
    n = 10_000_000
    keep = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "400")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df = spark.range(n).select(F.lit("hot").alias("k"), F.col("id").alias("o"), (F.col("id") % 5).alias("x"))
        out = prefix_scan(df, ["k"], ["o"], {"no": Scan("number"), "s": Scan("sum", "x")}, 40_000)
        tasks = out.groupBy(F.spark_partition_id()).agg(
            F.count("*").alias("rows"), F.count_if(F.col("no") != F.col("o") + 1).alias("wrong"),
            F.count_if(F.col("s") != F.expr("o div 5 * 10 + (o % 5) * (o % 5 + 1) div 2")).alias("off"))
        got = tasks.agg(F.max("rows"), F.sum("rows"), F.sum("wrong"), F.sum("off")).first()
        assert tuple(got)[1:] == (n, 0, 0) and got[0] <= n // 50
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 1 and "__range" in plan
    finally:
        for k, v in keep.items():
            spark.conf.set(k, v)


def test_small_groups_are_not_cut(spark):
    df = rows(spark, 300)
    assert hot_ranges(df, ["k"], "o", 1_000) is None
    assert with_range(df, ["k"], "o", None).filter("__range <> 0").count() == 0
    bounds = hot_ranges(df, ["k"], "o", 50)
    assert {r.k for r in bounds.collect()} == {1, None} and all(1 <= len(r["__bounds"]) <= 3 for r in bounds.collect())


def test_unknown_scans_are_refused():
    with pytest.raises(ValueError):
        Scan("median", "x")
    with pytest.raises(ValueError):
        Scan("number", "x")
    with pytest.raises(ValueError):
        Scan("sum")


def test_the_range_of_a_row_is_found_by_halving(spark):
    """Every number of bounds, values on, between and beyond them; no pass over the bounds."""
    for n in (0, 1, 2, 5, 700, MAX_RANGES - 1):
        df = spark.range(2 * n + 3).select(F.expr("sequence(2, 2 * {0}, 2)".format(n) if n else "array()").cast("array<double>").alias("b"),
                                           F.col("id").cast("double").alias("v"))
        got = df.select("v", bounds_below("b", F.col("v")).alias("k"))
        assert {r.v: r.k for r in got.collect()} == {float(v): min(n, max(0, (v - 1) // 2)) for v in range(2 * n + 3)}
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "filter(" not in plan and "aggregate(" in plan
