"""Quantiles bracketed by stored, merged sketches: the same values, one pass over the events."""

import pytest
from pyspark.sql import functions as F

from seqwise.operators.quantile import exact_quantiles, quantile_summary
from seqwise.sources.fixtures import plays_columns, plays_table


def values(spark, n=40_000):
    i = F.col("id")
    return spark.range(n).select(
        F.when(i % 3 == 0, F.lit(None)).otherwise((i % 5).cast("int")).alias("g"), (i % 4).cast("int").alias("s"),
        (F.sin("id") * 1_000).alias("x"), F.when(i % 7 != 0, i % 10).alias("ties"), F.when(i % 20_000 == 1, i).alias("rare"))


def bag(df):
    return sorted(map(repr, df.select(sorted(df.columns)).collect()))


@pytest.mark.parametrize("q, seasons", [(0.35, (0, 1, 2, 3)), (0.0, (1,)), (0.99, (0, 2))])
def test_same_values_for_any_set_of_seasons(spark, tmp_path, q, seasons):
    df, cols = values(spark), ["x", "ties", "rare"]
    quantile_summary(df, ["g", "s"], cols).write.parquet(str(tmp_path / "q"))
    stored = spark.read.parquet(str(tmp_path / "q"))
    some = F.col("s").isin(list(seasons))
    got = exact_quantiles(df.filter(some), ["g"], cols, q, summary=stored.filter(some))
    want = df.filter(some).groupBy("g").agg(*[F.percentile(c, F.lit(q)).alias(f"__q_{c}") for c in cols])
    assert bag(got) == bag(want.filter(" OR ".join(f"__q_{c} IS NOT NULL" for c in cols)))


def test_summaries_leave_one_pass_over_the_values(spark, tmp_path):
    values(spark, 2_000).write.parquet(str(tmp_path / "events"))
    df = spark.read.parquet(str(tmp_path / "events"))
    stored = quantile_summary(df, ["g"], ["x"], k=512)
    stored.write.parquet(str(tmp_path / "q"))
    (st,) = {r.g: r for r in spark.read.parquet(str(tmp_path / "q")).collect() if r.g == 1}.values()
    assert st["__n"] == df.filter("g = 1").count() and len(st.sketch) < 20_000
    got = exact_quantiles(df, ["g"], ["x"], 0.5, stage=False, summary=spark.read.parquet(str(tmp_path / "q")), k=512)
    assert bag(got) == bag(df.groupBy("g").agg(F.percentile("x", F.lit(0.5)).alias("__q_x")))


def test_values_are_read_once_and_sketched_side_by_side(spark, tmp_path):
    """Null groups, columns without a value in a group, ties; no row for each value where Spark may sort,
    and after the brackets the values are counted by one pass."""
    values(spark).write.parquet(str(tmp_path / "events"))
    df, cols = spark.read.parquet(str(tmp_path / "events")), ["x", "ties", "rare"]
    stored = quantile_summary(df, ["g", "s"], cols)
    assert stored._jdf.queryExecution().analyzed().toString().index("explode") < \
        stored._jdf.queryExecution().analyzed().toString().index("kll_sketch_agg_double")      # above the aggregate
    long = df.select("g", "s", F.explode(F.array(*[F.struct(F.lit(c).alias("c"), F.col(c).cast("double").alias("v")) for c in cols])).alias("e"))
    want = long.filter("e.v IS NOT NULL").groupBy("g", "s", F.col("e.c").alias("__c")).agg(F.count("*").alias("__n"))
    assert bag(stored.drop("sketch")) == bag(want)
    stored.write.parquet(str(tmp_path / "q"))
    got = exact_quantiles(df, ["g"], cols, 0.35, stage=False, summary=spark.read.parquet(str(tmp_path / "q")))
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Generate") == 1                     # the groups whose bracket misses


def test_a_few_columns_of_the_plays_are_not_stored_with_all(spark, tmp_path):
    sf, cols = str(tmp_path / "sf"), ["posteam", "season", "epa", "wind"]
    day = F.to_timestamp(F.lit("1997-03-04"))
    i = F.col("id")
    some = lambda v, k: F.when(i % k != 0, v)
    tables = {
        "customer": spark.range(10).select(i.alias("c_custkey"), (i % 4).alias("c_nationkey"), (i * 500.0).alias("c_acctbal")),
        "supplier": spark.range(5).select(i.alias("s_suppkey"), (i % 3).alias("s_nationkey"), F.lit("s").alias("s_name")),
        "orders": spark.range(40).select(i.alias("o_orderkey"), some(i % 12, 9).alias("o_custkey"), day.alias("o_orderdate")),
        "lineitem": spark.range(200).select(
            (i % 45).alias("l_orderkey"), some(i, 7).alias("l_partkey"), (i % 5).alias("l_suppkey"), (i % 7).cast("int").alias("l_linenumber"),
            (i % 50).cast("double").alias("l_quantity"), some(i * 1.5, 11).alias("l_extendedprice"), F.lit(0.05).alias("l_discount"),
            F.lit(0.01).alias("l_tax"), F.lit("R").alias("l_returnflag"), F.lit("F").alias("l_linestatus"), day.alias("l_shipdate"))}
    tables["lineitem"] = tables["lineitem"].unionByName(tables["lineitem"].limit(20))
    for name, t in tables.items():
        t.write.parquet(f"{sf}/{name}.parquet")
    narrow = plays_columns(spark, sf, cols)
    assert "down" not in spark.read.parquet(narrow.inputFiles()[0]).columns
    assert plays_columns(spark, sf, cols).inputFiles() == narrow.inputFiles()
    assert bag(narrow) == bag(plays_table(spark, sf).select(cols)) and narrow.count() > 100
    assert set(plays_columns(spark, sf, cols).inputFiles()) == set(plays_table(spark, sf).inputFiles())
