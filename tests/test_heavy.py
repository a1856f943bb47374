"""Heavy-key joins: same rows as the plain join, even tasks without AQE."""

import pytest
from pyspark.sql import functions as F

from seqwise.operators._util import join_null_safe
from seqwise.operators.heavy import heavy_join, heavy_keys, key_hash, key_summary, merged


def events(spark, n=60_000):
    """A third NULL, a third of one actor, the others spread; the season splits both."""
    i = F.col("id")
    actor = F.when(i % 3 == 0, F.lit(None)).when(i % 3 == 1, 7).otherwise((i % 5_000).cast("int") + 10)
    return spark.range(n).select(actor.alias("a"), (i % 2).cast("int").alias("s"), i.alias("e"), (i % 9).alias("n"))


def seasons(spark):
    keys = [(None, 0), (None, 1), (7, 0), (7, 0), *[(k, k % 2) for k in range(10, 3_000)], (9_999_999, 1)]
    return spark.createDataFrame([(a, s, f"{a}/{s}/{k}") for k, (a, s) in enumerate(keys)], "a int, s int, v string")


def bag(df):
    return sorted(map(tuple, df.select(sorted(df.columns)).collect()), key=repr)


def test_summary_finds_the_heavy_keys_and_merges(spark):
    e = events(spark)
    per = key_summary(e, ["a", "s"], ["s"])
    want = {r.h for r in e.groupBy("a", "s").count().filter("count > 600").select(key_hash(["a", "s"]).alias("h")).collect()}
    assert len(want) == 4
    assert set(heavy_keys(key_summary(e, ["a", "s"]), 0.01)) == want == set(heavy_keys(merged(per), 0.01))
    assert len(heavy_keys(merged(per.filter("s = 0")), 0.01)) == 2
    assert heavy_keys(key_summary(e.limit(0), ["a", "s"])) == []
    with pytest.raises(ValueError):
        heavy_keys(key_summary(e, ["a"]), 1e-6)


@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize("mode, limits", [("broadcast", {}), ("salt", {}), ("broadcast", {"max_rows": 1})])
def test_same_rows_as_the_plain_join(spark, how, mode, limits):
    e, s = events(spark, 6_000), seasons(spark)
    got = heavy_join(e, s, ["a", "s"], how, share=0.01, mode=mode, salts=5, **limits)
    want = join_null_safe(e, s, ["a", "s"], how)
    assert got.columns == want.columns and bag(got) == bag(want)


def test_light_keys_need_no_special_way(spark):
    e = spark.range(3_000).select(F.col("id").alias("a"), F.lit(1).alias("x"))
    plan = heavy_join(e, e.withColumnRenamed("x", "y"), ["a"], share=0.01)._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" not in plan
    with pytest.raises(ValueError):
        heavy_join(e, e, ["a"], "full")


@pytest.mark.parametrize("mode", ["broadcast", "salt"])
def test_tasks_are_even_without_aqe(spark, mode):
    """No task of the join has more than a twentieth of the events; the plain join's has a third."""
    e, s = events(spark, 200_000), seasons(spark)
    keep = {k: spark.conf.get(k, None) for k in ("spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions",
                                                 "spark.sql.autoBroadcastJoinThreshold")}
    for k, v in zip(keep, ("false", "64", "-1")):
        spark.conf.set(k, v)

    def largest(df):
        per = df.groupBy(F.spark_partition_id().alias("t")).agg(F.count("*").alias("n"), F.count("v"))
        return per.agg(F.max("n"), F.sum("n")).first()
    try:
        e = e.repartition(64)
        heavy = heavy_keys(key_summary(e, ["a", "s"]), 0.005)
        most, total = largest(join_null_safe(e, s, ["a", "s"], "left"))
        assert most > total / 7
        got = heavy_join(e, s, ["a", "s"], heavy=heavy, mode=mode)
        most, rows = largest(got)
        assert rows == total and most <= total / 20
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert ("BroadcastHashJoin" in plan) == (mode == "broadcast")
    finally:
        for k, v in keep.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)
