"""Audits observed by the write itself, and mergeable distinct counts."""

from pyspark.sql import functions as F

from seqwise.operators.aggregate import null_audit
from seqwise.sources.io import distinct_estimate, distinct_summary, write_splits_audited


def rows(spark, n=5_000):
    i = F.col("id")
    return spark.range(n).select(
        i, F.when(i % 7 != 0, i % 50).alias("odd name"), F.concat(F.lit("g"), (i % 211).cast("string")).alias("game"),
        F.element_at(F.array(*map(F.lit, ("train", "valid", "test"))), (i % 211 % 3 + 1).cast("int")).alias("split"), (i % 4).alias("season"))


def test_audit_is_that_of_the_written_rows_and_takes_no_other_job(spark, tmp_path):
    df = rows(spark)
    sc = spark.sparkContext
    sc.setJobGroup("audited", "one write")
    nulls, splits = write_splits_audited(df, str(tmp_path / "s"), "game", files=2)
    jobs = sc.statusTracker().getJobIdsForGroup("audited")
    sc.setJobGroup("after", "")
    assert len(jobs) <= 2                                      # the shuffle and the write
    back = spark.read.parquet(str(tmp_path / "s"))
    assert back.count() == df.count()
    assert dict(map(tuple, nulls.collect())) == dict(map(tuple, null_audit(back.select(df.columns)).collect()))
    want = {r.split: (r.n, r.g) for r in back.groupBy("split").agg(F.count("*").alias("n"), F.count_distinct("game").alias("g")).collect()}
    assert {r.split: (r.rows, r.games) for r in splits.collect()} == want


def test_empty_table(spark, tmp_path):
    nulls, splits = write_splits_audited(rows(spark).limit(0), str(tmp_path / "s"), "game")
    assert {r.n_null for r in nulls.collect()} == {0}
    assert {(r.split, r.rows, r.games) for r in splits.collect()} == {("train", 0, 0), ("valid", 0, 0), ("test", 0, 0)}


def test_distinct_sketches_merge_within_their_error(spark, tmp_path):
    df = spark.range(600_000).select((F.col("id") % 200_000).alias("v"), (F.col("id") % 7).alias("s"))
    distinct_summary(df, ["s"], "v").write.parquet(str(tmp_path / "d"))
    stored = spark.read.parquet(str(tmp_path / "d"))
    error = 3 * 1.04 / 2 ** 8
    assert abs(distinct_estimate(stored).first().n - 200_000) <= error * 200_000
    for r in distinct_estimate(stored, ["s"]).collect():
        n = df.filter(F.col("s") == r.s).select("v").distinct().count()
        assert abs(r.n - n) <= error * n
    whole = distinct_summary(df.withColumn("one", F.lit(1)), ["one"], "v")
    assert abs(distinct_estimate(whole).first().n - distinct_estimate(stored).first().n) <= error * 200_000
