"""Appended periods: equal to a full rebuild, old events unread, failures repeatable."""

import pytest
from pyspark.sql import functions as F

from seqwise.plans.append import RateStore
from seqwise.plans.rates import asof_rates
from seqwise.queries.rates import CFG
from seqwise.sources.fixtures import plays_table

SF = "/root/testdata/sf0.001"


def bag(df):
    cols = sorted(df.columns)
    return sorted(repr([round(v, 9) if isinstance(v, float) else v for v in r]) for r in df.select(cols).collect())


def poisoned(spark):
    """A NULL measure in the middle of a season, and a NULL side."""
    p = plays_table(spark, SF)
    return p.withColumns({"epa": F.when((F.col("season") != 1996) | (F.col("week") != 5), F.col("epa")),
                          "posteam": F.when(F.col("posteam") != 3, F.col("posteam"))})


def test_appends_equal_a_full_rebuild(spark, tmp_path):
    p = poisoned(spark)
    at = F.col("season") * 100 + F.col("week")
    cuts = [0, 199603, 199607, 199608, 999999]
    store = RateStore(spark, str(tmp_path / "r"), "posteam", "pt_", CFG)
    for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
        assert store.append(p.filter((at > a) & (at <= b))) == k
        now = asof_rates(p.filter(at <= b), "posteam", "pt_", CFG, fill=False)
        if k in (1, 3):
            assert bag(store.unfilled()) == bag(now)
    assert bag(store.filled()) == bag(asof_rates(p, "posteam", "pt_", CFG))
    last = spark.read.parquet(f"{store.path}/state/batch=2")
    assert {r.season for r in last.select("season").distinct().collect()} == {1996}          # its own keys only


def test_periods_that_do_not_follow_are_refused(spark, tmp_path):
    p = plays_table(spark, SF).filter("season <= 1996")
    store = RateStore(spark, str(tmp_path / "r"), "posteam", "pt_", CFG)
    with pytest.raises(ValueError):
        store.unfilled()
    store.append(p.filter("season = 1995"))
    before = bag(store.unfilled())
    for bad in (p.filter("season = 1995 AND week = 12"), p.filter("season = 1996").withColumn("game_date", F.lit(None).cast("date"))):
        with pytest.raises(Exception, match="period not after"):
            store.append(bad)
        assert store.batches() == 1 and bag(store.unfilled()) == before                      # nothing half done counts
    store.append(p.filter("season = 1996"))
    assert bag(store.unfilled()) == bag(asof_rates(p, "posteam", "pt_", CFG, fill=False))


def test_an_append_reads_no_old_events(spark, tmp_path):
    """Old events can be gone: only the store and the new ones are read."""
    p = plays_table(spark, SF)
    p.filter("season < 1996").write.parquet(str(tmp_path / "old"))
    p.filter("season >= 1996").write.parquet(str(tmp_path / "new"))
    store = RateStore(spark, str(tmp_path / "r"), "defteam", "dt_", CFG)
    store.append(spark.read.parquet(str(tmp_path / "old")))
    (tmp_path / "old").rename(tmp_path / "gone")
    store.append(spark.read.parquet(str(tmp_path / "new")))
    assert bag(store.unfilled()) == bag(asof_rates(p, "defteam", "dt_", CFG, fill=False))
