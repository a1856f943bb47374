"""Invariants from SURVEY §5 on the sf0.001 fixtures."""

import pytest
from pyspark.sql import functions as F

from seqwise.operators.encode import minmax_scale
from seqwise.operators.sequence import pad, to_sequences, windows
from seqwise.operators.split import rule_split
from seqwise.plans.features import enrich_events
from seqwise.plans.model import confusion
from seqwise.plans.rates import asof_rates
from seqwise.queries.rates import CFG
from seqwise.queries.sequence import labelled_events
from seqwise.sources.fixtures import players, plays, plays_table

SF = "/root/testdata/sf0.001"


def test_splits_partition_rows_and_periods(spark):
    p = plays_table(spark, SF)
    kept = p.filter(F.col("season") >= 1998)
    s = rule_split(p, "season", "week", 1998, 2001)
    assert s.count() == kept.count()                      # every kept row in exactly one split
    crossing = s.groupBy("posteam", "season", "game_date").agg(F.count_distinct("split").alias("k"))
    assert crossing.filter(F.col("k") > 1).count() == 0   # no (entity, period) crosses splits


def test_enrichment_keeps_event_count(spark):
    p = plays_table(spark, SF)
    e = enrich_events(p, players(spark, SF), CFG, stage=False)
    assert e.count() == p.count()


def test_asof_rates_ignore_later_events(spark):
    """Shifted (unfilled) rates keyed at period k do not move when events at
    or after period k change."""
    p = plays_table(spark, SF)
    cut = "1997-06-01"
    changed = p.withColumn("pass_attempt", F.when(F.col("game_date") >= F.lit(cut).cast("date"),
                                                  1 - F.col("pass_attempt")).otherwise(F.col("pass_attempt")))
    keys = ["posteam", "season", "game_date"]
    a = asof_rates(p, "posteam", "pt_", CFG, fill=False).filter(F.col("game_date") <= F.lit(cut).cast("date"))
    b = asof_rates(changed, "posteam", "pt_", CFG, fill=False).filter(F.col("game_date") <= F.lit(cut).cast("date"))
    assert a.count() > 0
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_train_scaled_in_unit_interval(spark):
    p = rule_split(plays(spark, SF).select("season", "week", "wp", "epa", "temp"), "season", "week", 1998, 2001)
    train = p.filter(F.col("split") == "train")
    s = minmax_scale(train, ["wp", "epa", "temp"], fit_on=train)
    r = s.agg(*[F.min(c).alias(f"mn_{c}") for c in ["wp", "epa", "temp"]],
              *[F.max(c).alias(f"mx_{c}") for c in ["wp", "epa", "temp"]]).first()
    assert all(0.0 <= r[f"mn_{c}"] and r[f"mx_{c}"] <= 1.0 for c in ["wp", "epa", "temp"])


def test_windows_per_sequence(spark):
    seqs = to_sequences(labelled_events(spark, SF), ["user_id"], ["ts", "event_id"], ["value"], "label", max_len=102)
    w = windows(pad(seqs, 102, "left"), ["user_id"], 15)
    per = w.groupBy("user_id").count()
    assert per.filter(F.col("count") != 102 - 2 * 15 + 1).count() == 0
    assert per.count() == seqs.count()


def test_confusion_sums_to_rows(spark):
    e = labelled_events(spark, SF).withColumn("prediction", F.lit(1))
    c = confusion(e, [0, 1, 2, 3, 4])
    total = c.select(sum(F.col(f"pred_{k}") for k in range(5)).alias("t")).agg(F.sum("t")).first()[0]
    assert total == e.count()


def _k(t):
    return tuple((v is None, str(v)) for v in t)


@pytest.mark.parametrize("parts", [1, 4, 31])
def test_same_answer_for_any_partition_count(spark, parts):
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    try:
        got = asof_rates(plays_table(spark, SF), "posteam", "pt_", CFG)
        rows = sorted((tuple(r) for r in got.collect()), key=_k)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    ref = sorted((tuple(r) for r in asof_rates(plays_table(spark, SF), "posteam", "pt_", CFG).collect()), key=_k)
    assert rows == ref
