"""Co-located events: the same results as the shuffling way, and fewer shuffles."""

import pytest
from pyspark.sql import functions as F

from seqwise.config import EventConfig
from seqwise.plans.features import attach, attach_colocated, build_features, side_tables
from seqwise.queries.rates import CFG
from seqwise.sources import bucketed
from seqwise.sources.bucketed import BLOCK, KEY, ROW, join_colocated, join_rows, key_text, numbered, write_colocated
from seqwise.sources.fixtures import players, plays_rows, plays_table

SF = "/root/testdata/sf0.001"


def null_keyed(spark):
    """Events with NULL entities, actors, periods and seasons, and periods of two seasons."""
    return plays_table(spark, SF).withColumns({
        "posteam": F.when(F.col("drive") % 11 != 0, F.col("posteam")), "passer": F.when(F.col("drive") % 13 != 0, F.col("passer")),
        "game_date": F.when(F.col("drive") % 17 != 0, F.col("game_date")),
        "season": F.when(F.col("drive") % 19 == 0, F.lit(None)).when(F.col("drive") % 23 == 0, 1997).otherwise(F.col("season"))})


def bag(df):
    return sorted(map(repr, df.select(sorted(df.columns)).collect()))


def test_key_text_is_exact(spark):
    rows = [("a", None), (None, "a"), ("a", ""), ("", "a"), (None, None), ("-", "-"), ("1:a", ""), ("1", ":a"), ("", "")]
    df = spark.createDataFrame(rows, "a string, b string").select(key_text(["a", "b"]).alias("k"))
    assert len({r.k for r in df.collect()}) == len(rows) and df.filter("k IS NULL").count() == 0


def test_attachments_equal_the_shuffling_way(spark):
    events = null_keyed(spark)
    store = write_colocated(events, ["posteam", "game_date"], ["drive", "play_id"], 6)
    side = side_tables(events, players(spark, SF), CFG)
    got = attach_colocated(store.read(spark), side, CFG)
    want = attach(events, side, CFG)
    assert sorted(got.columns) == sorted(want.columns) and bag(got) == bag(want)
    store.drop(spark)
    assert not spark.catalog.tableExists(store.table)


def test_join_colocated_matches_nulls_and_other_columns(spark):
    events = spark.createDataFrame([(1, 1, 5, "x"), (1, 1, 6, "y"), (None, 1, None, "z"), (2, None, 5, "w")], "e int, p int, s int, v string")
    side = spark.createDataFrame([(1, 1, 5, 0.5), (None, 1, None, 1.5), (2, 1, 5, 2.5)], "e int, p int, s int, r double")
    store = write_colocated(events, ["e", "p"], ["v"], 3)
    got = join_colocated(store.read(spark), side, ["e", "p"], ["s"]).drop(KEY)
    assert sorted((r.v, r.r) for r in got.collect()) == [("w", None), ("x", 0.5), ("y", None), ("z", 1.5)]


def test_stored_events_are_shuffled_twice(spark):
    """Without any broadcast: the window and the entity's rates need no exchange of the events."""
    events = plays_table(spark, SF)
    store = write_colocated(events, ["posteam", "game_date"], ["drive", "play_id"], 8)
    cfg = EventConfig()
    side = side_tables(events, players(spark, SF), cfg)
    keep = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = attach_colocated(store.read(spark), side, cfg)
        plan = got._jdf.queryExecution().executedPlan().toString()
        entity = join_colocated(store.read(spark), side["pt"], ["posteam", "game_date"], ["season"])
        first = entity._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", keep)
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # the events twice (opponent, actor), and the three attached tables
    assert plan.count("Exchange hashpartitioning") == 2 + 3 and "Bucketed: true" in plan
    assert first.count("Exchange hashpartitioning") == 1


def test_a_store_with_a_huge_group_takes_the_shuffling_way(spark, monkeypatch):
    events = plays_table(spark, SF)
    store = write_colocated(events, ["posteam", "game_date"], ["drive", "play_id"], 4)
    assert store.even and store.largest_group == events.groupBy("posteam", "game_date").count().agg(F.max("count")).first()[0]
    monkeypatch.setattr(bucketed, "MAX_GROUP_ROWS", 1)
    assert not store.even
    got = build_features(store, players(spark, SF), CFG, 1998, 2001)
    assert KEY not in got.columns and got.count() == build_features(events, players(spark, SF), CFG, 1998, 2001).count()
    with pytest.raises(ValueError):
        build_features(write_colocated(events, ["defteam"], ["drive"], 2), players(spark, SF), CFG)


def test_rows_meet_by_their_number(spark):
    """Each row its own, whatever else it holds: repeated and NULL rows, several matches, none."""
    df = numbered(spark.createDataFrame([(k % 5 or None, "x") for k in range(100)], "a int, b string").repartition(3))
    rows = spark.createDataFrame([tuple(r) for r in df.collect()], df.schema)
    right = rows.filter(f"{ROW} % 3 > 0").select(ROW, BLOCK, (F.col(ROW) * 2).alias("twice"))
    got = join_rows(rows, right.unionByName(right.filter(f"{ROW} % 3 = 1")))
    want = [(r.a, r[ROW], 2 * r[ROW]) for r in rows.collect() for _ in range({0: 0, 1: 2, 2: 1}[r[ROW] % 3])]
    assert sorted(((r.a, r[ROW], r.twice) for r in got.collect()), key=repr) == sorted(want, key=repr)


def test_stored_plays_stay_where_they_are(spark):
    """The events themselves are not shuffled by their attachment."""
    events = plays_rows(spark, SF)
    side = side_tables(events, players(spark, SF), CFG)
    keep = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = attach(events, side, CFG).filter("season = 1998")
        plan = got._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", keep)
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    moved = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    # the narrow events four times (window, its join back, actors, back to the rows), their
    # summary three times and the actors' stats
    assert len(moved) == 4 + 3 + 1 and "Bucketed: true" in plan
    want = attach(plays_table(spark, SF), side, CFG).filter("season = 1998")
    assert got.columns == want.columns and ROW not in got.columns and bag(got) == bag(want)
