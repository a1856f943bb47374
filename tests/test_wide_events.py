"""Wide events: numbered, joined and imputed without moving or storing them again."""

import pytest
from pyspark.sql import functions as F

from seqwise import session
from seqwise.operators.window import number_within
from seqwise.plans.features import attach, attach_colocated, side_tables
from seqwise.queries import chain, features
from seqwise.queries.rates import CFG
from seqwise.sources import fixtures
from seqwise.sources.bucketed import BLOCK, KEY, ROW, join_group_rows, stored_by, write_colocated
from seqwise.sources.fixtures import players, plays_colocated, plays_rows, plays_table

SF = "/root/testdata/sf0.001"


def bag(df):
    return sorted(map(repr, df.select(sorted(df.columns)).collect()))


@pytest.fixture
def unaided(spark):
    """No broadcast and no change of plan while it runs."""
    keep = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.adaptive.enabled", keep)
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def moved(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan, [x for x in plan.splitlines() if "Exchange hashpartitioning" in x]


def test_stored_plays_are_not_sorted_again(spark, unaided):
    """The stored plays meet what is joined by their number as they lie."""
    events = plays_rows(spark, SF)
    plan, _ = moved(attach(events, side_tables(events, players(spark, SF), CFG), CFG))
    assert "ShuffledHashJoin [__block" in plan and "Sort [__block" not in plan


def test_plays_are_dealt_once_and_a_long_drive_by_rows(spark, monkeypatch):
    by_drive = plays_rows(spark, SF)
    assert by_drive.filter(f"{BLOCK} <> drive").isEmpty() and by_drive.select(ROW).distinct().count() == by_drive.count()
    want = bag(by_drive.drop(ROW, BLOCK))
    monkeypatch.setattr(fixtures, "MAX_DRIVE", 3)
    monkeypatch.setattr(fixtures, "_STORED", {})
    by_rows = plays_rows(spark, SF)
    assert by_rows.filter(f"{BLOCK} <> shiftright({ROW}, 3)").isEmpty() and by_rows.groupBy(BLOCK).count().filter("count > 8").isEmpty()
    assert bag(by_rows.drop(ROW, BLOCK)) == want


def test_numbered_stores_move_narrow_rows_only(spark, unaided):
    store = plays_colocated(spark, SF)
    events = store.read(spark)
    side = side_tables(plays_table(spark, SF), players(spark, SF), CFG)
    got = attach_colocated(events, side, CFG)
    plan, exchanges = moved(got)
    # the narrow events to their actors and back, the actors' stats and the entity's rates
    assert len(exchanges) == 4 and "Bucketed: true" in plan
    want = attach(plays_table(spark, SF), side, CFG)
    assert ROW not in got.columns and bag(got) == bag(want)


def test_numbered_stores_meet_null_and_repeated_keys(spark):
    rows = [(k % 3 or None, k % 2, k, k % 4 or None, 1990 + k % 2) for k in range(40)] * 2
    df = spark.createDataFrame(rows, "e int, p int, o int, a int, s int")
    store = write_colocated(df, ["e", "p"], ["o"], 3, shape=lambda d: d.withColumn(ROW, F.monotonically_increasing_id()))
    left = store.read(spark)
    right = left.filter("o % 5 > 0").select(KEY, ROW, (F.col("o") * 2).alias("twice"))
    got = sorted((r.o, r.twice) for r in join_group_rows(left, right).collect())
    assert got == sorted((r[2], 2 * r[2]) for r in rows if r[2] % 5)
    assert store.largest_group == max(df.groupBy("e", "p").count().toPandas()["count"])
    store.drop(spark)


def test_notes_of_buckets_are_stored(spark):
    assert plays_rows(spark, SF).schema[BLOCK].metadata["buckets"] >= 4
    assert stored_by(spark.range(3), "id", 7).schema["id"].metadata == {"buckets": 7}


@pytest.mark.parametrize("query", ["q_imputed_events", "q_flags_label"])
def test_enriched_events_are_not_stored(spark, query, monkeypatch):
    plays_rows(spark, SF)
    before = len(session._STAGED)
    getattr(features, query)(spark, SF)
    assert not [p for p in session._STAGED[before:] if "enriched_events" in p]


def test_features_are_built_once_for_the_chain(spark):
    before = len(session._STAGED)
    chain.q_pipeline_windows(spark, SF)
    new = [p.rsplit("/", 1)[1].split("-")[0] for p in session._STAGED[before:]]
    assert new.count("prepared") == new.count("steps") == 1


def test_numbering_deals_the_events_once(spark, unaided):
    rows = [(k % 3 or None, None if k % 7 == 0 else k % 5, k) for k in range(60)] * 2
    df = spark.createDataFrame(rows, "g int, head int, o int")
    got = number_within(df, ["g"], ["head", "o"], "no", total="n")
    plan, exchanges = moved(got)
    # the events by their bucket; the sizes, their running sum and its way back
    assert len(exchanges) == 4 and sum("coalesce" in x for x in exchanges) == 0
    want = {}
    for g in (None, 1, 2):
        own = sorted((r for r in rows if r[0] == g), key=lambda r: (r[1] is None, r[1] or 0, r[2]))
        want[g] = [(r[1], r[2], k + 1, len(own)) for k, r in enumerate(own)]
    for g, w in want.items():
        assert [(r["head"], r.o, r.no, r.n) for r in got.filter(F.col("g").eqNullSafe(F.lit(g))).orderBy("no").collect()] == w
