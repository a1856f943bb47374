"""Hot keys, NULL keys, plan shape and staging rules."""

import duckdb
import pytest
from pyspark.sql import functions as F

from seqwise.config import EventConfig
from seqwise.operators.aggregate import first_per_group, last_per_group
from seqwise.operators.impute import group_stat
from seqwise.operators.join import left_attach, lookup
from seqwise.operators.sequence import (
    number_steps, pad_steps, previous_step, rolling_windows, sequence_profile, step_windows,
)
from seqwise.plans.features import attach, joined_rate_means, merge_groups
from seqwise.plans.model import confusion
from seqwise.queries.rates import CFG
from seqwise.sources.fixtures import players, plays_table

SF = "/root/testdata/sf0.001"


def hot_events(spark, n=100_000):
    """One key holds n events (and a third of all others follow no order)."""
    hot = spark.range(n).select(F.lit(1).alias("k"), F.floor(F.col("id") / 500).cast("int").alias("d"), F.col("id").alias("o"))
    rest = spark.range(n // 2).select((F.col("id") % 5000 + 2).cast("int").alias("k"), F.lit(0).alias("d"), F.col("id").alias("o"))
    return hot.unionByName(rest).withColumns({"x": F.col("o").cast("double"), "y": (F.col("o") % 7).cast("int")})


def test_hot_key_windows_collect_n_steps(spark):
    n = 15
    steps = number_steps(hot_events(spark), ["k"], ["d", "o"], ["x"], "y")
    w = step_windows(steps, ["k"], n, truncate_tail=False)
    got = w.filter("k = 1").agg(F.count("*"), F.max(F.size("features")), F.min(F.size("features"))).first()
    assert tuple(got) == (100_000 - n, n, n)
    # window i holds events i..i+n-1 and its label is that of event i+n
    wrong = w.filter("k = 1").filter((F.col("features")[0][0] != F.col("window_index"))
                                     | (F.col("features")[n - 1][0] != F.col("window_index") + n - 1)
                                     | (F.col("label") != (F.col("window_index") + n) % 7))
    assert wrong.count() == 0
    assert step_windows(steps, ["k"], n).filter("k = 1").count() == 100_000 - 2 * n + 1


def test_hot_key_rolling_previous_and_profile(spark):
    e = hot_events(spark, 20_000)
    r = rolling_windows(e, ["k"], ["d", "o"], ["x"], 4, label="y")
    got = r.filter("k = 1")
    assert got.count() == 20_000 - 4
    assert got.filter((F.col("features")[3][0] != F.col("o") - 1) | (F.col("y") != F.col("o") % 7)).count() == 0
    p = previous_step(number_steps(e, ["k"], ["d", "o"], ["x"], "y"), ["k"], "label", "before").filter("k = 1")
    assert p.count() == 20_000 and p.filter("before IS NULL").count() == 1
    assert p.filter((F.col("pos") > 0) & (F.col("before") != (F.col("pos") - 1) % 7)).count() == 0
    s = sequence_profile(e, ["k"], 1).first()
    assert (s.sequences, s.min_len, s.max_len, s.total_steps) == (5001, 2, 20_000, 30_000)


@pytest.mark.parametrize("side", ["left", "right"])
@pytest.mark.parametrize("block", [4, 7, 1024])
def test_step_windows_equal_plain_slices(spark, side, block):
    sizes, n, length = {1: 1, 2: 9, 3: 23}, 4, 23
    rows = [(k, i // 5, i, float(i + 1), i % 3) for k, m in sizes.items() for i in range(m)]
    df = spark.createDataFrame(rows + [(None, 0, 0, 1.0, 1)], "k int, d int, o int, x double, y int")
    steps = pad_steps(number_steps(df, ["k"], ["d", "o"], ["x"], "y"), ["k"], length, side)
    want = []
    for k, m in sizes.items():
        real = [(float(i + 1), i % 3, False) for i in range(m)]
        none = [(0.0, 0, True)] * (length - m)
        s = real + none if side == "right" else none + real
        want += [(k, i, [x[0] for x in s[i:i + n]], s[i + n][1], s[i + n][2]) for i in range(length - 2 * n + 1)]
    w = step_windows(steps, ["k"], n, length, padding="flag", block=block)
    got = sorted((r.k, r.window_index, [v[0] for v in r.features], r.label, r.target_is_pad) for r in w.collect())
    assert got == want
    assert step_windows(steps, ["k"], n, length, padding="drop", block=block).count() == sum(not x[4] for x in want)


def test_too_short_a_pad_length_raises(spark):
    steps = number_steps(hot_events(spark, 100), ["k"], ["d", "o"], ["x"], "y")
    with pytest.raises(Exception, match="longer than 10"):
        pad_steps(steps, ["k"], 10).collect()


def test_first_after_descending_sort_puts_null_last(spark):
    df = spark.createDataFrame([("a", 1, 10), ("a", 2, 20), ("a", None, 99), ("b", None, 5)], "k string, o int, v int")
    assert {r.k: r.v for r in first_per_group(df, ["k"], ["o"]).collect()} == {"a": 20, "b": 5}
    assert {r.k: r.v for r in last_per_group(df, ["k"], ["o"]).collect()} == {"a": 99, "b": 5}
    want = duckdb.sql("select k, v from (values ('a', 1, 10), ('a', 2, 20), ('a', null, 99), ('b', null, 5)) t(k, o, v) "
                      "qualify row_number() over (partition by k order by o desc nulls last) = 1").fetchall()
    assert dict(want) == {"a": 20, "b": 5}


def test_lookup_null_meets_null(spark):
    facts = spark.createDataFrame([(1, "x"), (None, "y"), (3, "z")], "id int, v string")
    dim = spark.createDataFrame([(1, "one"), (None, "none"), (None, "none")], "key int, name string")
    got = {r.v: r.name for r in lookup(facts, dim, "id", "key", ["name"]).collect()}
    assert got == {"x": "one", "y": "none", "z": None}


def test_confusion_lists_and_checks_classes(spark):
    pred = spark.createDataFrame([(0, 0), (1, 2), (2, 2)], "label int, prediction int")
    got = {r.true_label: (r.pred_0, r.pred_1, r.pred_2, r.pred_3) for r in confusion(pred, [0, 1, 2, 3]).collect()}
    assert got == {0: (1, 0, 0, 0), 1: (0, 0, 1, 0), 2: (0, 0, 1, 0), 3: (0, 0, 0, 0)}
    for bad in ([(0, 7)], [(7, 0)], [(0, None)]):
        with pytest.raises(Exception, match="class not listed"):
            confusion(spark.createDataFrame(bad, "label int, prediction int"), [0, 1]).collect()


def null_keyed(spark):
    p = plays_table(spark, SF)
    return p.withColumns({
        "posteam": F.when(F.col("drive") % 11 != 0, F.col("posteam")),
        "passer": F.when(F.col("drive") % 13 != 0, F.col("passer")),
        "game_date": F.when(F.col("drive") % 17 != 0, F.col("game_date"))})


@pytest.mark.parametrize("nulls", [False, True])
def test_joined_rate_means_equal_the_joined_events(spark, nulls):
    """The means from the per-period tables are those of the joined events, to
    12 digits, NULL keys included."""
    from seqwise.plans.features import side_tables
    p = null_keyed(spark) if nulls else plays_table(spark, SF)
    side = side_tables(p, players(spark, SF), CFG)
    cols = ["pt_pass_pct", "pt_rush_epa_play", "dt_pass_pct", "dt_pass_wpa_play"]
    ev = left_attach(left_attach(p.select("posteam", "defteam", "season", "game_date"), side["pt"], ["posteam", "season", "game_date"]),
                     side["dt"], ["defteam", "season", "game_date"])
    want = {r.season: r for r in group_stat(ev, ["season"], cols).collect()}
    got = {r.season: r for r in joined_rate_means(side, CFG).collect()}
    assert set(want) == set(got)
    for s, r in want.items():
        for c in cols:
            a, b = r[f"__g_{c}"], got[s][f"__g_{c}"]
            assert (a is None and b is None) or abs(a - b) <= 1e-12 * max(1, abs(a)), (s, c)


def test_merge_groups_keeps_the_null_group(spark):
    a = spark.createDataFrame([(1, 1.0), (None, 2.0)], "k int, x double")
    b = spark.createDataFrame([(None, 3.0), (2, 4.0)], "k int, y double")
    assert {r.k: (r.x, r.y) for r in merge_groups([a, b], ["k"]).collect()} == {1: (1.0, None), None: (2.0, 3.0), 2: (None, 4.0)}


def test_attach_shuffles_the_events_five_times_at_most(spark):
    """Without any broadcast: one window, one join back, three attachments."""
    from seqwise.plans.features import side_tables
    p = plays_table(spark, SF)
    side = side_tables(p, players(spark, SF), EventConfig())
    keep = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled",)}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = attach(p, side, EventConfig())._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", keep["spark.sql.adaptive.enabled"])
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # six more shuffle small tables: the summary of the numbering (three) and the attached ones (three)
    assert plan.count("Exchange hashpartitioning") <= 5 + 6
    assert "hashpartitioning(season" not in plan


def test_season_fill_has_no_season_window(spark):
    from seqwise.plans.rates import asof_rates
    plan = asof_rates(plays_table(spark, SF), "posteam", "pt_", CFG)._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "hashpartitioning(season" not in plan


def test_shared_folder_is_required_off_a_local_master():
    from seqwise.session import checkpoint_dir

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return {}

    class Session:
        sparkContext = Context()
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_dir(Session())


def test_staged_folders_can_be_dropped(spark):
    from seqwise import session
    kept = list(session._STAGED)
    df = session.materialize(spark.range(3), spark, "dropped")
    path = session._STAGED[-1]
    assert df.count() == 3 and session.drop_staged(spark, keep=tuple(kept) or ("plays-",)) == 1
    fs = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    assert not fs.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(fs)


def test_readers_turn_nan_into_null(spark, tmp_path):
    from seqwise.sources.io import read_events
    spark.createDataFrame([(1, float("nan")), (2, 3.0)], "season int, x double").write.parquet(str(tmp_path / "t"))
    assert {r.season: r.x for r in read_events(spark, str(tmp_path / "t")).collect()} == {1: None, 2: 3.0}


def test_split_sink_writes_few_files(spark, tmp_path):
    import glob

    from seqwise.sources.io import write_splits
    df = spark.range(2000).select("id", F.lit("train").alias("split"), (F.col("id") % 3).alias("season")).repartition(16)
    write_splits(df, str(tmp_path / "s"), files=2)
    files = glob.glob(str(tmp_path / "s" / "*" / "*" / "*.parquet"))
    assert 3 <= len(files) <= 6 and spark.read.parquet(str(tmp_path / "s")).count() == 2000
