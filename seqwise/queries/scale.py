"""Operators for groups and keys of any size: range-cut scans (W1, W2, W4, W11),
heavy-key joins (J5), co-located storage (S1, S5, C7),
as-of joins on unequal times (J6), bucketed padding (N3, N4), early stopping (M6),
appended periods (C1-C3), stored quantile summaries (W9, W10), the lookup reader (S2),
audits observed while writing (A9-A11)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from seqwise.operators.heavy import heavy_join, heavy_keys, key_summary, merged
from seqwise.operators.join import asof_join, lookup
from seqwise.operators.quantile import exact_quantiles, quantile_summary
from seqwise.operators.sequence import bucket_lengths, length_histogram, pad_steps, padding_report, step_windows
from seqwise.operators.split import rule_split
from seqwise.operators.scan import Scan, prefix_scan
from seqwise.plans.append import RateStore
from seqwise.plans.features import build_features, enrich_events
from seqwise.plans.model import evaluate, fit_rounds, stopping
from seqwise.queries._common import rnd, rounded
from seqwise.queries._sql import with_plays
from seqwise.queries.features import DOUBLES, ENRICH_CTES, ENRICH_OUT, MIN_SEASON, SPLIT_EXPR, TEST_SEASON, _round_cols
from seqwise.queries.features import ORACLE as FEATURE_ORACLE
from seqwise.queries.model import CLASSES, window_table
from seqwise.queries.rates import CFG, asof_sql
from seqwise.queries.rates import ORACLE as RATE_ORACLE
from seqwise.queries.sequence import EV, KEYS, WIN, _scalars, steps
from seqwise.session import checkpoint_dir, materialize
from seqwise.sources.fixtures import events, players, plays_colocated, plays_columns, plays_rows, plays_table as plays
from seqwise.sources.io import distinct_estimate, distinct_summary, read_lookup, write_splits_audited

# a group with more rows is cut by ranges of its order column; small, so that the
# nations of the test tables are cut at every scale factor
MAX_ROWS = 500
EVENT_KEY = "drive * 64 + play_id"      # one order column


def _ordered(spark, sf):
    p = plays(spark, sf).select("posteam", "drive", "play_id", "passer", "air_yards", "wind", "epa")
    return p.withColumn("event_key", F.expr(EVENT_KEY).cast("bigint"))


def q_scan_number_fill(spark, sf):
    """W1, W2, W11 over one order column: number and both fills per entity."""
    return prefix_scan(_ordered(spark, sf).select("posteam", "event_key", "passer"), ["posteam"], ["event_key"], {
        "event_no": Scan("number"), "passer_before": Scan("last", "passer"), "passer": Scan("down_up", "passer")}, MAX_ROWS)


def q_scan_running(spark, sf):
    """W4 over one order column: running sums, skipping and poisoned, and extremes."""
    return prefix_scan(_ordered(spark, sf).drop("drive", "play_id", "passer"), ["posteam"], ["event_key"], {
        "epa_so_far": Scan("sum", "epa"), "air_so_far": Scan("sum", "air_yards"), "air_strict": Scan("poisoned", "air_yards"),
        "wind_high": Scan("max", "wind"), "epa_low": Scan("min", "epa")}, MAX_ROWS)


def _actor_seasons(spark, sf):
    return plays(spark, sf).groupBy("passer", "season").agg(
        F.count(F.lit(1)).alias("n_events"), F.sum("epa").alias("sum_epa"))


def q_heavy_actor_join(spark, sf):
    """Every event meets its actor's season, NULL actors each other; the heavy
    actors come from summaries stored per season and merged."""
    p = plays(spark, sf).select("drive", "play_id", "passer", "season")
    stored = materialize(key_summary(p, ["passer", "season"], ["season"]), name="key_summaries")
    heavy = heavy_keys(merged(stored), 0.01)
    return heavy_join(p, _actor_seasons(spark, sf), ["passer", "season"], heavy=heavy)


def q_heavy_enriched(spark, sf):
    """C7 with the heavy actors of a period salted in its last join."""
    return rounded(enrich_events(plays_rows(spark, sf), players(spark, sf), CFG, heavy_share=0.001))


def q_feature_table_colocated(spark, sf):
    """C10 from events stored in buckets by (entity, period): two shuffles of the events."""
    return rounded(build_features(plays_colocated(spark, sf), players(spark, sf), CFG, MIN_SEASON, TEST_SEASON))


def q_asof_join(spark, sf):
    """J6 on unequal times: every event with the state its entity had after the last
    drive that ended before it; the state is at most 40,000 keys old."""
    p = _ordered(spark, sf)
    ends = p.groupBy("posteam", "drive").agg(F.count(F.lit(1)).alias("n"), F.sum("epa").alias("epa"))
    ends = ends.withColumn("ended", (F.col("drive") * 64 + 40).cast("bigint"))
    return asof_join(p.select("posteam", "event_key"), ends, ["posteam"], "event_key", "ended",
                     {"last_end": "ended", "last_events": "n", "last_epa": "epa"}, tolerance=40_000, max_rows=MAX_ROWS)


def q_asof_join_next(spark, sf):
    """The other direction: the first event of the opponent side strictly after each event."""
    p = plays(spark, sf).select("posteam", "defteam", F.expr(EVENT_KEY).cast("bigint").alias("event_key"))
    other = p.select(F.col("posteam").alias("defteam"), F.col("event_key").alias("next_key"))
    return asof_join(p, other, ["defteam"], "event_key", "next_key", {"answer": "next_key"}, allow_equal=False, forward=True,
                     max_rows=MAX_ROWS)


FACTOR = 1.25


def _bucketed(spark, sf, side):
    return pad_steps(steps(spark, sf), KEYS, bucket_lengths(length_histogram(events(spark, sf), KEYS, FACTOR)), side)


def q_pad_bucketed(spark, sf):
    """N4 by the bucket plan: a user is padded to the longest of those of a like length."""
    return _scalars(_bucketed(spark, sf, "left")).select(*KEYS, "pos", "length", "value", "hr", "label", "is_pad")


def q_windows_bucketed(spark, sf):
    """N5, N6 over bucketed steps: all windows whose target is an event."""
    w = step_windows(_bucketed(spark, sf, "right"), KEYS, WIN, F.col("length"), truncate_tail=False, padding="drop")
    return w.select(*KEYS, "window_index", F.transform("features", lambda v: v[0])[0].alias("first_value"), "label")


def q_padding_report(spark, sf):
    return padding_report(length_histogram(events(spark, sf), KEYS, FACTOR))


def _score_table(spark, sf):
    """A run of scores for every user: its events as rounds."""
    e = _rounds(events(spark, sf))
    return e.select("user_id", "round", (F.col("value") / 10).alias("valid_loss"),
                    F.when(F.col("event_id") % 17 != 0, (F.col("event_id") * 37 % 101).cast("double")).alias("valid_accuracy"))


def _rounds(e):
    return prefix_scan(e, ["user_id"], ["event_id"], {"round": Scan("number")})


def q_early_stopping(spark, sf):
    """M6: the stopping round and the kept round of many score lists."""
    return rounded(stopping(_score_table(spark, sf), ["user_id"]))


def q_train_early_stop(spark, sf):
    """A network trained in stored, warm-started rounds; the scores of every
    round, which one is kept, and its test scores."""
    w = materialize(window_table(spark, sf), spark, "windows")
    train, valid, test = (w.filter(F.col("split") == s) for s in ("train", "valid", "test"))
    width = len(w.select("vec").first().vec)
    path = f"{checkpoint_dir(spark).rstrip('/')}/rounds-{uuid.uuid4().hex}"
    model, run = fit_rounds(train, valid, path, [width, 16, len(CLASSES)])
    kept = run.verdict(5, 25).best_round
    scores = evaluate(model.transform(test))
    return run.scores().withColumns({"kept": F.col("round") == kept, "test_loss": F.when(F.col("round") == kept, scores["logLoss"]),
                                     "test_accuracy": F.when(F.col("round") == kept, scores["accuracy"])})


def _appended(spark, sf, side, prefix):
    """The events in four batches of periods, each added to the store of the ones before."""
    store = RateStore(spark, f"{checkpoint_dir(spark).rstrip('/')}/rates-{uuid.uuid4().hex}", side, prefix, CFG)
    at = F.col("season") * 100 + F.col("week")
    for low, high in ((0, 199605), (199605, 199812), (199812, 200006), (200006, 10 ** 9)):
        store.append(plays(spark, sf).filter((at > low) & (at <= high)))
    return store


def q_asof_appended(spark, sf):
    """C1-C3 unfilled, from appended periods."""
    return rounded(_appended(spark, sf, "posteam", "pt_").unfilled())


def q_asof_appended_filled(spark, sf):
    """C1-C3 of the other side with the season fill, from appended periods."""
    return rounded(_appended(spark, sf, "defteam", "dt_").filled())


def q_quantiles_from_summaries(spark, sf):
    """Quantiles per entity over a set of seasons, bracketed by sketches stored per season."""
    cols = ["epa", "wind", "air_yards"]
    p = plays_columns(spark, sf, ["posteam", "season", *cols])
    stored = materialize(quantile_summary(p, ["posteam", "season"], cols), name="quantile_summaries")
    recent = F.col("season") >= 1998
    return rounded(exact_quantiles(p.filter(recent), ["posteam"], cols, 0.35, prefix="q_", stage=False,
                                   summary=stored.filter(recent)))


def q_lookup_reader(spark, sf):
    """S2 + J4: the names read as a dimension with an explicit schema, joined to the events."""
    names = read_lookup(spark, f"{sf}/supplier.parquet", "s_suppkey bigint, s_name string")
    p = plays(spark, sf).select("drive", "play_id", "passer")
    return lookup(p, names, "passer", "s_suppkey", ["s_name"])


def _audited(spark, sf):
    p = plays(spark, sf).select("drive", "season", "week", "game_id", "passer", "down", "air_yards", "temp")
    path = f"{checkpoint_dir(spark).rstrip('/')}/audited-{uuid.uuid4().hex}"
    return write_splits_audited(rule_split(p, "season", "week", MIN_SEASON, TEST_SEASON), path, "game_id")


def q_audit_while_writing(spark, sf):
    """A11 of the written splits, observed by the write."""
    return _audited(spark, sf)[0]


def q_splits_while_writing(spark, sf):
    """A10: rows of each split, observed by the write."""
    return _audited(spark, sf)[1].select("split", "rows")


def q_distinct_summaries(spark, sf):
    """Distinct games of the recent seasons from sketches stored per season, beside the
    exact count: within 2 %."""
    stored = materialize(distinct_summary(plays(spark, sf), ["season"], "game_id"), name="distinct_summaries")
    recent = F.col("season") >= 1998
    exact = plays(spark, sf).filter(recent).select("game_id").distinct().agg(F.count("*").alias("n_exact"))
    guess = distinct_estimate(stored.filter(recent))
    both = exact.withColumn("k", F.lit(1)).join(guess.withColumn("k", F.lit(1)), "k")
    return both.select("n_exact", (F.abs(F.col("n") - F.col("n_exact")) <= 0.02 * F.col("n_exact")).alias("within"))


QUERIES = {
    "audit_while_writing": q_audit_while_writing,
    "splits_while_writing": q_splits_while_writing,
    "distinct_summaries": q_distinct_summaries,
    "quantiles_from_summaries": q_quantiles_from_summaries,
    "lookup_reader": q_lookup_reader,
    "asof_appended": q_asof_appended,
    "asof_appended_filled": q_asof_appended_filled,
    "asof_join": q_asof_join,
    "asof_join_next": q_asof_join_next,
    "pad_bucketed": q_pad_bucketed,
    "windows_bucketed": q_windows_bucketed,
    "padding_report": q_padding_report,
    "early_stopping": q_early_stopping,
    "train_early_stop": q_train_early_stop,
    "feature_table_colocated": q_feature_table_colocated,
    "heavy_actor_join": q_heavy_actor_join,
    "heavy_enriched": q_heavy_enriched,
    "scan_number_fill": q_scan_number_fill,
    "scan_running": q_scan_running,
}

_W = "(partition by posteam order by event_key rows between {} and {})"
_UP, _DOWN = _W.format("unbounded preceding", "current row"), _W.format("current row", "unbounded following")
_KEYED = f"keyed as (select *, cast({EVENT_KEY} as bigint) as event_key from plays)"

_BUCKETED = EV + f""", bk as (select *, max(n) over (partition by bin) as blen from (
    select *, cast(floor(ln(n) / ln({FACTOR}::double) + 1e-9) as int) as bin from seq) b)"""

_SPLIT = f"sp as (select * from (select *, {SPLIT_EXPR} as split from plays where season >= {MIN_SEASON}) t where split is not null)"
_AUDITED = ["drive", "season", "week", "game_id", "passer", "down", "air_yards", "temp", "split"]

ORACLE = {
    "audit_while_writing": with_plays(" union all ".join(
        f"select '{c}' as column_name, count(*) filter (where {c} is null) as n_null from sp" for c in _AUDITED), _SPLIT),
    "splits_while_writing": with_plays("select split, count(*) as rows from sp group by split", _SPLIT),
    "distinct_summaries": with_plays("select count(distinct game_id) as n_exact, true as within from plays where season >= 1998"),
    "quantiles_from_summaries": with_plays(
        "select posteam, " + ", ".join(f"{rnd(f'quantile_cont(cast({c} as double), 0.35)')} as q_{c}" for c in ("epa", "wind", "air_yards"))
        + " from plays where season >= 1998 group by posteam"),
    "lookup_reader": with_plays("select p.drive, p.play_id, p.passer, s.s_name from plays p left join supplier s on p.passer = s.s_suppkey"),
    "asof_appended": RATE_ORACLE["asof_unfilled"],
    "asof_appended_filled": asof_sql("defteam", "dt_"),
    "asof_join": with_plays(
        "select posteam, event_key, case when event_key - ended <= 40000 then ended end as last_end, "
        "case when event_key - ended <= 40000 then n end as last_events, case when event_key - ended <= 40000 then e_epa end as last_epa "
        "from (select k.posteam, k.event_key, d.ended, d.n, d.e_epa from keyed k asof left join ends d "
        "on k.posteam = d.posteam and k.event_key >= d.ended) j",
        _KEYED + ", ends as (select posteam, drive, cast(drive * 64 + 40 as bigint) as ended, count(*) as n, "
        "cast(sum(epa) as bigint) as e_epa from plays group by posteam, drive)"),
    "asof_join_next": with_plays(
        "select k.posteam, k.defteam, k.event_key, o.next_key as answer from keyed k asof left join "
        "(select posteam, event_key as next_key from keyed) o on k.defteam = o.posteam and k.event_key < o.next_key", _KEYED),
    "pad_bucketed": _BUCKETED + """ select user_id, cast(q as int) as pos, cast(blen as int) as length, q < blen - n as is_pad,
        case when q >= blen - n then x0[q - (blen - n) + 1] else 0.0 end as value,
        case when q >= blen - n then x1[q - (blen - n) + 1] else 0.0 end as hr,
        case when q >= blen - n then y[q - (blen - n) + 1] else 0 end as label from bk, generate_series(0, blen - 1) g(q)""",
    "windows_bucketed": EV + f""" select user_id, cast(i as int) as window_index, x0[i + 1] as first_value, y[i + {WIN} + 1] as label
        from seq, generate_series(0, n - {WIN} - 1) g(i)""",
    "padding_report": _BUCKETED + """ select cast(count(*) as bigint) as keys, cast(sum(n) as bigint) as steps, 'bucketed' as plan,
        cast(sum(blen - n) as bigint) as pad_rows from bk
        union all select count(*), cast(sum(n) as bigint), 'longest', cast(sum(len - n) as bigint) from bk""",
    "early_stopping": f"""with s as (select user_id, row_number() over (partition by user_id order by event_id) as r, value / 10 as loss,
          case when event_id % 17 <> 0 then cast(event_id * 37 % 101 as double) end as acc from events),
        b as (select *, acc is not null and acc > coalesce(max(acc) over (partition by user_id order by r
                rows between unbounded preceding and 1 preceding), -1) as better from s where r <= 25),
        w as (select *, r - coalesce(max(case when better then r end) over (partition by user_id order by r), 0) as wait from b),
        e as (select *, min(case when wait >= 5 then r end) over (partition by user_id) as stop from w)
        select user_id, cast(max(r) as int) as stopped_at, cast(arg_min(r, loss * 1000 + r / 1000000.0) as int) as best_round,
          {rnd('min(loss)')} as best_loss, max(stop) is not null as early from e where stop is null or r <= stop group by user_id""",
    "feature_table_colocated": FEATURE_ORACLE["feature_table"],
    "heavy_actor_join": with_plays(
        "select p.drive, p.play_id, p.passer, p.season, a.n_events, a.sum_epa from plays p left join "
        "(select passer, season, count(*) as n_events, cast(sum(epa) as bigint) as sum_epa from plays group by all) a "
        "on p.passer is not distinct from a.passer and p.season = a.season"),
    "heavy_enriched": with_plays(f"select {_round_cols(ENRICH_OUT, DOUBLES)} from ev3", ENRICH_CTES),
    "scan_number_fill": with_plays(
        f"select posteam, event_key, count(*) over {_UP} as event_no, last_value(passer ignore nulls) over {_UP} as passer_before, "
        f"coalesce(last_value(passer ignore nulls) over {_UP}, first_value(passer ignore nulls) over {_DOWN}) as passer from keyed", _KEYED),
    "scan_running": with_plays(
        f"select posteam, event_key, air_yards, wind, epa, cast(sum(epa) over {_UP} as bigint) as epa_so_far, "
        f"cast(sum(air_yards) over {_UP} as bigint) as air_so_far, "
        f"case when count(air_yards) over {_UP} = count(*) over {_UP} then cast(sum(air_yards) over {_UP} as bigint) end as air_strict, "
        f"max(wind) over {_UP} as wind_high, min(epa) over {_UP} as epa_low from keyed", _KEYED),
}
