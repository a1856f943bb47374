"""Event-grain operators on the ``plays`` adapter: numbering, ordinals, fills,
joins, imputation, flags and label, split and audits (W1-W3, W8, W11, W12,
J1, J2, J5, C7-C10, P16, A9-A11)."""

from __future__ import annotations


from seqwise.operators.aggregate import distinct_count, null_audit
from seqwise.operators.impute import fill_by_group
from seqwise.operators.join import left_attach
from seqwise.operators.split import rule_split, split_report
from seqwise.operators.window import fill_downup, number_within, period_ordinal
from seqwise.plans.features import attach, build_features, enrich_events, flags_and_label, impute_attached, side_tables
from seqwise.plans.rates import RATE_NAMES, asof_rates
from seqwise.queries._common import rnd, rounded
from seqwise.queries._sql import exact_avg, with_plays
from seqwise.queries.priors import SHRINK_CTES
from seqwise.queries.rates import CFG, asof_ctes
from seqwise.sources.fixtures import EXTRA, players, plays_rows, plays_table as plays

MIN_SEASON, TEST_SEASON = 1998, 2001
PT = ["pt_" + n for n in RATE_NAMES]
DT = ["dt_" + n for n in RATE_NAMES]
PLAY_COLS = ["season", "week", "game_date", "posteam", "defteam", "passer_src", "drive", "play_id", "down",
             "pass_attempt", "rush_attempt", "run_location", "goal_to_go", "wp", "epa", "wpa", "passer", "game_id",
             "play_type", "qb_dropback", "roof", "temp", "posteam_type", "penalty_team",
             "drive_time_of_possession", "spread_line", "timeout_team", "wind", "yards_gained", *[c for c, _, _ in EXTRA]]

PLAY_NO = "row_number() over (partition by posteam, game_date order by drive, play_id)"
FILL_W = "(partition by posteam, game_date order by pt_play_no rows between {} and {})"

ENRICH_CTES = SHRINK_CTES + ",\n" + asof_ctes("posteam", "pt_") + ",\n" + asof_ctes("defteam", "dt_") + f""",
pgn as (select posteam, season, game_date, cast(row_number() over (partition by posteam, season order by game_date) as int)
          as pos_team_game_no from (select distinct posteam, season, game_date from plays) d),
dgn as (select defteam, season, game_date, cast(row_number() over (partition by defteam, season order by game_date) as int)
          as def_team_game_no from (select distinct defteam, season, game_date from plays) d),
ev0 as (select *, cast({PLAY_NO} as int) as pt_play_no,
          case when posteam_type = 'away' then -1.0::double * spread_line else cast(spread_line as double) end as pt_spread
        from plays),
ev1 as (select ev0.*, {", ".join("pr." + c for c in PT)}, {", ".join("dr." + c for c in DT)},
          pg.pos_team_game_no, dg.def_team_game_no
        from ev0
        left join pt_rates pr on ev0.posteam = pr.posteam and ev0.season = pr.season and ev0.game_date = pr.game_date
        left join dt_rates dr on ev0.defteam = dr.defteam and ev0.season = dr.season and ev0.game_date = dr.game_date
        left join pgn pg on ev0.posteam = pg.posteam and ev0.season = pg.season and ev0.game_date = pg.game_date
        left join dgn dg on ev0.defteam = dg.defteam and ev0.season = dg.season and ev0.game_date = dg.game_date),
ev2 as (select * replace (coalesce(
          last_value(passer ignore nulls) over {FILL_W.format("unbounded preceding", "current row")},
          first_value(passer ignore nulls) over {FILL_W.format("current row", "unbounded following")}) as passer)
        from ev1),
ev3 as (select ev2.*, st.passer_name, st.qb_pass_attempts, st.qb_pass_epa_play_adj, st.qb_pass_wpa_play_adj
        from ev2 left join stats st on ev2.passer = st.passer and ev2.game_date = st.game_date and ev2.season = st.season)"""

ZERO = ["qb_pass_wpa_play_adj", "qb_pass_epa_play_adj", "air_yards", "yards_after_catch", "air_epa", "yac_epa", "qb_epa",
        "epa", "wind", "penalty_yards", "yards_gained"]
MEANS = ["pt_play_no", "pt_spread"] + PT + DT
IMPUTE_CTES = ENRICH_CTES + f""",
ev4 as (select * replace ({", ".join(f"coalesce({c}, 0) as {c}" for c in ZERO)},
          {", ".join(f"coalesce({c}, {exact_avg(c, '(partition by season)')}) as {c}" for c in MEANS)},
          coalesce(roof, 'dome') as roof)
        from ev3),
ev5 as (select * replace (coalesce(temp, round_even({exact_avg('temp', '(partition by week)')}, 0)) as temp) from ev4)"""

LABEL = """case when (play_type = 'qb_spike' or qb_dropback = 1) is null then null
  when (play_type = 'qb_spike' or qb_dropback = 1) then 'pass'
  else (case when (play_type = 'run') is null then null
             when play_type = 'run' then concat_ws('_', play_type, coalesce(run_location, 'middle'))
             else play_type end) end"""
FLAG_CTES = IMPUTE_CTES + f""",
ev6 as (select * exclude (timeout_team, penalty_team, pass_length, pass_location) replace ({LABEL} as play_type, coalesce(down, 1) as down),
          case when penalty_team = posteam then 1 else 0 end as pt_penalty,
          case when timeout_team = posteam then 1 else 0 end as pt_timeout,
          case when pass_length = 'deep' then 1 else 0 end as pass_deep,
          case when pass_location = 'right' then 1 else 0 end as pass_right,
          case when pass_location = 'left' then 1 else 0 end as pass_left,
          case when posteam_type = 'home' then 1 else 0 end as pt_home
        from ev5)"""

SPLIT_EXPR = f"""case when season = {TEST_SEASON} then 'test'
  when season < {TEST_SEASON} and (week % 2 = 1 or (season % 2 = 1 and week in (4, 8, 12, 16))
       or (season % 2 = 0 and week in (2, 6, 10, 14))) then 'train'
  when season < {TEST_SEASON} and (week % 2 = 0 and not (season % 2 = 1 and week in (4, 8, 12, 16))
       and not (season % 2 = 0 and week in (2, 6, 10, 14))) then 'valid' end"""
FEATURE_CTES = FLAG_CTES + f""",
ev7 as (select * exclude (run_location), {SPLIT_EXPR} as split from ev6 where season >= {MIN_SEASON}),
features as (select * from ev7 where split is not null)"""


def _round_cols(cols, doubles):
    return ", ".join(f"{rnd(c)} as {c}" if c in doubles else f'"{c}"' for c in cols)


ENRICH_OUT = PLAY_COLS + ["pt_play_no", "pt_spread"] + PT + DT + [
    "pos_team_game_no", "def_team_game_no", "passer_name", "qb_pass_attempts", "qb_pass_epa_play_adj",
    "qb_pass_wpa_play_adj"]
DOUBLES = set(["pt_spread", "qb_pass_attempts", "qb_pass_epa_play_adj", "qb_pass_wpa_play_adj"] + PT + DT)


def q_enriched_events(spark, sf):
    return rounded(enrich_events(plays_rows(spark, sf), players(spark, sf), CFG))


def _imputed(spark, sf):
    """C7, then C8 with its means taken from the tables that C7 attaches and from the raw events."""
    events = plays_rows(spark, sf)
    side = side_tables(events, players(spark, sf), CFG)
    return impute_attached(attach(events, side, CFG), events, side, CFG)


def q_imputed_events(spark, sf):
    return rounded(_imputed(spark, sf))


def q_flags_label(spark, sf):
    return rounded(flags_and_label(_imputed(spark, sf), CFG))


def q_feature_table(spark, sf):
    return rounded(build_features(plays_rows(spark, sf), players(spark, sf), CFG, MIN_SEASON, TEST_SEASON))


IMPUTED_OUT = [c for c in ENRICH_OUT]
FLAG_OUT = [c for c in ENRICH_OUT if c not in ("timeout_team", "penalty_team", "pass_length", "pass_location")] + [
    "pt_penalty", "pt_timeout", "pass_deep", "pass_right", "pass_left", "pt_home"]
FEATURE_OUT = [c for c in FLAG_OUT if c != "run_location"] + ["split"]
DOUBLES_IMPUTED = DOUBLES | {"pt_play_no", "temp"}


def q_event_no(spark, sf):
    """Event number inside (entity, season, period) by the order columns."""
    p = plays(spark, sf).select("posteam", "season", "game_date", "drive", "play_id")
    return number_within(p, ["posteam", "season", "game_date"], ["drive", "play_id"], "play_count")


def q_play_no(spark, sf):
    """Running event number per (entity, period), two-level numbering."""
    p = plays(spark, sf).select("posteam", "game_date", "drive", "play_id")
    return number_within(p, ["posteam", "game_date"], ["drive", "play_id"], "pt_play_no")


def q_period_no(spark, sf):
    return period_ordinal(plays(spark, sf), "defteam", "season", "game_date", "def_team_game_no")


def q_fill_downup(spark, sf):
    p = plays(spark, sf).select("posteam", "game_date", "drive", "play_id", "passer")
    return fill_downup(p, ["posteam", "game_date"], ["drive", "play_id"], "passer")


def q_left_join_keys(spark, sf):
    p = plays(spark, sf).select("drive", "play_id", "posteam", "season", "game_date")
    return rounded(left_attach(p, asof_rates(plays(spark, sf), "posteam", "pt_", CFG), ["posteam", "season", "game_date"]))


def q_natural_left_join(spark, sf):
    p = plays(spark, sf).select("drive", "play_id", "posteam", "season", "game_date")
    return left_attach(p, period_ordinal(plays(spark, sf), "posteam", "season", "game_date", "pos_team_game_no"))


def q_group_mean_fill(spark, sf):
    """W8 alone: event-weighted season mean fill of the as-of rates."""
    p = plays(spark, sf).select("drive", "play_id", "posteam", "season", "game_date")
    j = left_attach(p, asof_rates(plays(spark, sf), "posteam", "pt_", CFG), ["posteam", "season", "game_date"])
    return rounded(fill_by_group(j, ["season"], PT, "mean"))


def q_rounded_mean_fill(spark, sf):
    p = plays(spark, sf).select("drive", "play_id", "week", "temp")
    return fill_by_group(p, ["week"], ["temp"], "rounded_mean")


def q_rule_split(spark, sf):
    p = plays(spark, sf).select("drive", "play_id", "season", "week", "game_id")
    return rule_split(p, "season", "week", MIN_SEASON, TEST_SEASON)


def q_split_report(spark, sf):
    p = plays(spark, sf).select("season", "week", "game_id")
    return rounded(split_report(rule_split(p, "season", "week", MIN_SEASON, TEST_SEASON)))


def q_distinct_games(spark, sf):
    return distinct_count(plays(spark, sf), ["game_id"])


def q_null_audit(spark, sf):
    return null_audit(plays(spark, sf))


QUERIES = {
    "event_no": q_event_no,
    "play_no": q_play_no,
    "period_no": q_period_no,
    "fill_downup": q_fill_downup,
    "left_join_keys": q_left_join_keys,
    "natural_left_join": q_natural_left_join,
    "group_mean_fill": q_group_mean_fill,
    "rounded_mean_fill": q_rounded_mean_fill,
    "rule_split": q_rule_split,
    "split_report": q_split_report,
    "distinct_games": q_distinct_games,
    "null_audit": q_null_audit,
    "enriched_events": q_enriched_events,
    "imputed_events": q_imputed_events,
    "flags_label": q_flags_label,
    "feature_table": q_feature_table,
}

ORACLE = {
    "event_no": with_plays("select posteam, season, game_date, drive, play_id, cast(row_number() over "
                           "(partition by posteam, season, game_date order by drive, play_id) as int) as play_count from plays"),
    "play_no": with_plays(f"select posteam, game_date, drive, play_id, cast({PLAY_NO} as int) as pt_play_no from plays"),
    "period_no": with_plays("select defteam, season, game_date, cast(row_number() over (partition by defteam, season "
                            "order by game_date) as int) as def_team_game_no from (select distinct defteam, season, game_date from plays) d"),
    "fill_downup": with_plays(
        "select posteam, game_date, drive, play_id, coalesce("
        f"last_value(passer ignore nulls) over {FILL_W.format('unbounded preceding', 'current row').replace('pt_play_no', 'drive, play_id')}, "
        f"first_value(passer ignore nulls) over {FILL_W.format('current row', 'unbounded following').replace('pt_play_no', 'drive, play_id')}"
        ") as passer from plays"),
    "left_join_keys": with_plays(
        "select p.drive, p.play_id, p.posteam, p.season, p.game_date, " + ", ".join(f"{rnd('r.' + c)} as {c}" for c in PT)
        + " from plays p left join pt_rates r on p.posteam = r.posteam and p.season = r.season and p.game_date = r.game_date",
        asof_ctes("posteam", "pt_")),
    "natural_left_join": with_plays(
        "select p.drive, p.play_id, p.posteam, p.season, p.game_date, g.pos_team_game_no from plays p left join "
        "(select posteam, season, game_date, cast(row_number() over (partition by posteam, season order by game_date) as int) "
        "as pos_team_game_no from (select distinct posteam, season, game_date from plays) d) g "
        "on p.posteam = g.posteam and p.season = g.season and p.game_date = g.game_date"),
    "group_mean_fill": with_plays(
        "select drive, play_id, posteam, season, game_date, "
        + ", ".join(f"{rnd(f'coalesce({c}, {exact_avg(c, "(partition by season)")})')} as {c}" for c in PT)
        + " from (select p.drive, p.play_id, p.posteam, p.season, p.game_date, " + ", ".join("r." + c for c in PT)
        + " from plays p left join pt_rates r on p.posteam = r.posteam and p.season = r.season and p.game_date = r.game_date) j",
        asof_ctes("posteam", "pt_")),
    "rounded_mean_fill": with_plays(
        "select drive, play_id, week, coalesce(temp, round_even(" + exact_avg('temp', '(partition by week)') + ", 0)) as temp from plays"),
    "rule_split": with_plays(
        f"select * from (select drive, play_id, season, week, game_id, {SPLIT_EXPR} as split from plays "
        f"where season >= {MIN_SEASON}) t where split is not null"),
    "split_report": with_plays(
        "select train_games + valid_games as training_games, "
        f"{rnd('valid_games / (train_games + valid_games)')} as validation_split, test_games, "
        f"{rnd('test_games / (train_games + valid_games + test_games)')} as test_split "
        "from (select cast(count(distinct case when split = 'train' then game_id end) * 2 as bigint) as train_games, "
        "cast(count(distinct case when split = 'valid' then game_id end) * 2 as bigint) as valid_games, "
        "cast(count(distinct case when split = 'test' then game_id end) * 2 as bigint) as test_games "
        f"from (select game_id, {SPLIT_EXPR} as split from plays where season >= {MIN_SEASON}) s) c"),
    "distinct_games": with_plays("select count(*) as n from (select distinct game_id from plays) d"),
    "null_audit": with_plays(
        "select column_name, n_null from (select " + ", ".join(f'count(*) filter (where "{c}" is null) as "{c}"' for c in PLAY_COLS)
        + " from plays) unpivot (n_null for column_name in (" + ", ".join(f'"{c}"' for c in PLAY_COLS) + "))"),
    "enriched_events": with_plays(f"select {_round_cols(ENRICH_OUT, DOUBLES)} from ev3", ENRICH_CTES),
    "imputed_events": with_plays(f"select {_round_cols(IMPUTED_OUT, DOUBLES_IMPUTED)} from ev5", IMPUTE_CTES),
    "flags_label": with_plays(f"select {_round_cols(FLAG_OUT, DOUBLES_IMPUTED)} from ev6", FLAG_CTES),
    "feature_table": with_plays(f"select {_round_cols(FEATURE_OUT, DOUBLES_IMPUTED)} from features", FEATURE_CTES),
}
