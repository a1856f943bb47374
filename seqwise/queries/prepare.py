"""Projection, filter and recode operators on the ``plays`` adapter
(P1-P15, F9-F14, M1-M3)."""

from __future__ import annotations

from pyspark.sql import functions as F

from seqwise.functions.scalar import attempt_rule, encode_by_list, label_of, recode
from seqwise.functions.semantics import not_in, r_ifelse
from seqwise.operators.aggregate import class_balance
from seqwise.operators.encode import apply_labels, fit_labels, minmax_scale
from seqwise.operators.project import (
    BASE_DROP, EPA_DETAIL_DROP, FOURTH_DOWN_DROP, TOTALS_DROP, cols_of_type, cols_with_prefix, derive, keys_first,
    prepare_events, with_suffix,
)
from seqwise.operators.split import rule_split
from seqwise.plans.prepare import encode_and_scale
from seqwise.plans.priors import STAT_COLS, actor_cumulative, actor_season
from seqwise.plans.rates import RATE_NAMES, asof_rates
from seqwise.queries._common import rnd, rounded
from seqwise.queries._sql import with_plays
from seqwise.queries.features import (
    DOUBLES_IMPUTED, FEATURE_CTES, FEATURE_OUT, MIN_SEASON, SPLIT_EXPR, TEST_SEASON, q_feature_table,
)
from seqwise.queries.priors import QB_CTES
from seqwise.queries.rates import CFG, asof_ctes
from seqwise.sources.fixtures import EXTRA, plays_table as plays

# Label recode and the class list of the four-class model.
LABEL_MAP = {"run_left": "run", "run_right": "run", "run_middle": "run", "pass": "pass",
             "field_goal": "fg", "punt": "punt"}
PLAY_TYPES = ["fg", "pass", "punt", "run"]


def _labelled(spark, sf):
    p = plays(spark, sf)
    return p.withColumn("play_type", label_of("play_type", "qb_dropback", "run_location"))


LABEL_SQL = """case when (play_type = 'qb_spike' or qb_dropback = 1) is null then null
  when (play_type = 'qb_spike' or qb_dropback = 1) then 'pass'
  else (case when (play_type = 'run') is null then null
             when play_type = 'run' then concat_ws('_', play_type, coalesce(run_location, 'middle'))
             else play_type end) end"""
RECODE_SQL = ("case pt when 'run_left' then 'run' when 'run_right' then 'run' when 'run_middle' then 'run' "
              "when 'pass' then 'pass' when 'field_goal' then 'fg' when 'punt' then 'punt' end")
LABELLED = f"lab as (select * replace ({LABEL_SQL} as play_type) from plays)"


def q_filter_arith(spark, sf):
    """Conjunctive filter with an arithmetic predicate; a NULL addend drops the row."""
    p = plays(spark, sf)
    return p.filter((F.col("posteam_type") == "home")
                    & ((F.col("pass_attempt") + F.col("rush_attempt") + F.col("down")) > 2)).select(
        "drive", "play_id", "down")


def q_derived_columns(spark, sf):
    """Ordered derived columns; the attempt rule reads the new pass flag."""
    p = plays(spark, sf)
    d = derive(p, [
        ("drive_start", r_ifelse(F.col("play_id") == 1, 1, 0)),
        ("pass_attempt", F.col("qb_dropback")),
        ("rush_attempt", attempt_rule("rush_attempt", "pass_attempt", "as_written")),
    ])
    return d.select("drive", "play_id", "drive_start", "pass_attempt", "rush_attempt")


def q_filter_not_in(spark, sf):
    """P4 + P5: negated membership (never NULL) and equality, then drop NULL labels."""
    p = plays(spark, sf)
    return (p.filter(not_in("play_type", ["punt", "qb_spike"]) & (F.col("goal_to_go") == 0))
            .dropna(subset=["play_type"]).select("drive", "play_id", "play_type"))


def q_project_prefix(spark, sf):
    """P8 + P3: select keys and every column starting with a prefix."""
    r = asof_rates(plays(spark, sf), "posteam", "pt_", CFG, fill=False)
    return rounded(r.select("posteam", "season", "game_date", *cols_with_prefix(r, "PT_")))


def q_rename_suffix(spark, sf):
    """P9 + P7: next-season copy of the season table, every column suffixed."""
    s = actor_season(actor_cumulative(plays(spark, sf), CFG), CFG).select("passer", "season", *STAT_COLS)
    s = s.withColumn("season", F.col("season") + 1)
    return rounded(with_suffix(s, "_1"))


def q_keys_first(spark, sf):
    """P14 + P13: season range filter, keys moved first."""
    p = plays(spark, sf).filter(F.col("season").between(MIN_SEASON, TEST_SEASON))
    return keys_first(p.select("wp", "epa", "play_id", "game_id", "posteam"), ["game_id", "posteam", "play_id"])


BASE = {"passer" if c == "passer_player_id" else c for c in BASE_DROP}


def _prep_sql(totals=False, wp=True, ep=True, epa_detail=False, fourth=None):
    """Select list and filter of the preparation over the feature table."""
    drop = BASE | (set() if totals else set(TOTALS_DROP)) | (set() if wp else {"wp"}) | (set() if ep else {"ep"})
    drop |= (set() if epa_detail else set(EPA_DETAIL_DROP)) | (set(FOURTH_DOWN_DROP) if fourth else set())
    out = []
    for c in FEATURE_OUT:
        if c in drop:
            continue
        if c == "drive_time_of_possession":
            out.append("try_cast(split_part(drive_time_of_possession, ':', 1) as int) * 60 + "
                       "try_cast(split_part(drive_time_of_possession, ':', 2) as int) as drive_time_of_possession")
        elif c == "roof":
            out.append("case when roof in ('dome', 'closed') then 1 else 0 end as roof")
        else:
            out.append(f"{rnd(c)} as {c}" if c in DOUBLES_IMPUTED else f'"{c}"')
    rows = {None: "true", True: "down = 4 and timeout = 0 and pt_penalty = 0",
            False: "not (down is not distinct from 4) and not (play_type is not distinct from 'field_goal') "
                   "and not (play_type is not distinct from 'punt')"}[fourth]
    return with_plays(f"select {', '.join(out)} from features where {rows}", FEATURE_CTES)


def _prepared(spark, sf, **flags):
    return rounded(prepare_events(q_feature_table(spark, sf), cfg=CFG, **flags))


def q_prepare_events(spark, sf):
    """P10 + P11 + F12 + F13 on the feature table: every listed column is there
    (strict), duration to seconds, roof flag, then the keep-NULL inequality
    filters of the non-fourth-down branch."""
    return _prepared(spark, sf)


def q_fourth_branch(spark, sf):
    """The fourth-down branch: filter, then drop the listed columns."""
    return _prepared(spark, sf, fourth_down=True)


def q_prepare_all(spark, sf):
    """P10 without a row filter (the four-class preparation)."""
    return _prepared(spark, sf, fourth_down=None)


def q_prepare_totals(spark, sf):
    """P10 with the totals and the detailed measures kept."""
    return _prepared(spark, sf, totals=True, epa_detail=True)


def q_prepare_no_wp_ep(spark, sf):
    return _prepared(spark, sf, wp=False, ep=False)


def q_type_counts(spark, sf):
    """Columns by kind, with the rows and NULLs of each kind in the table."""
    p = plays(spark, sf)
    parts = []
    for kind in ("string", "numeric"):
        cols = cols_of_type(p, kind)
        nulls = sum(F.col(c).isNull().cast("int") for c in cols)
        parts.append(p.agg(F.lit(kind).alias("kind"), F.lit(len(cols)).alias("columns"),
                           F.count(F.lit(1)).alias("rows"), F.sum(nulls).alias("nulls")))
    return parts[0].unionByName(parts[1])


def q_recode_map(spark, sf):
    """F11 + F14: derived label, then the dictionary recode (unmapped -> NULL)."""
    return _labelled(spark, sf).select("drive", "play_id", "play_type",
                                       recode("play_type", LABEL_MAP).alias("play_class"))


def q_label_encode(spark, sf):
    """M1 (fit per split, as the source does): sorted classes -> codes, NULL last."""
    p = rule_split(_labelled(spark, sf).withColumn("play_class", recode("play_type", LABEL_MAP)),
                   "season", "week", MIN_SEASON, TEST_SEASON)
    fitted = fit_labels(p, "play_class", by=["split"], code="play_type_encoded")
    return apply_labels(p, fitted, "play_class", by=["split"]).select(
        "drive", "play_id", "split", "play_class", "play_type_encoded")


def q_list_encode(spark, sf):
    """M2: position in a fixed class list; unknown values raise."""
    p = _labelled(spark, sf).withColumn("play_class", recode("play_type", LABEL_MAP)).dropna(subset=["play_class"])
    return p.select("drive", "play_id", "play_class", encode_by_list("play_class", PLAY_TYPES).alias("play_code"))


# The second target of the four-class model.
DIRECTION_MAP = {"run_left": "left", "run_right": "right", "run_middle": "middle"}


def _with_direction(spark, sf):
    p = rule_split(_labelled(spark, sf), "season", "week", MIN_SEASON, TEST_SEASON)
    p = p.withColumns({"run_direction": recode("play_type", DIRECTION_MAP), "play_type": recode("play_type", LABEL_MAP)})
    fitted = fit_labels(p, "run_direction", by=["split"], code="run_direction_encoded")
    return apply_labels(p, fitted, "run_direction", by=["split"])


def q_direction_encode(spark, sf):
    """F14 + M1 for the second target: runs to their direction, all else to
    NULL, whose code is the last."""
    return _with_direction(spark, sf).select("drive", "play_id", "split", "play_type", "run_direction", "run_direction_encoded")


def q_direction_balance(spark, sf):
    """A12 for the second target."""
    return class_balance(_with_direction(spark, sf), ["split", "run_direction_encoded", "play_type"])


SCALE_COLS = ["wp", "epa", "temp", "wind", "yards_gained", "goal_to_go"]


def q_minmax_scale(spark, sf):
    """M3: min-max fitted on the train split, applied to every split."""
    p = rule_split(plays(spark, sf).select("drive", "play_id", "season", "week", "game_id", *SCALE_COLS),
                   "season", "week", MIN_SEASON, TEST_SEASON)
    return rounded(minmax_scale(p, SCALE_COLS, fit_on=p.filter(F.col("split") == "train")))


def q_encode_and_scale(spark, sf):
    """C12 composite on the labelled plays."""
    p = rule_split(_labelled(spark, sf).select("drive", "play_id", "season", "week", "play_type", *SCALE_COLS),
                   "season", "week", MIN_SEASON, TEST_SEASON)
    return rounded(encode_and_scale(p, "play_type", LABEL_MAP, SCALE_COLS))


QUERIES = {
    "filter_arith": q_filter_arith,
    "derived_columns": q_derived_columns,
    "filter_not_in": q_filter_not_in,
    "project_prefix": q_project_prefix,
    "rename_suffix": q_rename_suffix,
    "keys_first": q_keys_first,
    "prepare_events": q_prepare_events,
    "fourth_branch": q_fourth_branch,
    "prepare_all": q_prepare_all,
    "prepare_totals": q_prepare_totals,
    "prepare_no_wp_ep": q_prepare_no_wp_ep,
    "type_counts": q_type_counts,
    "direction_encode": q_direction_encode,
    "direction_balance": q_direction_balance,
    "recode_map": q_recode_map,
    "label_encode": q_label_encode,
    "list_encode": q_list_encode,
    "minmax_scale": q_minmax_scale,
    "encode_and_scale": q_encode_and_scale,
}

_SPLIT_CTE = f"sp as (select * from (select *, {SPLIT_EXPR} as split from plays where season >= {MIN_SEASON}) t where split is not null)"
_MM = ", ".join(f"min({c}) as mn_{c}, max({c}) as mx_{c}" for c in SCALE_COLS)
_SCALED = ", ".join(
    f"{rnd(f'(cast({c} as double) - mn_{c}) / (case when mx_{c} = mn_{c} then 1.0 else cast(mx_{c} - mn_{c} as double) end)')} as {c}"
    for c in SCALE_COLS)
DIRECTION = f"""dir as (select drive, play_id, split, {RECODE_SQL.replace('case pt', 'case lab_type')} as play_type, run_direction,
  cast(dense_rank() over (partition by split order by run_direction nulls last) - 1 as int) as run_direction_encoded
  from (select *, play_type as lab_type, {SPLIT_EXPR} as split,
          case play_type when 'run_left' then 'left' when 'run_right' then 'right' when 'run_middle' then 'middle' end as run_direction
        from lab where season >= {MIN_SEASON}) t where split is not null)"""
STRINGS = ["run_location", "game_id", "play_type", "roof", "posteam_type", "drive_time_of_possession", *[c for c, _, k in EXTRA if k == "string"]]
NUMBERS = ["season", "week", "posteam", "defteam", "passer_src", "drive", "play_id", "down", "pass_attempt", "rush_attempt",
           "goal_to_go", "wp", "epa", "wpa", "passer", "qb_dropback", "temp", "penalty_team", "spread_line", "timeout_team",
           "wind", "yards_gained", *[c for c, _, k in EXTRA if k != "string"]]


def _nulls(cols):
    return "cast(" + " + ".join(f"""sum(case when "{c}" is null then 1 else 0 end)""" for c in cols) + " as bigint)"


ORACLE = {
    "filter_arith": with_plays("select drive, play_id, down from plays where posteam_type = 'home' "
                               "and (pass_attempt + rush_attempt + down) > 2"),
    "derived_columns": with_plays(
        "select drive, play_id, case when play_id = 1 then 1 else 0 end as drive_start, qb_dropback as pass_attempt, "
        "case when (rush_attempt = 1 and qb_dropback = 0) is null then null when rush_attempt = 1 and qb_dropback = 0 "
        "then 0 else rush_attempt end as rush_attempt from plays"),
    "filter_not_in": with_plays("select drive, play_id, play_type from plays where coalesce(not play_type in "
                                "('punt', 'qb_spike'), true) and goal_to_go = 0 and play_type is not null"),
    "project_prefix": with_plays(
        "select posteam, season, lead(game_date) over (partition by posteam order by season, game_date) as game_date, "
        + ", ".join(f"{rnd('pt_' + n)} as pt_{n}" for n in RATE_NAMES) + " from pt_cum", asof_ctes("posteam", "pt_")),
    "rename_suffix": with_plays(
        "select passer as passer_1, season + 1 as season_1, qb_pass_attempts as qb_pass_attempts_1, "
        f"{rnd('qb_pass_epa_play')} as qb_pass_epa_play_1, {rnd('qb_pass_wpa_play')} as qb_pass_wpa_play_1 from qbseason",
        QB_CTES),
    "keys_first": with_plays(f"select game_id, posteam, play_id, wp, epa from plays where season between {MIN_SEASON} and {TEST_SEASON}"),
    "prepare_events": _prep_sql(fourth=False),
    "fourth_branch": _prep_sql(fourth=True),
    "prepare_all": _prep_sql(),
    "prepare_totals": _prep_sql(totals=True, epa_detail=True, fourth=False),
    "prepare_no_wp_ep": _prep_sql(wp=False, ep=False, fourth=False),
    "type_counts": with_plays(
        f"select 'string' as kind, {len(STRINGS)} as columns, count(*) as rows, {_nulls(STRINGS)} as nulls from plays "
        f"union all select 'numeric', {len(NUMBERS)}, count(*), {_nulls(NUMBERS)} from plays"),
    "direction_encode": with_plays("select * from dir", LABELLED + ", " + DIRECTION),
    "direction_balance": with_plays("select split, run_direction_encoded, play_type, count(*) as n from dir group by all",
                                    LABELLED + ", " + DIRECTION),
    "recode_map": with_plays(f"select drive, play_id, play_type, {RECODE_SQL.replace('case pt', 'case play_type')} as play_class from lab",
                             LABELLED),
    "label_encode": with_plays(
        "select drive, play_id, split, play_class, cast(dense_rank() over (partition by split order by play_class nulls last) - 1 as int) "
        f"as play_type_encoded from (select *, {RECODE_SQL.replace('case pt', 'case play_type')} as play_class, "
        f"{SPLIT_EXPR} as split from lab where season >= {MIN_SEASON}) t where split is not null", LABELLED),
    "list_encode": with_plays(
        "select drive, play_id, play_class, cast(list_position(['fg', 'pass', 'punt', 'run'], play_class) - 1 as int) as play_code "
        f"from (select *, {RECODE_SQL.replace('case pt', 'case play_type')} as play_class from lab) t where play_class is not null",
        LABELLED),
    "minmax_scale": with_plays(
        f"select drive, play_id, season, week, game_id, split, {_SCALED} from sp, "
        f"(select {_MM} from sp where split = 'train') m", _SPLIT_CTE),
    "encode_and_scale": with_plays(
        f"select drive, play_id, season, week, play_type, split, "
        "cast(dense_rank() over (partition by split order by play_type nulls last) - 1 as int) as play_type_encoded, "
        f"{_SCALED} from (select drive, play_id, season, week, split, {RECODE_SQL.replace('case pt', 'case play_type')} as play_type, "
        f"{', '.join(SCALE_COLS)} from (select *, {SPLIT_EXPR} as split from lab where season >= {MIN_SEASON}) t "
        "where split is not null) e, (select " + _MM + f" from (select *, {SPLIT_EXPR} as split from lab "
        f"where season >= {MIN_SEASON}) t2 where split = 'train') m", LABELLED),
}
