"""Projections, column selection and feature preparation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, StringType

from seqwise.config import EventConfig
from seqwise.functions.scalar import closed_flag, mmss_to_seconds
from seqwise.functions.semantics import ne_keep_null


def derive(df: DataFrame, steps) -> DataFrame:
    """Ordered derived columns: each step sees the columns made before it."""
    for name, expr in steps:
        df = df.withColumn(name, expr)
    return df


def keys_first(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.select(*keys, *[c for c in df.columns if c not in set(keys)])


def cols_with_prefix(df: DataFrame, *prefixes: str, ignore_case: bool = True) -> list[str]:
    """Columns whose name starts with any prefix (case-insensitive by default)."""
    if ignore_case:
        ps = [p.lower() for p in prefixes]
        return [c for c in df.columns if any(c.lower().startswith(p) for p in ps)]
    return [c for c in df.columns if any(c.startswith(p) for p in prefixes)]


def with_suffix(df: DataFrame, suffix: str, exclude=()) -> DataFrame:
    return df.withColumnsRenamed({c: c + suffix for c in df.columns if c not in set(exclude)})


def cols_of_type(df: DataFrame, kind: str = "numeric", exclude=()) -> list[str]:
    t = NumericType if kind == "numeric" else StringType
    return [f.name for f in df.schema.fields if isinstance(f.dataType, t) and f.name not in set(exclude)]


def type_counts(df: DataFrame) -> dict:
    num = len(cols_of_type(df, "numeric"))
    cat = len(cols_of_type(df, "string"))
    return {"categorical": cat, "numeric": num, "total": num + cat}


def drop_existing(df: DataFrame, cols, strict: bool) -> DataFrame:
    missing = [c for c in cols if c not in set(df.columns)]
    if strict and missing:
        raise KeyError(f"columns not found: {missing}")
    return df.drop(*[c for c in cols if c not in set(missing)])


# Columns the model preparation removes (base list, then the
# optional groups switched by flags, then the fourth-down branch list).
BASE_DROP = [
    "season", "week", "drive", "series", "surface", "season_type", "home_team", "away_team", "spread_line",
    "game_date", "play_id", "desc", "two_point_attempt", "posteam_type", "defteam", "game_half", "passer_name",
    "passer_player_id", "quarter_end", "pass_attempt", "rush_attempt", "field_goal_attempt", "punt_attempt",
    "half_seconds_remaining", "drive_play_count", "pass_deep", "pass_right", "pass_left", "yards_after_catch",
    "pt_run_left_pct", "pt_run_right_pct", "pt_rush_wpa_play", "pt_pass_wpa_play", "dt_fd_pass_pct",
    "dt_sd_pass_pct", "dt_td_pass_pct", "dt_gtg_pass_pct", "dt_neutral_pass_pct", "dt_scripted_pass_pct",
    "dt_pass_pct", "dt_run_left_pct", "dt_run_right_pct", "dt_rush_wpa_play", "dt_pass_wpa_play",
    "pt_sd_pass_pct", "pt_td_pass_pct", "pt_gtg_pass_pct", "qb_dropback", "qb_spike", "qb_scramble",
    "no_huddle", "shotgun",
]
TOTALS_DROP = ["total_away_rush_epa", "total_home_rush_epa", "total_away_pass_epa", "total_home_pass_epa",
               "total_away_rush_wpa", "total_home_rush_wpa", "total_away_pass_wpa", "total_home_pass_wpa"]
EPA_DETAIL_DROP = ["air_epa", "yac_epa"]
FOURTH_DOWN_DROP = ["down", "yards_gained", "epa", "wpa", "penalty_yards", "pt_fd_pass_pct",
                    "pt_neutral_pass_pct", "pt_scripted_pass_pct", "pt_pass_pct", "qb_hit", "air_yards",
                    "first_down"]


def prepare_events(df: DataFrame, totals: bool = False, wp: bool = True, ep: bool = True,
                   epa_detail: bool = False, fourth_down: bool | None = False,
                   cfg: EventConfig = EventConfig(), strict: bool = True) -> DataFrame:
    """C11: drop by flags, parse the duration, recode the roof, then the
    row filter of the chosen branch (``fourth_down=None``: no filter).

    ``strict`` raises on a missing column as the source does; the actor's
    id and name columns are taken from ``cfg``.
    """
    base = [cfg.actor if c == "passer_player_id" else f"{cfg.actor}_name" if c == "passer_name" else c
            for c in BASE_DROP]
    drops = list(base)
    if not totals:
        drops += TOTALS_DROP
    if not wp:
        drops += ["wp"]
    if not ep:
        drops += ["ep"]
    if not epa_detail:
        drops += EPA_DETAIL_DROP
    df = drop_existing(df, drops, strict)
    df = df.withColumns({"drive_time_of_possession": mmss_to_seconds("drive_time_of_possession"),
                         "roof": closed_flag("roof")})
    if fourth_down is True:
        df = df.filter((F.col("down") == 4) & (F.col("timeout") == 0) & (F.col("pt_penalty") == 0))
        df = drop_existing(df, FOURTH_DOWN_DROP, strict)
    elif fourth_down is False:
        df = df.filter(ne_keep_null("down", 4) & ne_keep_null(cfg.label, "field_goal")
                       & ne_keep_null(cfg.label, "punt"))
    return df
