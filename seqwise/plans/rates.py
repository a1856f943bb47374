"""As-of cumulative rates per side.

Per (side, season, period) facts -> running ratios per (side, season) ->
each row relabelled with the side's next period (so a period sees only
earlier ones) -> NULL rates filled with the season mean.

Plan shape: one aggregation over events (partial agg, shuffle on the three
keys), then windows and a season-mean join over the facts table, which is
smaller than the events by the events-per-period factor.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from seqwise.config import EventConfig
from seqwise.operators.aggregate import period_facts
from seqwise.operators.impute import fill_by_group
from seqwise.operators.window import cumulative_ratio, lead_period
from seqwise.session import materialize

# The 13 rate definitions (name, running numerator, running denominator).
RATE_SPECS = [
    ("fd_pass_pct", "fd_pass", "first_downs"),
    ("sd_pass_pct", "sd_pass", "second_downs"),
    ("td_pass_pct", "td_pass", "third_downs"),
    ("gtg_pass_pct", "gtg_pass", "goal_to_go"),
    ("neutral_pass_pct", "neutral_pass", "neutral_wp"),
    ("scripted_pass_pct", "scripted_pass", "scripted"),
    ("pass_pct", "pass_attempts", "pass_attempts + rush_attempts"),
    ("run_left_pct", "run_left", "rush_attempts"),
    ("run_right_pct", "run_right", "rush_attempts"),
    ("rush_epa_play", "rush_epa", "rush_attempts"),
    ("pass_epa_play", "pass_epa", "pass_attempts"),
    ("rush_wpa_play", "rush_wpa", "rush_attempts"),
    ("pass_wpa_play", "pass_wpa", "pass_attempts"),
]
RATE_NAMES = [name for name, _, _ in RATE_SPECS]


def cumulative_rates(facts: DataFrame, side: str, prefix: str, cfg: EventConfig = EventConfig()) -> DataFrame:
    """Running ratios per (side, season) in period order."""
    return cumulative_ratio(facts, [side, cfg.season], [cfg.period], RATE_SPECS, prefix)


def asof_shift(rates: DataFrame, side: str, cols: list[str], cfg: EventConfig = EventConfig(),
               fill: bool = True) -> DataFrame:
    """State after period k is labelled with the side's next period.

    The lead runs per side across seasons, so a season's last period takes
    the next season's first date but keeps its own season and never joins
    (each season opener is then filled downstream). NULLs are filled with
    the season mean of the column, over all rows of the season.
    """
    shifted = lead_period(rates.select(side, cfg.season, cfg.period, *cols), side,
                          [cfg.season, cfg.period], cfg.period)
    if not fill:
        return shifted
    # stored, so the means and the fill read it instead of the events; means are
    # partial aggregates, so no task holds a season
    return fill_by_group(materialize(shifted, name="asof_shifted"), [cfg.season], cols)


def asof_rates(events: DataFrame, side: str, prefix: str, cfg: EventConfig = EventConfig(),
               fill: bool = True) -> DataFrame:
    """Facts -> running rates -> shift -> season fill, keyed (side, season, period)."""
    facts = period_facts(events, side, cfg)
    rates = cumulative_rates(facts, side, prefix, cfg)
    return asof_shift(rates, side, [prefix + n for n in RATE_NAMES], cfg, fill)
