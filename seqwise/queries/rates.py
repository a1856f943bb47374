"""Per-period facts and as-of rates on the ``plays`` adapter."""

from __future__ import annotations


from seqwise.config import EventConfig
from seqwise.operators.aggregate import FACT_COLUMNS, period_facts
from seqwise.plans.rates import RATE_NAMES, asof_rates, cumulative_rates
from seqwise.queries._common import rnd, rounded
from seqwise.queries._sql import exact_avg, ifelse, na_cumsum, na_sum, ratio, with_plays
from seqwise.sources.fixtures import plays_table as plays

# plays adapter: wp is in hundredths of the source scale, so the neutral
# band 0.1 < wp < 0.9 becomes 1 < wp < 9 (see FIXTURES.md §3.1)
CFG = EventConfig(neutral_lo=1, neutral_hi=9)


def facts_sql(side: str) -> str:
    pa = "pass_attempt"
    neutral = "(wp > 1 and wp < 9)"
    cols = {
        "first_downs": na_sum(ifelse("down = 1", "1", "0")),
        "second_downs": na_sum(ifelse("down = 2", "1", "0")),
        "third_downs": na_sum(ifelse("down = 3", "1", "0")),
        "fourth_downs": na_sum(ifelse("down = 4", "1", "0")),
        "neutral_wp": na_sum(ifelse(neutral, "1", "0")),
        "goal_to_go": na_sum("goal_to_go"),
        "scripted": na_sum(ifelse("rn <= 15", "1", "0")),
        "rush_attempts": na_sum("rush_attempt"),
        "pass_attempts": na_sum(pa),
        "fd_pass": na_sum(ifelse("down = 1", pa, "0")),
        "sd_pass": na_sum(ifelse("down = 2", pa, "0")),
        "td_pass": na_sum(ifelse("down = 3", pa, "0")),
        "neutral_pass": na_sum(ifelse(neutral, pa, "0")),
        "gtg_pass": "cast(" + ifelse(na_sum("goal_to_go") + " = 1",
                                     "min(case when rn = 1 then pass_attempt end)", "0") + " as bigint)",
        "scripted_pass": na_sum(ifelse("rn <= 15", pa, "0")),
        "run_left": na_sum(ifelse("rush_attempt = 1 and coalesce(run_location, 'middle') = 'left'", "1", "0")),
        "run_right": na_sum(ifelse("rush_attempt = 1 and coalesce(run_location, 'middle') = 'right'", "1", "0")),
        "rush_epa": na_sum("epa * rush_attempt"),
        "pass_epa": na_sum("epa * pass_attempt"),
        "rush_wpa": na_sum("wpa * rush_attempt"),
        "pass_wpa": na_sum("wpa * pass_attempt"),
    }
    sel = ",\n  ".join(f"{v} as {k}" for k, v in cols.items())
    return f"""select {side}, season, game_date,
  {sel}
from (select *, row_number() over (partition by {side}, season, game_date order by drive, play_id) as rn from plays) t
group by {side}, season, game_date"""


RATE_SQL = [
    ("fd_pass_pct", "fd_pass", "first_downs"),
    ("sd_pass_pct", "sd_pass", "second_downs"),
    ("td_pass_pct", "td_pass", "third_downs"),
    ("gtg_pass_pct", "gtg_pass", "goal_to_go"),
    ("neutral_pass_pct", "neutral_pass", "neutral_wp"),
    ("scripted_pass_pct", "scripted_pass", "scripted"),
    ("pass_pct", "pass_attempts", "(pass_attempts + rush_attempts)"),
    ("run_left_pct", "run_left", "rush_attempts"),
    ("run_right_pct", "run_right", "rush_attempts"),
    ("rush_epa_play", "rush_epa", "rush_attempts"),
    ("pass_epa_play", "pass_epa", "pass_attempts"),
    ("rush_wpa_play", "rush_wpa", "rush_attempts"),
    ("pass_wpa_play", "pass_wpa", "pass_attempts"),
]


def cum_sql(side: str, prefix: str) -> str:
    w = f"(partition by {side}, season order by game_date rows between unbounded preceding and current row)"
    sel = ",\n  ".join(f"{ratio(na_cumsum(n, w), na_cumsum(d, w))} as {prefix}{name}" for name, n, d in RATE_SQL)
    return f"select {side}, season, game_date,\n  {sel}\nfrom facts"


def asof_ctes(side: str, prefix: str) -> str:
    """CTEs {prefix}facts, {prefix}cum, {prefix}shifted, {prefix}rates (season-mean filled)."""
    names = [prefix + n for n in RATE_NAMES]
    fill = ",\n  ".join(f"coalesce({c}, {exact_avg(c, '(partition by season)')}) as {c}" for c in names)
    return f"""{prefix}facts as ({facts_sql(side)}),
{prefix}cum as ({cum_sql(side, prefix).replace("from facts", f"from {prefix}facts")}),
{prefix}shifted as (select {side}, season, lead(game_date) over (partition by {side} order by season, game_date) as game_date,
  {", ".join(names)} from {prefix}cum),
{prefix}rates as (select {side}, season, game_date,
  {fill}
from {prefix}shifted)"""


def asof_sql(side: str, prefix: str) -> str:
    names = [prefix + n for n in RATE_NAMES]
    return with_plays(f"select {side}, season, game_date, " + ", ".join(f"{rnd(c)} as {c}" for c in names)
                      + f" from {prefix}rates", asof_ctes(side, prefix))


def q_asof_rates_entity(spark, sf):
    return rounded(asof_rates(plays(spark, sf), "posteam", "pt_", CFG))


def q_asof_rates_opponent(spark, sf):
    return rounded(asof_rates(plays(spark, sf), "defteam", "dt_", CFG))


def q_period_facts(spark, sf):
    return period_facts(plays(spark, sf), "posteam", CFG)


def q_cumulative_ratio(spark, sf):
    facts = period_facts(plays(spark, sf), "posteam", CFG)
    return rounded(cumulative_rates(facts, "posteam", "pt_", CFG).select(
        "posteam", "season", "game_date", *["pt_" + n for n in RATE_NAMES]))


def q_asof_unfilled(spark, sf):
    return rounded(asof_rates(plays(spark, sf), "posteam", "pt_", CFG, fill=False))


QUERIES = {
    "asof_rates_entity": q_asof_rates_entity,
    "asof_rates_opponent": q_asof_rates_opponent,
    "period_facts": q_period_facts,
    "cumulative_ratio": q_cumulative_ratio,
    "asof_unfilled": q_asof_unfilled,
}

ORACLE = {
    "asof_rates_entity": asof_sql("posteam", "pt_"),
    "asof_rates_opponent": asof_sql("defteam", "dt_"),
    "period_facts": with_plays("select posteam, season, game_date, " + ", ".join(FACT_COLUMNS)
                               + " from facts", f"facts as ({facts_sql('posteam')})"),
    "cumulative_ratio": with_plays(
        "select posteam, season, game_date, " + ", ".join(rnd("pt_" + n) + " as pt_" + n for n in RATE_NAMES)
        + " from cum", f"facts as ({facts_sql('posteam')}), cum as ({cum_sql('posteam', 'pt_')})"),
    "asof_unfilled": with_plays(
        "select posteam, season, lead(game_date) over (partition by posteam order by season, game_date) as game_date, "
        + ", ".join(rnd("pt_" + n) + " as pt_" + n for n in RATE_NAMES) + " from cum",
        f"facts as ({facts_sql('posteam')}), cum as ({cum_sql('posteam', 'pt_')})"),
}
