"""Actor running stats, season lags, shrinkage priors, leaderboard."""

from __future__ import annotations

from pyspark.sql import functions as F

from seqwise.operators.aggregate import first_per_group
from seqwise.operators.impute import group_quantile
from seqwise.operators.join import asof_state, lookup, season_lags
from seqwise.plans.priors import STAT_COLS, actor_cumulative, actor_season, actor_stats, leaderboard, shrunk_rates
from seqwise.queries._common import rnd, rounded
from seqwise.queries._sql import PLAYERS, na_cumsum, na_sum, ratio, with_plays
from seqwise.queries.rates import CFG
from seqwise.sources.fixtures import players, plays_table as plays

W_ACT = "(partition by passer, season order by game_date rows between unbounded preceding and current row)"

QB_CTES = f"""qbper as (
  select passer, season, game_date, {na_sum('pass_attempt')} as pass_attempts,
    {na_sum('epa * pass_attempt')} as pass_epa, {na_sum('wpa * pass_attempt')} as pass_wpa
  from plays where passer is not null group by passer, season, game_date),
qbcum0 as (
  select passer, season, game_date, pass_attempts, pass_epa, pass_wpa,
    {na_cumsum('pass_attempts', W_ACT)} as qb_pass_attempts,
    {ratio(na_cumsum('pass_epa', W_ACT), na_cumsum('pass_attempts', W_ACT))} as qb_pass_epa_play,
    {ratio(na_cumsum('pass_wpa', W_ACT), na_cumsum('pass_attempts', W_ACT))} as qb_pass_wpa_play
  from qbper),
qbcum as (
  select passer, season, game_date, coalesce(pass_attempts, 0) as pass_attempts, coalesce(pass_epa, 0) as pass_epa,
    coalesce(pass_wpa, 0) as pass_wpa, coalesce(qb_pass_attempts, 0) as qb_pass_attempts,
    coalesce(qb_pass_epa_play, 0) as qb_pass_epa_play, coalesce(qb_pass_wpa_play, 0) as qb_pass_wpa_play
  from qbcum0),
qbseason as (
  select passer, season, pass_attempts, pass_epa, pass_wpa, qb_pass_attempts, qb_pass_epa_play, qb_pass_wpa_play
  from (select *, row_number() over (partition by passer, season order by game_date desc) as rn from qbcum) t
  where rn = 1),
lagged as (
  select c.*,
    s1.qb_pass_attempts as qb_pass_attempts_1, s1.qb_pass_epa_play as qb_pass_epa_play_1, s1.qb_pass_wpa_play as qb_pass_wpa_play_1,
    s2.qb_pass_attempts as qb_pass_attempts_2, s2.qb_pass_epa_play as qb_pass_epa_play_2, s2.qb_pass_wpa_play as qb_pass_wpa_play_2,
    s3.qb_pass_attempts as qb_pass_attempts_3, s3.qb_pass_epa_play as qb_pass_epa_play_3, s3.qb_pass_wpa_play as qb_pass_wpa_play_3
  from qbcum c
  left join qbseason s1 on s1.passer = c.passer and s1.season + 1 = c.season
  left join qbseason s2 on s2.passer = c.passer and s2.season + 2 = c.season
  left join qbseason s3 on s3.passer = c.passer and s3.season + 3 = c.season)"""

QCOLS = STAT_COLS + [f"{c}_{k}" for k in (1, 2, 3) for c in STAT_COLS]


def _prior_sql(rate: str, rep: str) -> str:
    num = " + ".join(f"{w}::double * (qb_pass_{rate}_play_{k} * qb_pass_attempts_{k})"
                     for k, w in ((1, "0.6"), (2, "0.3"), (3, "0.1")))
    den = " + ".join(f"{w}::double * qb_pass_attempts_{k}" for k, w in ((1, "0.6"), (2, "0.3"), (3, "0.1")))
    return f"(({num}) + {rep} * rc) / nullif(({den}) + rc, 0)"


SHRINK_CTES = QB_CTES + f""",
q as (select season, {", ".join(f"quantile_cont({c}, 0.2) as q_{c}" for c in QCOLS)} from lagged group by season),
filled as (
  select l.passer, l.season, l.game_date, l.pass_attempts, l.pass_epa, l.pass_wpa,
    q.q_qb_pass_epa_play_1 as rep_epa_play, q.q_qb_pass_wpa_play_1 as rep_wpa_play,
    {", ".join(f"coalesce(cast(l.{c} as double), q.q_{c}) as {c}" for c in QCOLS)}
  from lagged l left join q on l.season = q.season),
rcq as (select season, quantile_cont(qb_pass_attempts_1, 0.25) as rc from filled group by season),
pri as (
  select f.*, r.rc, {_prior_sql('epa', 'rep_epa_play')} as prior_pass_epa_play,
    {_prior_sql('wpa', 'rep_wpa_play')} as prior_pass_wpa_play
  from filled f left join rcq r on f.season = r.season),
shr as (
  select *, (qb_pass_epa_play * qb_pass_attempts + rc * prior_pass_epa_play) / nullif(rc + qb_pass_attempts, 0) as qb_pass_epa_play_adj,
    (qb_pass_wpa_play * qb_pass_attempts + rc * prior_pass_wpa_play) / nullif(rc + qb_pass_attempts, 0) as qb_pass_wpa_play_adj
  from pri),
stats as (
  select s.passer, p.player_display_name as passer_name, s.season, s.game_date, s.qb_pass_attempts,
    s.qb_pass_epa_play_adj, s.qb_pass_wpa_play_adj
  from shr s left join (select distinct player_id, player_display_name from ({PLAYERS}) pl) p on s.passer = p.player_id)"""


def q_actor_cumulative(spark, sf):
    return rounded(actor_cumulative(plays(spark, sf), CFG))


def q_last_per_group(spark, sf):
    return rounded(actor_season(actor_cumulative(plays(spark, sf), CFG), CFG))


def q_first_per_group(spark, sf):
    # slice_head after a descending sort: the row with the latest period
    cum = actor_cumulative(plays(spark, sf), CFG)
    return rounded(first_per_group(cum, ["passer", "season"], ["game_date"]).drop("game_date"))


def q_lagged_self_join(spark, sf):
    s = actor_season(actor_cumulative(plays(spark, sf), CFG), CFG).select("passer", "season", *STAT_COLS)
    return rounded(season_lags(s, "passer", "season", STAT_COLS, (1, 2, 3)))


def q_shrunk_actor_rate(spark, sf):
    shr = shrunk_rates(actor_cumulative(plays(spark, sf), CFG), CFG, stage=True)
    return rounded(shr.select("passer", "season", "game_date", "rep_epa_play", "rep_wpa_play", "rc",
                              "prior_pass_epa_play", "prior_pass_wpa_play",
                              "qb_pass_epa_play_adj", "qb_pass_wpa_play_adj"))


def q_group_quantile_fill(spark, sf):
    """W9/W10 alone: 20 % season quantile of last season's rate, and the fill."""
    s = actor_season(actor_cumulative(plays(spark, sf), CFG), CFG).select("passer", "season", *STAT_COLS)
    lag = season_lags(s, "passer", "season", ["qb_pass_epa_play"], (1,))
    g = group_quantile(lag, ["season"], "qb_pass_epa_play_1", 0.2, "rep_epa_play")
    return rounded(g.select("passer", "season", "rep_epa_play",
                            F.coalesce("qb_pass_epa_play_1", "rep_epa_play").alias("filled_epa_play_1")))


def q_actor_stats(spark, sf):
    return rounded(actor_stats(plays(spark, sf), players(spark, sf), CFG, stage=True))


def q_lookup_left_join(spark, sf):
    p = plays(spark, sf).select("drive", "play_id", "passer")
    return lookup(p, players(spark, sf), "passer", "player_id", ["player_display_name"])


def q_asof_state_actor(spark, sf):
    """J6 general form with shift=1 on the actor table: each actor period sees
    only earlier periods (the leak-free variant of Q4)."""
    cum = actor_cumulative(plays(spark, sf), CFG)
    return rounded(asof_state(cum, "passer", "season", "game_date", ["qb_pass_attempts", "qb_pass_epa_play"], shift=1))


def q_leaderboard(spark, sf):
    return rounded(leaderboard(actor_stats(plays(spark, sf), players(spark, sf), CFG, stage=True), CFG))


QUERIES = {
    "actor_cumulative": q_actor_cumulative,
    "last_per_group": q_last_per_group,
    "first_per_group": q_first_per_group,
    "lagged_self_join": q_lagged_self_join,
    "group_quantile_fill": q_group_quantile_fill,
    "shrunk_actor_rate": q_shrunk_actor_rate,
    "actor_stats": q_actor_stats,
    "lookup_left_join": q_lookup_left_join,
    "leaderboard": q_leaderboard,
    "asof_state_actor": q_asof_state_actor,
}

_stat = ", ".join
ORACLE = {
    "actor_cumulative": with_plays(
        "select passer, season, game_date, pass_attempts, pass_epa, pass_wpa, qb_pass_attempts, "
        f"{rnd('qb_pass_epa_play')} as qb_pass_epa_play, {rnd('qb_pass_wpa_play')} as qb_pass_wpa_play from qbcum", QB_CTES),
    "last_per_group": with_plays(
        "select passer, season, pass_attempts, pass_epa, pass_wpa, qb_pass_attempts, "
        f"{rnd('qb_pass_epa_play')} as qb_pass_epa_play, {rnd('qb_pass_wpa_play')} as qb_pass_wpa_play from qbseason", QB_CTES),
    "first_per_group": with_plays(
        "select passer, season, pass_attempts, pass_epa, pass_wpa, qb_pass_attempts, "
        f"{rnd('qb_pass_epa_play')} as qb_pass_epa_play, {rnd('qb_pass_wpa_play')} as qb_pass_wpa_play from qbseason", QB_CTES),
    "lagged_self_join": with_plays(
        "select s.passer, s.season, s.qb_pass_attempts, " + rnd("s.qb_pass_epa_play") + " as qb_pass_epa_play, "
        + rnd("s.qb_pass_wpa_play") + " as qb_pass_wpa_play, "
        + ", ".join(f"s{k}.qb_pass_attempts as qb_pass_attempts_{k}, {rnd(f's{k}.qb_pass_epa_play')} as qb_pass_epa_play_{k}, "
                    f"{rnd(f's{k}.qb_pass_wpa_play')} as qb_pass_wpa_play_{k}" for k in (1, 2, 3))
        + " from qbseason s " + " ".join(
            f"left join qbseason s{k} on s{k}.passer = s.passer and s{k}.season + {k} = s.season" for k in (1, 2, 3)),
        QB_CTES),
    "group_quantile_fill": with_plays(
        f"select s.passer, s.season, {rnd('g.q')} as rep_epa_play, {rnd('coalesce(s1.qb_pass_epa_play, g.q)')} as filled_epa_play_1 "
        "from qbseason s left join qbseason s1 on s1.passer = s.passer and s1.season + 1 = s.season "
        "left join (select s.season, quantile_cont(s1.qb_pass_epa_play, 0.2) as q from qbseason s "
        "left join qbseason s1 on s1.passer = s.passer and s1.season + 1 = s.season group by s.season) g on g.season = s.season",
        QB_CTES),
    "shrunk_actor_rate": with_plays(
        "select passer, season, game_date, " + ", ".join(f"{rnd(c)} as {c}" for c in [
            "rep_epa_play", "rep_wpa_play", "rc", "prior_pass_epa_play", "prior_pass_wpa_play",
            "qb_pass_epa_play_adj", "qb_pass_wpa_play_adj"]) + " from shr", SHRINK_CTES),
    "actor_stats": with_plays(
        "select passer, passer_name, season, game_date, " + rnd("qb_pass_attempts") + " as qb_pass_attempts, "
        + rnd("qb_pass_epa_play_adj") + " as qb_pass_epa_play_adj, " + rnd("qb_pass_wpa_play_adj")
        + " as qb_pass_wpa_play_adj from stats", SHRINK_CTES),
    "lookup_left_join": with_plays(
        f"select drive, play_id, passer, p.player_display_name from plays left join "
        f"(select distinct player_id, player_display_name from ({PLAYERS}) pl) p on plays.passer = p.player_id"),
    "leaderboard": with_plays(
        "select passer, passer_name, season, game_date, " + rnd("qb_pass_attempts") + " as qb_pass_attempts, "
        + rnd("qb_pass_epa_play_adj") + " as qb_pass_epa_play_adj, " + rnd("qb_pass_wpa_play_adj")
        + " as qb_pass_wpa_play_adj from (select *, row_number() over (partition by passer, season order by game_date desc) as rn "
        "from stats) t where rn = 1 order by qb_pass_epa_play_adj desc nulls last, passer, season limit 15", SHRINK_CTES),
    "asof_state_actor": with_plays(
        "select passer, season, lead(game_date) over (partition by passer order by season, game_date) as game_date, "
        f"qb_pass_attempts, {rnd('qb_pass_epa_play')} as qb_pass_epa_play from qbcum", QB_CTES),
}
