"""Actor running stats and multi-season shrinkage.

Per (actor, season, period) sums -> running rates per (actor, season) ->
end-of-season row -> that row for the three previous seasons -> per-season
quantile fills -> prior = weighted past rate plus a replacement level
weighted by a typical sample size -> adjusted rate = (rate·n + rc·prior)/(rc + n).

Everything after the first aggregation runs on the actor-period table.
Quantiles are exact per season (``exact_quantiles``: a bounded sketch to
bracket the rank, then only the narrow band of values is ranked), so no
season's values are held in one buffer.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seqwise.config import EventConfig
from seqwise.functions.semantics import na_cumsum, na_sum, running, safe_ratio
from seqwise.operators._util import asc_last, join_null_safe, small_side
from seqwise.operators.aggregate import first_per_group, last_per_group
from seqwise.operators.join import lookup, season_lags
from seqwise.operators.quantile import exact_quantiles
from seqwise.session import materialize

STAT_COLS = ["qb_pass_attempts", "qb_pass_epa_play", "qb_pass_wpa_play"]


def actor_cumulative(events: DataFrame, cfg: EventConfig = EventConfig()) -> DataFrame:
    """C4: running pass attempts and per-attempt measures per (actor, season)
    at each of the actor's periods, current period included; NULL -> 0."""
    a, s, p = cfg.actor, cfg.season, cfg.period
    pa = F.col("pass_attempt")
    epa, wpa = F.col(cfg.measures[0]), F.col(cfg.measures[1])
    per = (events.filter(F.col(a).isNotNull()).groupBy(a, s, p)
           .agg(na_sum(pa).alias("pass_attempts"), na_sum(epa * pa).alias("pass_epa"),
                na_sum(wpa * pa).alias("pass_wpa")))
    w = running([a, s], asc_last([p]))
    cum = per.select(
        a, s, p, "pass_attempts", "pass_epa", "pass_wpa",
        na_cumsum("pass_attempts", w).alias("qb_pass_attempts"),
        safe_ratio(na_cumsum("pass_epa", w), na_cumsum("pass_attempts", w)).alias("qb_pass_epa_play"),
        safe_ratio(na_cumsum("pass_wpa", w), na_cumsum("pass_attempts", w)).alias("qb_pass_wpa_play"))
    nums = ["pass_attempts", "pass_epa", "pass_wpa"] + STAT_COLS
    return cum.withColumns({c: F.coalesce(F.col(c), F.lit(0)) for c in nums})


def actor_season(cum: DataFrame, cfg: EventConfig = EventConfig()) -> DataFrame:
    """Last running row of each (actor, season)."""
    return last_per_group(cum, [cfg.actor, cfg.season], [cfg.period]).drop(cfg.period)


def shrunk_rates(cum: DataFrame, cfg: EventConfig = EventConfig(), weights=(0.6, 0.3, 0.1),
                 rep_q: float = 0.2, rc_q: float = 0.25, stage: bool = False) -> DataFrame:
    """Prior and adjusted per-attempt rates on every (actor, season, period).

    ``stage`` writes the running table joined to its season lags once: the
    quantile passes, the fill and the prior all read it."""
    a, s = cfg.actor, cfg.season
    lagged = season_lags(actor_season(cum, cfg).select(a, s, *STAT_COLS), a, s, STAT_COLS,
                         lags=range(1, len(weights) + 1))
    lag_cols = [f"{c}_{k}" for k in range(1, len(weights) + 1) for c in STAT_COLS]
    j = join_null_safe(cum, lagged.select(a, s, *lag_cols), [a, s], "left")
    if stage:
        j = materialize(j, name="actor_lagged")
    qcols = STAT_COLS + lag_cols      # every column named qb_pass_*
    # a stored ``j`` needs no second copy inside the quantile passes
    q = exact_quantiles(j, [s], qcols, rep_q, prefix="__q_", stage=not stage)
    j = join_null_safe(j, small_side(q), [s], "left")
    j = j.withColumns({
        "rep_epa_play": F.col("__q_qb_pass_epa_play_1"),
        "rep_wpa_play": F.col("__q_qb_pass_wpa_play_1"),
        **{c: F.coalesce(F.col(c).cast("double"), F.col(f"__q_{c}")) for c in qcols},
    }).drop(*[f"__q_{c}" for c in qcols])
    rc = exact_quantiles(j, [s], ["qb_pass_attempts_1"], rc_q, prefix="__rc_", stage=not stage).withColumnRenamed(
        "__rc_qb_pass_attempts_1", "rc")
    j = join_null_safe(j, small_side(rc), [s], "left")
    rcc = F.col("rc")
    n = len(weights)

    def prior(rate, rep):
        num = None
        den = None
        for k, wk in enumerate(weights, start=1):
            t = F.lit(wk) * (F.col(f"qb_pass_{rate}_play_{k}") * F.col(f"qb_pass_attempts_{k}"))
            d = F.lit(wk) * F.col(f"qb_pass_attempts_{k}")
            num = t if num is None else num + t
            den = d if den is None else den + d
        return F.try_divide(num + F.col(rep) * rcc, den + rcc)

    assert n >= 1
    j = j.withColumns({"prior_pass_epa_play": prior("epa", "rep_epa_play"),
                       "prior_pass_wpa_play": prior("wpa", "rep_wpa_play")})
    att = F.col("qb_pass_attempts")
    return j.withColumns({
        "qb_pass_epa_play_adj": F.try_divide(F.col("qb_pass_epa_play") * att + rcc * F.col("prior_pass_epa_play"), rcc + att),
        "qb_pass_wpa_play_adj": F.try_divide(F.col("qb_pass_wpa_play") * att + rcc * F.col("prior_pass_wpa_play"), rcc + att),
    })


def actor_stats(events: DataFrame, players: DataFrame, cfg: EventConfig = EventConfig(),
                player_key: str = "player_id", player_name: str = "player_display_name",
                stage: bool = False) -> DataFrame:
    """C4+C5+J4: actor stats keyed (actor, season, period) with the actor's name.

    The running table feeds four consumers (season rows and lags, the join,
    two quantile passes); ``stage`` writes it once so the events are scanned
    once instead of per consumer."""
    cum = actor_cumulative(events, cfg)
    if stage:
        cum = materialize(cum, name="actor_cumulative")
    shr = shrunk_rates(cum, cfg, stage=stage)
    named = lookup(shr, players, cfg.actor, player_key, [player_name])
    return named.select(cfg.actor, F.col(player_name).alias(f"{cfg.actor}_name"), cfg.season, cfg.period,
                        "qb_pass_attempts", "qb_pass_epa_play_adj", "qb_pass_wpa_play_adj")


def leaderboard(stats: DataFrame, cfg: EventConfig = EventConfig(), score: str = "qb_pass_epa_play_adj",
                k: int = 15) -> DataFrame:
    """Latest row per (actor, season), best ``k`` by score (NULLs last),
    ties broken by actor then season. Plans as TakeOrderedAndProject."""
    latest = first_per_group(stats, [cfg.actor, cfg.season], [cfg.period])
    return latest.orderBy(F.col(score).desc_nulls_last(), F.col(cfg.actor).asc_nulls_last(),
                          F.col(cfg.season).asc_nulls_last()).limit(k)
