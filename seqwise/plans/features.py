"""Event feature table (C7-C10): enrich, impute, flags and label, split.

The wide events are shuffled once, or never if they are stored in buckets by their row
blocks. What needs their order or their actor (the play
number, the actor fill, the actor's stats) is worked out on a narrow copy of their
keys, shuffled by (entity, period, first order column) and by actor, and joined
to the events by the number of the stored row, which no key makes uneven. Filters on
the events' own columns pass that join, so rows that no split keeps are not moved.
The rates of entity and opponent, one row a (side, season, period), follow by a
size-checked broadcast. None of the joins multiplies rows (keys are unique).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seqwise.config import EventConfig
from seqwise.functions.scalar import label_of, signed_by_side
from seqwise.functions.semantics import eq_flag
from seqwise.operators._util import asc_last, small_side
from seqwise.operators.heavy import SHARE, heavy_join, heavy_keys, key_summary
from seqwise.operators.impute import exact_mean, fill_by_group, fill_constant, fill_from_stats
from seqwise.operators.join import left_attach
from seqwise.operators.project import cols_with_prefix
from seqwise.operators.split import rule_split
from seqwise.operators.window import number_and_fill
from seqwise.plans.priors import actor_stats
from seqwise.plans.rates import asof_rates
from seqwise.session import materialize, materialize_all
from seqwise.sources.bucketed import BLOCK, KEY, ROW, Colocated, join_colocated, join_group_rows, join_rows, numbered

# Columns whose NULLs become 0.
ZERO_FILL = ["qb_pass_wpa_play_adj", "qb_pass_epa_play_adj", "air_yards", "yards_after_catch", "air_epa",
             "yac_epa", "qb_epa", "epa", "wind", "penalty_yards", "yards_gained"]
# 0/1 flags (name, source column, value compared, compare to a column?).
FLAGS = [
    ("pt_penalty", "penalty_team", "posteam", True),
    ("pt_timeout", "timeout_team", "posteam", True),
    ("pass_deep", "pass_length", "deep", False),
    ("pass_right", "pass_location", "right", False),
    ("pass_left", "pass_location", "left", False),
    ("pt_home", "posteam_type", "home", False),
]
FLAG_SOURCES_DROPPED = ["timeout_team", "penalty_team", "pass_length", "pass_location"]


def side_table(events: DataFrame, side: str, prefix: str, number: str, cfg: EventConfig) -> DataFrame:
    """Everything the events take from one side's (side, season, period): its
    as-of rates, the period's ordinal in the season and the event count ``n``.
    A state without a next period belongs to no event, not to those without a
    date, so keys stay unique and no join multiplies events."""
    s, p = cfg.season, cfg.period
    per = events.groupBy(side, s, p).agg(F.count(F.lit(1)).alias(f"{prefix}n"))
    per = per.withColumn(number, F.row_number().over(
        Window.partitionBy(side, s).orderBy(F.col(p).asc_nulls_last())).cast("int"))
    rates = asof_rates(events, side, prefix, cfg).filter(F.col(p).isNotNull())
    return left_attach(per, rates, [side, s, p])


def side_tables(events: DataFrame, players: DataFrame, cfg: EventConfig = EventConfig(),
                stage: bool = True) -> dict:
    """The tables attached to the events: one per side (``side_table``) and the
    actor stats. All keyed far coarser than events.

    ``stage`` writes them once to the shared checkpoint folder, built and
    written as concurrent jobs: the event plan stays short, a lost executor
    re-reads files instead of recomputing the aggregations, and the events
    are not rescanned for each consumer of a side table."""
    side = {
        "pt": lambda: side_table(events, cfg.entity, "pt_", "pos_team_game_no", cfg),
        "dt": lambda: side_table(events, cfg.opponent, "dt_", "def_team_game_no", cfg),
        "actor_stats": lambda: actor_stats(events, players, cfg, stage=stage),
    }
    if stage:
        return materialize_all(side, events.sparkSession)
    return {k: f() for k, f in side.items()}


def heavy_actors(events: DataFrame, cfg: EventConfig = EventConfig(), share: float = SHARE) -> list[int]:
    """Hashes of the (actor, period, season) with more than ``share`` of the events."""
    return heavy_keys(key_summary(events, [cfg.actor, cfg.period, cfg.season]), share)


def attach(events: DataFrame, side: dict, cfg: EventConfig = EventConfig(), heavy: list[int] | None = None) -> DataFrame:
    """C7 joins: play number and actor fill (one two-level pass), signed
    spread, rates and ordinals of both sides, actor stats. ``heavy`` (of
    ``heavy_actors``): actors whose events are salted in the join with their stats, in the same
    one pass; without it an uneven join is left to AQE.

    ``events`` may be stored with the columns of ``numbered``; else they are stored with
    them here, since number, actor and stats are joined back by the row."""
    e, o, s, p = cfg.entity, cfg.opponent, cfg.season, cfg.period
    cols = [c for c in events.columns if c not in (ROW, BLOCK)]
    if ROW not in events.columns:
        events = materialize(numbered(events), name="event_rows")
    narrow = events.select(*dict.fromkeys([ROW, BLOCK, e, s, p, *cfg.order_cols, cfg.actor]))
    own = number_and_fill(narrow, [e, p], cfg.order_cols, "pt_play_no", [cfg.actor])
    own = own.select(ROW, BLOCK, cfg.actor, p, s, "pt_play_no")
    stats, keys = side["actor_stats"], [cfg.actor, p, s]
    own = heavy_join(own, stats, keys, heavy=heavy, mode="salt") if heavy else left_attach(own, stats, keys)
    own = own.drop(p, s)
    ev = join_rows(events.drop(cfg.actor), own)
    spread = {"pt_spread": signed_by_side("spread_line", "posteam_type")} if "spread_line" in cols else {}
    ev = ev.select(*cols, "pt_play_no", *[c.alias(n) for n, c in spread.items()], *[c for c in own.columns if c not in {ROW, BLOCK, *cols, "pt_play_no"}])
    ev = left_attach(ev, small_side(side["pt"].drop("pt_n")), [e, s, p])
    return left_attach(ev, small_side(side["dt"].drop("dt_n")), [o, s, p])


def _number_and_fill_stored(events: DataFrame, cfg: EventConfig) -> DataFrame:
    """Number and actor fill by one window on the stored key."""
    w = Window.partitionBy(KEY).orderBy(*asc_last(cfg.order_cols))
    so_far, back = w.rowsBetween(Window.unboundedPreceding, 0), Window.partitionBy(KEY).orderBy(F.desc("pt_play_no"))
    ev = events.withColumns({"pt_play_no": F.row_number().over(w).cast("int"), "__down": F.last(cfg.actor, ignorenulls=True).over(so_far)})
    up = F.last(cfg.actor, ignorenulls=True).over(back.rowsBetween(Window.unboundedPreceding, 0))
    return ev.withColumn(cfg.actor, F.coalesce("__down", up)).drop("__down")


def attach_colocated(events: DataFrame, side: dict, cfg: EventConfig = EventConfig(), heavy: list[int] | None = None) -> DataFrame:
    """``attach`` for events read from a store bucketed by (entity, period): number and
    actor fill are one window on the stored key, the entity's rates move to the events'
    buckets. Two shuffles of the events are left, those of opponent and actor; none if the
    store has numbered rows: then a narrow copy meets the actor's stats and comes back to its
    rows, and the opponent's rates follow by a size-checked broadcast."""
    e, o, s, p = cfg.entity, cfg.opponent, cfg.season, cfg.period
    if ROW in events.columns:
        cols = [c for c in events.columns if c not in (ROW, KEY)]
        own = _number_and_fill_stored(events.select(*dict.fromkeys([KEY, ROW, s, p, *cfg.order_cols, cfg.actor])), cfg)
        own = own.select(KEY, ROW, cfg.actor, p, s, "pt_play_no")
        stats, keys = side["actor_stats"], [cfg.actor, p, s]
        own = heavy_join(own, stats, keys, heavy=heavy, mode="salt") if heavy else left_attach(own, stats, keys)
        ev = join_group_rows(events.drop(cfg.actor), own.drop(p, s))
        spread = {"pt_spread": signed_by_side("spread_line", "posteam_type")} if "spread_line" in cols else {}
        ev = ev.withColumns(spread) if spread else ev
        ev = join_colocated(ev, side["pt"].drop("pt_n"), [e, p], [s])
        ev = left_attach(ev, small_side(side["dt"].drop("dt_n")), [o, s, p])
        made = [c for c in (*side["pt"].columns, *side["dt"].columns, *stats.columns) if c not in {e, o, *keys, "pt_n", "dt_n"}]
        return ev.select(*cols, "pt_play_no", *spread, *made)
    ev = _number_and_fill_stored(events, cfg)
    if "spread_line" in ev.columns:
        ev = ev.withColumn("pt_spread", signed_by_side("spread_line", "posteam_type"))
    ev = join_colocated(ev, side["pt"].drop("pt_n"), [e, p], [s]).drop(KEY)
    ev = left_attach(ev, side["dt"].drop("dt_n"), [o, s, p])
    if heavy:
        return heavy_join(ev, side["actor_stats"], [cfg.actor, p, s], heavy=heavy, mode="salt")
    return left_attach(ev, side["actor_stats"], [cfg.actor, p, s])


def enrich_events(events: DataFrame, players: DataFrame, cfg: EventConfig = EventConfig(),
                  stage: bool = True, heavy_share: float | None = None) -> DataFrame:
    """Play number, signed spread, as-of rates of both sides, period
    ordinals, actor filled inside the period, actor stats. ``heavy_share``: actors
    of a period with more than this share of the events are salted (one more narrow pass)."""
    heavy = heavy_actors(events, cfg, heavy_share) if heavy_share else None
    return attach(events, side_tables(events, players, cfg, stage), cfg, heavy)


# rate and count as decimals whose product keeps all 12 digits (38, 12)
RATE_DECIMAL, COUNT_DECIMAL = "decimal(26,12)", "decimal(11,0)"


def merge_groups(frames: list[DataFrame], keys: list[str]) -> DataFrame:
    """Group tables side by side, NULL keys as a group of their own."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out.groupBy(*keys).agg(*[F.max(c).alias(c) for c in out.columns if c not in keys])


def joined_rate_means(side: dict, cfg: EventConfig = EventConfig()) -> DataFrame:
    """Season means, over events, of the rate columns the events received by
    the left joins: sum(rate x events of the period) / sum(events of periods
    with a rate). The same exact 12-digit sums as averaging the joined events,
    computed on the per-period tables; a count beyond 11 digits fails."""
    s = cfg.season
    parts = []
    for name, keys in (("pt", {cfg.entity, s, cfg.period, "pt_n", "pos_team_game_no"}),
                       ("dt", {cfg.opponent, s, cfg.period, "dt_n", "def_team_game_no"})):
        t = side[name]
        n = F.col(f"{name}_n")
        fits = F.when(n < 10 ** 11, n).otherwise(F.raise_error(F.lit("too many events in a period")).cast("long"))
        aggs = [F.try_divide(
            F.sum(F.when(F.col(c).isNotNull(), F.col(c).cast(RATE_DECIMAL) * fits.cast(COUNT_DECIMAL))).cast("double"),
            F.sum(F.when(F.col(c).isNotNull(), n)).cast("double")).alias(f"__g_{c}")
            for c in t.columns if c not in keys]
        parts.append(t.groupBy(s).agg(*aggs))
    return merge_groups(parts, [s])


def impute(ev: DataFrame, cfg: EventConfig = EventConfig(), zero_cols=ZERO_FILL,
           mean_prefixes=("pt_", "dt"), roof_default: str = "dome",
           known_means: DataFrame | None = None, known_week: DataFrame | None = None,
           never_null=()) -> DataFrame:
    """Zeros, event-weighted season means by prefix, a constant roof,
    and the per-week mean temperature rounded half to even.

    ``known_means`` (season -> ``__g_<col>``) and ``known_week`` (week ->
    ``__g_temp``) supply means computed elsewhere; ``never_null`` names
    columns NULL-free by construction (their fill is a no-op). Whatever is
    left is averaged over ``ev`` itself."""
    ev = fill_constant(ev, [c for c in zero_cols if c in ev.columns], 0)
    prefixed = cols_with_prefix(ev, *mean_prefixes)
    # a mean fill leaves a NULL-free column's values alone but makes it a double
    ev = ev.withColumns({c: F.col(c).cast("double") for c in prefixed if c in set(never_null)})
    cols = [c for c in prefixed if c not in set(never_null)]
    known = set()
    if known_means is not None:
        known = {c for c in cols if f"__g_{c}" in known_means.columns}
        ev = fill_from_stats(ev, known_means, [cfg.season], sorted(known))
    ev = fill_by_group(ev, [cfg.season], [c for c in cols if c not in known], how="mean")
    if "roof" in ev.columns:
        ev = fill_constant(ev, ["roof"], roof_default)
    if "temp" in ev.columns:
        if known_week is not None:
            ev = fill_from_stats(ev, known_week, [cfg.week], ["temp"])
        else:
            ev = fill_by_group(ev, [cfg.week], ["temp"], how="rounded_mean")
    return ev


def raw_event_means(events: DataFrame, cfg: EventConfig = EventConfig()):
    """Group means of the imputed columns that are per-row functions of the
    raw events (the signed spread by season, temperature by week, rounded
    half to even), computed on the raw events: same rows, same exact sums,
    no pass over the enriched table."""
    season = None
    if "spread_line" in events.columns:
        season = events.groupBy(cfg.season).agg(
            exact_mean(signed_by_side("spread_line", "posteam_type")).alias("__g_pt_spread"))
    week = None
    if "temp" in events.columns:
        week = events.groupBy(cfg.week).agg(F.bround(exact_mean("temp"), 0).alias("__g_temp"))
    return season, week


def impute_attached(ev: DataFrame, events: DataFrame, side: dict, cfg: EventConfig = EventConfig()) -> DataFrame:
    """C8 of ``ev``, the ``events`` with the tables of ``side`` attached, in one pass: every statistic
    comes from the side tables or the raw events, so ``ev`` is neither stored nor read twice."""
    rates = joined_rate_means(side, cfg)
    spread, week = raw_event_means(events, cfg)
    means = rates if spread is None else merge_groups([rates, spread], [cfg.season])
    return impute(ev, cfg, known_means=means, known_week=week, never_null=("pt_play_no",))


def flags_and_label(ev: DataFrame, cfg: EventConfig = EventConfig()) -> DataFrame:
    """0/1 flags (missing -> 0), drop their sources, derive the label,
    default a missing down to 1."""
    flags = {}
    for name, src, other, is_col in FLAGS:
        if src in ev.columns:
            flags[name] = eq_flag(src, F.col(cfg.entity if other == "posteam" else other) if is_col
                                  else F.lit(other))
    ev = ev.withColumns(flags).drop(*FLAG_SOURCES_DROPPED)
    ev = ev.withColumn(cfg.label, label_of(cfg.label, "qb_dropback", "run_location"))
    return ev.withColumn("down", F.coalesce(F.col("down"), F.lit(1)))


def build_features(events: DataFrame | Colocated, players: DataFrame, cfg: EventConfig = EventConfig(),
                   min_season: int = 2016, test_season: int = 2022, stage: bool = True) -> DataFrame:
    """C7 -> C10: the full event feature table with a ``split`` column.

    ``events`` may be a store of ``write_colocated`` grouped by (entity, period): its
    events are numbered and filled as they lie. A store with a group too large
    for a task is read like any other table.

    Every statistic the imputation needs comes from the side tables or the
    raw events (``joined_rate_means``, ``raw_event_means``; the play number is
    NULL-free), so the enriched events are produced in a single pass and
    never stored or read twice."""
    together = None
    if isinstance(events, Colocated):
        if events.group != (cfg.entity, cfg.period):
            raise ValueError(f"events are stored by {events.group}, not by {(cfg.entity, cfg.period)}")
        stored = events.read(players.sparkSession)
        together, events = stored if events.even else None, stored.drop(KEY, ROW)
    side = side_tables(events, players, cfg, stage)
    ev = attach(events, side, cfg) if together is None else attach_colocated(together, side, cfg)
    ev = flags_and_label(impute_attached(ev, events, side, cfg), cfg)
    ev = ev.drop("run_location")
    return rule_split(ev, cfg.season, cfg.week, min_season, test_season)
