"""Grouped aggregates: per-period facts, per-group first/last rows, audits.

All are ``groupBy().agg()`` with partial (map-side) aggregation, so a hot
group is combined before the shuffle. First/last rows use ``max_by`` /
``min_by`` on an order struct instead of sorting whole groups.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seqwise.config import EventConfig
from seqwise.functions.semantics import na_sum, order_key, r_ifelse
from seqwise.operators._util import asc_last, join_null_safe


def cond_count(cond, poison: bool = True):
    s = na_sum if poison else F.sum
    return s(r_ifelse(cond, 1, 0))


def cond_sum(cond, c, poison: bool = True):
    s = na_sum if poison else F.sum
    return s(r_ifelse(cond, F.col(c) if isinstance(c, str) else c, 0))


def first_k_per_group(df: DataFrame, keys: list[str], order: list[str], k: int) -> DataFrame:
    """Rows ranked 1..k per group by ``order`` (NULLs last).

    ``row_number() <= k`` lets Spark insert a partial per-group limit before
    the exchange (WindowGroupLimit), so at most k rows per group and map
    task are shuffled, however large the group.
    """
    w = Window.partitionBy(*keys).orderBy(*asc_last(order))
    return df.withColumn("__rk", F.row_number().over(w)).filter(F.col("__rk") <= k).drop("__rk")


def shadowed_sum(flag: str, c: str, order: list[str], poison: bool = True):
    """The source's summary reuses a name: once ``flag`` is replaced by its
    group total, ``sum(ifelse(flag == 1, c, 0))`` tests that total and takes
    ``c`` from the group's first row. Result: first row's ``c`` when the total
    is exactly 1, else 0; NULL when the total is NULL."""
    total = (na_sum if poison else F.sum)(F.col(flag))
    first_c = F.min_by(F.col(c), order_key(*order))
    return r_ifelse(total == 1, first_c, F.lit(0))


FACT_COLUMNS = [
    "first_downs", "second_downs", "third_downs", "fourth_downs", "neutral_wp", "goal_to_go",
    "scripted", "rush_attempts", "pass_attempts", "fd_pass", "sd_pass", "td_pass",
    "neutral_pass", "gtg_pass", "scripted_pass", "run_left", "run_right",
    "rush_epa", "pass_epa", "rush_wpa", "pass_wpa",
]


def period_facts(df: DataFrame, side: str, cfg: EventConfig = EventConfig(),
                 poison: bool = True, shadowed: bool = True) -> DataFrame:
    """One row per (side, season, period) with the conditional counts and sums
    the rates are built from (C1)."""
    keys = [side, cfg.season, cfg.period]
    order = cfg.order_cols
    s = na_sum if poison else F.sum
    down, pa, ra = F.col("down"), F.col("pass_attempt"), F.col("rush_attempt")
    wp, epa, wpa = F.col("wp"), F.col(cfg.measures[0]), F.col(cfg.measures[1])
    neutral = (wp > F.lit(cfg.neutral_lo)) & (wp < F.lit(cfg.neutral_hi))
    loc = F.coalesce(F.col("run_location"), F.lit("middle"))
    gtg = (shadowed_sum("goal_to_go", "pass_attempt", order, poison) if shadowed
           else cond_sum(F.col("goal_to_go") == 1, pa, poison))
    facts = df.groupBy(*keys).agg(
        cond_count(down == 1, poison).alias("first_downs"),
        cond_count(down == 2, poison).alias("second_downs"),
        cond_count(down == 3, poison).alias("third_downs"),
        cond_count(down == 4, poison).alias("fourth_downs"),
        cond_count(neutral, poison).alias("neutral_wp"),
        s(F.col("goal_to_go")).alias("goal_to_go"),
        # rows numbered 1..n: at most k of them are <= k, never missing
        F.least(F.count(F.lit(1)), F.lit(cfg.scripted_k)).cast("bigint").alias("scripted"),
        s(ra).alias("rush_attempts"),
        s(pa).alias("pass_attempts"),
        cond_sum(down == 1, pa, poison).alias("fd_pass"),
        cond_sum(down == 2, pa, poison).alias("sd_pass"),
        cond_sum(down == 3, pa, poison).alias("td_pass"),
        cond_sum(neutral, pa, poison).alias("neutral_pass"),
        gtg.cast("bigint").alias("gtg_pass"),
        cond_count((ra == 1) & (loc == "left"), poison).alias("run_left"),
        cond_count((ra == 1) & (loc == "right"), poison).alias("run_right"),
        s(epa * ra).alias("rush_epa"),
        s(epa * pa).alias("pass_epa"),
        s(wpa * ra).alias("rush_wpa"),
        s(wpa * pa).alias("pass_wpa"),
    )
    scripted = (first_k_per_group(df.select(*keys, *order, "pass_attempt"), keys, order, cfg.scripted_k)
                .groupBy(*keys).agg(s(pa).alias("scripted_pass")))
    out = join_null_safe(facts, scripted, keys, "left")
    return out.select(*keys, *FACT_COLUMNS)


def last_per_group(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Last row per group by ``order`` (``slice_tail(n=1)`` after sorting)."""
    rest = [c for c in df.columns if c not in keys]
    agg = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), order_key(*order)).alias("__r"))
    return agg.select(*keys, *[F.col("__r")[c].alias(c) for c in rest])


def first_per_group(df: DataFrame, keys: list[str], order_desc: list[str]) -> DataFrame:
    """First row per group after a descending sort (``slice_head(n=1)``): the
    greatest non-NULL order value; NULLs sort last in either direction, so a
    NULL row is first only where there is no other."""
    rest = [c for c in df.columns if c not in keys]
    first = F.struct(*[f for c in order_desc for f in (F.col(c).isNotNull(), F.col(c))])
    agg = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), first).alias("__r"))
    return agg.select(*keys, *[F.col("__r")[c].alias(c) for c in rest])


def distinct_count(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.select(*keys).distinct().agg(F.count(F.lit(1)).alias("n"))


def null_audit(df: DataFrame) -> DataFrame:
    """NULL count per column in one pass, returned long (column, n_null)."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    stack = ", ".join(f"'{c}', `{c}`" for c in df.columns)
    return counts.selectExpr(f"stack({len(df.columns)}, {stack}) as (column_name, n_null)")


def class_balance(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias("n"))


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """Balanced class weights n / (k * n_c), one row per class.

    The class count k and the total n come from a window over the per-class
    table, which has one row per class (small by construction)."""
    per = df.groupBy(label).agg(F.count(F.lit(1)).alias("n_c"))
    w = Window.partitionBy()
    return per.select(label, "n_c", (F.sum("n_c").over(w) / (F.count(F.lit(1)).over(w) * F.col("n_c")))
                      .alias("weight"))


def minmax_fit(df: DataFrame, cols: list[str]) -> DataFrame:
    """One row with min and max of every column (NULLs skipped)."""
    aggs = []
    for c in cols:
        aggs += [F.min(c).cast("double").alias(f"{c}__min"), F.max(c).cast("double").alias(f"{c}__max")]
    return df.agg(*aggs)
