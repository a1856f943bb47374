"""Left equi-joins.

No join here carries a broadcast hint: the attached tables (per-period rates,
per-period ordinals, actor stats, name lookups) are much smaller than the
events, and AQE converts a sort-merge join into a broadcast join at run time
only when the measured size is under ``spark.sql.adaptive.autoBroadcastJoinThreshold``.
That is the size check; beyond it the shuffle join stays.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seqwise.operators import scan
from seqwise.operators._util import join_null_safe


def left_attach(df: DataFrame, side: DataFrame, on: list[str] | None = None,
                null_safe: bool = True) -> DataFrame:
    """Left join on ``on`` or, when None, on every shared column name (a
    natural join). NULL keys match NULL keys, as in the source."""
    if on is None:
        on = [c for c in df.columns if c in set(side.columns)]
    if null_safe:
        return join_null_safe(df, side, on, "left")
    return df.join(side, on, "left")


def lookup(df: DataFrame, dim: DataFrame, left_key: str, right_key: str,
           cols: list[str]) -> DataFrame:
    """Left join to the distinct (key, cols) of a dimension. An id with two
    names fans out, and a NULL id meets a NULL id, as in the source."""
    d = dim.select(F.col(right_key).alias(left_key), *cols).distinct()
    return join_null_safe(df, d, [left_key], "left")


def season_lags(df: DataFrame, actor: str, season: str, cols: list[str],
                lags=(1, 2, 3)) -> DataFrame:
    """Add ``c_k`` = the actor's value of ``c`` in season - k (NULL if absent).

    One row per (actor, season) in ``df``. A range frame [-k, -k] over the
    numeric season replaces k self-joins: one exchange on ``actor``.
    """
    w = Window.partitionBy(actor).orderBy(F.col(season))
    return df.withColumns({f"{c}_{k}": F.max(c).over(w.rangeBetween(-k, -k))
                           for k in lags for c in cols})


def asof_state(df: DataFrame, entity: str, season: str, period: str, cols: list[str],
               shift: int = 1) -> DataFrame:
    """General as-of relabel: the state after period k is keyed by the
    entity's period k + shift (lead across seasons), so an equi-join on
    (entity, season, period) gives each period only earlier state."""
    if shift == 0:
        return df.select(entity, season, period, *cols)
    w = Window.partitionBy(entity).orderBy(F.col(season).asc_nulls_last(), F.col(period).asc_nulls_last())
    return df.select(entity, season, F.lead(period, shift).over(w).alias(period), *cols)


def asof_join(left: DataFrame, right: DataFrame, by: list[str], left_time: str, right_time: str, cols: dict[str, str],
              allow_equal: bool = True, forward: bool = False, tolerance=None, max_rows: int | None = None) -> DataFrame:
    """J6 on unequal times: each row of ``left`` with the latest row of ``right`` of the same
    ``by`` at or before its time (``forward``: the earliest at or after; without
    ``allow_equal``: strictly). ``cols`` maps output names to columns of ``right``;
    they are NULL where nothing matches, or only something further away than ``tolerance``.

    Both sides are laid into one order and the last state is carried by ``prefix_scan``: one
    shuffle of both, a hot key cut by ranges of time, no pair of rows is ever formed. Rows of
    ``right`` should have distinct times in a key (else the one whose columns are the
    greatest counts); rows without a time match nothing; NULL keys match each other."""
    state = F.struct(F.col(right_time).alias("t"), *[F.col(c).alias(f"c{k}") for k, c in enumerate(cols.values())])
    kind = right.select(state.alias("s")).schema["s"].dataType
    rows = left.select(*left.columns, F.col(left_time).alias("__t"), F.lit(None).cast(kind).alias("__state"), F.lit(True).alias("__left"))
    states = right.filter(F.col(right_time).isNotNull()).select(
        *[F.col(k) for k in by], F.col(right_time).cast(left.schema[left_time].dataType).alias("__t"), state.alias("__state"),
        F.lit(False).alias("__left"))
    both = rows.unionByName(states, allowMissingColumns=True)
    # states stand before the rows of their time where they count for them (forward: after)
    first = F.col("__left") if allow_equal != forward else ~F.col("__left")
    both = both.withColumn("__side", first.cast("int"))
    found = scan.prefix_scan(both, by, ["__t", "__side", "__state"], {"__state": scan.Scan("next" if forward else "last", "__state")},
                             max_rows or scan.MAX_ROWS).filter("__left")
    near = F.col("__t").isNotNull() & F.col("__state").isNotNull()
    if tolerance is not None:
        gap = F.col("__state.t") - F.col("__t") if forward else F.col("__t") - F.col("__state.t")
        near = near & (gap <= (tolerance if isinstance(tolerance, Column) else F.lit(tolerance)))
    kept = [c for c in left.columns if c not in cols]
    return found.select(*kept, *[F.when(near, F.col(f"__state.c{k}")).alias(c) for k, c in enumerate(cols)])
