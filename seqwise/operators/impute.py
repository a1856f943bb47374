"""Group-wise imputation.

Group statistics are one ``groupBy(keys).agg`` pass whose result has one
row per group value (seasons, weeks). It is joined back through
``small_side``: stored, counted, broadcast only under a row bound, else a
shuffle join. Neither a ``Window.partitionBy(season)`` over events nor a
shuffle join on a season key, both of which would put a whole season in one
task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seqwise.operators._util import join_null_safe, small_side
from seqwise.operators.quantile import exact_quantiles


# Mean over an exact decimal sum: a plain double sum drifts with the number
# and order of addends (the source's mean is accumulated in extended
# precision). 12 decimals, magnitudes up to 1e26.
MEAN_DECIMAL = "decimal(38,12)"


def exact_mean(c):
    col = F.col(c) if isinstance(c, str) else c
    return F.try_divide(F.sum(col.cast(MEAN_DECIMAL)).cast("double"), F.count(col).cast("double"))


def group_stat(df: DataFrame, keys: list[str], cols: list[str], how: str = "mean",
               q: float | None = None) -> DataFrame:
    if how == "quantile":
        return exact_quantiles(df, keys, cols, q, prefix="__g_")
    aggs = []
    for c in cols:
        if how == "mean":
            e = exact_mean(c)
        elif how == "rounded_mean":
            e = F.bround(exact_mean(c), 0)
        else:
            raise ValueError(how)
        aggs.append(e.alias(f"__g_{c}"))
    return df.groupBy(*keys).agg(*aggs)


def fill_by_group(df: DataFrame, keys: list[str], cols: list[str], how: str = "mean",
                  q: float | None = None) -> DataFrame:
    """Replace NULLs in ``cols`` by a per-group statistic of the same column
    (computed before any fill). ``how``: mean | rounded_mean (half-even) |
    quantile (exact, linear interpolation, no whole-group buffer)."""
    if not cols:
        return df
    stats = small_side(group_stat(df, keys, cols, how, q))
    j = join_null_safe(df, stats, keys, "left")
    fill = set(cols)
    return j.select(*[F.coalesce(F.col(c), F.col(f"__g_{c}")).alias(c) if c in fill else F.col(c)
                      for c in df.columns])


def fill_from_stats(df: DataFrame, stats: DataFrame, keys: list[str], cols: list[str]) -> DataFrame:
    """Coalesce ``cols`` with precomputed per-group values ``__g_<col>``."""
    if not cols:
        return df
    j = join_null_safe(df, small_side(stats.select(*keys, *[f"__g_{c}" for c in cols])), keys, "left")
    fill = set(cols)
    return j.select(*[F.coalesce(F.col(c), F.col(f"__g_{c}")).alias(c) if c in fill else F.col(c)
                      for c in df.columns])


def fill_constant(df: DataFrame, cols: list[str], value) -> DataFrame:
    fill = set(cols)
    return df.select(*[F.coalesce(F.col(c), F.lit(value)).alias(c) if c in fill else F.col(c)
                       for c in df.columns])


def group_quantile(df: DataFrame, keys: list[str], col: str, q: float, name: str) -> DataFrame:
    """Per-group exact quantile as a column on every row (source type 7)."""
    stats = exact_quantiles(df, keys, [col], q, prefix="__gq_").withColumnRenamed(f"__gq_{col}", name)
    return join_null_safe(df, small_side(stats), keys, "left")
