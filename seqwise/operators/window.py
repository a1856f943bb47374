"""Ordered numbering, running sums, lead and bidirectional fill.

Numbering and filling at event grain use a two-level scan so that a hot
group is never sorted in one task: rows are first numbered inside
(group, first order column) buckets, then each bucket gets an offset from a
running sum over the per-bucket summary table, which is smaller than the
event table by the bucket size. The result is exact.

The first order column must be a coarse sub-group of the group (drives in a
game, days in a user's history): with a unique first column the summary is
as large as the events and the running scan over it holds the whole group
again. With a single order column there is no such sub-group: the range-cut
``prefix_scan`` makes one for the groups that need it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seqwise.functions.semantics import na_cumsum, order_key, running, safe_ratio
from seqwise.operators import scan
from seqwise.operators._util import asc_last, desc_first, join_dealt, join_null_safe


def number_within(df: DataFrame, keys: list[str], order: list[str], name: str,
                  two_level: bool = True, total: str | None = None) -> DataFrame:
    """Dense 1-based row number per group in ``order`` (NULLs last); ``total``
    names a column for the rows of the group."""
    if not two_level:
        w = Window.partitionBy(*keys).orderBy(*asc_last(order))
        out = df.withColumn(name, F.row_number().over(w).cast("int"))
        return out.withColumn(total, F.count(F.lit(1)).over(Window.partitionBy(*keys))) if total else out
    if len(order) < 2:
        out = scan.prefix_scan(df, keys, order, {name: scan.Scan("number")}, scan.MAX_ROWS)
        out = out.withColumn(name, F.col(name).cast("int"))
        if not total:
            return out
        return join_null_safe(out, df.groupBy(*keys).agg(F.count(F.lit(1)).alias(total)), keys, "inner")
    head, rest = order[0], list(order[1:])
    # sizes of the buckets: partial counts, not a window over the events
    sizes = df.groupBy(*keys, head).agg(F.count(F.lit(1)).alias("__n_in"))
    before = Window.partitionBy(*keys).orderBy(*asc_last([head])).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(*keys, head, F.coalesce(F.sum("__n_in").over(before), F.lit(0)).alias("__off"),
                           *([F.sum("__n_in").over(Window.partitionBy(*keys)).alias(total)] if total else []))
    # dealt once for the window and the join, by a hash that is never NULL
    at = F.xxhash64(*keys, head)
    inner = Window.partitionBy("__at", *keys, head).orderBy(*asc_last(rest))
    local = df.withColumn("__at", at).repartition("__at").withColumn("__rn_in", F.row_number().over(inner))
    out = join_dealt(local, offsets.withColumn("__at", at), "__at", [*keys, head])
    return out.withColumn(name, (F.col("__off") + F.col("__rn_in")).cast("int")).drop("__rn_in", "__off", "__at")


def fill_downup(df: DataFrame, keys: list[str], order: list[str], col: str,
                two_level: bool = True) -> DataFrame:
    """Fill NULLs from the last non-NULL at or before the row, else from the
    first non-NULL after it, inside each group."""
    v = F.col(col)
    if two_level and len(order) < 2:
        return scan.prefix_scan(df, keys, order, {col: scan.Scan("down_up", f"`{col}`")}, scan.MAX_ROWS)
    if not two_level:
        w = Window.partitionBy(*keys).orderBy(*asc_last(order))
        down = F.last(v, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))
        back = Window.partitionBy(*keys).orderBy(F.desc("__at")).rowsBetween(Window.unboundedPreceding, 0)
        out = df.withColumns({"__at": F.row_number().over(w), "__down": down})
        return out.withColumn(col, F.coalesce("__down", F.last(v, ignorenulls=True).over(back))).drop("__at", "__down")
    head, rest = order[0], list(order[1:])
    inner = Window.partitionBy(*keys, head).orderBy(*asc_last(rest))
    back = Window.partitionBy(*keys, head).orderBy(F.desc("__rn_in")).rowsBetween(Window.unboundedPreceding, 0)
    local = (df.withColumns({"__rn_in": F.row_number().over(inner), "__down_in": F.last(v, ignorenulls=True).over(
                inner.rowsBetween(Window.unboundedPreceding, 0))})
             .withColumn("__up_in", F.last(v, ignorenulls=True).over(back)))
    # per bucket: its last and first non-NULL value (partial aggregation, so
    # a hot bucket is combined map-side); buckets without a value stay NULL
    okey = F.when(v.isNotNull(), order_key(*rest))
    buckets = df.groupBy(*keys, head).agg(F.max_by(v, okey).alias("__b_last"), F.min_by(v, okey).alias("__b_first"))
    wb = Window.partitionBy(*keys)
    buckets = buckets.select(
        *keys, head,
        F.last("__b_last", ignorenulls=True).over(
            wb.orderBy(*asc_last([head])).rowsBetween(Window.unboundedPreceding, -1)).alias("__prev"),
        F.last("__b_first", ignorenulls=True).over(
            wb.orderBy(*desc_first([head])).rowsBetween(Window.unboundedPreceding, -1)).alias("__next"))
    out = join_null_safe(local, buckets, keys + [head], "inner")
    filled = F.coalesce(F.col("__down_in"), F.col("__prev"), F.col("__up_in"), F.col("__next"))
    return out.withColumn(col, filled).drop("__rn_in", "__down_in", "__up_in", "__prev", "__next")


def period_ordinal(df: DataFrame, entity: str, season: str, period: str, name: str) -> DataFrame:
    """Ordinal of each distinct period inside (entity, season)."""
    d = df.select(entity, season, period).distinct()
    w = Window.partitionBy(entity, season).orderBy(*asc_last([period]))
    return d.withColumn(name, F.row_number().over(w).cast("int"))


def lead_period(df: DataFrame, entity: str, order: list[str], col: str) -> DataFrame:
    """Replace ``col`` by its next value per entity (across seasons)."""
    w = Window.partitionBy(entity).orderBy(*asc_last(order))
    return df.withColumn(col, F.lead(col).over(w))


def cumulative_sums(df: DataFrame, keys: list[str], order: list[str], sums: dict[str, str],
                    poisoned: bool = False, max_rows: int | None = None) -> DataFrame:
    """Running sums at event grain by the range-cut scan: ``sums`` maps a name to a
    SQL expression; NULLs are skipped, or ``poisoned``: NULL at and after the first."""
    kind = "poisoned" if poisoned else "sum"
    return scan.prefix_scan(df, keys, order, {n: scan.Scan(kind, e) for n, e in sums.items()}, max_rows or scan.MAX_ROWS)


def cumulative_ratio(df: DataFrame, keys: list[str], order: list[str], specs, prefix: str = "") -> DataFrame:
    """For each (name, numerator, denominator): running-sum ratio per group.

    Running sums are poisoned by NULL (NULL at and after the first NULL);
    0/0 is NULL. ``numerator``/``denominator`` are SQL expressions or Columns.
    """
    w = running(keys, asc_last(order))
    cols = {}
    for name, num, den in specs:
        num = F.expr(num) if isinstance(num, str) else num
        den = F.expr(den) if isinstance(den, str) else den
        cols[prefix + name] = safe_ratio(na_cumsum(num, w), na_cumsum(den, w))
    return df.withColumns(cols)


def number_and_fill(df: DataFrame, keys: list[str], order: list[str], name: str,
                    fill_cols: list[str]) -> DataFrame:
    """``number_within`` and ``fill_downup`` of ``fill_cols`` in one two-level
    pass: one per-bucket summary (count, last and first non-NULL value; a
    partial aggregation over a narrow projection), one running scan over the
    summary, one join back on (group, bucket) that reuses the events'
    partitioning. Same results as the two operators applied in turn."""
    head, rest = order[0], list(order[1:])
    okey = order_key(*rest)
    aggs = [F.count(F.lit(1)).alias("__n")]
    for c in fill_cols:
        v = F.col(c)
        aggs += [F.max_by(v, F.when(v.isNotNull(), okey)).alias(f"__bl_{c}"),
                 F.min_by(v, F.when(v.isNotNull(), okey)).alias(f"__bf_{c}")]
    summ = df.select(*keys, head, *rest, *fill_cols).groupBy(*keys, head).agg(*aggs)
    wb = Window.partitionBy(*keys)
    before = wb.orderBy(*asc_last([head])).rowsBetween(Window.unboundedPreceding, -1)
    after = wb.orderBy(*desc_first([head])).rowsBetween(Window.unboundedPreceding, -1)
    summ = summ.select(
        *keys, head,
        F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__off"),
        *[F.last(f"__bl_{c}", ignorenulls=True).over(before).alias(f"__prev_{c}") for c in fill_cols],
        *[F.last(f"__bf_{c}", ignorenulls=True).over(after).alias(f"__next_{c}") for c in fill_cols])
    inner = Window.partitionBy(*keys, head).orderBy(*asc_last(rest))
    local = df.withColumns({
        "__rn_in": F.row_number().over(inner),
        **{f"__down_{c}": F.last(c, ignorenulls=True).over(inner.rowsBetween(Window.unboundedPreceding, 0))
           for c in fill_cols}})
    back = Window.partitionBy(*keys, head).orderBy(F.desc("__rn_in")).rowsBetween(Window.unboundedPreceding, 0)
    local = local.withColumns({f"__up_{c}": F.last(c, ignorenulls=True).over(back) for c in fill_cols})
    j = join_null_safe(local, summ, keys + [head], "inner")
    out = {c: F.coalesce(F.col(f"__down_{c}"), F.col(f"__prev_{c}"), F.col(f"__up_{c}"), F.col(f"__next_{c}"))
           for c in fill_cols}
    out[name] = (F.col("__off") + F.col("__rn_in")).cast("int")
    cols = [out.get(c, F.col(c)).alias(c) for c in df.columns] + ([out[name].alias(name)] if name not in df.columns else [])
    return j.select(*cols)
