"""Range-partitioned prefix scan: ordered numbering, running sums and fills of
groups of any size (W1, W2, W4, W11).

A plain window sorts a whole group in one task. Here a group with more than
``max_rows`` rows (a *hot* group) is cut by ranges of its first order column, so a
task sorts and scans one range, and the state at the end of every range is
carried into the next ones in a second pass over one row a range:

1. count rows per group (partial aggregation, one narrow pass); the hot groups
   are at most rows / ``max_rows``;
2. for the hot groups alone, one mergeable quantile sketch each gives the range
   bounds (about ``max_rows`` rows a range);
3. summarise each range (partial aggregation) and scan the summaries;
4. number the events' ranges by a broadcast of the bounds, scan inside
   (group, range), and combine with the broadcast state before the range.

The events are shuffled once, by (group, range); no join brings them back. What is
broadcast has one row a hot group or range, at most about 2 x rows / ``max_rows`` in all;
where that is beyond ``SMALL_ROWS``, ``max_rows`` is doubled until it is not. Bounds only
decide where rows are scanned, never a value: results are those of the plain window
(sums of doubles are added in another order, as in any partial sum). NULL keys are a group, NULL order values come last. Rows with the
same first order value are scanned by one task.

``df`` is read up to four times (narrow projections but for the last): pass a
stored table, not a long computation.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seqwise.functions.semantics import order_key
from seqwise.operators._util import SMALL_ROWS, asc_last, join_null_safe
from seqwise.session import materialize

MAX_ROWS = 1_000_000
MAX_RANGES = 4_096


@dataclass(frozen=True)
class Scan:
    """One scanned column: ``kind`` over ``value`` (a column name or expression).

    number: running row number. sum: running sum skipping NULLs; poisoned sum: NULL
    at and after the first NULL, as in the source. max / min: running extremes.
    last: last non-NULL value so far. next: first non-NULL value from here on.
    down_up: ``last``, else ``next``.
    """
    kind: str
    value: str | None = None

    def __post_init__(self):
        if self.kind not in ("number", "sum", "poisoned", "max", "min", "last", "next", "down_up"):
            raise ValueError(self.kind)
        if (self.value is None) != (self.kind == "number"):
            raise ValueError(f"{self.kind} over {self.value}")

    @property
    def col(self) -> Column:
        return F.lit(1) if self.value is None else F.expr(self.value)

    def local(self, so_far, from_here) -> dict[str, Column]:
        """Parts of the value inside a range; both windows end at the row, ``from_here`` in the
        reverse order."""
        v = self.col
        if self.kind == "number":
            return {"n": F.count(F.lit(1)).over(so_far)}
        if self.kind in ("sum", "max", "min"):
            return {"v": getattr(F, self.kind)(v).over(so_far)}
        if self.kind == "poisoned":
            return {"v": F.sum(v).over(so_far), "nulls": F.count(F.lit(1)).over(so_far) - F.count(v).over(so_far)}
        out = {"last": F.last(v, ignorenulls=True).over(so_far)} if self.kind != "next" else {}
        return out | ({"next": F.last(v, ignorenulls=True).over(from_here)} if self.kind != "last" else {})

    def summary(self, order: Column) -> dict[str, Column]:
        """Parts of the state of a whole range, as aggregates."""
        v = self.col
        if self.kind == "number":
            return {"n": F.count(F.lit(1))}
        if self.kind in ("sum", "max", "min"):
            return {"v": getattr(F, self.kind)(v)}
        if self.kind == "poisoned":
            return {"v": F.sum(v), "nulls": F.count(F.lit(1)) - F.count(v)}
        at = F.when(v.isNotNull(), order)
        out = {"last": F.max_by(v, at)} if self.kind != "next" else {}
        return out | ({"next": F.min_by(v, at)} if self.kind != "last" else {})

    def carried(self, part: str, col: str, before, after) -> Column:
        """The state of a part before (for ``next``: after) a range."""
        if part == "last":
            return F.last(col, ignorenulls=True).over(before)
        if part == "next":
            return F.last(col, ignorenulls=True).over(after)
        return getattr(F, self.kind if self.kind in ("max", "min") else "sum")(col).over(before)

    def combined(self, local: dict[str, Column], before: dict[str, Column]) -> Column:
        if self.kind == "number":
            return F.coalesce(before["n"], F.lit(0)) + local["n"]
        if self.kind == "sum":
            return F.coalesce(before["v"] + local["v"], before["v"], local["v"])
        if self.kind in ("max", "min"):
            return (F.greatest if self.kind == "max" else F.least)(before["v"], local["v"])
        if self.kind == "poisoned":
            none = (F.coalesce(before["nulls"], F.lit(0)) + local["nulls"]) == 0
            return F.when(none, F.coalesce(before["v"] + local["v"], local["v"]))
        down = [local["last"], before["last"]] if "last" in local else []
        up = [local["next"], before["next"]] if "next" in local else []
        return F.coalesce(*down, *up)


def order_number(df: DataFrame, col: str) -> Column:
    """A double that never falls as ``col`` rises, to cut ranges by: numbers, dates and
    timestamps as they are, strings and binaries by their first six bytes."""
    kind = df.schema[col].dataType
    c = F.col(col)
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return F.conv(F.rpad(F.substring(F.hex(c.cast("binary")), 1, 12), 12, "0"), 16, 10).cast("double")
    if isinstance(kind, T.DateType):
        return F.unix_date(c).cast("double")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(c.cast("timestamp")).cast("double")
    return c.cast("double")


def hot_ranges(df: DataFrame, keys: list[str], first: str, max_rows: int = MAX_ROWS) -> DataFrame | None:
    """(keys, ``__bounds``): ascending upper bounds of the ranges of every group of more
    than ``max_rows`` rows; None where there is no such group."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__rows"))
    hot = materialize(counts.filter(F.col("__rows") > max_rows), name="hot_groups")
    total = hot.agg(F.count("*").alias("groups"), F.sum(F.ceil(F.col("__rows") / max_rows)).alias("ranges")).first()
    if not total.groups:
        return None
    while total.groups > SMALL_ROWS or total.ranges > 4 * SMALL_ROWS:
        max_rows *= 2
        hot = hot.filter(F.col("__rows") > max_rows)
        total = hot.agg(F.count("*").alias("groups"), F.sum(F.ceil(F.col("__rows") / max_rows)).alias("ranges")).first()
    most = hot.agg(F.max("__rows")).first()[0]
    ranges = min(MAX_RANGES, -(-most // max_rows))
    at = [k / ranges for k in range(1, ranges)]
    narrow = join_null_safe(df.select(*keys, order_number(df, first).alias("__o")), F.broadcast(hot), keys, "inner")
    cut = narrow.groupBy(*keys).agg(F.percentile_approx("__o", at, max(10_000, 20 * ranges)).alias("__q"), F.max("__rows").alias("__rows"))
    # a smaller hot group keeps every k-th bound only
    step = F.greatest(F.floor(F.lit(ranges) * max_rows / F.col("__rows")), F.lit(1))
    kept = F.filter("__q", lambda q, i: F.pmod(i + 1, step) == 0)
    out = cut.select(*keys, F.array_distinct(F.coalesce(kept, F.array().cast("array<double>"))).alias("__bounds"))
    return materialize(out, name="range_bounds")


def bounds_below(bounds: str, value: Column) -> Column:
    """How many of the ascending ``bounds`` (fewer than ``MAX_RANGES``) are below ``value``, found
    by halving: 12 comparisons a row however many ranges a group has."""
    steps = F.array(*[F.lit(1 << k) for k in reversed(range((MAX_RANGES - 1).bit_length()))])

    def search(v: Column) -> Column:
        return F.aggregate(steps, F.lit(0), lambda at, s: F.when(F.get(bounds, at + s - 1) < v, at + s).otherwise(at))
    return F.transform(F.array(value), search)[0]


def with_range(df: DataFrame, keys: list[str], first: str, bounds: DataFrame | None, how: str = "left") -> DataFrame:
    """``df`` with ``__range``: 0 for groups that are not hot, else the number of bounds
    below the row's value, from 1 on (NULL values: the last range). ``how="inner"``: hot groups alone."""
    if bounds is None:
        return df.withColumn("__range", F.lit(0))
    o = order_number(df, first)
    out = join_null_safe(df, F.broadcast(bounds), keys, how)
    at = F.when(F.col("__bounds").isNull(), 0).when(o.isNull(), F.size("__bounds") + 2).otherwise(bounds_below("__bounds", o) + 1)
    return out.withColumn("__range", at.cast("int")).drop("__bounds")


def prefix_scan(df: DataFrame, keys: list[str], order: list[str], scans: dict[str, Scan],
                max_rows: int = MAX_ROWS) -> DataFrame:
    """``df`` with a column for each of ``scans`` (an existing one is replaced),
    scanned per group of ``keys`` in ``order`` (NULLs last)."""
    bounds = hot_ranges(df, keys, order[0], max_rows)
    ranged = with_range(df, keys, order[0], bounds)
    within = Window.partitionBy(*keys, "__range").orderBy(*asc_last(order))
    so_far = within.rowsBetween(Window.unboundedPreceding, 0)
    # backwards by row number, so that rows of the same order values stay in one order
    from_here = Window.partitionBy(*keys, "__range").orderBy(F.desc("__at")).rowsBetween(Window.unboundedPreceding, 0)
    if any(s.kind in ("next", "down_up") for s in scans.values()):
        ranged = ranged.withColumn("__at", F.row_number().over(within))
    parts = {name: {p: f"__{k}_{p}" for p in s.summary(F.lit(1))} for k, (name, s) in enumerate(scans.items())}
    local = {parts[name][p]: c for name, s in scans.items() for p, c in s.local(so_far, from_here).items()}
    out = ranged.select("*", *[c.alias(n) for n, c in local.items()])
    if bounds is not None:
        states = range_states(with_range(df, keys, order[0], bounds, "inner"), keys, order, scans, parts)
        out = join_null_safe(out, F.broadcast(states), [*keys, "__range"], "left")
    before = {name: {p: F.col(f"{c}_b") if bounds is not None else F.lit(None) for p, c in parts[name].items()} for name in scans}
    made = {name: s.combined({p: F.col(c) for p, c in parts[name].items()}, before[name]) if bounds is not None
            else plain(s, {p: F.col(c) for p, c in parts[name].items()}) for name, s in scans.items()}
    cols = [made[c].alias(c) if c in made else F.col(c) for c in df.columns]
    return out.select(*cols, *[c.alias(n) for n, c in made.items() if n not in df.columns])


def plain(scan: Scan, local: dict[str, Column]) -> Column:
    """The value where no state comes before."""
    if scan.kind == "poisoned":
        return F.when(local["nulls"] == 0, local["v"])
    if scan.kind == "down_up":
        return F.coalesce(local["last"], local["next"])
    return next(iter(local.values()))


def range_states(ranged: DataFrame, keys: list[str], order: list[str], scans: dict[str, Scan],
                 parts: dict[str, dict[str, str]]) -> DataFrame:
    """(keys, ``__range``, state before): one row a range of ``ranged``, the rows of the hot groups."""
    okey = order_key(*order)
    aggs = [c.alias(parts[name][p]) for name, s in scans.items() for p, c in s.summary(okey).items()]
    per = ranged.groupBy(*keys, "__range").agg(*aggs)
    w = Window.partitionBy(*keys)
    before = w.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    after = w.orderBy(F.desc("__range")).rowsBetween(Window.unboundedPreceding, -1)
    carried = [s.carried(p, c, before, after).alias(f"{c}_b") for name, s in scans.items() for p, c in parts[name].items()]
    return materialize(per.select(*keys, "__range", *carried), name="range_states")
