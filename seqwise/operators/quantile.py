"""Exact per-group quantiles without one buffer per group.

``percentile`` keeps every distinct value of a group in one aggregation
buffer, so a large group lands whole in one task. Here, per (group,
column): (1) count and bracket the target ranks with ``percentile_approx``
(a bounded sketch); (2) count values below the lower bracket and rank the
distinct values inside the bracket (a narrow band) with a window. Groups
whose bracket misses the target ranks (small groups, heavy ties at the
edges) fall back to the exact aggregate, which is cheap for them. The
result equals ``percentile`` (linear interpolation between the order
statistics at floor and ceil of q·(n-1), as R's type 7).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seqwise.operators._util import join_null_safe, small_side
from seqwise.session import materialize

ACCURACY = 10000
SKETCH = 4096               # size of a stored quantile sketch: rank error 0.13 %


def long_values(df: DataFrame, keys: list[str], cols: list[str]) -> DataFrame:
    """(keys, ``__c`` column name, ``__v`` value) of the non-NULL values."""
    return (df.select(*keys, F.explode(F.array(*[
                F.struct(F.lit(c).alias("c"), F.col(c).cast("double").alias("v")) for c in cols])).alias("__cv"))
            .select(*keys, F.col("__cv.c").alias("__c"), F.col("__cv.v").alias("__v"))
            .filter(F.col("__v").isNotNull()))


def quantile_summary(df: DataFrame, by: list[str], cols: list[str], k: int = SKETCH) -> DataFrame:
    """(``by``, ``__c``, ``__n``, sketch): one mergeable quantile sketch for each group and
    column, e.g. by season, to be stored. ``exact_quantiles`` with ``summary`` merges those
    of the groups it is asked for, so its brackets need no pass over the events. The columns
    of a row are sketched side by side: with many groups Spark sorts what it aggregates, and
    a row for each value would be sorted as often as there are columns."""
    v = [F.col(c).cast("double") for c in cols]
    wide = df.groupBy(*by).agg(F.array(*[
        F.struct(F.lit(c).alias("c"), F.count(x).alias("n"), F.kll_sketch_agg_double(x, F.lit(k)).alias("sketch"))
        for c, x in zip(cols, v)]).alias("__cs"))
    return (wide.select(*by, F.explode("__cs").alias("__cv"))
            .select(*by, F.col("__cv.c").alias("__c"), F.col("__cv.n").alias("__n"), F.col("__cv.sketch").alias("sketch"))
            .filter(F.col("__n") > 0))


def exact_quantiles(df: DataFrame, keys: list[str], cols: list[str], q: float,
                    accuracy: int = ACCURACY, prefix: str = "__q_", stage: bool = True,
                    summary: DataFrame | None = None, k: int = SKETCH) -> DataFrame:
    """One row per group holding a value, ``{prefix}{col}`` = the q-quantile of each column.

    The input is read by three passes; ``stage`` writes its narrow projection
    (keys and the columns) once so a computed input is not recomputed per pass.
    ``summary`` (of ``quantile_summary`` over the same rows, by ``keys`` or finer groups)
    replaces the first pass: one pass over the values is left, and one over the groups
    whose bracket misses, if any."""
    if stage:
        df = materialize(df.select(*keys, *cols), name="quantile_input")
    long = long_values(df, keys, cols)
    gk = keys + ["__c"]
    if summary is None:
        d = 3.0 / accuracy
        st = long.groupBy(*gk).agg(
            F.count(F.lit(1)).alias("__n"),
            F.percentile_approx("__v", [max(0.0, q - d), min(1.0, q + d)], accuracy).alias("__br"))
    else:
        d = 3 * 2.296 / k ** 0.9021              # three times the sketch's rank error
        st = summary.filter(F.col("__c").isin(list(cols))).groupBy(*gk).agg(
            F.sum("__n").alias("__n"), F.kll_merge_agg_double("sketch", F.lit(k)).alias("__s"))
        st = st.select(*gk, "__n", F.array(*[F.kll_sketch_get_quantile_double("__s", F.lit(x))
                                             for x in (max(0.0, q - d), min(1.0, q + d))]).alias("__br"))
    pos = F.lit(q) * (F.col("__n") - 1).cast("double")
    st = st.select(*gk, "__n", pos.alias("__pos"), F.floor(pos).cast("long").alias("__lo_r"),
                   F.ceil(pos).cast("long").alias("__hi_r"),
                   F.col("__br")[0].alias("__lo"), F.col("__br")[1].alias("__hi"))
    # one pass: values below / above the bracket collapse to one counted row
    # each, values inside it stay distinct with their counts
    # one row per (group, column): never a shuffle of the values onto so few keys
    st = small_side(st)
    j = join_null_safe(long, st.select(*gk, "__lo", "__hi"), gk, "inner")
    side = F.when(F.col("__v") < F.col("__lo"), F.lit(-1)).when(F.col("__v") > F.col("__hi"), F.lit(1)).otherwise(F.lit(0))
    hist = (j.select(*gk, side.alias("__side"), F.when(side == 0, F.col("__v")).alias("__v"))
            .groupBy(*gk, "__side", "__v").agg(F.count(F.lit(1)).alias("__k")))
    hist = materialize(hist, name="quantile_bands")          # read twice, made by one pass over the values
    ends = hist.groupBy(*gk).agg(F.sum(F.when(F.col("__side") == -1, F.col("__k")).otherwise(0)).alias("__below"),
                                 F.sum(F.when(F.col("__side") == 1, F.col("__k")).otherwise(0)).alias("__above"))
    st = small_side(join_null_safe(ends, st, gk, "inner").withColumn(
        "__ok", (F.col("__below") <= F.col("__lo_r")) & (F.col("__n") - F.col("__above") > F.col("__hi_r"))))
    band = join_null_safe(hist.filter(F.col("__side") == 0),
                          st.filter("__ok").select(*gk, "__below", "__lo_r", "__hi_r", "__pos"), gk, "inner")
    w = Window.partitionBy(*gk).orderBy("__v").rowsBetween(Window.unboundedPreceding, -1)
    band = band.withColumn("__start", F.col("__below") + F.coalesce(F.sum("__k").over(w), F.lit(0)))
    covers = lambda r: (F.col("__start") <= F.col(r)) & (F.col(r) < F.col("__start") + F.col("__k"))
    picked = band.groupBy(*gk, "__pos", "__lo_r", "__hi_r").agg(
        F.max(F.when(covers("__lo_r"), F.col("__v"))).alias("__vl"),
        F.max(F.when(covers("__hi_r"), F.col("__v"))).alias("__vh"))
    lin = F.when((F.col("__lo_r") == F.col("__hi_r")) | (F.col("__vl") == F.col("__vh")), F.col("__vl")).otherwise(
        (F.col("__hi_r") - F.col("__pos")) * F.col("__vl") + (F.col("__pos") - F.col("__lo_r")) * F.col("__vh"))
    fast = picked.select(*gk, lin.alias("__val"))
    slow = (join_null_safe(long, st.filter(~F.col("__ok")).select(*gk), gk, "inner").groupBy(*gk)
            .agg(F.percentile("__v", F.lit(q)).alias("__val")))
    wide = fast.unionByName(slow).groupBy(*keys).pivot("__c", list(cols)).agg(F.first("__val"))
    # groups without any value are absent: callers left-join, which gives
    # NULL there, as ``percentile`` does
    return wide.select(*keys, *[F.col(c).alias(f"{prefix}{c}") for c in cols])
