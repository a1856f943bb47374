"""Missing-value semantics of the source pipeline, as Spark expressions.

The source treats a missing input as poison in sums and running sums, makes
``if`` three-valued, and keeps missing rows under ``!=``. Spark's defaults
differ (``sum`` skips NULL, ``CASE`` sends NULL to ELSE, ``<>`` drops NULL),
so each rule is spelled out here once.
"""

from __future__ import annotations

from pyspark.sql import Column, Window
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def r_ifelse(cond: Column, yes, no) -> Column:
    """Three-valued if: NULL condition gives NULL (not the ELSE arm)."""
    yes = yes if isinstance(yes, Column) else F.lit(yes)
    no = no if isinstance(no, Column) else F.lit(no)
    return F.when(cond.isNull(), F.lit(None)).when(cond, yes).otherwise(no)


def na_sum(c) -> Column:
    """Aggregate sum that is NULL when any input is NULL."""
    c = _c(c)
    return F.when(F.count(F.lit(1)) == F.count(c), F.sum(c))


def na_cumsum(c, window) -> Column:
    """Running sum that is NULL at and after the first NULL of the frame."""
    c = _c(c)
    return F.when(F.count(F.lit(1)).over(window) == F.count(c).over(window),
                  F.sum(c).over(window))


def safe_ratio(num, den) -> Column:
    """Division where 0/0 (NaN in the source) is NULL, always a double."""
    return F.try_divide(_c(num).cast("double"), _c(den).cast("double"))


def nan_to_null(c) -> Column:
    """NaN is missing: normalise it to NULL at ingest."""
    c = _c(c)
    return F.when(~F.isnan(c), c)


def ne_keep_null(c, value) -> Column:
    """``c != value`` that keeps rows where ``c`` is NULL."""
    return ~_c(c).eqNullSafe(F.lit(value))


def not_in(c, values) -> Column:
    """Negated membership that is never NULL (NULL is not in the list)."""
    return F.coalesce(~_c(c).isin(list(values)), F.lit(True))


def eq_flag(a, b) -> Column:
    """1 when a == b, else 0 (NULL on either side gives 0)."""
    return F.when(_c(a) == _c(b), F.lit(1)).otherwise(F.lit(0))


def order_key(*cols) -> Column:
    """Orderable struct with NULLs last per field, for min_by / max_by."""
    parts = []
    for c in cols:
        c = _c(c)
        parts += [c.isNull(), c]
    return F.struct(*parts)


def running(partition, order) -> Window:
    """Frame from the first row of the partition to the current row."""
    return (Window.partitionBy(*partition).orderBy(*order)
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))
