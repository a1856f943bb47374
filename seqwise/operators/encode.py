"""Fit-on-train encoders and scalers.

Fitted state is tiny (one row per class, one min/max pair per column): the
class table is joined back through a size-checked broadcast, the min/max
pair is read once on the driver and applied as literals, as Spark ML models
hold their fitted state.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seqwise.operators._util import join_null_safe, small_side
from seqwise.operators.aggregate import minmax_fit


def fit_labels(df: DataFrame, col: str, by: list[str] | None = None, code: str | None = None) -> DataFrame:
    """Sorted distinct values -> 0..k-1, a missing value gets the last code.

    ``by`` fits one encoding per group (the source re-fits on every split).
    One row per (group, class): a window over it is bounded by the class count.
    """
    by = by or []
    code = code or f"{col}_encoded"
    d = df.select(*by, col).distinct()
    w = Window.partitionBy(*by).orderBy(F.col(col).asc_nulls_last())
    return d.withColumn(code, (F.row_number().over(w) - 1).cast("int"))


def apply_labels(df: DataFrame, fitted: DataFrame, col: str, by: list[str] | None = None) -> DataFrame:
    """Join the codes; the class table is size-checked and broadcast (a
    shuffle join on a handful of class keys would send a class to one task)."""
    return join_null_safe(df, small_side(fitted), (by or []) + [col], "left")


def minmax_scale(df: DataFrame, cols: list[str], fit_on: DataFrame | None = None) -> DataFrame:
    """(x - min) / (max - min) with min/max from ``fit_on`` (the train rows).
    Constant column: range 1, so x - min. No clipping; NULL stays NULL."""
    row = minmax_fit(fit_on if fit_on is not None else df, cols).first()
    out = {}
    for c in cols:
        mn, mx = row[f"{c}__min"], row[f"{c}__max"]
        if mn is None:
            out[c] = F.lit(None).cast("double")
            continue
        rng = 1.0 if mx == mn else mx - mn
        out[c] = (F.col(c).cast("double") - F.lit(mn)) / F.lit(rng)
    return df.withColumns(out)
