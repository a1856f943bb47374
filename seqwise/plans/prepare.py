"""Model-input preparation composites."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seqwise.functions.scalar import recode
from seqwise.operators.encode import apply_labels, fit_labels, minmax_scale


def encode_and_scale(df: DataFrame, label: str, mapping: dict, scale_cols: list[str], split: str = "split",
                     fit_labels_on: str = "each", code: str | None = None) -> DataFrame:
    """Recode the label (unmapped -> NULL), encode it (sorted classes,
    missing last; fitted per split as the source does, or on train only),
    then min-max scale ``scale_cols`` with min/max from the train rows."""
    code = code or f"{label}_encoded"
    d = df.withColumn(label, recode(label, mapping))
    if fit_labels_on == "each":
        d = apply_labels(d, fit_labels(d, label, by=[split], code=code), label, by=[split])
    else:
        d = apply_labels(d, fit_labels(d.filter(F.col(split) == "train"), label, code=code), label)
    return minmax_scale(d, scale_cols, fit_on=d.filter(F.col(split) == "train"))
