"""Helpers shared by the registered queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

DIGITS = 6


def rounded(df: DataFrame, digits: int = DIGITS) -> DataFrame:
    """Round floating outputs for the engine-to-engine compare: float sums
    differ in the last bits with summation order."""
    return df.withColumns({f.name: F.round(F.col(f.name), digits) for f in df.schema.fields
                           if isinstance(f.dataType, (DoubleType, FloatType))})


def rnd(expr: str, digits: int = DIGITS) -> str:
    # + 0.0 turns -0.0 into 0.0, as Spark's decimal rounding does
    return f"(round({expr}, {digits}) + 0.0::double)"
