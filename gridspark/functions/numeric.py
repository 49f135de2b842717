"""Value expressions: sentinels, units and small maths."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gridspark import vocab


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def missing_to_null(value: Column | str, sentinels: list[int] | None = None) -> Column:
    value = _c(value)
    return F.when(~value.isin(*(sentinels or vocab.ISD_MISSING)), value)


def zero_to_null(value: Column | str) -> Column:
    return F.nullif(_c(value), F.lit(0))


def fahrenheit(tenths: Column | str) -> Column:
    """Tenths of a degree Celsius to Fahrenheit."""
    return 32 + _c(tenths) * 9 / F.lit(50.0)


def temp_shift(tenths: Column | str, centre: float = 150.0) -> Column:
    return centre + F.abs(_c(tenths) - centre)


def sinc(x: Column) -> Column:
    return F.when(F.abs(x) > 1e-16, F.sin(x) / x).otherwise(F.lit(1.0))
