"""Numeric helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def nan_to_null(c: Column | str) -> Column:
    """NaN -> null.  Spark orders NaN above every number, pandas compares it as false;
    turning it into null first gives the pandas-style result in greatest/least checks."""
    c = F.col(c) if isinstance(c, str) else c
    # nanvl references the operand once (a CASE would duplicate it when Catalyst inlines).
    return F.nanvl(c.cast("double"), F.lit(None).cast("double"))


def to_double(c: Column | str) -> Column:
    """Text or number -> double, null when the text does not parse (ANSI-safe)."""
    c = F.col(c) if isinstance(c, str) else c
    return F.try_cast(c, "double") if hasattr(F, "try_cast") else c.try_cast("double")
