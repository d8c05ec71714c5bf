"""Time helpers independent of the session time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def epoch_micros(col: str) -> Column:
    """Microseconds since 1970-01-01 of a wall-clock (TIMESTAMP_NTZ) value."""
    return F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', CAST(`{col}` AS TIMESTAMP_NTZ))")
