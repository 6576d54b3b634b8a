"""Small column helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def div(dividend: Column, divisor: Column | int) -> Column:
    """Integer division as bigint (exact, unlike `floor` of a double)."""
    divisor = F.lit(divisor) if isinstance(divisor, int) else divisor
    return F.call_function("div", dividend, divisor)
