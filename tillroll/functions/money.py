"""Money helpers (F7, F10, F11, S1-S3): minor units to decimals, exact rounding, zero guards."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def cent() -> Column:
    return F.lit(0.01).cast("decimal(3,2)")


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def minor_to_major(col, scale_type: str = "decimal(20,2)") -> Column:
    """Integer pence/cents to a decimal amount (exact; never integer division)."""
    return (_c(col).cast("decimal(20,0)") * cent()).cast(scale_type)


def nullif_zero(col) -> Column:
    c = _c(col)
    return F.when(c != 0, c)


def avg_half_up(col, places: int = 2) -> Column:
    """Exact average of a non-negative integer column rounded half-up to `places` (aggregate expression).

    Computed in integers as (2 * 10^p * sum + n) div (2n), then scaled back, so no binary fraction and no
    intermediate decimal rounding can move a tie.
    """
    c = _c(col).cast("bigint")
    scale = 10 ** places
    n = F.count(c)
    num = F.sum(c) * (2 * scale) + n
    den = n * 2
    quotient = (num - F.pmod(num, den)).cast("decimal(38,0)") / den.cast("decimal(38,0)")
    return F.when(n > 0, quotient.cast("bigint").cast("double") / scale)
