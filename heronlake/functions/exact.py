"""Sums, means and roundings that do not depend on the order rows arrive in.

Sums of doubles change with task order and with retries.  Adding decimals does
not, so every reported total goes through ``decimal(18,6)`` and comes back as a
double only at the end.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def dec(c) -> Column:
    return _col(c).cast("decimal(18,6)")


def total(c) -> Column:
    """Exact sum as a double; null when there is nothing to add."""
    return F.sum(dec(c)).cast("double")


def mean(c) -> Column:
    """Exact sum over the count of non-null values; null on empty input."""
    return total(c) / F.nullif(F.count(_col(c)), F.lit(0))


def rnd(c, digits: int = 2) -> Column:
    """Round half up after snapping binary noise away at the eighth digit."""
    return F.round(_col(c).cast("decimal(30,8)"), digits).cast("double")


def ratio(a, b) -> Column:
    """Fractional division that gives null on a zero divisor."""
    return _col(a).cast("double") / F.nullif(_col(b).cast("double"), F.lit(0.0))


def flag(c) -> Column:
    """1 or 0 for a condition; an unknown condition counts as 0."""
    return F.when(c, F.lit(1)).otherwise(F.lit(0))


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c
