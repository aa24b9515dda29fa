"""Numeric column helpers.

ANSI mode stays on: divisions use ``try_divide`` so a zero denominator is a
NULL, not a failed job. Rounding goes through a decimal first (half away from
zero on the decimal value), which is what the SQL sources do with
``ROUND(x::numeric, n)`` and makes results identical across engines.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Wide enough that the cast itself does not round what is rounded after it.
ROUND_TYPE = "decimal(38,15)"
MONEY_TYPE = "decimal(18,2)"
RATE_TYPE = "decimal(18,9)"


def c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def dec_round(x, scale: int = 2) -> Column:
    """``ROUND(x::numeric, scale)`` returned as double."""
    return F.round(c(x).cast(ROUND_TYPE), scale).cast("double")


def money(x) -> Column:
    """Exact cents; sums of money are exact (and order independent)."""
    return c(x).cast(MONEY_TYPE)


def rate(x) -> Column:
    """A rate for a product with money: exact, but not cut to cents."""
    return c(x).cast(RATE_TYPE)


def ratio(num, den) -> Column:
    """``num / NULLIF(den, 0)`` as double."""
    return F.try_divide(c(num).cast("double"), c(den).cast("double"))


def pct(num, den, scale: int = 2) -> Column:
    """Percent share rounded like the SQL sources."""
    return dec_round(ratio(num, den) * F.lit(100.0), scale)


def ratio_eps(num, den, eps: float = 1e-6) -> Column:
    """Epsilon-guarded ratio ``num / (den + eps)``."""
    return c(num).cast("double") / (c(den).cast("double") + F.lit(eps))
