"""Type repair for dirty text columns.

``pd.to_numeric(errors='coerce')``: bad text -> NULL, surrounding blanks are
ignored, ``'nan'`` -> missing, exponent notation accepted.
``pd.to_datetime(errors='coerce')``: bad text -> NULL, and dates outside the
nanosecond range 1677-09-22 .. 2262-04-11 -> NULL.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from metricforge.functions.numeric import c

# The representable range of pandas datetime64[ns].
PANDAS_MIN_DATE = "1677-09-22"
PANDAS_MAX_DATE = "2262-04-11"


def coerce_numeric(x, thousands: str | None = None) -> Column:
    """Text -> double, bad text -> NULL, NaN -> NULL. ``thousands``: a
    separator removed first (``'1,000'`` -> 1000; the start-up amounts)."""
    s = c(x).cast("string")
    if thousands:
        s = F.replace(s, F.lit(thousands), F.lit(""))
    v = F.trim(s).try_cast("double")
    return F.when(F.isnan(v), F.lit(None).cast("double")).otherwise(v)


def coerce_date(x, fmt: str = "yyyy-MM-dd", pandas_range: bool = True) -> Column:
    d = F.to_date(F.try_to_timestamp(F.trim(c(x)), F.lit(fmt)))
    if pandas_range:
        d = F.when(d.between(F.lit(PANDAS_MIN_DATE).cast("date"),
                             F.lit(PANDAS_MAX_DATE).cast("date")), d)
    return d


def midpoint(first, last) -> Column:
    """``first + (last - first) / 2`` on wall-clock timestamps (C19),
    microsecond exact and independent of the session time zone (no DST)."""
    f = c(first).cast("timestamp_ntz")
    l = c(last).cast("timestamp_ntz")
    half = F.floor(F.timestamp_diff("MICROSECOND", f, l) / 2)
    return F.timestamp_add("MICROSECOND", half, f)
