"""Calendar helpers.

Locale month names come from a fixed lookup instead of a session locale;
``date_format(d, 'LLLL')`` only yields the JVM locale's names.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from metricforge.functions.numeric import c

# Full month names, nominative, January first.
MONTH_NAMES = {
    "ru": ["Январь", "Февраль", "Март", "Апрель", "Май", "Июнь",
           "Июль", "Август", "Сентябрь", "Октябрь", "Ноябрь", "Декабрь"],
    "en": ["January", "February", "March", "April", "May", "June",
           "July", "August", "September", "October", "November", "December"],
}


def month_name(month_num, lang: str = "ru") -> Column:
    """Month number 1..12 -> name; a literal array lookup stays in codegen."""
    names = F.array(*[F.lit(n) for n in MONTH_NAMES[lang]])
    return F.element_at(names, c(month_num).cast("int"))


def month_start(ts) -> Column:
    """``DATE_TRUNC('month', d)::date``."""
    return F.trunc(F.to_date(c(ts)), "MM")


def year_range(ts, first_year: int, last_year: int) -> Column:
    """``EXTRACT(YEAR FROM d) BETWEEN a AND b`` written as a range on the raw
    column, so the parquet reader can skip row groups."""
    lo = F.lit(f"{first_year}-01-01 00:00:00").cast("timestamp_ntz")
    hi = F.lit(f"{last_year + 1}-01-01 00:00:00").cast("timestamp_ntz")
    return (c(ts) >= lo) & (c(ts) < hi)
