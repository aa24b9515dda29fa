from metricforge.functions.numeric import c, dec_round, money, ratio, pct, ratio_eps
from metricforge.functions.text import normalize_text, strip_unicode, contains_flag
from metricforge.functions.coerce import coerce_numeric, coerce_date, midpoint
from metricforge.functions.binning import bucketize, classify_size
from metricforge.functions.calendar import month_name, month_start, year_range

__all__ = [
    "c", "dec_round", "money", "ratio", "pct", "ratio_eps",
    "normalize_text", "strip_unicode", "contains_flag",
    "coerce_numeric", "coerce_date", "midpoint",
    "bucketize", "classify_size",
    "month_name", "month_start", "year_range",
]
