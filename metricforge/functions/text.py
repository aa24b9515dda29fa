"""Text helpers.

pandas ``str.strip()`` removes Unicode whitespace; Spark ``trim`` removes
spaces only, so stripping trims an explicit whitespace set.
``str.replace('  ', ' ')`` is one left-to-right pass: three spaces become
two, kept as is.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from metricforge.functions.numeric import c


# pandas ``str.strip()`` removes exactly the characters for which Python's
# ``str.isspace()`` holds; the set is derived from that rule, not listed.
PY_WHITESPACE = "".join(chr(i) for i in range(0x3001) if chr(i).isspace())


def strip_unicode(x) -> Column:
    """Both-ends strip of Python whitespace; a character-set trim, no regex."""
    return F.btrim(c(x), F.lit(PY_WHITESPACE))


def normalize_text(x, lower: bool = True, strip: bool = True, collapse_double: bool = True) -> Column:
    """lower -> strip -> one pass of double space to single space."""
    out = c(x)
    if lower:
        out = F.lower(out)
    if strip:
        out = strip_unicode(out)
    if collapse_double:
        out = F.replace(out, F.lit("  "), F.lit(" "))
    return out


def contains_flag(x, needle: str) -> Column:
    """``str.contains(needle, na=False)`` - literal substring, null is False."""
    return F.coalesce(c(x).contains(F.lit(needle)), F.lit(False))
