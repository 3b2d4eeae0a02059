"""Column-level helpers shared by every model (all JVM-side built-ins)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the source project's for identical results.
# Product page slug: lower-case, every run of characters outside [a-z0-9] becomes
# one '-', leading/trailing '-' removed, prefixed with '/'.
SLUG_PATTERN = "[^a-z0-9]+"
SLUG_SEPARATOR = "-"
URL_PREFIX = "/"
# Label for a missing channel attribute in the channel mart.
NONE_LABEL = "(none)"
# Floor for the incremental cutoff when the target holds no dated row.
EMPTY_TARGET_DATE = _dt.date(1900, 1, 1)
LOOKBACK_DAYS = 7


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def product_page_url(name: Column | str) -> Column:
    """'/' + slug(name); NULL name -> NULL (NULL-propagating concat)."""
    slug = F.regexp_replace(F.lower(_c(name)), SLUG_PATTERN, SLUG_SEPARATOR)
    return F.concat(F.lit(URL_PREFIX), F.btrim(slug, F.lit(SLUG_SEPARATOR)))


def safe_ratio(num: Column | str, den: Column | str) -> Column:
    """num / den, NULL when den is 0 (the branch guards ANSI divide-by-zero)."""
    n, d = _c(num), _c(den)
    return F.when(d == 0, F.lit(None)).otherwise(n.cast("double") / d.cast("double"))


def flag(cond: Column) -> Column:
    """CASE WHEN cond THEN true ELSE false END: NULL condition gives false."""
    return F.when(cond, F.lit(True)).otherwise(F.lit(False))


def count_if(cond: Column) -> Column:
    """SUM(CASE WHEN cond THEN 1 ELSE 0 END) as a long (0 for an all-NULL cond)."""
    return F.sum(F.when(cond, F.lit(1)).otherwise(F.lit(0))).cast("long")


def seconds_between(start: Column | str, end: Column | str) -> Column:
    """Number of whole-second boundaries crossed from start to end.

    00:00:00.9 -> 00:00:01.1 is 1 (a boundary is crossed) although only 0.2 s
    elapse; both ends are truncated to the second before differencing.
    """
    a = F.date_trunc("second", _c(start))
    b = F.date_trunc("second", _c(end))
    return F.timestamp_diff("SECOND", a, b)


def to_date(c: Column | str) -> Column:
    return _c(c).cast("timestamp_ntz").cast("date")
