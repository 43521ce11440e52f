"""Dates kept as ISO strings: strict reading, distances, precision. Session time zone must be UTC."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_INSTANT = "^\\d{4}-\\d{2}-\\d{2}T\\d{2}:\\d{2}(:\\d{2}(\\.\\d{1,9})?)?(Z|[+-]\\d{2}:\\d{2})$"
_DAY = "^\\d{4}-\\d{2}-\\d{2}$"
#: Distance of days of which one can't be read.
FAR = 1_000_000_000


def day(c: Column) -> Column:
    """The date of a bare day; null for anything else and for days that don't exist."""
    return F.when(c.rlike(_DAY), F.try_to_date(c, "yyyy-MM-dd"))


def instant(c: Column) -> Column:
    """The UTC instant of a day (midnight) or of a timestamp with zone; null for naive and impossible ones."""
    return F.when(c.rlike(_DAY), day(c).cast("timestamp")).when(c.rlike(_INSTANT) & F.try_to_date(F.substring(c, 1, 10), "yyyy-MM-dd").isNotNull(), c.try_cast("timestamp"))


def precision(c: Column) -> Column:
    """'day' or 'instant'; null if neither can be read."""
    return F.when(day(c).isNotNull(), "day").when(instant(c).isNotNull(), "instant")


def leading_day(c: Column) -> Column:
    return day(F.substring(c, 1, 10))


def distance(a: Column, b: Column) -> Column:
    """Days between the leading days of two strings; FAR if either can't be read."""
    return F.coalesce(F.abs(F.datediff(leading_day(a), leading_day(b))), F.lit(FAR))


def sortable(c: Column) -> Column:
    return F.coalesce(instant(c), F.lit("1970-01-01").cast("timestamp"))


def from_epoch_millis(c: Column, floor: str = "2010-01-01") -> Column:
    """ISO with milliseconds; null before the floor."""
    t = F.timestamp_millis(c)
    return F.when(t >= F.lit(floor).cast("timestamp"), F.date_format(t, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"))


def from_rfc2822(c: Column) -> Column:
    """The date of a feed item, the name of its day aside."""
    bare = F.regexp_replace(F.regexp_replace(c, "^[A-Za-z]{3},\\s*", ""), "(GMT|UTC|Z)$", "+0000")
    return F.try_to_timestamp(bare, F.lit("d MMM yyyy HH:mm:ss xx"))


def in_prose(c: Column) -> Column:
    """Days spelled with the month's name, in order of sight."""
    found = F.regexp_extract_all(c, F.lit("(?i)\\b(?:January|February|March|April|May|June|July|August|September|October|November|December)\\s+[0-9]{1,2}(?:st|nd|rd|th)?(?:,\\s*|\\s+)[0-9]{4}\\b"), F.lit(0))
    plain = lambda x: F.initcap(F.regexp_replace(F.regexp_replace(x, "(?i)(?<=[0-9])(st|nd|rd|th)", ""), "[,\\s]+", " "))
    return F.filter(F.transform(found, lambda x: F.try_to_date(plain(x), "MMMM d yyyy")), lambda d: d.isNotNull())


def displayed(c: Column) -> Column:
    return F.upper(F.date_format(leading_day(c), "dd MMM yyyy"))
