"""Column functions: parsing, dates, geometry, text. All stay inside the JVM."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidewright.fixed import ACCESS_LOG_PATTERN, ANONYMOUS_USER, DELAY_LIMITS

# ---- numbers --------------------------------------------------------------------------


def lenient_int(c: Column, blank: str = "null") -> Column:
    """The leading whole number of a text ("12.7" and "12abc" give 12).

    Without one, or out of range: null, or 0 with `blank="zero"`.
    """
    n = F.regexp_extract(c.cast("string"), r"^\s*([+-]?\d+)", 1).try_cast("int")
    return F.coalesce(n, F.lit(0)) if blank == "zero" else n


def lenient_double(c: Column) -> Column:
    """The number at the start of a text ("3.5kg" gives 3.5), else null."""
    text = F.regexp_extract(c.cast("string"), r"^\s*([+-]?(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?)", 1)
    return text.try_cast("double")


def clamp(c: Column, low: float, high: float) -> Column:
    return F.greatest(F.lit(float(low)), F.least(F.lit(float(high)), c))


def above(c: Column, threshold: float) -> Column:
    """1.0 where the value is above the threshold, else 0.0."""
    return F.when(c > threshold, 1.0).otherwise(0.0)


def log_ratio(top: Column | float, c: Column) -> Column:
    return F.ln(top / c)


# ---- dates ----------------------------------------------------------------------------


def date_of(c: Column) -> Column:
    """The date at the start of a text such as 2013-07-01."""
    return F.try_to_date(F.regexp_extract(c, r"(\d{4}-\d{1,2}-\d{1,2})", 1), "yyyy-M-d")


def instant_of(day: Column, clock: Column) -> Column:
    """Date text and clock text joined into one instant; null if either is broken."""
    return F.try_to_timestamp(F.concat_ws(" ", day, clock), F.lit("yyyy-M-d H:m[:s]"))


def day_key(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM-dd")


def on_calendar_day(c: Column, month: int, day: int) -> Column:
    return (F.month(c) == month) & (F.day(c) == day)


# ---- geometry of delays ---------------------------------------------------------------


def bearing(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Clockwise angle in (0, 360] from the first point to the second, 360 along the x axis."""
    turn = F.degrees(F.atan2(lat2 - lat1, lon2 - lon1))
    return F.lit(360.0) - F.pmod(turn, F.lit(360.0))


def compass_region(angle: Column) -> Column:
    """Twelve 30-degree sectors counted from north: the sector index moved three on, modulo 12.

    Sector 12 (an angle of exactly 360) lands on region 3.
    """
    return F.pmod(F.floor(angle / 30) + 3, F.lit(12)).cast("int")


def delay_status(delay: Column, limits: Sequence[int] = DELAY_LIMITS) -> Column:
    """ontime / delay_minor / delay_major. A missing delay counts as 0, so as on time."""
    on_time, minor = limits
    d = F.coalesce(delay, F.lit(0))
    return (F.when(d <= on_time, "ontime").when(d <= minor, "delay_minor")
            .otherwise("delay_major"))


# ---- text -----------------------------------------------------------------------------


def words(c: Column, lower: bool = False) -> Column:
    """Words of a text, split at spaces and line ends; blank pieces dropped."""
    text = F.lower(c) if lower else c
    return F.filter(F.split(text, "[ \r\n]"), lambda w: w.rlike(r"[^ \t\n\f\r]"))


def title_year(c: Column) -> Column:
    """The year in brackets of a title such as `Heat (1995)`; null when there is none."""
    return F.regexp_extract(c, r"\((\d{4})\)", 1).try_cast("int")


def without_leading_quote(c: Column) -> Column:
    return F.regexp_replace(c, '^"', "")


def mentions_any(c: Column, names: Sequence[str]) -> Column:
    """True where the text contains one of the given words (plain substrings)."""
    hit = F.lit(False)
    for name in names:
        hit = hit | c.contains(name)
    return hit


# ---- access logs ----------------------------------------------------------------------


def access_log(c: Column) -> Column:
    """An access-log line as struct(ip, user, query, bytes).

    ip, user and query are null for lines that do not match and for anonymous users;
    bytes is 0 where the line has none.
    """
    matched = c.rlike(ACCESS_LOG_PATTERN)

    def part(i):
        return F.regexp_extract(c, ACCESS_LOG_PATTERN, i)

    known = matched & (part(3) != ANONYMOUS_USER)
    return F.struct(
        F.when(known, part(1)).alias("ip"),
        F.when(known, part(3)).alias("user"),
        F.when(known, part(5)).alias("query"),
        F.coalesce(part(7).try_cast("bigint"), F.lit(0)).alias("bytes"),
    )
