"""Time columns: epoch millis, `yyyy-MM-dd HH:mm:ss` text and timestamps."""

from __future__ import annotations

import datetime as dt
import re
from zoneinfo import ZoneInfo

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# Fixed formats of the shop records.
TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
DAY_FORMAT = "yyyy-MM-dd"

_UNITS = {
    "millisecond": 1_000, "second": 1_000_000, "minute": 60_000_000,
    "hour": 3_600_000_000, "day": 86_400_000_000, "week": 7 * 86_400_000_000,
}


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def micros(duration: str) -> int:
    """`"5 seconds"` or `"-45 minutes"` as microseconds."""
    m = re.fullmatch(r"\s*(-?\d+)\s+([a-z]+?)s?\s*", duration)
    if not m or m.group(2) not in _UNITS:
        raise ValueError(f"not a duration: {duration!r}")
    return int(m.group(1)) * _UNITS[m.group(2)]


def millis_to_timestamp(c) -> Column:
    return F.timestamp_millis(_col(c))


def timestamp_to_millis(c) -> Column:
    return F.unix_millis(_col(c))


def time_text(c, pattern: str = TIME_FORMAT) -> Column:
    """Timestamp as text in the session zone."""
    return F.date_format(_col(c), pattern)


def millis_to_text(c, pattern: str = TIME_FORMAT) -> Column:
    return time_text(millis_to_timestamp(c), pattern)


def parse_time(c, pattern: str = TIME_FORMAT) -> Column:
    """Text to timestamp; null when it is none.

    The usual format goes through the plain cast, which is several times faster
    than a pattern.
    """
    if pattern in (TIME_FORMAT, DAY_FORMAT):
        return F.try_to_timestamp(_col(c))
    return F.try_to_timestamp(_col(c), F.lit(pattern))


def event_time(df: DataFrame, text: str) -> str:
    """SQL for a record's event time: its `et` or `ts` if any, else parsed text."""
    if "et" in df.columns:
        return "et"
    return "timestamp_millis(ts)" if "ts" in df.columns else f"try_to_timestamp({text})"


def text_to_millis(c, pattern: str = TIME_FORMAT) -> Column:
    return F.unix_millis(parse_time(c, pattern))


def _wall_clock(c, tz: str | None) -> Column:
    # The timestamp_ntz cast shows the session zone's wall clock, which is
    # also the source zone convert_timezone assumes.
    if tz is None:
        return _col(c)
    return F.convert_timezone(None, F.lit(tz), _col(c).cast("timestamp_ntz"))


def local_text(c, tz: str | None = None, pattern: str = TIME_FORMAT) -> Column:
    """Timestamp as text in zone `tz` (the session zone when None)."""
    return F.date_format(_wall_clock(c, tz), pattern)


def day_of(c, tz: str | None = None) -> Column:
    """Calendar day of a timestamp in zone `tz` (the session zone when None)."""
    return F.to_date(_wall_clock(c, tz))


def date_part(c) -> Column:
    """Day portion of time text."""
    return F.substring(_col(c), 1, 10)


def hour_part(c) -> Column:
    """Hour portion of time text."""
    return F.substring(_col(c), 12, 2)


def day_key(c) -> Column:
    """Timestamp as the number yyyymmdd."""
    return F.date_format(_col(c), "yyyyMMdd").cast("int")


def hour_of(c) -> Column:
    return F.hour(_col(c))


def now_millis() -> Column:
    return F.unix_millis(F.current_timestamp())


def age_years(birthday, asof) -> Column:
    """Whole 365-day years between a birthday and `asof`, leap days ignored."""
    seconds = F.unix_timestamp(_col(asof)) - F.unix_timestamp(
        parse_time(birthday, DAY_FORMAT)
    )
    return (seconds / F.lit(365 * 86_400)).cast("int")


def day_range(c, date) -> Column:
    """Predicate "time falls on `date`", for time text and timestamps.

    Written as a range over the column itself, not over a function of it, so
    the parquet reader can skip row groups. `date` is a `date`, `yyyymmdd` or ISO
    text; 0 and None mean today.
    """
    day = as_date(date)
    return (_col(c) >= F.lit(f"{day} 00:00:00")) & (
        _col(c) < F.lit(f"{day + dt.timedelta(days=1)} 00:00:00")
    )


def today() -> dt.date:
    """The day in the session zone, in which times are written as text."""
    session = SparkSession.getActiveSession()
    zone = session.conf.get("spark.sql.session.timeZone") if session else "UTC"
    return dt.datetime.now(ZoneInfo(zone)).date()


def as_date(date) -> dt.date:
    if date in (None, 0, "0"):
        return today()
    if isinstance(date, dt.datetime):
        return date.date()
    if isinstance(date, dt.date):
        return date
    return dt.date.fromisoformat(str(date))
