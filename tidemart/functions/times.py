"""Time helpers. Epoch values are milliseconds; the zone is always an argument."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemart.functions.values import slice_start

DATE = "yyyy-MM-dd"
DATE_TIME = "yyyy-MM-dd HH:mm:ss"
DAY_MS = 24 * 60 * 60 * 1000


def _col(value) -> Column:
    return F.col(value) if isinstance(value, str) else value


def wall_clock(ms, tz: str = "UTC") -> Column:
    """Zone-less local time of an epoch value, whatever the session zone is."""
    session_clock = F.timestamp_millis(_col(ms)).cast("timestamp_ntz")
    return F.convert_timezone(None, F.lit(tz), session_clock)


def to_date_str(ms, tz: str = "UTC") -> Column:
    return F.date_format(wall_clock(ms, tz), DATE)


def to_ymdhms(ms, tz: str = "UTC") -> Column:
    return F.date_format(wall_clock(ms, tz), DATE_TIME)


def to_ts(text, full: bool = False, tz: str = "UTC") -> Column:
    """Epoch milliseconds of local date text (``full``: date and time); bad text gives NULL."""
    text = _col(text) if full else F.concat(_col(text), F.lit(" 00:00:00"))
    local = F.try_to_timestamp(text, F.lit(DATE_TIME)).cast("timestamp_ntz")
    session = F.convert_timezone(F.lit(tz), F.current_timezone(), local)
    return F.unix_millis(session.cast("timestamp"))


def date_id(text) -> Column:
    """Day of a date-time text; text that is no date gives NULL instead of failing the job."""
    return F.date_format(F.try_to_timestamp(_col(text)), DATE)


def row_time(ms) -> Column:
    """Event time in whole seconds, as the keyword summary uses it."""
    return F.timestamp_millis(slice_start(_col(ms), 1000))


def now_seconds_ms() -> Column:
    """Current time in milliseconds, cut to whole seconds."""
    return F.unix_millis(F.date_trunc("second", F.current_timestamp()))


def now_ms() -> Column:
    return F.unix_millis(F.current_timestamp())


def window_bounds(window="window", tz: str = "UTC") -> list[Column]:
    """Start and end of a window column as text, named ``stt`` and ``edt``."""
    window = _col(window)
    return [
        to_ymdhms(F.unix_millis(window["start"]), tz).alias("stt"),
        to_ymdhms(F.unix_millis(window["end"]), tz).alias("edt"),
    ]
