"""Time text: zone defaults, the ``yyyy-MM-ddDHH:mm:ss`` form, second counts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

D_FORMAT = "yyyy-MM-dd'D'HH:mm:ss.SSSSSS"
SEQ_FORMAT = "yyyyMMddHHmmssSSSSSS"


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def parse_utc(text: Column | str) -> Column:
    """Text to an instant. Text without a zone is read as UTC whatever the
    session zone is; text that is no timestamp gives null."""
    t = F.trim(_col(text))
    zoned = t.rlike(r"(?i)(z|utc|gmt|[+-]\d{2}:?\d{2})$") & t.rlike(r"\d:\d")
    return F.try_to_timestamp(F.when(zoned, t).otherwise(F.concat(t, F.lit("Z"))))


def utc_ntz(instant: Column | str) -> Column:
    """The UTC wall clock of an instant, as a timestamp without zone."""
    return F.timestamp_add(
        "MICROSECOND", F.unix_micros(_col(instant)), F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    )


def from_d_text(text: Column | str) -> Column:
    """``2025-02-17D00:00:00.5`` to a timestamp without zone (microseconds)."""
    return F.to_timestamp_ntz(F.replace(_col(text), F.lit("D"), F.lit(" ")))


def from_d_parts(text: Column | str) -> Column:
    """The same by splitting at the ``D`` and joining the two parts."""
    t = _col(text)
    parts = F.concat_ws(" ", F.split_part(t, F.lit("D"), F.lit(1)), F.split_part(t, F.lit("D"), F.lit(2)))
    return F.to_timestamp_ntz(parts)


def to_d_text(ts: Column | str) -> Column:
    return F.date_format(_col(ts), D_FORMAT)


def second_boundaries(start: Column | str, end: Column | str) -> Column:
    """How many second boundaries lie between two times (not whole seconds
    elapsed: 0.9 s to 1.1 s crosses one)."""
    return F.unix_timestamp(F.date_trunc("second", _col(end))) - F.unix_timestamp(
        F.date_trunc("second", _col(start))
    )


def shift_days(value: Column | str, days: Column | str | int) -> Column:
    """Add days to a timestamp, keeping its clock time."""
    n = F.lit(days) if isinstance(days, int) else _col(days)
    return F.timestamp_add("DAY", n, _col(value))


def shift_seconds(value: Column | str, seconds: Column | str | int) -> Column:
    """Add seconds to a timestamp."""
    n = F.lit(seconds) if isinstance(seconds, int) else _col(seconds)
    return F.timestamp_add("SECOND", n, _col(value))


def shift_hours(value: Column | str, hours: int) -> Column:
    """Add a fixed number of hours, as between two zones that never move their clocks."""
    return F.timestamp_add("HOUR", F.lit(hours), _col(value))


def time_key(ts: Column | str, ordinal: Column | str) -> Column:
    """``yyyyMMddHHmmssffffff`` followed by an ordinal."""
    return F.concat(F.date_format(_col(ts), SEQ_FORMAT), _col(ordinal).cast("string"))
