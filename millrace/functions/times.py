"""Timestamp parsing, formatting and calendar flags."""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T

# Fixed value: the layout of timestamps written as text in the raw files.
RAW_LAYOUT = "MM-dd-yyyy HH:mm:ss"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_timestamp(c: Column | str, layout: str = RAW_LAYOUT, strict: bool = False) -> Column:
    """Text to timestamp. Bad text gives null, or an error when ``strict``."""
    parse = F.to_timestamp if strict else F.try_to_timestamp
    return parse(_col(c), layout if strict else F.lit(layout))


def formatted(c: Column | str, layout: str = RAW_LAYOUT) -> Column:
    """Timestamp to text."""
    return F.date_format(_col(c), layout)


def whole_second(c: Column | str) -> Column:
    """Drop the sub-second part; the result is a zoned timestamp."""
    return F.date_trunc("second", _col(c))


def epoch_millis(c: Column | str) -> Column:
    """Milliseconds since the epoch to timestamp."""
    return F.timestamp_millis(_col(c))


def days_between(c: Column | str, as_of: Column | None = None) -> Column:
    """Whole days from ``c`` to ``as_of``, which is now unless given."""
    return F.datediff(F.current_timestamp() if as_of is None else as_of, _col(c))


def weekend_flag(
    c: Column | str, zone: str = "America/New_York", source_zone: str | None = None
) -> Column:
    """1 when the local day in ``zone`` is Saturday or Sunday, else 0; null stays null.

    ``source_zone`` says which zone a timestamp without a zone is in (the session's by default).
    """
    source = F.current_timezone() if source_zone is None else F.lit(source_zone)
    local = F.convert_timezone(source, F.lit(zone), _col(c).cast("timestamp_ntz"))
    return (F.weekday(local) >= 5).cast("int")


def clock_seconds(c: Column | str, kind: T.DataType) -> Column:
    """Seconds since the epoch, rising with the time whatever the session's zone is.

    A timestamp without a zone is counted on its own clock: taken through a zone, its order would
    break where clocks are put forward.
    """
    c = _col(c)
    if isinstance(kind, T.TimestampType):
        return F.unix_seconds(c)
    days = F.unix_date(c.cast("date")).cast("long") * 86400
    if isinstance(kind, T.DateType):
        return days
    return days + F.hour(c) * 3600 + F.minute(c) * 60 + F.second(c)
