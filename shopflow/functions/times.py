"""Time handling: wire epochs, zone shift, truncation, recency.

Event times are stored as ``TIMESTAMP_NTZ`` wall-clock readings in a zone chosen
by the caller (the reference fixes Asia/Bangkok).  Conversions (epoch, zone
shift, truncation) and the second-to-week differences of :func:`elapsed` do not
depend on ``spark.sql.session.timeZone``; only the month / quarter / year
differences use Spark's ``timestampdiff``, whose calendar reading follows the
session zone (``shopflow.session`` sets UTC).  The reference time of recency
columns is an explicit ``as_of`` argument instead of a hidden
``current_timestamp()`` frozen into a snapshot.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

#: zone of the reference deployment (fixed value)
REFERENCE_ZONE = "Asia/Bangkok"

#: lower bound used for "no previous order" (fixed value)
EARLIEST = _dt.datetime(1900, 1, 1)

_EPOCH = _dt.datetime(1970, 1, 1)

AsOf = "str | _dt.datetime | Column | None"


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def ntz_literal(value: str | _dt.datetime) -> Column:
    """A ``TIMESTAMP_NTZ`` literal."""
    if isinstance(value, str):
        value = _dt.datetime.fromisoformat(value)
    return F.lit(value.replace(tzinfo=None)).cast("timestamp_ntz")


def epoch_ntz() -> Column:
    return ntz_literal(_EPOCH)


def now_in_zone(zone: str = "UTC") -> Column:
    """Processing time as a whole-second wall-clock reading in ``zone``.

    ``current_timestamp()`` is fixed per query (per micro-batch on a stream).
    """
    return truncate_to_second(F.convert_timezone(None, F.lit(zone), F.current_timestamp()))


def as_of_column(as_of: AsOf = None, zone: str = REFERENCE_ZONE) -> Column:
    """Reference time for recency maths; ``None`` means "now" as a wall clock in
    ``zone`` -- the zone of the event times it is compared with."""
    if as_of is None:
        return F.convert_timezone(None, F.lit(zone), F.current_timestamp())
    if isinstance(as_of, Column):
        return as_of
    return ntz_literal(as_of)


def epoch_seconds(col: str | Column) -> Column:
    """Whole seconds since 1970-01-01 of an NTZ wall-clock value (floor)."""
    c = _c(col)
    secs = F.unix_timestamp(c)  # NTZ input: read as UTC, no session zone involved
    # unix_timestamp truncates toward zero; step back for fractional pre-epoch values
    return F.when(F.timestamp_add("SECOND", secs, epoch_ntz()) > c, secs - 1).otherwise(secs)


def epoch_micros(col: str | Column) -> Column:
    """Microseconds since 1970-01-01 of an NTZ wall-clock value, read as UTC
    (no session zone involved)."""
    c = _c(col)
    frac = F.date_part(F.lit("SECOND"), c)  # seconds of the minute, with micros
    micros_of_second = ((frac - F.floor(frac)) * F.lit(1_000_000)).cast("long")
    return epoch_seconds(c) * F.lit(1_000_000) + micros_of_second


def truncate_to_second(col: str | Column) -> Column:
    """Drop sub-second digits of an NTZ value without touching any time zone."""
    return F.timestamp_add("SECOND", epoch_seconds(col), epoch_ntz())


def from_epoch_millis(ms: str | Column, zone: str = REFERENCE_ZONE) -> Column:
    """Wire ``ts`` (epoch ms) -> whole-second wall-clock time in ``zone``.

    Same values as the reference's ``from_utc_timestamp(from_unixtime(ms/1000,
    'yyyy-MM-dd HH:mm:ss'), zone)`` under a UTC session: milliseconds are cut
    (toward zero, as the ``long`` cast of ``from_unixtime`` does), then the UTC
    reading is moved to ``zone``, honouring its offset history.
    """
    secs = (_c(ms) / F.lit(1000)).cast("long")
    utc_wall = F.timestamp_add("SECOND", secs, epoch_ntz())
    if zone.upper() in ("UTC", "Z", "+00:00", "ETC/UTC"):
        return utc_wall
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), utc_wall)


def shift_zone(col: str | Column, zone: str = REFERENCE_ZONE, source_zone: str = "UTC") -> Column:
    """Re-read a ``source_zone`` wall-clock value in ``zone`` (``from_utc_timestamp``)."""
    return F.convert_timezone(F.lit(source_zone), F.lit(zone), _c(col).cast("timestamp_ntz"))


#: fixed-length units of ``elapsed``, in microseconds
_FIXED_UNITS = {"second": 1_000_000, "minute": 60_000_000, "hour": 3_600_000_000,
                "day": 86_400_000_000, "week": 604_800_000_000}
#: calendar units of ``elapsed`` -> Spark ``timestampdiff`` units
_CALENDAR_UNITS = {"month": "MONTH", "quarter": "QUARTER", "year": "YEAR"}


def elapsed(unit: str, start: str | Column, end: Column) -> Column:
    """Whole ``unit``s from ``start`` to ``end``, truncated toward zero
    (negative when ``start`` is later) -- ``DATEDIFF(unit, start, end)``.

    Seconds to weeks are computed from zone-free epoch microseconds; months,
    quarters and years use Spark's calendar ``timestampdiff``."""
    u = unit.lower()
    if u in _FIXED_UNITS:
        diff = epoch_micros(end) - epoch_micros(start)
        step = F.lit(_FIXED_UNITS[u])
        # integer division truncating toward zero, like timestampdiff
        return F.when(diff >= 0, F.floor(diff / step)).otherwise(-F.floor(-diff / step)).cast("long")
    return F.timestamp_diff(_CALENDAR_UNITS[u], _c(start), end)


def recency_columns(ts: str | Column, as_of: Column) -> list[Column]:
    """The three recency columns of the click history tables."""
    return [
        elapsed("hour", ts, as_of).alias("hours_since_timestamp"),
        elapsed("day", ts, as_of).alias("days_since_timestamp"),
        elapsed("month", ts, as_of).alias("month_since_timestamp"),
    ]


def within_days(ts: str | Column, as_of: Column, days: int) -> Column:
    """``DATEDIFF(day, ts, as_of) < days`` written on the raw column.

    Whole elapsed days < n  <=>  ts > as_of - n days (and every ``ts`` after
    ``as_of`` qualifies), so the predicate is a plain range on ``ts`` that the
    parquet reader can push down.  NULL ``ts`` is dropped as in the reference.
    """
    return _c(ts) > as_of - F.make_dt_interval(F.lit(days))


def since(ts: str | Column, as_of: Column, minutes: int) -> Column:
    """``ts >= as_of - INTERVAL n MINUTES`` (inclusive, no upper bound)."""
    return _c(ts) >= as_of - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(minutes))


def month_key(ts: str | Column) -> Column:
    """``date_format(ts, 'yyyyMM')``."""
    return F.date_format(_c(ts), "yyyyMM")

