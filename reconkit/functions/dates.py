"""Date and time expressions."""

from __future__ import annotations

from zoneinfo import available_timezones

from pyspark.sql import Column, functions as F

# The epoch of package-style day and second counts, and the day length.
EPOCH_DATE = "1960-01-01"
DAY_SECONDS = 86400


def days_since_epoch(d: Column) -> Column:
    return F.datediff(F.to_date(d), F.lit(EPOCH_DATE).cast("date"))


def date_from_days(n: Column) -> Column:
    return F.date_add(F.lit(EPOCH_DATE).cast("date"), n.cast("int"))


def seconds_since_epoch(ts: Column) -> Column:
    """Seconds with fraction since 1960-01-01 00:00."""
    return F.timestamp_diff("MICROSECOND", F.lit(EPOCH_DATE).cast("timestamp_ntz"), ts) / F.lit(1e6)


def datetime_from_seconds(s: Column) -> Column:
    micros = F.round(s * F.lit(1e6)).cast("bigint")
    return F.timestamp_add("MICROSECOND", micros, F.lit(EPOCH_DATE).cast("timestamp_ntz"))


def seconds_of_day(ts: Column) -> Column:
    return F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)


def time_from_seconds(s: Column) -> Column:
    """``HH:MM:SS`` text, wrapping at midnight in either direction."""
    s = F.pmod(s.cast("bigint"), F.lit(DAY_SECONDS))
    part = lambda x: F.lpad(x.cast("bigint").cast("string"), 2, "0")
    return F.concat_ws(":", part(F.floor(s / 3600)), part(F.floor(s % 3600 / 60)), part(s % 60))


def year_text(d: Column) -> Column:
    return F.lpad(F.year(d).cast("string"), 4, "0")


def month_text(d: Column) -> Column:
    return F.lpad(F.month(d).cast("string"), 2, "0")


def date_text(d: Column) -> Column:
    """``yyyy-MM-dd``, whatever the session time zone."""
    return F.to_date(d).cast("string")


def years_between(later: Column, earlier: Column) -> Column:
    return F.datediff(later, earlier) / F.lit(365.25)


def whole_days_between(first: Column, last: Column) -> Column:
    return F.floor(F.timestamp_diff("MICROSECOND", first, last) / F.lit(DAY_SECONDS * 1e6)).cast("bigint")


def weekday_monday0(d: Column) -> Column:
    return F.weekday(d)


def is_weekend(d: Column) -> Column:
    return F.weekday(d) >= 5


def iso_text(ts: Column, zone_mark: str = "Z") -> Column:
    return F.date_format(ts, f"yyyy-MM-dd'T'HH:mm:ss'{zone_mark}'")


def in_zone(utc: Column, zone: str) -> Column:
    """Wall-clock time in ``zone`` for a UTC wall-clock time."""
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), utc)


def from_zone(local: Column, zone: str) -> Column:
    """UTC wall-clock time for a wall-clock time in ``zone``."""
    return F.convert_timezone(F.lit(zone), F.lit("UTC"), local)


def is_valid_date(year: Column, month: Column, day: Column) -> Column:
    return F.try_make_timestamp(year, month, day, F.lit(0), F.lit(0), F.lit(0)).isNotNull()


def is_valid_time(hour: Column, minute: Column, second: Column) -> Column:
    ok = lambda x, top: (x >= 0) & (x < top)
    return ok(hour, 24) & ok(minute, 60) & ok(second, 60)


def is_valid_zone(zone: Column) -> Column:
    """Whether the text is a fixed offset of at most 18 hours or a known region name."""
    sign = r"^[+-](\d{2}):([0-5]\d)$"
    hours, minutes = (F.regexp_extract(zone, sign, i).try_cast("int") for i in (1, 2))
    offset = F.coalesce(hours * 60 + minutes <= 18 * 60, F.lit(False))
    return offset | zone.isin(*sorted({"UTC", "GMT", *available_timezones()}))
