"""Local days of ISO timestamps, independent of the session time zone."""

from __future__ import annotations

from datetime import date
from zoneinfo import ZoneInfo

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerloom.functions.once import bind

_DATE = r"(?:(\d{4})-(\d\d)-(\d\d)|(\d{4})(\d\d)(\d\d)|(\d{4})-W(\d\d)(?:-(\d))?|(\d{4})W(\d\d)(\d)?)"
_TIME = r"(?:(\d\d)(?::(\d\d)(?::(\d\d)(?:[.,](\d+))?)?)?|(\d\d)(\d\d)(?:(\d\d)(?:[.,](\d+))?)?)"
_OFFSET = r"([+-])(\d\d)(?::?(\d\d)(?::?(\d\d)(?:[.,]\d+)?)?)?"
_ISO = rf"(?s)\A{_DATE}.{_TIME}{_OFFSET}\z"

_USUAL = r"\A(?!0000)\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d(?:\.\d{1,6})?(?:Z|[+-]\d\d:\d\d)\z"

# The alternatives of one field exclude each other, so joining their groups
# leaves the one that matched.
_FIELDS = {
    "year": (1, 4),
    "month": (2, 5),
    "day": (3, 6),
    "week_year": (7, 10),
    "week": (8, 11),
    "weekday": (9, 12),
    "hour": (13, 17),
    "minute": (14, 18),
    "second": (15, 19),
    "fraction": (16, 20),
    "sign": (21,),
    "offset_hour": (22,),
    "offset_minute": (23,),
    "offset_second": (24,),
}
_FIELD_LIST = "|".join("".join(f"${group}" for group in groups) for groups in _FIELDS.values())


def _week_date(year: Column, week: Column, weekday: Column) -> Column:
    monday = F.date_trunc("week", F.make_date(year, F.lit(1), F.lit(4)).cast("timestamp_ntz")).cast("date")
    # Week 53 exists only if its Thursday is still in the same year.
    exists = week.between(1, 53) & (F.year(F.date_add(monday, (week - 1) * 7 + 3)) == year)
    day = F.date_add(monday, (week - 1) * 7 + weekday - 1)
    return F.when((year >= 1) & exists & weekday.between(1, 7), day)


def _instant(fields: Column) -> Column:
    def text(name: str) -> Column:
        return fields[list(_FIELDS).index(name)]

    def number(name: str) -> Column:
        return F.nullif(text(name), F.lit("")).cast("int")

    def or_zero(name: str) -> Column:
        return F.coalesce(number(name), F.lit(0))

    calendar = F.try_to_date(F.concat_ws("-", text("year"), text("month"), text("day")), "yyyy-MM-dd")
    week_date = _week_date(
        number("week_year"), number("week"), F.coalesce(number("weekday"), F.lit(1))
    )
    day = F.when(text("year") == "", week_date).when(number("year") >= 1, calendar)
    offset = or_zero("offset_hour") * 3600 + or_zero("offset_minute") * 60 + or_zero("offset_second")
    signed = F.when(text("sign") == "-", -offset).otherwise(offset)
    seconds = or_zero("hour") * 3600 + or_zero("minute") * 60 + or_zero("second") - signed
    micros = F.rpad(F.substring(text("fraction"), 1, 6), 6, "0").cast("decimal(18,6)") / 1_000_000
    valid = (
        (number("hour") < 24)
        & (or_zero("minute") < 60)
        & (or_zero("second") < 60)
        & (offset < 86_400)
    )
    zero = F.lit(0)
    shifted = day.cast("timestamp_ntz") + F.make_dt_interval(zero, zero, zero, seconds + micros)
    return F.when(valid, shifted)


def _epoch_plus(micros: Column) -> Column:
    zero = F.lit(0)
    seconds = micros.cast("decimal(18,0)") / F.lit(1_000_000).cast("decimal(7,0)")
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return epoch + F.make_dt_interval(zero, zero, zero, seconds.cast("decimal(18,6)"))


def utc_instant(text: Column) -> Column:
    """UTC wall time of an ISO timestamp; null if unparsable or without an offset.

    Calendar, basic and week dates are read, with any one character between
    date and time. Strings without an offset have no instant. The usual form is
    cast directly; only strings that are not of it are taken apart by fields.
    """
    usual = F.when(text.rlike(_USUAL), F.unix_micros(text.try_cast("timestamp")))
    iso = F.replace(text, F.lit("Z"), F.lit("+00:00"))
    fields = F.split(F.regexp_replace(iso, _ISO, _FIELD_LIST), r"\|", -1)
    by_field = bind(
        F.when(iso.rlike(_ISO), fields), lambda f: F.when(f.isNotNull(), _instant(f))
    )
    return F.coalesce(_epoch_plus(usual), by_field)


def day_in_zone(instant: Column, zone: str) -> Column:
    """Calendar day of a UTC wall time in an IANA time zone."""
    ZoneInfo(zone)  # refuse unknown zones before the job starts
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), instant).cast("date")


def local_day(text: Column, zone: str = "UTC") -> Column:
    return day_in_zone(utc_instant(text), zone)


def utc_day(text: Column) -> Column:
    return utc_instant(text).cast("date")


def resolve_day(literal: Column, now: Column, zone: str = "UTC") -> Column:
    """``today``, ``previous-local-day`` or an ISO date, relative to a UTC instant."""
    today = day_in_zone(now, zone)
    return (
        F.when(literal == "today", today)
        .when(literal == "previous-local-day", F.date_sub(today, 1))
        .otherwise(F.try_to_date(literal, "yyyy-MM-dd"))
    )


def utc_day_range(day: date | str) -> tuple[Column, Column]:
    """UTC days that can hold an instant of local ``day`` in any zone."""
    base = F.lit(str(day)).cast("date")
    return F.date_sub(base, 1), F.date_add(base, 1)
