"""Times as columns. Truth is a long of milliseconds since 1970 in UTC; zones are always explicit."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_EPOCH = "timestamp_ntz'1970-01-01 00:00:00'"


def ms_to_utc(ms: Column) -> Column:
    """Wall-clock time in UTC, without zone, whatever the session's zone is."""
    return F.expr(_EPOCH) + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), (ms.cast("decimal(20,0)") / 1000).cast("decimal(18,6)"))


def in_zone(ms: Column, zone: str) -> Column:
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), ms_to_utc(ms)) if zone != "UTC" else ms_to_utc(ms)


def ms_to_seconds(ms: Column) -> Column:
    return ms / 1000.0


def stamp(ms: Column, zone: str = "UTC") -> Column:
    """yyyyMMdd HHmmss in a zone."""
    return F.date_format(in_zone(ms, zone), "yyyyMMdd HHmmss")


def day(ms: Column, zone: str = "UTC") -> Column:
    return F.to_date(in_zone(ms, zone))


def archive_day(ms: Column, zone: str = "UTC") -> Column:
    """The daily file of a row: a row exactly at midnight stays in the old file."""
    return day(ms - 1, zone)


def snapped_hour(ms: Column, zone: str = "UTC") -> Column:
    return F.date_trunc("hour", in_zone(ms, zone)).cast("timestamp_ntz")


def clock_name(at: Column) -> Column:
    """A time of day as people write it: noon, midnight, 3pm, 3:04pm, 3:04:05pm, with a fraction of a second where there is one."""
    half = F.lower(F.date_format(at, "a"))
    fraction = F.rtrim(F.date_format(at, "SSSSSS"), F.lit("0"))
    return (
        F.when(fraction != "", F.concat(F.date_format(at, "h:mm:ss"), F.lit("."), fraction, half))
        .when(F.second(at) != 0, F.concat(F.date_format(at, "h:mm:ss"), half))
        .when(F.minute(at) != 0, F.concat(F.date_format(at, "h:mm"), half))
        .when(F.hour(at) == 0, "midnight").when(F.hour(at) == 12, "noon")
        .otherwise(F.concat(F.date_format(at, "h"), half))
    )


def human(now: Column, at: Column) -> Column:
    """A later time in UTC as seen from now: its clock time today, tomorrow, on a weekday within a week, else with its date.

    Midnight belongs to the day that it ends. A time that isn't later is given in full.
    """
    clock, fraction = clock_name(at), F.rtrim(F.date_format(at, "SSSSSS"), F.lit("0"))
    days = F.date_diff(F.to_date(at), F.to_date(now)) - F.when(clock == "midnight", 1).otherwise(0)
    full = F.concat(F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss"), F.when(fraction != "", F.concat(F.lit("."), fraction)).otherwise(""), F.lit("Z"))
    on = lambda day: F.concat(day, F.lit(" at "), clock)
    return F.when(at <= now, full).when(days <= 0, clock).when(days == 1, on(F.lit("tomorrow"))).when(days < 7, on(F.date_format(at, "EEEE"))).otherwise(on(F.date_format(at, "yyyy-MM-dd")))


def name_to_time(name: Column) -> Column:
    """HHMMSS.mmm.xml for a file named by milliseconds; other names stay."""
    ms = F.regexp_extract(name, r"^(\d{13})\.xml$", 1)
    clock = F.date_format(ms_to_utc(ms.try_cast("long")), "HHmmss.SSS")
    return F.when(ms != "", F.concat(clock, F.lit(".xml"))).otherwise(name)


def dashed_date(name: Column) -> Column:
    """YYYYMMDD to YYYY-MM-DD at the start of a name."""
    return F.regexp_replace(name, r"^(\d{4})(\d{2})(\d{2})(?!\d)", "$1-$2-$3")


def midpoint(start_ms: Column, end_ms: Column) -> Column:
    """Estimated time of a server's answer: half way between request and response."""
    return (start_ms + end_ms) / 2
