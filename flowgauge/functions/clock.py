"""Time arithmetic on zone-less timestamps.

Everything here is independent of the session time zone: zone-less values are
never cast to ``TIMESTAMP`` through it, so daylight-saving gaps of the session
zone cannot move a value.
"""

from __future__ import annotations

import re
from datetime import datetime, timedelta, timezone
from decimal import Decimal
from zoneinfo import ZoneInfo, available_timezones

from pyspark.sql import Column
from pyspark.sql import functions as F

from flowgauge.errors import DATE_PARSING_ERROR, KpiError, bad_input, one_of

# Unit names of duration(), roundings and result types of date().
DURATION_UNITS = ("MS", "SECOND", "MINUTE", "HOUR", "DAY", "WEEK")
ROUNDINGS = ("FULL", "SECOND", "MINUTE", "HOUR", "DAY", "MONTH")
DATE_TYPES = ("LOCALDATE", "LOCALTIME", "LOCALDATETIME", "OFFSETDATETIME", "INSTANT", "STRING")


def micros_of(interval: Column) -> Column:
    """Microseconds of a day-time interval column, signed."""
    hours = F.extract(F.lit("DAY"), interval).cast("bigint") * 24 + F.extract(F.lit("HOUR"), interval)
    minutes = hours * 60 + F.extract(F.lit("MINUTE"), interval)
    return minutes * 60_000_000 + (F.extract(F.lit("SECOND"), interval) * 1_000_000).cast("bigint")


def micros_between(start: Column, end: Column) -> Column:
    return micros_of(end - start)


# Above the microseconds of any moment up to the year 160 000; a missing moment stands here.
_NEVER = 5 * 10**18
_KEYS = Decimal(1 << 64)


def packed_order(moment: Column, key: Column, descending: bool = False) -> Column:
    """One number that orders by moment, then by key (by falling key with ``descending``); no moment comes last.

    Unlike a struct it has a fixed width, so an aggregate ordered by it can update its buffers in place and stays a
    hash aggregate.
    """
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    micros = F.coalesce(micros_between(epoch, moment), F.lit(_NEVER)).cast("decimal(19,0)")
    number = key.cast("decimal(19,0)")
    return micros * F.lit(_KEYS) + (-number if descending else number)


def whole_div(value: Column, by: int) -> Column:
    """Integer division of longs, rounding towards zero."""
    return F.call_function("div", value, F.lit(by))


def floor_div(value: Column, by: int) -> Column:
    """Integer division of longs, rounding down."""
    return whole_div(value - F.pmod(value, F.lit(by)), by)


def in_unit(micros: Column, unit: str) -> Column:
    """Elapsed time in ``unit``; an unknown unit means milliseconds.

    Seconds round down; minutes and longer are cut from whole seconds towards
    zero; milliseconds are cut towards zero.
    """
    seconds = floor_div(micros, 1_000_000)
    match unit.strip().upper():
        case "SECOND":
            return seconds
        case "MINUTE":
            return whole_div(seconds, 60)
        case "HOUR":
            return whole_div(seconds, 3600)
        case "DAY":
            return whole_div(seconds, 86_400)
        case "WEEK":
            return whole_div(whole_div(seconds, 86_400), 7)
        case _:
            return whole_div(micros, 1000)


def hour_slot(moment: Column) -> Column:
    """Number of whole hours since 1970, as a long; keeps the order of time.

    Ordered work on one instance is split along these slots, so that an instance
    holding a large share of the log is not sorted by a single task.
    """
    return F.unix_date(moment.cast("date")).cast("bigint") * 24 + F.hour(moment)


def minute_slot(moment: Column) -> Column:
    """The same for whole minutes."""
    return hour_slot(moment) * 60 + F.minute(moment)


def iso_text(moment: Column, suffix: str = "Z") -> Column:
    """ISO-8601 text with as many fraction digits as needed."""
    return F.concat(F.replace(moment.cast("string"), F.lit(" "), F.lit("T")), F.lit(suffix))


_EPOCH = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def as_instant(utc: Column) -> Column:
    """A zone-less UTC value as an instant (``TIMESTAMP``)."""
    return F.timestamp_micros(micros_between(F.expr(_EPOCH), utc))


def as_utc(instant: Column) -> Column:
    """An instant (``TIMESTAMP``) as a zone-less UTC value."""
    micros = F.unix_micros(instant)
    days = floor_div(micros, 86_400_000_000)
    seconds = (F.pmod(micros, F.lit(86_400_000_000)) / 1_000_000).cast("decimal(18,6)")
    return F.expr(_EPOCH) + F.make_dt_interval(days.cast("int"), F.lit(0), F.lit(0), seconds)


def parse_iso_duration(text: str) -> timedelta:
    """``PT2H``, ``P1DT30M``, ``PT1.5S``, ``-PT5M``: a day counts 24 hours."""
    pattern = (
        r"(?P<sign>[+-])?P(?:(?P<d>[+-]?\d+)D)?"
        r"(?P<t>T(?:(?P<h>[+-]?\d+)H)?(?:(?P<m>[+-]?\d+)M)?(?:(?P<s>[+-]?\d+(?:[.,]\d{0,9})?)S)?)?"
    )
    found = re.fullmatch(pattern, text or "", re.IGNORECASE)
    parts = found.groupdict() if found else {}
    if not found or not any(parts[name] for name in "dhms") or (parts["t"] or "").upper() == "T":
        raise KpiError(DATE_PARSING_ERROR, f"expected an ISO-8601 duration such as PT2H, got {text!r}")
    seconds = (parts["s"] or "0").replace(",", ".")
    whole = timedelta(
        days=int(parts["d"] or 0), hours=int(parts["h"] or 0), minutes=int(parts["m"] or 0),
    )
    total = whole + timedelta(microseconds=round(float(seconds) * 1_000_000))
    return -total if parts["sign"] == "-" else total


# ISO-8601 date, local date-time and offset date-time.
ISO_DATE = r"\d{4}-\d{2}-\d{2}"
ISO_TIME = r"\d{2}:\d{2}(?::\d{2}(?:\.\d{1,9})?)?"
ISO_OFFSET = r"[Zz]|[+-]\d{2}(?::?\d{2}(?::?\d{2})?)?"
ISO_MOMENT = rf"^({ISO_DATE})(?:[Tt]({ISO_TIME})({ISO_OFFSET})?)?$"
_OFFSET_PARTS = r"^([+-])(\d{2}):?(\d{2})?:?(\d{2})?$"


def parse_moment(text: Column) -> Column:
    """Zone-less UTC moment of ISO text, null when it is none.

    Accepts an offset date-time, a local date-time (taken as UTC) and a date
    (midnight UTC).
    """
    day = F.regexp_extract(text, ISO_MOMENT, 1)
    time = F.regexp_extract(text, ISO_MOMENT, 2)
    offset = F.regexp_extract(text, ISO_MOMENT, 3)
    clock = F.when(time == "", F.lit("00:00:00")).otherwise(time)
    local = F.concat(day, F.lit("T"), clock).try_cast("timestamp_ntz")

    def part(index: int) -> Column:
        return F.coalesce(F.regexp_extract(offset, _OFFSET_PARTS, index).try_cast("int"), F.lit(0))

    seconds = part(2) * 3600 + part(3) * 60 + part(4)
    valid = (part(3) < 60) & (part(4) < 60) & (seconds <= 18 * 3600)
    signed = F.when(F.startswith(offset, F.lit("-")), -seconds).otherwise(seconds)
    shift = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), signed.cast("decimal(18,6)"))
    return F.when(text.rlike(ISO_MOMENT) & valid, local - shift)


def parse_moment_literal(text: str) -> datetime:
    """The driver-side twin of :func:`parse_moment` for a literal argument."""
    found = re.match(ISO_MOMENT, text or "")
    try:
        if not found:
            raise ValueError(text)
        day, time, offset = found.groups()
        fraction = (time or "").partition(".")[2]
        clock = (time or "00:00").partition(".")[0]
        local = datetime.fromisoformat(f"{day}T{clock}")
        local += timedelta(microseconds=int((fraction + "000000")[:6]) if fraction else 0)
        parts = re.match(_OFFSET_PARTS, offset or "")
        if not parts:
            return local
        hours, minutes, seconds = (int(value or 0) for value in parts.groups()[1:])
        shift = timedelta(hours=hours, minutes=minutes, seconds=seconds)
        if minutes > 59 or seconds > 59 or shift > timedelta(hours=18):
            raise ValueError(offset)
        return local + shift if parts[1] == "-" else local - shift
    except ValueError as error:
        raise KpiError(DATE_PARSING_ERROR, f"expected an ISO-8601 date or date-time, got {text!r}") from error


def offset_text(micros: Column) -> Column:
    """An offset from UTC as ``+01:00``, with seconds where it has some; ``Z`` for none."""
    seconds = whole_div(F.abs(micros), 1_000_000)
    sign = F.when(micros < 0, F.lit("-")).otherwise(F.lit("+"))
    hours, minutes, rest = whole_div(seconds, 3600), F.pmod(whole_div(seconds, 60), F.lit(60)), F.pmod(seconds, F.lit(60))
    text = F.concat(sign, F.format_string("%02d:%02d", hours, minutes), F.when(rest > 0, F.format_string(":%02d", rest)).otherwise(""))
    return F.when(seconds == 0, F.lit("Z")).otherwise(text)


def check_zone(zone: str) -> str:
    """A zone name Spark accepts: ``UTC``, an offset such as ``+07:00``, or a region."""
    name = zone.strip()
    if name.upper() in ("UTC", "Z"):
        return "UTC"
    shift = re.fullmatch(r"(?:UTC|GMT|UT)?([+-])(\d{1,2})(?::?(\d{2}))?", name)
    if shift:
        hours, minutes = int(shift[2]), int(shift[3] or 0)
        if minutes < 60 and hours * 60 + minutes <= 18 * 60:
            return f"{shift[1]}{hours:02d}:{minutes:02d}"
    elif name in available_timezones():
        ZoneInfo(name)
        return name
    raise bad_input(f"no time zone {zone!r}: give UTC, local, an offset or a region")


def rounded_date(
    as_of: datetime | Column | None = None, rounding: str = "FULL", kind: str = "LocalDateTime",
    zone: str = "UTC",
) -> Column:
    """The moment ``as_of`` cut to ``rounding`` in ``zone`` and shown as ``kind``.

    ``as_of`` is a zone-less UTC column, a datetime, or None for the query's clock.
    """
    cut = one_of(rounding, ROUNDINGS, "rounding of a date")
    shown = one_of(kind, DATE_TYPES, "type of a date")
    place = F.current_timezone() if zone.strip().lower() == "local" else F.lit(check_zone(zone))
    if as_of is None:
        utc = as_utc(F.current_timestamp())
    elif isinstance(as_of, datetime):
        naive = as_of.astimezone(timezone.utc).replace(tzinfo=None) if as_of.tzinfo else as_of
        utc = F.lit(naive.isoformat(sep=" ")).cast("timestamp_ntz")
    else:
        utc = as_of

    def wall(moment: Column) -> Column:
        return F.convert_timezone(F.lit("UTC"), place, moment)

    local = wall(utc)
    if cut in ("DAY", "MONTH"):
        # Start of day by the rules of the zone: a midnight that does not exist moves on.
        start = local.cast("date") if cut == "DAY" else F.date_add(local.cast("date"), 1 - F.day(local))
        utc = F.convert_timezone(place, F.lit("UTC"), start.cast("timestamp_ntz"))
    elif cut != "FULL":
        # Cutting the instant keeps the offset when local time is ambiguous.
        seconds = F.extract(F.lit("SECOND"), local).cast("decimal(18,6)")
        drop = {
            "SECOND": seconds % 1,
            "MINUTE": seconds,
            "HOUR": seconds + F.minute(local) * 60,
        }[cut]
        utc = utc - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), drop.cast("decimal(18,6)"))
    local = wall(utc)
    match shown:
        case "LOCALDATE":
            return local.cast("date")
        case "LOCALTIME":
            return F.substring(local.cast("string"), 12, 15)
        case "LOCALDATETIME":
            return local
        case "STRING":
            return iso_text(local, "")
        case "OFFSETDATETIME":
            return F.struct(as_instant(utc).alias("instant"), offset_text(micros_between(utc, local)).alias("offset"))
        case _:
            return as_instant(utc)
