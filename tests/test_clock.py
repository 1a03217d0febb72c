"""Dates, zones and ISO text; the session runs in a zone with daylight saving."""

from datetime import date, datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from flowgauge.errors import KpiError
from flowgauge.functions import clock


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


def ntz(text):
    return F.lit(text).cast("timestamp_ntz")


@pytest.mark.parametrize("text, seconds", [
    ("PT1H", 3600), ("pt12s", 12), ("P1DT2M", 86520), ("PT1.5S", 1.5), ("-PT5M", -300), ("PT-5M", -300), ("P2D", 172800),
])
def test_iso_durations(text, seconds):
    assert clock.parse_iso_duration(text) == timedelta(seconds=seconds)


@pytest.mark.parametrize("text", ["", "P", "PT", "1H", "P1Y", "P1DT", "PT1M1H", None])
def test_bad_iso_durations(text):
    with pytest.raises(KpiError):
        clock.parse_iso_duration(text)


@pytest.mark.parametrize("text, expected", [
    ("2024-03-10", "2024-03-10 00:00:00"),
    ("2024-03-10T02:30", "2024-03-10 02:30:00"),
    ("2024-03-10T02:30:15.25", "2024-03-10 02:30:15.250000"),
    ("2024-03-10T02:30:00Z", "2024-03-10 02:30:00"),
    ("2024-03-10t02:30:00+05:30", "2024-03-09 21:00:00"),
    ("2024-03-10T02:30:00-0800", "2024-03-10 10:30:00"),
    ("2024-02-30", None), ("2024-03-10 02:30:00", None), ("2024-3-1", None), ("soon", None), ("2024-03-10T25:00", None),
    ("2024-03-10T02:30:00+19:00", None),
])
def test_moments(spark, text, expected):
    wanted = expected and datetime.fromisoformat(expected)
    assert one(spark, clock.parse_moment(F.lit(text))) == wanted
    if expected:
        assert clock.parse_moment_literal(text) == wanted
    else:
        with pytest.raises(KpiError):
            clock.parse_moment_literal(text)


def test_differences_ignore_the_session_zone(spark):
    # 02:30 does not exist on this day in the session's zone.
    micros = clock.micros_between(ntz("2024-03-10 01:30:00"), ntz("2024-03-10 02:30:00.000001"))
    assert one(spark, micros) == 3_600_000_001
    assert one(spark, clock.hour_slot(ntz("2024-03-10 02:30:00")) - clock.hour_slot(ntz("2024-03-10 01:30:00"))) == 1
    assert one(spark, clock.hour_slot(ntz("1969-12-31 23:59:59"))) == -1
    assert one(spark, clock.iso_text(ntz("2024-03-10 02:30:00"))) == "2024-03-10T02:30:00Z"
    there_and_back = clock.as_utc(clock.as_instant(ntz("2024-03-10 02:30:00.123456")))
    assert one(spark, there_and_back) == datetime(2024, 3, 10, 2, 30, 0, 123456)
    assert one(spark, clock.as_utc(clock.as_instant(ntz("1950-01-01 00:00:00.5")))) == datetime(1950, 1, 1, 0, 0, 0, 500000)


@pytest.mark.parametrize("unit, expected", [
    ("ms", -1), ("second", -2), ("minute", 0), ("hour", 0), ("day", 0), ("week", 0),
])
def test_negative_units(spark, unit, expected):
    assert one(spark, clock.in_unit(F.lit(-1_500).cast("bigint") if unit == "ms" else F.lit(-1_500_000).cast("bigint"), unit)) == expected


AS_OF = datetime(2024, 11, 3, 6, 45, 30, 250000)  # 01:45:30.25 for the second time in New York


@pytest.mark.parametrize("rounding, kind, zone, expected", [
    ("FULL", "LocalDateTime", "UTC", AS_OF),
    ("hour", "localdatetime", "America/New_York", datetime(2024, 11, 3, 1)),
    ("DAY", "STRING", "America/New_York", "2024-11-03T00:00:00"),
    ("MONTH", "LocalDate", "+07:00", date(2024, 11, 1)),
    ("MINUTE", "LocalTime", "UTC", "06:45:00"),
    ("FULL", "LocalTime", "UTC", "06:45:30.25"),
    ("SECOND", "STRING", "+5", "2024-11-03T11:45:30"),
    ("FULL", "STRING", "local", "2024-11-03T01:45:30.25"),
])
def test_rounded_dates(spark, rounding, kind, zone, expected):
    assert one(spark, clock.rounded_date(AS_OF, rounding, kind, zone)) == expected


def test_rounded_instants(spark):
    def seconds(rounding):
        return one(spark, F.unix_micros(clock.rounded_date(AS_OF, rounding, "Instant", "America/New_York"))) / 1e6

    utc = AS_OF.replace(tzinfo=timezone.utc).timestamp()
    assert seconds("FULL") == utc
    assert seconds("HOUR") == utc - 45 * 60 - 30.25      # the later of the two 01:00
    assert seconds("DAY") == utc - (2 * 60 + 45) * 60 - 30.25
    with_zone = AS_OF.replace(tzinfo=timezone(timedelta(hours=2)))
    assert one(spark, clock.rounded_date(with_zone)) == AS_OF - timedelta(hours=2)


def test_midnight_that_does_not_exist(spark):
    # Clocks went from 00:00 to 01:00 on this day in Sao Paulo.
    value = clock.rounded_date(datetime(2018, 11, 4, 15), "DAY", "LocalDateTime", "America/Sao_Paulo")
    assert one(spark, value) == datetime(2018, 11, 4, 1)


def test_current_clock(spark):
    now = one(spark, clock.rounded_date())
    assert abs(datetime.now(timezone.utc).replace(tzinfo=None) - now) < timedelta(minutes=5)


@pytest.mark.parametrize("zone, text", [
    ("UTC", "Z"), ("+07:00", "+07:00"), ("America/New_York", "-05:00"), ("Asia/Kolkata", "+05:30"), ("Europe/Amsterdam", "+01:00"),
])
def test_offset_date_times_keep_their_offset(spark, zone, text):
    shown = clock.rounded_date(datetime(2024, 1, 15, 9, 30, 15), "HOUR", "OffsetDateTime", zone)
    row = spark.range(1).select(shown.alias("d")).select(F.unix_seconds("d.instant").alias("s"), "d.offset").first()
    half = 1800 if zone == "Asia/Kolkata" else 0
    assert row["offset"] == text and row["s"] == 1705309200 + half


def test_offsets_with_seconds(spark):
    shown = clock.rounded_date(datetime(1880, 1, 1), "FULL", "OffsetDateTime", "America/New_York")
    assert spark.range(1).select(shown.alias("d")).first()["d"]["offset"] == "-04:56:02"
