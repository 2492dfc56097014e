from __future__ import annotations

import math
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tramline.functions import columns as C


def one(spark, column, **values):
    schema = ", ".join(f"{k} {t}" for k, (_, t) in values.items()) or "x int"
    row = tuple(v for v, _ in values.values()) or (1,)
    return spark.createDataFrame([row], schema).select(column.alias("r")).first()["r"]


@pytest.mark.parametrize(("text", "seconds"), [("08:00:00", 28800), ("25:10:00", 90600), ("", None), (None, None), ("7:05", None)])
def test_clock_passes_midnight(spark, text, seconds):
    assert one(spark, C.clock_seconds("t"), t=(text, "string")) == seconds


@pytest.mark.parametrize(("day", "utc"), [(date(2026, 9, 26), datetime(2026, 9, 25, 12)), (date(2026, 9, 27), datetime(2026, 9, 26, 11))])
def test_service_day_starts_twelve_hours_before_noon(spark, day, utc):
    assert one(spark, C.service_day_epoch("d"), d=(day, "date")) == int((utc - datetime(1970, 1, 1)).total_seconds())


def test_haversine_and_bearing(spark):
    point = {"a": (0.0, "double"), "b": (0.0, "double"), "c": (0.0, "double"), "d": (90.0, "double")}
    assert one(spark, C.haversine_m("a", "b", "c", "d"), **point) == pytest.approx(math.pi / 2 * 6_371_000)
    assert one(spark, C.bearing("a", "b", "c", "d"), **point) == 90.0
    assert one(spark, C.bearing("c", "d", "a", "b"), **point) == 270.0


@pytest.mark.parametrize(("stamp", "peak"), [
    ("2024-01-01 06:29:59", False), ("2024-01-01 06:30:00", True), ("2024-01-01 08:59:59", True), ("2024-01-01 09:00:00", False),
    ("2024-01-01 14:59:59", False), ("2024-01-01 15:00:00", True), ("2024-01-01 18:00:00", False), ("2024-01-06 07:00:00", False),
])
def test_peak_is_half_open_on_weekdays(spark, stamp, peak):
    assert one(spark, C.in_peak(F.col("t").cast("timestamp_ntz")), t=(stamp, "string")) is peak


def test_local_time_across_daylight_saving(spark):
    local = C.local_time(F.col("t").cast("timestamp_ntz"))
    assert one(spark, local, t=("2026-09-26 13:59:00", "string")) == datetime(2026, 9, 27, 1, 59)
    assert one(spark, local, t=("2026-09-26 14:00:00", "string")) == datetime(2026, 9, 27, 3, 0)


def test_wilson(spark):
    low, high = (one(spark, C.wilson("k", "n", u), k=(8, "int"), n=(10, "int")) for u in (False, True))
    assert (round(low, 4), round(high, 4)) == (0.4902, 0.9433)
    assert one(spark, C.wilson("k", "n", True), k=(0, "int"), n=(0, "int")) is None


def test_shortened_and_week(spark):
    assert one(spark, C.shortened("t"), t=("x" * 40, "string")) == "x" * 40
    assert one(spark, C.shortened("t"), t=("x" * 41, "string")) == "x" * 39 + "…"
    assert one(spark, C.week_of("d"), d=(date(2024, 1, 7), "date")) == date(2024, 1, 1)
