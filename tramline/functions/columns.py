"""Time, geography, statistics and text as Column expressions."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS_M = 6_371_000
TIME_ZONE = "Pacific/Auckland"
#: Minutes of the local day, half-open, on Monday to Friday.
PEAKS = ((390, 540), (900, 1080))


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def local_time(instant: Column | str, zone: str = TIME_ZONE) -> Column:
    """Wall-clock time (without zone) of a UTC instant. Plain timestamps need a session in UTC."""
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), col(instant).cast("timestamp_ntz"))


def epoch_time(seconds: Column | str) -> Column:
    """Instant of epoch seconds, which may come as text; text that is no number is null."""
    return F.timestamp_seconds(col(seconds).try_cast("bigint"))


def seconds_between(start: Column | str, end: Column | str) -> Column:
    return F.timestamp_diff("SECOND", col(start), col(end))


def add_seconds(instant: Column | str, seconds: Column) -> Column:
    return F.timestamp_add("SECOND", seconds, col(instant))


def day_type(ts: Column | str) -> Column:
    day = F.dayofweek(col(ts))
    return F.when(day == 1, "sunday").when(day == 7, "saturday").otherwise("weekday")


def in_peak(ts: Column | str, windows: Sequence[tuple[int, int]] = PEAKS) -> Column:
    minute = F.hour(col(ts)) * 60 + F.minute(col(ts))
    weekday = F.dayofweek(col(ts)).between(2, 6)
    hits = [(minute >= a) & (minute < b) for a, b in windows]
    return weekday & _any(hits)


def _any(conditions: Sequence[Column]) -> Column:
    out = F.lit(False)
    for c in conditions:
        out = out | c
    return out


def week_of(day: Column | str) -> Column:
    """Monday of the day's week."""
    return F.date_trunc("week", col(day)).cast("date")


def clock_seconds(text: Column | str) -> Column:
    """Seconds of ``HH:MM:SS``, where hours may pass 24; null for blank or malformed text."""
    part = F.split(col(text), ":")
    h, m, s = (F.get(part, F.lit(i)).try_cast("int") for i in range(3))
    return h * 3600 + m * 60 + s


def service_day_epoch(day: Column | str, zone: str = TIME_ZONE) -> Column:
    """Epoch seconds from which a service day's clock counts: twelve hours before local noon, so the hour that a change of
    daylight saving adds or drops doesn't shift the timetable."""
    noon = F.timestamp_add("HOUR", F.lit(12), col(day).cast("timestamp_ntz"))
    utc = F.convert_timezone(F.lit(zone), F.lit("UTC"), noon)
    return F.timestamp_diff("SECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), utc) - 43_200


def haversine_m(lat1, lon1, lat2, lon2) -> Column:
    """Great-circle metres between two points in degrees."""
    p1, l1, p2, l2 = (F.radians(col(c)) for c in (lat1, lon1, lat2, lon2))
    half = F.pow(F.sin((p2 - p1) / 2), 2) + F.cos(p1) * F.cos(p2) * F.pow(F.sin((l2 - l1) / 2), 2)
    return F.asin(F.sqrt(half)) * (2 * EARTH_RADIUS_M)


def bearing(lat1, lon1, lat2, lon2) -> Column:
    """Initial course in degrees from north, in [0, 360), to one decimal."""
    p1, p2 = F.radians(col(lat1)), F.radians(col(lat2))
    turn = F.radians(col(lon2) - col(lon1))
    east, north = F.sin(turn) * F.cos(p2), F.cos(p1) * F.sin(p2) - F.sin(p1) * F.cos(p2) * F.cos(turn)
    return F.pmod(F.round(F.pmod(F.degrees(F.atan2(east, north)), F.lit(360.0)), 1), F.lit(360.0))


def grid_cell(lon, lat, size_m: float = 350.0, origin_lat: float = -41.0) -> Column:
    """Id of a square of about size_m metres. A grid of equal angles, scaled at origin_lat; these are no H3 ids."""
    up = math.degrees(size_m / EARTH_RADIUS_M)
    row = F.floor((col(lat) + 90) / up)
    column = F.floor((col(lon) + 180) / (up / math.cos(math.radians(origin_lat))))
    return row * F.lit(1 << 24) + column


def wilson(successes, trials, upper: bool, z: float = 1.96) -> Column:
    """Bound of the Wilson score interval; null without trials."""
    k, n = col(successes).cast("double"), col(trials).cast("double")
    share, square = k / n, z * z
    spread = z * F.sqrt(share * (1 - share) / n + square / (4 * n * n))
    centre = share + square / (2 * n)
    return F.when(n > 0, ((centre + spread) if upper else (centre - spread)) / (1 + square / n))


def shortened(text: Column | str, most: int = 40) -> Column:
    """The text, or its beginning and an ellipsis, in ``most`` characters."""
    t = col(text)
    return F.when(F.length(t) > most, F.concat(F.left(t, F.lit(most - 1)), F.lit("…"))).otherwise(t)


def translation(field: str, language: str = "en") -> Column:
    """Text of a translated string in a language, or else its first text."""
    texts = F.col(f"{field}.translation")
    wanted = F.filter(texts, lambda t: t["language"] == language)
    return F.coalesce(F.get(wanted, F.lit(0))["text"], F.get(texts, F.lit(0))["text"])


def share_of(condition: Column) -> Column:
    """Share of rows (aggregate) for which a condition holds; null counts as not."""
    return F.count_if(condition) / F.count(F.lit(1))


def quantile(value: Column | str, q, accuracy: int = 1_000_000) -> Column:
    """Exact up to ``accuracy`` distinct values: the least value with a share q at or below it; an array for a list of q."""
    return F.percentile_approx(col(value), q, accuracy)
