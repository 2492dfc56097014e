"""Realtime feed polls flattened, and the arrivals that are drawn from them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import TIME_ZONE, add_seconds, epoch_time, local_time, translation
from .expectations import Expectation
from .history import within_latest

TRIP_RULES = (
    Expectation("has_keys", "trip_id IS NOT NULL AND service_date IS NOT NULL AND stop_sequence IS NOT NULL"),
    Expectation("has_update_time", "updated_at IS NOT NULL"),
    Expectation("plausible_delay", "abs(arrival_delay_s) < 10800", "warn"),
)
VEHICLE_RULES = (
    Expectation("has_vehicle_id", "vehicle_id IS NOT NULL"),
    Expectation("has_position_time", "position_at IS NOT NULL"),
    Expectation("in_region", "latitude BETWEEN -42 AND -40 AND longitude BETWEEN 174 AND 177"),
    Expectation("has_trip", "trip_id IS NOT NULL", "warn"),
)
ALERT_RULES = (Expectation("has_alert_id", "alert_id IS NOT NULL"),)
ARRIVAL_RULES = (Expectation("has_delay", "arrival_delay_s IS NOT NULL AND arrival_at IS NOT NULL"),)
ALERT_TRACKED = ("cause", "effect", "severity_level", "header_text", "description_text", "url", "active_start_at", "active_end_at", "informed_entities")


def _trip(prefix: str) -> dict[str, Column]:
    t = lambda f: F.col(f"{prefix}.{f}")
    return {"trip_id": t("trip_id"), "route_id": t("route_id"), "direction_id": t("direction_id").try_cast("int"), "service_date": F.to_date(t("start_date"), "yyyyMMdd"), "start_time": t("start_time")}


def _named(columns: dict[str, Column]) -> list[Column]:
    return [c.alias(n) for n, c in columns.items()]


def _entities(polls: DataFrame, *extra: Column) -> DataFrame:
    return polls.select(F.col("fetched_at").cast("timestamp").alias("fetched_at"), *extra, F.explode("feed_message.entity").alias("e"))


def trip_updates(polls: DataFrame, zone: str = TIME_ZONE) -> DataFrame:
    """A row for each stop of each trip update of each poll."""
    u = "e.trip_update"
    rows = _entities(polls).select(
        "fetched_at", *_named(_trip(f"{u}.trip")), F.col(f"{u}.trip.schedule_relationship").alias("trip_schedule_relationship"),
        F.col(f"{u}.vehicle.id").alias("vehicle_id"), epoch_time(f"{u}.timestamp").alias("updated_at"), F.explode(f"{u}.stop_time_update").alias("s"),
    )
    rows = rows.withColumns({
        "stop_id": F.col("s.stop_id"), "stop_sequence": F.col("s.stop_sequence").cast("int"),
        "stop_schedule_relationship": F.col("s.schedule_relationship"), "arrival_delay_s": F.col("s.arrival.delay").cast("int"),
        "predicted_arrival_at": epoch_time("s.arrival.time"),
    }).drop("s")
    return rows.withColumns({"updated_at_local": local_time("updated_at", zone), "predicted_arrival_at_local": local_time("predicted_arrival_at", zone)})


def vehicle_positions(polls: DataFrame, zone: str = TIME_ZONE) -> DataFrame:
    v = "e.vehicle"
    place = {c: F.col(f"{v}.position.{c}").cast("double") for c in ("latitude", "longitude", "bearing")}
    rows = _entities(polls).select(
        F.col(f"{v}.vehicle.id").alias("vehicle_id"), *_named(_trip(f"{v}.trip")), F.col(f"{v}.trip.schedule_relationship").alias("schedule_relationship"),
        *_named(place), F.col(f"{v}.occupancy_status").alias("occupancy_status"), epoch_time(f"{v}.timestamp").alias("position_at"), "fetched_at",
    )
    return rows.withColumn("position_at_local", local_time("position_at", zone))


def alert_polls(polls: DataFrame) -> DataFrame:
    """A row for each alert of each poll; of several active periods the first counts."""
    a = "e.alert"
    rows = _entities(polls, epoch_time("header_timestamp").alias("feed_at"))
    texts = {c: translation(f"{a}.{c}") for c in ("header_text", "description_text", "url")}
    period = F.get(f"{a}.active_period", F.lit(0))
    return rows.select(
        F.col("e.id").alias("alert_id"), *(F.col(f"{a}.{c}").alias(c) for c in ("cause", "effect", "severity_level")), *_named(texts),
        epoch_time(period["start"]).alias("active_start_at"), epoch_time(period["end"]).alias("active_end_at"),
        F.col(f"{a}.informed_entity").alias("informed_entities"), "feed_at", F.col("fetched_at").alias("last_seen_at"),
    )


def alert_entities(current_alerts: DataFrame) -> DataFrame:
    """What each alert affects, a row for each informed entity."""
    kept = ("alert_id", "effect", "severity_level", "active_start_at", "active_end_at", "last_seen_at")
    rows = current_alerts.select(*kept, F.explode("informed_entities").alias("i"))
    trip = _trip("i.trip")
    return rows.select(*kept, F.col("i.route_id").alias("route_id"), F.col("i.route_type").cast("int").alias("route_type"), F.col("i.stop_id").alias("stop_id"), trip["trip_id"].alias("trip_id"), trip["direction_id"].alias("direction_id"), trip["service_date"].alias("service_date"))


def last_predictions(updates: DataFrame, as_of: Column, keys: Sequence[str] = ("trip_id", "service_date", "stop_sequence"), grace: str = "10 MINUTES", values: Sequence[str] = ("stop_id", "route_id", "direction_id", "vehicle_id", "start_time", "arrival_delay_s", "predicted_arrival_at"), at: str = "updated_at") -> DataFrame:
    """Each stop's last prediction as its arrival, whose plan is the prediction less the delay.

    It is final once the trip was seen at a later stop, or ``grace`` after the arrival. Skipped stops are left out before,
    rows without a delay after that is decided; a last update without a delay hides earlier ones. Rows are dealt by trip
    once, which serves the aggregation and the window.
    """
    trip = list(keys[:-1])
    seen = updates.where("stop_schedule_relationship IS NULL OR stop_schedule_relationship <> 'SKIPPED'").repartition(*trip)
    row = F.max(F.struct(at, *values)).alias("_r")
    last = seen.groupBy(*keys).agg(row, F.count(F.lit(1)).alias("prediction_count"))
    rename = {"predicted_arrival_at": "arrival_at"}
    last = last.select(*keys, *(F.col(f"_r.{v}").alias(rename.get(v, v)) for v in values), F.col(f"_r.{at}").alias("last_updated_at"), "prediction_count")
    passed = F.col(keys[-1]) < F.max(keys[-1]).over(Window.partitionBy(*trip))
    return last.withColumns({
        "scheduled_arrival_at": add_seconds("arrival_at", -F.col("arrival_delay_s")),
        "is_final": passed | (F.col("arrival_at") < as_of - F.expr(f"INTERVAL {grace}")),
    }).where(ARRIVAL_RULES[0].holds)


def conformed(arrivals: DataFrame, routes: DataFrame, stops: DataFrame, trips: DataFrame, roles: DataFrame, zone: str = TIME_ZONE) -> DataFrame:
    """Arrivals with what the timetable knows of their route, stop, trip and place in it. Dimensions are left to the
    optimizer, which broadcasts those below its size threshold."""
    places = stops.select("stop_id", "stop_name", *(F.col(c).try_cast("double").alias(c) for c in ("stop_lat", "stop_lon")))
    rows = arrivals.join(routes, "route_id", "left").join(places, "stop_id", "left").join(trips.select("trip_id", "trip_headsign"), "trip_id", "left")
    rows = rows.join(roles, ["trip_id", "stop_sequence"], "left")
    return rows.withColumns({f"{c}_local": local_time(c, zone) for c in ("arrival_at", "scheduled_arrival_at")})


def latest_vehicles(vehicles: DataFrame, routes: DataFrame, interval: str = "10 MINUTES") -> DataFrame:
    """Vehicles heard from within an interval of the newest report; those without a trip are not in service."""
    rows = within_latest(vehicles, "position_at", interval, "snapshot_at").join(routes, "route_id", "left")
    idle = F.col("trip_id").isNull()
    return rows.withColumns({c: F.when(idle, "not in service").otherwise(F.col(c)) for c in ("mode", "mode_group")})
