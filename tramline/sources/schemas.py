"""Declared schemas. Numbers of 64 bits come as text in the feeds; unknown fields are ignored."""

from __future__ import annotations

TRIP = "struct<trip_id: string, route_id: string, direction_id: int, start_date: string, start_time: string, schedule_relationship: string>"
TEXT = "struct<translation: array<struct<language: string, text: string>>>"
TIMES = "array<struct<stop_sequence: int, stop_id: string, schedule_relationship: string, arrival: struct<delay: int, time: string>>>"
ENTITY = {
    "tripupdates": f"id: string, trip_update: struct<trip: {TRIP}, vehicle: struct<id: string>, timestamp: string, stop_time_update: {TIMES}>",
    "vehiclepositions": f"id: string, vehicle: struct<trip: {TRIP}, vehicle: struct<id: string>, position: struct<latitude: double, longitude: double, bearing: double>, "
    "occupancy_status: string, timestamp: string>",
    "servicealerts": f"id: string, alert: struct<cause: string, effect: string, severity_level: string, header_text: {TEXT}, description_text: {TEXT}, url: {TEXT}, "
    "active_period: array<struct<start: string, end: string>>, informed_entity: array<struct<route_id: string, route_type: int, stop_id: string, "
    "trip: struct<trip_id: string, direction_id: int, start_date: string>>>>",
}
FEEDS = tuple(ENTITY)
HEADER = "struct<gtfs_realtime_version: string, incrementality: string, timestamp: string>"


def poll_schema(feed: str) -> str:
    """A row for each poll of a feed, partitioned by date; malformed lines are kept as text."""
    message = f"struct<header: {HEADER}, entity: array<struct<{ENTITY[feed]}>>>"
    return f"feed string, fetched_at string, header_timestamp bigint, entity_count int, feed_message {message}, date date, _corrupt_record string"


STATIC = ("routes", "stops", "trips", "stop_times", "calendar", "calendar_dates")
PUBLISHED_INTS = ("scheduled_trips", "punctuality_numerator", "punctuality_denominator", "peak_punctuality_numerator", "peak_punctuality_denominator", "cancellations", "patronage")
PUBLISHED_DOUBLES = ("reliability", "punctuality", "punctuality_contributing_percent", "mean_departure_time_variance", "cancellations_rate", "trips_with_some_standing_rate")
