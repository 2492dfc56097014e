"""The transit datasets, from polls and timetable to metrics."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..ml.arrival import route_features
from ..operators import feeds, history, movement, punctuality, timetable
from .registry import Plan

ROUTE_GROUPS = ("route_id", "mode_group")


def transit_plan(as_of: Column | None = None) -> Plan:
    """Inputs: bronze.<feed> (polls), static.<file> (timetable) and official.weekly (published figures). as_of decides which
    arrivals are final; the same inputs and as_of give the same tables."""
    plan, now = Plan(), as_of if as_of is not None else F.current_timestamp()
    stop_keys = ["trip_id", "service_date", "stop_sequence"]

    @plan.add("silver.trip_updates", "bronze.tripupdates", rules=feeds.TRIP_RULES)
    def _(polls):
        return history.latest(feeds.trip_updates(polls), [*stop_keys, "updated_at"], ["fetched_at"])

    @plan.add("silver.vehicle_positions", "bronze.vehiclepositions", rules=feeds.VEHICLE_RULES)
    def _(polls):
        return history.latest(feeds.vehicle_positions(polls), ["vehicle_id", "position_at"], ["fetched_at"])

    @plan.add("silver.trip_stop_delays", "silver.trip_updates")
    def _(updates):
        return history.versions(updates, stop_keys, "updated_at", ["arrival_delay_s", "predicted_arrival_at"])

    @plan.add("silver.vehicle_current", "silver.vehicle_positions")
    def _(positions):
        return history.latest(positions, ["vehicle_id"], ["position_at"])

    @plan.add("silver.service_alerts", "bronze.servicealerts")
    def _(polls):
        rows = feeds.alert_polls(polls).where(feeds.ALERT_RULES[0].holds)
        return history.versions(rows, ["alert_id"], "feed_at", feeds.ALERT_TRACKED)

    @plan.add("silver.service_alert_entities", "silver.service_alerts")
    def _(alerts):
        return feeds.alert_entities(history.current(alerts))

    @plan.add("silver.routes", "static.routes")
    def _(routes):
        return timetable.route_dimension(routes)

    @plan.add("silver.stop_arrivals", "silver.trip_updates", "silver.routes", "static.stops", "static.trips", "static.stop_times")
    def _(updates, routes, stops, trips, stop_times):
        return feeds.conformed(feeds.last_predictions(updates, now), routes, stops, trips, timetable.stop_roles(stop_times))

    @plan.add("gold.route_ontime_hourly", "silver.stop_arrivals")
    def _(arrivals):
        return punctuality.route_hourly(punctuality.final_arrivals(arrivals))

    @plan.add("gold.stop_delay_stats", "silver.stop_arrivals")
    def _(arrivals):
        return punctuality.stop_statistics(punctuality.final_arrivals(arrivals))

    @plan.add("gold.headways", "silver.stop_arrivals")
    def _(arrivals):
        return punctuality.headways(punctuality.final_arrivals(arrivals))

    @plan.add("gold.headway_regularity", "gold.headways")
    def _(headways):
        return punctuality.regularity(headways)

    @plan.add("gold.bus_bunching_events", "gold.headways")
    def _(headways):
        return headways.where("is_bunched")

    @plan.add("gold.vehicle_latest", "silver.vehicle_current", "silver.routes")
    def _(vehicles, routes):
        return feeds.latest_vehicles(vehicles, routes)

    @plan.add("gold.road_speeds", "silver.vehicle_positions", "silver.routes")
    def _(positions, routes):
        return movement.cell_speeds(movement.steps(positions).join(routes.select(*ROUTE_GROUPS), "route_id", "left"))

    @plan.add("gold.congestion_hotspots", "gold.road_speeds")
    def _(speeds):
        return movement.hotspots(speeds)

    @plan.add("gold.segment_runtimes", "silver.stop_arrivals")
    def _(arrivals):
        return movement.segment_runtimes(arrivals)

    @plan.add("gold.timetable_shortfalls", "gold.segment_runtimes")
    def _(segments):
        return movement.shortfalls(segments)

    @plan.add("gold.origin_departures", "silver.stop_arrivals")
    def _(arrivals):
        return punctuality.origin_departures(arrivals)

    @plan.add("gold.route_punctuality_daily", "gold.origin_departures", "static.calendar", "static.calendar_dates", "static.trips", "silver.routes")
    def _(departures, calendar, exceptions, trips, routes):
        running = timetable.active_services(calendar, exceptions, departures)
        return punctuality.punctuality_daily(departures, timetable.scheduled_trips(running, trips.select("trip_id", "route_id", "service_id"), routes))

    @plan.add("gold.route_punctuality_weekly", "gold.route_punctuality_daily")
    def _(daily):
        return punctuality.punctuality_weekly(daily)

    @plan.add("gold.punctuality_benchmark", "gold.route_punctuality_weekly", "official.weekly")
    def _(weekly, published):
        return punctuality.benchmark(weekly, published)

    @plan.add("ml.route_delay_15min", "silver.stop_arrivals")
    def _(arrivals):
        return route_features(arrivals)

    return plan
