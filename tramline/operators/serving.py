"""What boards, alerts and dashboards ask of the results."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import local_time


def busiest_stops(arrivals: DataFrame, interval: str = "7 DAYS") -> DataFrame:
    newest = arrivals.agg(F.max("arrival_at").alias("_newest"))
    recent = arrivals.crossJoin(F.broadcast(newest)).where(F.col("arrival_at") >= F.col("_newest") - F.expr(f"INTERVAL {interval}"))
    return recent.groupBy("stop_id").agg(F.min("stop_name").alias("stop_name"), F.count(F.lit(1)).alias("arrivals")).orderBy(F.desc("arrivals"), "stop_id")


def recent_arrivals(arrivals: DataFrame, stop_id: str, most: int = 15, tie: str = "trip_id") -> DataFrame:
    rows = arrivals.where((F.col("stop_id") == stop_id) & F.col("is_final")).orderBy(F.desc("arrival_at"), F.desc(tie)).limit(most)
    return rows.withColumns({"arrived": local_time("arrival_at"), "scheduled": local_time("scheduled_arrival_at"), "delay_min": F.round(F.col("arrival_delay_s") / 60, 1)})


def expected_arrivals(predictions: DataFrame, stop_id: str) -> DataFrame:
    rows = predictions.where(F.col("target_stop_id") == stop_id)
    return rows.select(
        local_time("predicted_arrival_at").alias("expected"), local_time("target_scheduled_at").alias("scheduled"), F.col("route_label").alias("route"),
        F.round(F.col("predicted_delay_s") / 60, 1).alias("delay_min"), F.col("vehicle_id").alias("vehicle"), local_time("snapshot_at").alias("as_of"),
    ).orderBy("expected")


def alerts_for_stop(entities: DataFrame, alerts: DataFrame, arrivals: DataFrame, stop_id: str) -> DataFrame:
    """Open alerts on the stop or on a route that has served it."""
    serving = arrivals.where(F.col("stop_id") == stop_id).select("route_id").distinct()
    at_stop = entities.where(F.col("stop_id") == stop_id).select("alert_id")
    on_route = entities.join(serving, "route_id", "left_semi").select("alert_id")
    open_alerts = alerts.where("__END_AT IS NULL").join(at_stop.unionByName(on_route), "alert_id", "left_semi")
    return open_alerts.select("effect", F.col("header_text").alias("alert")).distinct()


def worst_route(hourly: DataFrame, least_arrivals: int = 50) -> DataFrame:
    """One row: the greatest mean delay in minutes of a route on the latest date, and the route; 0 and null without any."""
    newest = hourly.agg(F.max("service_date").alias("_day"))
    today = hourly.crossJoin(F.broadcast(newest)).where(F.col("service_date") == F.col("_day"))
    mean = (F.sum(F.col("avg_delay_s") * F.col("arrivals")) / F.sum("arrivals") / 60).alias("m")
    routes = today.groupBy("route_label").agg(mean, F.sum("arrivals").alias("n")).where(F.col("n") >= least_arrivals)
    return routes.agg(F.coalesce(F.max("m"), F.lit(0.0)).alias("worst_route_avg_delay_min"), F.max_by("route_label", "m").alias("worst_route"))


def rates():
    """Aggregates of hourly rows: rates are computed from counts."""
    return [F.sum("arrivals").alias("arrivals"), F.round(F.sum("on_time") / F.sum("arrivals"), 4).alias("on_time_rate")]


def on_time_by(hourly: DataFrame, *by: str) -> DataFrame:
    return hourly.groupBy(*by).agg(*rates())


def worst_on_time(hourly: DataFrame, by: str = "route_label", least_arrivals: int = 100, most: int = 10) -> DataFrame:
    grouped = hourly.groupBy(by).agg(*rates(), (F.sum("on_time") / F.sum("arrivals")).alias("_rate")).where(F.col("arrivals") >= least_arrivals)
    return grouped.orderBy("_rate", by).limit(most).drop("_rate")


def by_weekday_and_hour(hourly: DataFrame) -> DataFrame:
    mean = F.round(F.sum(F.col("avg_delay_s") * F.col("arrivals")) / F.sum("arrivals"), 2).alias("avg_delay_s")
    return hourly.groupBy(F.dayofweek("service_date").alias("weekday"), "hour").agg(*rates(), mean)


def bunching_rates(regularity: DataFrame, *by: str) -> DataFrame:
    return regularity.groupBy(*by).agg(F.sum("headways").alias("headways"), F.sum("bunched").alias("bunched"), F.round(F.sum("bunched") / F.sum("headways"), 4).alias("bunched_rate"))


def is_fresh(arrivals: DataFrame, now, interval: str = "2 HOURS") -> DataFrame:
    """One row: whether the newest arrival is at most an interval old."""
    return arrivals.agg(F.coalesce(F.max("arrival_at") >= now - F.expr(f"INTERVAL {interval}"), F.lit(False)).alias("fresh"))
