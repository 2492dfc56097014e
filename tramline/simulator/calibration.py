"""What the simulator learns from observed updates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import day_type, quantile

#: Probabilities at which delays are described. Fixed values.
PROBABILITIES = [0.0, 0.02, 0.05, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 0.95, 0.98, 1.0]
LEAST_HOURLY, LEAST_ORIGINS, LEAST_STEPS = 50, 100, 500


def quantiles_by(df: DataFrame, by: str, value: str, probabilities: Sequence[float] = PROBABILITIES) -> DataFrame:
    return df.groupBy(by).agg(F.count(F.lit(1)).alias("n"), quantile(value, list(probabilities)).alias("quantiles"))


def observed_window(updates: DataFrame) -> DataFrame:
    return updates.agg(F.min("updated_at").alias("first"), F.max("updated_at").alias("last"), F.count_distinct("trip_id", "service_date").alias("trips"))


def initial_delays(updates: DataFrame) -> DataFrame:
    """Quantiles by mode of the first delay seen of each trip."""
    first = updates.groupBy("trip_id", "service_date", "mode").agg(F.min_by("arrival_delay_s", "updated_at").alias("d"))
    return quantiles_by(first, "mode", "d")


def origin_delays(arrivals: DataFrame) -> DataFrame:
    return quantiles_by(arrivals.where("is_origin AND is_final"), "mode", "arrival_delay_s")


def stop_steps(updates: DataFrame) -> DataFrame:
    """By mode: number, mean and spread of the change of delay from one observed stop to the next, and stops between."""
    last = updates.groupBy("trip_id", "service_date", "mode", "stop_sequence").agg(F.max_by("arrival_delay_s", "updated_at").alias("d"))
    order = Window.partitionBy("trip_id", "service_date").orderBy("stop_sequence")
    step = last.select("mode", (F.col("d") - F.lag("d").over(order)).alias("change"), (F.col("stop_sequence") - F.lag("stop_sequence").over(order)).alias("stops"))
    return step.where("stops > 0").groupBy("mode").agg(F.count(F.lit(1)).alias("n"), F.avg("change").alias("mean"), F.stddev_samp("change").alias("sd"), F.avg("stops").alias("stops"))


def hourly_means(updates: DataFrame, local: str = "updated_at_local") -> DataFrame:
    return updates.groupBy("mode", day_type(local).alias("day_type"), F.hour(local).alias("hour")).agg(F.count(F.lit(1)).alias("n"), F.avg("arrival_delay_s").alias("mean"))


def overall_means(updates: DataFrame) -> DataFrame:
    return updates.groupBy("mode").agg(F.avg("arrival_delay_s").alias("mean"))


def occupancy_shares(positions: DataFrame) -> DataFrame:
    """Shares of each occupancy by mode, null as a status of its own."""
    counted = positions.where("trip_id IS NOT NULL").groupBy("mode", F.coalesce("occupancy_status", F.lit("null")).alias("status")).agg(F.count(F.lit(1)).alias("n"))
    return counted.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy("mode")))


def parameters(updates: DataFrame, arrivals: DataFrame, positions: DataFrame) -> dict:
    """By mode, as the simulator reads them. All tables here have a few rows for each mode."""
    first = {r["mode"]: r for r in initial_delays(updates).collect()}
    origins = {r["mode"]: r for r in origin_delays(arrivals).collect()}
    steps = {r["mode"]: r for r in stop_steps(updates).collect()}
    overall = {r["mode"]: r["mean"] for r in overall_means(updates).collect()}
    out: dict = {}
    for mode, row in first.items():
        start = origins[mode] if mode in origins and origins[mode]["n"] >= LEAST_ORIGINS else row
        step = steps.get(mode)
        n = step["n"] if step else 0
        out[mode] = {
            "initial": list(zip(PROBABILITIES, start["quantiles"], strict=True)), "steps": n, "step_mean_s": float(step["mean"] or 0) if n >= LEAST_STEPS else 0.0,
            "step_sd_s": float(step["sd"] or 0) if step else 0.0, "mean_s": overall[mode], "hourly": {}, "occupancy": {},
        }
    for r in hourly_means(updates).where(F.col("n") >= LEAST_HOURLY).collect():
        out[r["mode"]]["hourly"].setdefault(r["day_type"], {})[r["hour"]] = r["mean"]
    for r in occupancy_shares(positions).collect():
        if r["mode"] in out:
            out[r["mode"]]["occupancy"][r["status"]] = r["share"]
    return out
