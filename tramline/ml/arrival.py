"""The arrival-delay model: features by time window, examples, gradient-boosted trees, promotion and batch scoring."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import Imputer, VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import add_seconds, quantile, seconds_between, share_of
from ..operators.history import latest
from ..operators.temporal import as_of_join, hashed_sample, pairs_ahead, split_by_date, tumbling

MODES = ("bus", "school bus", "rail", "ferry", "cable car")
MOST_AHEAD = 15
ROUTE_FEATURES = ("route_mean_delay_s", "route_p90_delay_s", "route_late_share", "route_arrivals")
INPUTS = ("current_delay_s", "stops_ahead", "scheduled_minutes_ahead", "hour", "day_of_week", "mode_code", *ROUTE_FEATURES)
TARGET = "target_delay_s"


def route_features(arrivals: DataFrame, width: str = "15 minutes") -> DataFrame:
    delay = "arrival_delay_s"
    return tumbling(arrivals.where("is_final"), ["route_id"], "arrival_at", width, [
        F.avg(delay).alias("route_mean_delay_s"), quantile(delay, 0.9).alias("route_p90_delay_s"),
        share_of(F.col(delay) >= 300).alias("route_late_share"), F.count(F.lit(1)).alias("route_arrivals"),
    ]).select("route_id", "window_end", *ROUTE_FEATURES)


def mode_code(mode: str = "mode") -> Column:
    """1 for the first of MODES and so on, 0 for any other, null for null."""
    return F.array_position(F.array(*(F.lit(m) for m in MODES)), F.col(mode)).cast("int")


def clock(local: str) -> dict[str, Column]:
    return {"hour": F.hour(local), "day_of_week": F.dayofweek(local)}


def examples(arrivals: DataFrame, one_in: int = 4, most: int = MOST_AHEAD) -> DataFrame:
    """A sampled observation of a trip with each of its next stops."""
    trip = ["trip_id", "service_date"]
    final = arrivals.where("is_final").withColumns({"mode_code": mode_code(), **clock("scheduled_arrival_at_local"), "_seen": F.col("arrival_delay_s").cast("double")})
    observed = {"route_id": "route_id", "arrival_at": "observed_at", "_seen": "current_delay_s", "scheduled_arrival_at": "_from", "hour": "hour", "day_of_week": "day_of_week", "mode_code": "mode_code", "stop_sequence": "_sequence"}
    later = {"_seen": TARGET, "scheduled_arrival_at": "_to"}
    pairs = pairs_ahead(final, trip, "stop_sequence", most, observed, later, "stops_ahead")
    pairs = hashed_sample(pairs, ["trip_id", "_sequence"], one_in)
    return pairs.withColumn("scheduled_minutes_ahead", seconds_between("_from", "_to") / 60).drop("_from", "_to", "_sequence")


def with_route_features(rows: DataFrame, features: DataFrame) -> DataFrame:
    """The features of the latest window that ended at or before the observation."""
    return as_of_join(rows, features, ["route_id"], "observed_at", "window_end", ROUTE_FEATURES)


def train(rows: DataFrame, test_days: int = 2, max_rows: int = 400_000, seed: int = 42, trees: int = 20, inputs: Sequence[str] = INPUTS) -> tuple[PipelineModel, dict]:
    """A model fitted on all but the last test_days dates, and its errors there against keeping the current delay."""
    rows = rows.withColumns({c: F.col(c).cast("double") for c in (*inputs, TARGET)})
    fit, test = split_by_date(rows, "service_date", test_days)
    n = fit.count()
    if n > max_rows:
        fit = fit.sample(max_rows / n, seed)
    filled = [f"{c}_" for c in inputs]
    model = Pipeline(stages=[
        Imputer(inputCols=list(inputs), outputCols=filled), VectorAssembler(inputCols=filled, outputCol="features"),
        GBTRegressor(featuresCol="features", labelCol=TARGET, predictionCol="prediction", maxIter=trees, maxDepth=5, seed=seed),
    ]).fit(fit)
    return model, evaluate(model.transform(test), n)


def evaluate(scored: DataFrame, trained_rows: int) -> dict:
    error = lambda c: F.avg(F.abs(F.col(c) - F.col(TARGET)))
    by_horizon = scored.groupBy("stops_ahead").agg(error("prediction").alias("mae"), error("current_delay_s").alias("baseline"), F.count(F.lit(1)).alias("n"))
    rows = [r.asDict() for r in by_horizon.orderBy("stops_ahead").collect()]
    total = sum(r["n"] for r in rows)
    mean = lambda k: sum(r[k] * r["n"] for r in rows) / total if total else None
    return {"rows": trained_rows, "test_rows": total, "mae": mean("mae"), "baseline_mae": mean("baseline"), "by_stops_ahead": {int(r["stops_ahead"]): r["mae"] for r in rows}}


def promoted(metrics: dict, champion: dict | None) -> bool:
    """Whether a model beats keeping the current delay, and isn't worse than the champion."""
    if metrics["mae"] is None or metrics["mae"] >= metrics["baseline_mae"]:
        return False
    return champion is None or metrics["mae"] <= champion["mae"]


def register(spark: SparkSession, model: PipelineModel, metrics: dict, root: str) -> bool:
    """Saves the model as the next version under root, and names it champion in a manifest if it is promoted."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/champion.json")
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    champion = json.loads("\n".join(r["value"] for r in spark.read.text(str(path.toString())).collect())) if fs.exists(path) else None
    home = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/versions")
    version = (len(fs.listStatus(home)) if fs.exists(home) else 0) + 1
    model.write().save(f"{root}/versions/{version}")
    if not promoted(metrics, champion["metrics"] if champion else None):
        return False
    out = fs.create(path, True)
    out.write(bytearray(json.dumps({"version": version, "metrics": metrics}).encode()))
    out.close()
    return True


def candidates(arrivals: DataFrame, offsets: DataFrame, snapshot_at: Column, in_progress: str = "15 MINUTES", most: int = MOST_AHEAD) -> DataFrame:
    """The next stops of every trip that was seen within in_progress of the snapshot, timed from its latest stop."""
    trip = ["trip_id", "service_date"]
    seen = arrivals.where("is_final").where((F.col("arrival_at") <= snapshot_at) & (F.col("arrival_at") >= snapshot_at - F.expr(f"INTERVAL {in_progress}")))
    now = latest(seen, trip, ["stop_sequence"]).join(offsets.select("trip_id", "stop_sequence", F.col("offset_s").alias("_here")), ["trip_id", "stop_sequence"])
    ahead = offsets.select("trip_id", F.col("stop_sequence").alias("target_stop_sequence"), F.col("stop_id").alias("target_stop_id"), "offset_s")
    rows = now.join(ahead, "trip_id").where(F.col("target_stop_sequence").between(F.col("stop_sequence") + 1, F.col("stop_sequence") + most))
    later = F.col("offset_s") - F.col("_here")
    return rows.select(
        *trip, "route_id", "route_label", "vehicle_id", F.col("arrival_at").alias("observed_at"), F.col("arrival_delay_s").cast("double").alias("current_delay_s"),
        "target_stop_sequence", "target_stop_id", (F.col("target_stop_sequence") - F.col("stop_sequence")).alias("stops_ahead"), (later / 60).alias("scheduled_minutes_ahead"),
        add_seconds("scheduled_arrival_at", later).alias("target_scheduled_at"), *(c.alias(n) for n, c in clock("scheduled_arrival_at_local").items()), mode_code().alias("mode_code"),
    )


def predictions(model: PipelineModel, rows: DataFrame, stops: DataFrame, snapshot_at: Column, inputs: Sequence[str] = INPUTS) -> DataFrame:
    """rows: candidates with route features. The predicted delay in whole seconds and the arrival."""
    scored = model.transform(rows.withColumns({c: F.col(c).cast("double") for c in inputs}))
    delay = F.round("prediction").cast("int")
    named = scored.join(stops.select(F.col("stop_id").alias("target_stop_id"), "stop_name"), "target_stop_id", "left")
    return named.select(
        snapshot_at.alias("snapshot_at"), "trip_id", "service_date", "route_id", "route_label", "vehicle_id", "current_delay_s", "target_stop_sequence", "target_stop_id", "stop_name",
        F.col("stops_ahead").cast("int").alias("stops_ahead"), "target_scheduled_at", delay.alias("predicted_delay_s"), add_seconds("target_scheduled_at", delay).alias("predicted_arrival_at"),
    )
