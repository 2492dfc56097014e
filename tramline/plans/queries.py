"""Named queries that apply the operators to the star-schema tables, each with an independent SQL form.

There is no transit data there, so ``events`` stands in for arrivals (user = trip and vehicle, event type = stop) and for
positions on a made-up map, and an order's lines stand in for a trip's stops.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import columns as C
from ..operators import expectations, feeds, history, movement, punctuality, serving, temporal, timetable
from ..simulator import calibration

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def rnd(x: str, places: int) -> str:
    """SQL that rounds the decimal form of x half up, as Spark does."""
    return f"round(CAST(CAST(({x}) AS VARCHAR) AS DECIMAL(38, 12)), {places})::DOUBLE"


def arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")
    rows = e.select(
        "event_id", F.col("user_id").alias("trip_id"), F.col("user_id").alias("vehicle_id"), (F.col("user_id") % 20).alias("route_id"),
        (F.col("event_id") % 2).alias("direction_id"), F.col("event_type").alias("stop_id"), F.col("ts").alias("arrival_at"),
        (F.floor("value").cast("int") - 120).alias("arrival_delay_s"),
    )
    rows = rows.withColumn("scheduled_arrival_at", C.add_seconds("arrival_at", -F.col("arrival_delay_s")))
    local = C.local_time("scheduled_arrival_at")
    return rows.withColumns({"scheduled_arrival_at_local": local, "service_date": F.to_date(local), "is_final": F.lit(True)})


ARRIVALS = """arrivals AS (
  SELECT *, CAST(scheduled_arrival_at_local AS DATE) AS service_date, hour(scheduled_arrival_at_local)::INTEGER AS hour,
    CASE WHEN arrival_delay_s < -60 THEN 'early' WHEN arrival_delay_s >= 300 THEN 'late' ELSE 'on_time' END AS punctuality,
    CASE dayofweek(scheduled_arrival_at_local) WHEN 0 THEN 'sunday' WHEN 6 THEN 'saturday' ELSE 'weekday' END AS day_type
  FROM (
    SELECT *, scheduled_arrival_at AT TIME ZONE 'UTC' AT TIME ZONE 'Pacific/Auckland' AS scheduled_arrival_at_local
    FROM (
      SELECT *, arrival_at - to_seconds(arrival_delay_s) AS scheduled_arrival_at
      FROM (
        SELECT event_id, user_id AS trip_id, user_id AS vehicle_id, user_id % 20 AS route_id, event_id % 2 AS direction_id,
          event_type AS stop_id, ts::TIMESTAMP AS arrival_at, CAST(floor(value) AS INTEGER) - 120 AS arrival_delay_s
        FROM events))))"""
SUMMARY = f"""count(*) AS arrivals, count(*) FILTER (punctuality = 'early') AS early, count(*) FILTER (punctuality = 'on_time') AS on_time,
  count(*) FILTER (punctuality = 'late') AS late, {rnd("count(*) FILTER (punctuality = 'on_time')::DOUBLE / count(*)", 4)} AS on_time_rate,
  {rnd("sum(arrival_delay_s)::DOUBLE / count(*)", 1)} AS avg_delay_s,
  quantile_disc(arrival_delay_s, 0.5) AS p50_delay_s, quantile_disc(arrival_delay_s, 0.9) AS p90_delay_s"""


@query(f"WITH {ARRIVALS} SELECT service_date, hour, route_id, direction_id, {SUMMARY}, count(DISTINCT trip_id) AS trips FROM arrivals GROUP BY ALL")
def route_ontime_hourly(spark, sf_dir):
    return punctuality.route_hourly(punctuality.final_arrivals(arrivals(spark, sf_dir)), ("route_id", "direction_id"))


@query(f"WITH {ARRIVALS} SELECT stop_id, day_type, hour, {SUMMARY}, min(service_date) AS first_date, max(service_date) AS last_date FROM arrivals GROUP BY stop_id, day_type, hour")
def stop_delay_stats(spark, sf_dir):
    return punctuality.stop_statistics(punctuality.final_arrivals(arrivals(spark, sf_dir)), ("stop_id",))


@query(f"""WITH {ARRIVALS} SELECT day_type, hour, CASE WHEN dayofweek(scheduled_arrival_at_local) BETWEEN 1 AND 5 AND
  (hour * 60 + minute(scheduled_arrival_at_local) BETWEEN 390 AND 539 OR hour * 60 + minute(scheduled_arrival_at_local) BETWEEN 900 AND 1079)
  THEN TRUE ELSE FALSE END AS is_peak, count(*) AS n FROM arrivals GROUP BY ALL""")
def local_day_type_hour(spark, sf_dir):
    local = F.col("scheduled_arrival_at_local")
    by = arrivals(spark, sf_dir).groupBy(C.day_type(local).alias("day_type"), F.hour(local).alias("hour"), C.in_peak(local).alias("is_peak"))
    return by.agg(F.count(F.lit(1)).alias("n"))


HEADWAYS = f"""{ARRIVALS}, led AS (
  SELECT *, lag(event_id) OVER w AS leading_event_id, lag(scheduled_arrival_at) OVER w AS leading_scheduled, lag(arrival_at) OVER w AS leading_arrival
  FROM arrivals WINDOW w AS (PARTITION BY route_id, direction_id, stop_id, service_date ORDER BY scheduled_arrival_at, event_id)
), headways AS (
  SELECT *, round(CAST(CAST(actual_headway_s::DOUBLE / scheduled_headway_s AS VARCHAR) AS DECIMAL(38, 12)), 3)::DOUBLE AS headway_ratio
  FROM (SELECT *, date_diff('second', leading_scheduled, scheduled_arrival_at) AS scheduled_headway_s, date_diff('second', leading_arrival, arrival_at) AS actual_headway_s
    FROM led WHERE leading_event_id IS NOT NULL)
  WHERE scheduled_headway_s BETWEEN 1 AND 7200)"""



WHOLE = HEADWAYS.replace("ts::TIMESTAMP AS arrival_at", "date_trunc('second', ts::TIMESTAMP) AS arrival_at")


def _headways(spark, sf_dir):
    rows = arrivals(spark, sf_dir)
    rows = rows.withColumn("arrival_at", F.date_trunc("second", "arrival_at").cast("timestamp_ntz"))
    rows = rows.withColumn("scheduled_arrival_at", C.add_seconds("arrival_at", -F.col("arrival_delay_s")))
    return punctuality.headways(punctuality.final_arrivals(rows), trip="event_id", ahead=("event_id", "vehicle_id", "scheduled_arrival_at", "arrival_at"))


@query(f"WITH {WHOLE} SELECT event_id, leading_event_id, service_date, hour, scheduled_headway_s, actual_headway_s, headway_ratio, headway_ratio < 0.25 AS is_bunched FROM headways")
def headways(spark, sf_dir):
    return _headways(spark, sf_dir).select("event_id", "leading_event_id", "service_date", "hour", "scheduled_headway_s", "actual_headway_s", "headway_ratio", "is_bunched")


@query(f"WITH {WHOLE} SELECT event_id, route_id, stop_id, headway_ratio FROM headways WHERE headway_ratio < 0.25")
def bunching_events(spark, sf_dir):
    return _headways(spark, sf_dir).where("is_bunched").select("event_id", "route_id", "stop_id", "headway_ratio")


@query(f"""WITH {WHOLE} SELECT route_id, direction_id, count(*) AS headways,
  {rnd("sum(scheduled_headway_s)::DOUBLE / count(*)", 1)} AS avg_scheduled_headway_s, {rnd("sum(actual_headway_s)::DOUBLE / count(*)", 1)} AS avg_actual_headway_s,
  {rnd("stddev_samp(actual_headway_s - scheduled_headway_s) / avg(scheduled_headway_s)", 3)} AS headway_cv,
  count(*) FILTER (headway_ratio < 0.25) AS bunched FROM headways GROUP BY ALL""")
def headway_regularity(spark, sf_dir):
    return punctuality.regularity(_headways(spark, sf_dir), ("route_id", "direction_id"))


FEATURES = """features AS (SELECT route_id, time_bucket(INTERVAL 15 MINUTES, arrival_at) + INTERVAL 15 MINUTES AS window_end,
  sum(arrival_delay_s)::DOUBLE / count(*) AS route_mean_delay_s, quantile_disc(arrival_delay_s, 0.9) AS route_p90_delay_s,
  count(*) FILTER (arrival_delay_s >= 300)::DOUBLE / count(*) AS route_late_share, count(*) AS route_arrivals
  FROM arrivals GROUP BY 1, 2)"""


def route_features(rows: DataFrame) -> DataFrame:
    from ..ml.arrival import route_features as features

    return features(rows)


@query(f"WITH {ARRIVALS}, {FEATURES} SELECT * FROM features")
def route_delay_15min(spark, sf_dir):
    return route_features(arrivals(spark, sf_dir))


@query(f"""WITH {ARRIVALS}, {FEATURES} SELECT a.event_id, a.route_id, f.window_end, f.route_mean_delay_s, f.route_p90_delay_s, f.route_late_share, f.route_arrivals
  FROM arrivals a ASOF LEFT JOIN features f ON a.route_id = f.route_id AND a.arrival_at >= f.window_end""")
def asof_features(spark, sf_dir):
    rows = arrivals(spark, sf_dir)
    right = route_features(rows).withColumn("at", F.col("window_end"))
    names = ["window_end", "route_mean_delay_s", "route_p90_delay_s", "route_late_share", "route_arrivals"]
    return temporal.as_of_join(rows.select("event_id", "route_id", "arrival_at"), right, ["route_id"], "arrival_at", "at", names).drop("arrival_at")


@query("""WITH o AS (SELECT user_id, event_type, ts::TIMESTAMP AS ts, event_id,
    CASE WHEN event_type IS DISTINCT FROM lag(event_type) OVER w OR row_number() OVER w = 1 THEN 1 ELSE 0 END AS new
    FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_type)),
  r AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts, event_type ROWS UNBOUNDED PRECEDING) AS run FROM o),
  g AS (SELECT user_id, run, min(event_type) AS event_type, min(ts) AS start_at, arg_max(event_id, (ts, event_id)) AS event_id FROM r GROUP BY ALL)
  SELECT user_id, event_type, event_id, start_at AS "__START_AT", lead(start_at) OVER (PARTITION BY user_id ORDER BY run) AS "__END_AT" FROM g""")
def scd2_history(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select("user_id", "event_type", "ts", "event_id")
    return history.versions(rows, ["user_id"], "ts", ["event_type"])


@query("""SELECT user_id, ts::TIMESTAMP AS ts, event_id, event_type, value FROM events
  QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""")
def scd1_current(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select("user_id", "ts", "event_id", "event_type", "value")
    return history.latest(rows, ["user_id"], ["ts", "event_id"])


@query("""SELECT user_id, event_type, arg_max_null(value, (ts, event_id)) AS value, max(ts)::TIMESTAMP AS last_at, count(*) AS n FROM events GROUP BY ALL""")
def final_observation(spark, sf_dir):
    rows = table(spark, sf_dir, "events")
    last = F.max(F.struct("ts", "event_id", "value"))
    return rows.groupBy("user_id", "event_type").agg(last["value"].alias("value"), F.max("ts").alias("last_at"), F.count(F.lit(1)).alias("n"))


@query("""SELECT DISTINCT user_id, event_type FROM events""")
def deduplicated_keys(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select("user_id", "event_type")
    return history.deduplicated(rows, ["user_id", "event_type"])


@query("""WITH l AS (SELECT event_id, user_id, event_type, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS before FROM events)
  SELECT event_id, user_id, event_type FROM l WHERE before IS NULL OR before <> event_type""")
def unchanged_skipped(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "ts")
    return history.without_unchanged(rows, ["user_id"], ["ts", "event_id"], "event_type").drop("ts")


@query("""SELECT event_id, user_id, ts::TIMESTAMP AS ts, (SELECT max(ts) FROM events)::TIMESTAMP AS snapshot_at FROM events
  WHERE ts >= (SELECT max(ts) FROM events) - INTERVAL 1 DAY""")
def vehicle_latest(spark, sf_dir):
    return history.within_latest(table(spark, sf_dir, "events").select("event_id", "user_id", "ts"), "ts", "1 DAY", "snapshot_at")


@query("""WITH a AS (SELECT user_id, min(event_type) AS t, count(*) AS n FROM events WHERE event_id % 2 = 0 GROUP BY 1),
  b AS (SELECT user_id, min(event_type) AS t, count(*) AS n FROM events WHERE event_id % 3 = 0 GROUP BY 1)
  SELECT coalesce(b.user_id, a.user_id) AS user_id, CASE WHEN b.user_id IS NULL THEN a.t ELSE b.t END AS t,
    CASE WHEN b.user_id IS NULL THEN a.n ELSE b.n END AS n,
    CASE WHEN a.user_id IS NULL THEN 'insert' WHEN b.user_id IS NULL THEN 'delete' ELSE 'update' END AS _change
  FROM a FULL JOIN b ON a.user_id = b.user_id
  WHERE a.user_id IS NULL OR b.user_id IS NULL OR a.t <> b.t OR a.n <> b.n""")
def snapshot_changes(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    a, b = (e.where(F.col("event_id") % m == 0).groupBy("user_id").agg(F.min("event_type").alias("t"), F.count(F.lit(1)).alias("n")) for m in (2, 3))
    return history.changes(a, b, ["user_id"])


@query("""SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)
  QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) = 1""")
def insert_only_new(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    known = table(spark, sf_dir, "customer").where("c_acctbal < 0").select(F.col("c_custkey").alias("o_custkey"))
    return history.only_new(orders, known, ["o_custkey"])


@query("""SELECT c_custkey, c_mktsegment, c_acctbal FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)
  UNION ALL SELECT o_custkey, min(o_orderpriority), max(o_totalprice) FROM orders GROUP BY 1""")
def keyed_upsert(spark, sf_dir):
    old = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment", "c_acctbal")
    new = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.min("o_orderpriority").alias("c_mktsegment"), F.max("o_totalprice").alias("c_acctbal"))
    return history.upserted(old, new, ["c_custkey"])


@query(f"""WITH {ARRIVALS}, c AS (SELECT route_id, count(*) FILTER (punctuality = 'on_time')::DOUBLE AS k, count(*)::DOUBLE AS n FROM arrivals GROUP BY 1)
  SELECT route_id, {rnd("(k / n + 1.96 * 1.96 / (2 * n) - 1.96 * sqrt(k / n * (1 - k / n) / n + 1.96 * 1.96 / (4 * n * n))) / (1 + 1.96 * 1.96 / n)", 6)} AS low,
    {rnd("(k / n + 1.96 * 1.96 / (2 * n) + 1.96 * sqrt(k / n * (1 - k / n) / n + 1.96 * 1.96 / (4 * n * n))) / (1 + 1.96 * 1.96 / n)", 6)} AS high FROM c""")
def wilson_interval(spark, sf_dir):
    counts = punctuality.final_arrivals(arrivals(spark, sf_dir)).groupBy("route_id").agg(F.count_if(F.col("punctuality") == "on_time").alias("k"), F.count(F.lit(1)).alias("n"))
    return counts.select("route_id", F.round(C.wilson("k", "n", False), 6).alias("low"), F.round(C.wilson("k", "n", True), 6).alias("high"))


def _departures(spark, sf_dir):
    rows = arrivals(spark, sf_dir).withColumns({"is_origin": F.col("stop_id") == "click", "mode_group": F.lit("bus"), "mode": F.lit("bus"), "route_short_name": F.col("route_id").cast("string"), "route_label": F.concat(F.lit("Route "), F.col("route_id").cast("string"))})
    return punctuality.origin_departures(rows)


def _scheduled(departures):
    return departures.groupBy("service_date", "route_short_name").agg((F.count_distinct("trip_id") * 2).alias("scheduled_trips"))


DAILY = f"""{ARRIVALS}, departures AS (
  SELECT *, date_trunc('week', service_date)::DATE AS week, route_id::VARCHAR AS route_short_name, 'Route ' || route_id AS route_label, 'bus' AS mode,
    arrival_delay_s > -75 AND arrival_delay_s < 315 AS is_punctual,
    dayofweek(scheduled_arrival_at_local) BETWEEN 1 AND 5 AND (hour * 60 + minute(scheduled_arrival_at_local) BETWEEN 390 AND 539
      OR hour * 60 + minute(scheduled_arrival_at_local) BETWEEN 900 AND 1079) AS is_peak
  FROM arrivals WHERE stop_id = 'click'
), scheduled AS (SELECT service_date, route_short_name, count(DISTINCT trip_id) * 2 AS scheduled_trips FROM departures GROUP BY ALL
), daily AS (
  SELECT d.service_date, d.route_short_name, week, route_label, mode, count(*) AS punctuality_denominator, count(*) FILTER (is_punctual) AS punctuality_numerator,
    {rnd("sum(arrival_delay_s)::DOUBLE / count(*)", 1)} AS mean_departure_delay_s, count(*) FILTER (is_peak) AS peak_punctuality_denominator,
    count(*) FILTER (is_peak AND is_punctual) AS peak_punctuality_numerator, any_value(scheduled_trips) AS scheduled_trips,
    {rnd("count(*) FILTER (is_punctual)::DOUBLE / count(*)", 4)} AS punctuality,
    {rnd("count(*)::DOUBLE / any_value(scheduled_trips)", 4)} AS punctuality_contributing_percent
  FROM departures d JOIN scheduled s ON d.service_date = s.service_date AND d.route_short_name = s.route_short_name
  GROUP BY d.service_date, d.route_short_name, week, route_label, mode)"""
WEEKLY = f"""{DAILY}, weekly AS (SELECT week, route_short_name, route_label, mode, count(*) AS days_observed, sum(scheduled_trips)::BIGINT AS scheduled_trips,
  sum(punctuality_denominator)::BIGINT AS punctuality_denominator, sum(punctuality_numerator)::BIGINT AS punctuality_numerator,
  sum(peak_punctuality_denominator)::BIGINT AS peak_punctuality_denominator, sum(peak_punctuality_numerator)::BIGINT AS peak_punctuality_numerator,
  {rnd("sum(punctuality_numerator)::DOUBLE / sum(punctuality_denominator)::DOUBLE", 4)} AS punctuality FROM daily GROUP BY week, route_short_name, route_label, mode)"""


def _daily(spark, sf_dir):
    departures = _departures(spark, sf_dir)
    return punctuality.punctuality_daily(departures, _scheduled(departures))


@query(f"WITH {DAILY} SELECT * FROM daily")
def punctuality_daily(spark, sf_dir):
    return _daily(spark, sf_dir)


@query(f"WITH {WEEKLY} SELECT * FROM weekly")
def punctuality_weekly(spark, sf_dir):
    return punctuality.punctuality_weekly(_daily(spark, sf_dir))


def _published(weekly):
    return weekly.where("cast(route_short_name as int) % 3 <> 0").select("week", "route_short_name", F.col("days_observed").alias("punctuality_denominator"), (F.col("days_observed") - 1).alias("punctuality_numerator"))


@query(f"""WITH {WEEKLY}, published AS (SELECT week, route_short_name, days_observed AS d, days_observed - 1 AS k FROM weekly WHERE route_short_name::INTEGER % 3 <> 0 AND days_observed > 0),
  recent AS (SELECT * FROM published WHERE week IN (SELECT DISTINCT week FROM published ORDER BY week DESC LIMIT 2)),
  ours AS (SELECT coalesce(route_short_name, 'All routes') AS name, count(DISTINCT week) AS our_weeks, sum(punctuality_denominator)::DOUBLE AS n, sum(punctuality_numerator)::DOUBLE AS k
    FROM weekly GROUP BY GROUPING SETS ((route_short_name), ())),
  same_r AS (SELECT coalesce(route_short_name, 'All routes') AS name, count(*) AS w, sum(k)::DOUBLE / sum(d)::DOUBLE AS p FROM published GROUP BY GROUPING SETS ((route_short_name), ())),
  recent_r AS (SELECT coalesce(route_short_name, 'All routes') AS name, min(week) AS f, max(week) AS t, sum(k)::DOUBLE / sum(d)::DOUBLE AS p FROM recent GROUP BY GROUPING SETS ((route_short_name), ()))
  SELECT o.name AS route_short_name, CASE WHEN o.name <> 'All routes' THEN 'Route ' || o.name END AS route_label,
    CASE WHEN s.p IS NOT NULL THEN 'same weeks' WHEN r.p IS NOT NULL THEN 'latest published weeks' ELSE 'no published figure' END AS comparison_basis,
    our_weeks, n::BIGINT AS our_trips, {rnd("o.k / n", 4)} AS our_punctuality,
    {rnd("(o.k / n + 1.96 * 1.96 / (2 * n) - 1.96 * sqrt(o.k / n * (1 - o.k / n) / n + 1.96 * 1.96 / (4 * n * n))) / (1 + 1.96 * 1.96 / n)", 4)} AS our_punctuality_low,
    {rnd("(o.k / n + 1.96 * 1.96 / (2 * n) + 1.96 * sqrt(o.k / n * (1 - o.k / n) / n + 1.96 * 1.96 / (4 * n * n))) / (1 + 1.96 * 1.96 / n)", 4)} AS our_punctuality_high,
    {rnd("s.p", 4)} AS official_same_period_punctuality, s.w AS official_same_period_weeks, {rnd("r.p", 4)} AS official_recent_punctuality,
    r.f AS official_recent_from, r.t AS official_recent_to, {rnd("(o.k / n - coalesce(s.p, r.p)) * 100", 1)} AS difference_pp,
    coalesce(s.p, r.p) BETWEEN (o.k / n + 1.96 * 1.96 / (2 * n) - 1.96 * sqrt(o.k / n * (1 - o.k / n) / n + 1.96 * 1.96 / (4 * n * n))) / (1 + 1.96 * 1.96 / n)
      AND (o.k / n + 1.96 * 1.96 / (2 * n) + 1.96 * sqrt(o.k / n * (1 - o.k / n) / n + 1.96 * 1.96 / (4 * n * n))) / (1 + 1.96 * 1.96 / n) AS reference_within_interval
  FROM ours o LEFT JOIN same_r s ON o.name = s.name LEFT JOIN recent_r r ON o.name = r.name""")
def punctuality_benchmark(spark, sf_dir):
    weekly = punctuality.punctuality_weekly(_daily(spark, sf_dir))
    return punctuality.benchmark(weekly, _published(weekly), recent_weeks=2)


POSITIONS = """positions AS (SELECT event_id, user_id AS vehicle_id, user_id AS trip_id, user_id % 20 AS route_id, ts::TIMESTAMP AS position_at,
  -41.0 - (event_id % 97) / 1000.0::DOUBLE AS latitude, 174.7 + (event_id % 89) / 1000.0::DOUBLE AS longitude FROM events),
stepped AS (SELECT *, lag(latitude) OVER w AS lat0, lag(longitude) OVER w AS lon0, lag(position_at) OVER w AS at0
  FROM positions WINDOW w AS (PARTITION BY vehicle_id ORDER BY position_at, event_id)),
moves AS (SELECT *, date_diff('second', date_trunc('second', at0), date_trunc('second', position_at)) AS gap_s,
    2 * 6371000 * asin(sqrt(pow(sin(radians(latitude - lat0) / 2), 2) + cos(radians(lat0)) * cos(radians(latitude)) * pow(sin(radians(longitude - lon0) / 2), 2))) AS m,
    (latitude + lat0) / 2 AS mid_lat, (longitude + lon0) / 2 AS mid_lon FROM stepped WHERE at0 IS NOT NULL),
speeds AS (SELECT *, m / gap_s * 3.6 AS speed_kmh, CAST(floor((mid_lat + 90) / 0.01) * 100000 + floor((mid_lon + 180) / 0.01) AS BIGINT) AS cell,
    position_at AT TIME ZONE 'UTC' AT TIME ZONE 'Pacific/Auckland' AS local FROM moves WHERE gap_s BETWEEN 10 AND 100000)"""


def _positions(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("event_id", "user_id", "ts")
    rows = e.select(
        "event_id", F.col("user_id").alias("vehicle_id"), F.col("user_id").alias("trip_id"), (F.col("user_id") % 20).alias("route_id"), F.date_trunc("second", "ts").cast("timestamp_ntz").alias("position_at"), "ts",
        (F.lit(-41.0) - (F.col("event_id") % 97) / F.lit(1000.0)).alias("latitude"), (F.lit(174.7) + (F.col("event_id") % 89) / F.lit(1000.0)).alias("longitude"),
    )
    return rows.withColumn("position_at_local", C.local_time("ts"))


def _moves(spark, sf_dir):
    return movement.steps(_positions(spark, sf_dir).drop("ts"), gap_s=(10, 100_000), fastest_kmh=1e9, tie=["event_id"]).withColumn("mode_group", F.lit("bus"))


SPEEDS = POSITIONS.replace("ts::TIMESTAMP AS position_at,", "date_trunc('second', ts::TIMESTAMP) AS position_at,")


@query(f"WITH {SPEEDS} SELECT event_id, gap_s, {rnd('m', 2)} AS metres FROM speeds")
def great_circle(spark, sf_dir):
    return _moves(spark, sf_dir).select("event_id", "gap_s", F.round(F.col("speed_kmh") / 3.6 * F.col("gap_s"), 2).alias("metres"))


def _cells(spark, sf_dir):
    cell = lambda lon, lat: (F.floor((F.col(lat) + 90) / 0.01) * 100_000 + F.floor((F.col(lon) + 180) / 0.01)).cast("bigint")
    return movement.cell_speeds(_moves(spark, sf_dir), cell=cell)


CELLS = f"""{SPEEDS}, cells AS (SELECT cell, 'bus' AS mode_group, CASE dayofweek(local) WHEN 0 THEN 'sunday' WHEN 6 THEN 'saturday' ELSE 'weekday' END AS day_type,
  hour(local)::INTEGER AS hour, count(*) AS samples, {rnd("quantile_disc(speed_kmh, 0.5)", 1)} AS median_speed_kmh, {rnd("avg(mid_lat)", 6)} AS latitude,
  {rnd("avg(mid_lon)", 6)} AS longitude, count(DISTINCT route_id) AS routes FROM speeds GROUP BY ALL)"""


@query(f"WITH {CELLS} SELECT cell, mode_group, day_type, hour, samples, median_speed_kmh, routes FROM cells")
def speed_cells(spark, sf_dir):
    return _cells(spark, sf_dir).drop("latitude", "longitude")


@query(f"""WITH {CELLS}, h AS (SELECT cell, sum(samples) FILTER (hour IN (7, 8))::BIGINT AS peak_samples, sum(samples) FILTER (hour NOT IN (7, 8))::BIGINT AS midday_samples,
    {rnd("(sum(samples * median_speed_kmh::DECIMAL(10, 1)) FILTER (hour IN (7, 8)))::DOUBLE / (sum(samples) FILTER (hour IN (7, 8)))::DOUBLE", 1)} AS peak_speed_kmh,
    {rnd("(sum(samples * median_speed_kmh::DECIMAL(10, 1)) FILTER (hour NOT IN (7, 8)))::DOUBLE / (sum(samples) FILTER (hour NOT IN (7, 8)))::DOUBLE", 1)} AS midday_speed_kmh, max(routes) AS routes
  FROM cells WHERE day_type = 'weekday' AND hour IN (7, 8, 10, 11, 12, 13, 14) GROUP BY cell)
  SELECT *, {rnd("(1 - peak_speed_kmh / midday_speed_kmh) * 100", 1)} AS peak_slowdown_pct FROM h WHERE peak_samples >= 1 AND midday_samples >= 1 AND midday_speed_kmh >= 0.1""")
def congestion_hotspots(spark, sf_dir):
    return movement.hotspots(_cells(spark, sf_dir), 1, 0.1).drop("latitude", "longitude")


SEGMENTS = f"""lines AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey % 3 AS route_id, l_returnflag AS stop_id,
    TIMESTAMP '2024-01-01' + to_seconds(CAST(l_linenumber * 600 AS INTEGER)) AS planned_at,
    TIMESTAMP '2024-01-01' + to_seconds(CAST(l_linenumber * 600 + l_quantity * 10 AS INTEGER)) AS arrival_at FROM lineitem),
led AS (SELECT *, lag(stop_id) OVER w AS from_stop_id, lag(l_linenumber) OVER w AS from_line, lag(planned_at) OVER w AS p0, lag(arrival_at) OVER w AS a0
  FROM lines WINDOW w AS (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, stop_id, arrival_at, route_id)),
d AS (SELECT *, date_diff('second', p0, planned_at) AS planned, date_diff('second', a0, arrival_at) AS actual FROM led WHERE from_stop_id IS NOT NULL),
segments AS (SELECT route_id, from_stop_id, stop_id AS to_stop_id, l_linenumber - from_line AS stops_spanned, CASE dayofweek(p0) WHEN 0 THEN 'sunday' WHEN 6 THEN 'saturday' ELSE 'weekday' END AS day_type,
    hour(p0)::INTEGER AS hour, count(*) AS trips, {rnd("sum(planned)::DOUBLE / count(*)", 1)} AS scheduled_s, quantile_disc(actual, 0.5) AS median_actual_s,
    quantile_disc(actual - planned, 0.5) AS median_excess_s, quantile_disc(actual - planned, 0.85) AS p85_excess_s,
    {rnd("count(*) FILTER (actual - planned > 60)::DOUBLE / count(*)", 3)} AS share_over_60s FROM d WHERE planned > 0 GROUP BY ALL)"""


def _segments(spark, sf_dir):
    start = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    rows = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", (F.col("l_suppkey") % 3).alias("route_id"), F.col("l_returnflag").alias("stop_id"), F.col("l_returnflag").alias("stop_name"),
        C.add_seconds(start, (F.col("l_linenumber") * 600).cast("int")).alias("scheduled_arrival_at"),
        C.add_seconds(start, (F.col("l_linenumber") * 600 + F.col("l_quantity") * 10).cast("int")).alias("arrival_at"),
    ).withColumns({"scheduled_arrival_at_local": F.col("scheduled_arrival_at"), "is_final": F.lit(True)})
    made = movement.segment_runtimes(rows, ("l_orderkey",), "l_linenumber", ("route_id",), ("l_partkey", "stop_id", "arrival_at", "route_id"))
    return made.drop("from_stop_name", "to_stop_name")


@query(f"WITH {SEGMENTS} SELECT * FROM segments")
def segment_runtimes(spark, sf_dir):
    return _segments(spark, sf_dir)


@query(f"WITH {SEGMENTS} SELECT *, median_excess_s AS suggested_extra_s, {rnd('median_excess_s * trips / 60.0::DOUBLE', 1)} AS excess_trip_minutes FROM segments WHERE trips >= 20 AND median_excess_s >= 0")
def timetable_shortfalls(spark, sf_dir):
    return movement.shortfalls(_segments(spark, sf_dir), 20, 0)


@query("""SELECT a.l_orderkey, a.l_partkey AS part, b.l_partkey AS target_part, b.l_linenumber - a.l_linenumber AS steps_ahead
  FROM lineitem a JOIN lineitem b ON a.l_orderkey = b.l_orderkey AND b.l_linenumber > a.l_linenumber AND b.l_linenumber - a.l_linenumber <= 2""")
def band_pairs(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return temporal.pairs_ahead(rows, ["l_orderkey"], "l_linenumber", 2, {"l_partkey": "part"}, {"l_partkey": "target_part"})


CALENDAR = """(VALUES ('WK', '19920101', '19981231', '0', '1', '1', '1', '1', '1', '0'), ('SAT', '19950101', '19961231', '0', '0', '0', '0', '0', '0', '1'))
  {0}(service_id, start_date, end_date, sunday, monday, tuesday, wednesday, thursday, friday, saturday)"""
EXCEPTIONS = "(VALUES ('SAT', '19950104', '1'), ('WK', '19950104', '2'), ('SAT', '19960106', '1'), ('SAT', '19960106', '2')) {0}(service_id, date, exception_type)"


@query(f"""WITH c AS (SELECT * FROM {CALENDAR.format("c")}), x AS (SELECT service_id, strptime(date, '%Y%m%d')::DATE AS d, exception_type FROM {EXCEPTIONS.format("x")}),
  dates AS (SELECT DISTINCT o_orderdate::DATE AS d FROM orders),
  regular AS (SELECT d, service_id FROM dates, c WHERE d BETWEEN strptime(start_date, '%Y%m%d')::DATE AND strptime(end_date, '%Y%m%d')::DATE
    AND [sunday, monday, tuesday, wednesday, thursday, friday, saturday][dayofweek(d) + 1] = '1'),
  added AS (SELECT d, service_id FROM x JOIN dates USING (d) WHERE exception_type = '1')
  SELECT d AS service_date, service_id FROM (SELECT * FROM regular UNION SELECT * FROM added) a
  WHERE NOT EXISTS (SELECT 1 FROM x WHERE x.exception_type = '2' AND x.d = a.d AND x.service_id = a.service_id)""")
def calendar_expansion(spark, sf_dir):
    dates = table(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("service_date"))
    calendar, exceptions = (spark.sql(f"SELECT * FROM {t.format('AS t')}") for t in (CALENDAR, EXCEPTIONS))
    return timetable.active_services(calendar, exceptions, dates)


@query("""SELECT CASE WHEN grouping(c_mktsegment) = 1 THEN 'All routes' ELSE c_mktsegment END AS c_mktsegment, count(*) AS n, max(c_custkey) AS latest FROM customer GROUP BY GROUPING SETS ((c_mktsegment), ())""")
def total_row(spark, sf_dir):
    return punctuality.with_total(table(spark, sf_dir, "customer"), "c_mktsegment", [F.count(F.lit(1)).alias("n"), F.max("c_custkey").alias("latest")])


@query("""SELECT c_custkey, c_mktsegment FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')""")
def left_anti(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    return customers.join(table(spark, sf_dir, "orders").where("o_orderpriority = '1-URGENT'"), F.col("c_custkey") == F.col("o_custkey"), "left_anti")


@query("""SELECT o_orderkey, date_trunc('week', o_orderdate)::DATE AS week FROM orders
  WHERE date_trunc('week', o_orderdate)::DATE IN (SELECT DISTINCT date_trunc('week', o_orderdate)::DATE AS w FROM orders ORDER BY w DESC LIMIT 8)""")
def topk_weeks(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", C.week_of("o_orderdate").alias("week"))
    return orders.join(F.broadcast(orders.select("week").distinct().orderBy(F.desc("week")).limit(8)), "week", "left_semi").select("o_orderkey", "week")


@query("""WITH r AS (SELECT p_partkey::VARCHAR AS route_id, p_brand AS route_short_name, p_name || ' (' || p_type || ')' AS route_long_name,
    [2, 3, 4, 5, 100, 700, 712, 9][(p_partkey % 8 + 1)::INTEGER] AS route_type FROM part),
  m AS (SELECT *, CASE route_type WHEN 2 THEN 'rail' WHEN 100 THEN 'rail' WHEN 3 THEN 'bus' WHEN 700 THEN 'bus' WHEN 712 THEN 'school bus' WHEN 4 THEN 'ferry' WHEN 5 THEN 'cable car' ELSE 'other' END AS mode FROM r)
  SELECT route_id, route_short_name, route_long_name, route_type::INTEGER AS route_type, mode,
    CASE WHEN mode IN ('bus', 'school bus') THEN 'bus' WHEN mode = 'rail' THEN 'rail' ELSE 'ferry & cable car' END AS mode_group,
    CASE WHEN mode IN ('rail', 'cable car') THEN regexp_replace(route_long_name, '\\s*\\(.*\\)$', '')
      ELSE route_short_name || ' · ' || CASE WHEN length(route_long_name) > 40 THEN substr(route_long_name, 1, 39) || '…' ELSE route_long_name END END AS route_label FROM m""")
def route_dimension(spark, sf_dir):
    kinds = F.array(*(F.lit(str(k)) for k in (2, 3, 4, 5, 100, 700, 712, 9)))
    name = F.concat("p_name", F.lit(" ("), "p_type", F.lit(")"))
    part = table(spark, sf_dir, "part").select(F.col("p_partkey").cast("string").alias("route_id"), F.col("p_brand").alias("route_short_name"), name.alias("route_long_name"), F.element_at(kinds, (F.col("p_partkey") % 8 + 1).cast("int")).alias("route_type"))
    return timetable.route_dimension(part)


@query("""WITH p AS (SELECT date_trunc('second', ts::TIMESTAMP) AS polled, TIMESTAMP '2024-01-31 00:00:00' AS checked FROM events),
  c AS (SELECT date_diff('second', max(polled), any_value(checked)) / 60.0 AS age_min, count(DISTINCT CASE WHEN polled >= checked - INTERVAL 24 HOURS THEN floor(epoch(polled) / 300) END) AS slots,
    greatest(date_diff('second', greatest(min(polled), any_value(checked) - INTERVAL 24 HOURS), any_value(checked)) // 300, 1)::BIGINT AS expected_slots FROM p)
  SELECT age_min::DOUBLE AS age_min, slots, expected_slots, least(slots / expected_slots, 1.0)::DOUBLE AS coverage FROM c""")
def dq_freshness(spark, sf_dir):
    polls = table(spark, sf_dir, "events").select(F.date_trunc("second", "ts").cast("timestamp_ntz").alias("fetched_at"))
    return expectations.freshness(polls, F.lit("2024-01-31 00:00:00").cast("timestamp_ntz"))


@query(f"""WITH {ARRIVALS} SELECT count(*) AS detail_rows, count(*) AS summary_rows, TRUE AS agrees FROM arrivals""")
def dq_reconciliation(spark, sf_dir):
    rows = arrivals(spark, sf_dir)
    return expectations.reconciled(rows, punctuality.route_hourly(punctuality.final_arrivals(rows), ("route_id", "direction_id")), "arrivals")


RULES = (expectations.Expectation("small", "value < 400"), expectations.Expectation("clicks", "event_type = 'click'", "warn"), expectations.Expectation("json", "props IS NOT NULL"))


@query("""SELECT 'events' AS dataset, name, passed, n - passed AS failed, (n - passed)::DOUBLE / n AS rate FROM (
  SELECT count(*) AS n, count(*) FILTER (value < 400) AS small, count(*) FILTER (event_type = 'click') AS clicks, count(props) AS json FROM events)
  UNPIVOT (passed FOR name IN (small, clicks, json))""")
def dq_drop_rates(spark, sf_dir):
    return expectations.drop_rates(table(spark, sf_dir, "events"), RULES, "events")


@query("""SELECT event_id, value FROM events WHERE value < 400 AND props IS NOT NULL""")
def expectations_applied(spark, sf_dir):
    return expectations.expected(table(spark, sf_dir, "events"), RULES)[0].select("event_id", "value")


@query("""SELECT count(c_custkey)::DOUBLE / count(*) AS coverage, count(c_custkey)::DOUBLE / count(*) >= 0.99 AS passes FROM orders LEFT JOIN customer ON o_custkey = c_custkey""")
def dq_join_coverage(spark, sf_dir):
    joined = table(spark, sf_dir, "orders").join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"), "left")
    return expectations.join_coverage(joined, ["c_custkey"])


@query("""SELECT event_type AS stop_id, count(*) AS arrivals FROM events WHERE ts >= (SELECT max(ts) FROM events) - INTERVAL 7 DAYS GROUP BY 1""")
def busiest_stops(spark, sf_dir):
    rows = arrivals(spark, sf_dir).withColumn("stop_name", F.col("stop_id"))
    return serving.busiest_stops(rows).select("stop_id", "arrivals")


@query(f"""WITH {ARRIVALS} SELECT event_id, arrival_at, {rnd("arrival_delay_s / 60.0::DOUBLE", 1)} AS delay_min FROM arrivals WHERE stop_id = 'click' ORDER BY arrival_at DESC, event_id DESC LIMIT 15""")
def board_recent(spark, sf_dir):
    return serving.recent_arrivals(arrivals(spark, sf_dir), "click", 15, tie="event_id").select("event_id", "arrival_at", "delay_min")


@query(f"""WITH {ARRIVALS}, h AS (SELECT service_date, hour, route_id, direction_id, {SUMMARY} FROM arrivals GROUP BY ALL),
  r AS (SELECT 'Route ' || route_id AS route_label, sum(avg_delay_s * arrivals) / sum(arrivals)::DOUBLE / 60 AS m FROM h
    WHERE service_date = (SELECT max(service_date) FROM h) GROUP BY 1 HAVING sum(arrivals) >= 2)
  SELECT {rnd("coalesce(max(m), 0)", 6)} AS worst_route_avg_delay_min, arg_max(route_label, m) AS worst_route FROM r""")
def worst_route(spark, sf_dir):
    hourly = punctuality.route_hourly(punctuality.final_arrivals(arrivals(spark, sf_dir)), ("route_id", "direction_id"))
    hourly = hourly.withColumn("route_label", F.concat(F.lit("Route "), F.col("route_id").cast("string")))
    found = serving.worst_route(hourly, least_arrivals=2)
    return found.withColumn("worst_route_avg_delay_min", F.round("worst_route_avg_delay_min", 6))


@query(f"""WITH {ARRIVALS}, h AS (SELECT service_date, hour, route_id, direction_id, {SUMMARY} FROM arrivals GROUP BY ALL)
  SELECT route_id, sum(arrivals)::BIGINT AS arrivals, {rnd("sum(on_time)::DOUBLE / sum(arrivals)::DOUBLE", 4)} AS on_time_rate FROM h
  GROUP BY route_id HAVING sum(arrivals) >= 100 ORDER BY sum(on_time)::DOUBLE / sum(arrivals)::DOUBLE, route_id LIMIT 10""")
def worst_routes(spark, sf_dir):
    hourly = punctuality.route_hourly(punctuality.final_arrivals(arrivals(spark, sf_dir)), ("route_id", "direction_id"))
    return serving.worst_on_time(hourly, "route_id", 100, 10)


@query(f"""WITH {ARRIVALS}, h AS (SELECT service_date, hour, route_id, direction_id, day_type, {SUMMARY} FROM arrivals GROUP BY ALL)
  SELECT dayofweek(service_date)::INTEGER + 1 AS weekday, hour, sum(arrivals)::BIGINT AS arrivals, {rnd("sum(on_time)::DOUBLE / sum(arrivals)::DOUBLE", 4)} AS on_time_rate,
    {rnd("sum(avg_delay_s * arrivals) / sum(arrivals)::DOUBLE", 2)} AS avg_delay_s FROM (SELECT service_date, hour, route_id, direction_id, {SUMMARY} FROM arrivals GROUP BY ALL) GROUP BY 1, 2""")
def dashboard_weekday_hour(spark, sf_dir):
    hourly = punctuality.route_hourly(punctuality.final_arrivals(arrivals(spark, sf_dir)), ("route_id", "direction_id"))
    return serving.by_weekday_and_hour(hourly)


@query("""SELECT event_id, json_extract_string(props, '$.k')::BIGINT AS k FROM events""")
def json_extract(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", F.from_json("props", "k bigint")["k"].alias("k"))


@query(None)
def hash_sample(spark, sf_dir):
    return temporal.hashed_sample(table(spark, sf_dir, "events").select("event_id", "user_id"), ["user_id", "event_id"], 4)


@query("""WITH d AS (SELECT DISTINCT o_orderdate::DATE AS d FROM orders ORDER BY d DESC LIMIT 2) SELECT o_orderkey, o_orderdate::DATE AS day FROM orders WHERE o_orderdate::DATE >= (SELECT min(d) FROM d)""")
def time_split(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("day"))
    return temporal.split_by_date(orders, "day", 2)[1]


@query("""SELECT event_type, [quantile_disc(value, 0.0), quantile_disc(value, 0.1), quantile_disc(value, 0.5), quantile_disc(value, 0.9), quantile_disc(value, 1.0)]::VARCHAR AS q, count(DISTINCT (user_id, event_type)) AS n FROM events GROUP BY 1""")
def calibration_quantiles(spark, sf_dir):
    rows = calibration.quantiles_by(table(spark, sf_dir, "events"), "event_type", "value", [0.0, 0.1, 0.5, 0.9, 1.0]).drop("n")
    counts = table(spark, sf_dir, "events").groupBy("event_type").agg(F.count_distinct("user_id", "event_type").alias("n"))
    return rows.join(counts, "event_type").select("event_type", F.concat(F.lit("["), F.array_join(F.transform("quantiles", lambda x: x.cast("string")), ", "), F.lit("]")).alias("q"), "n")


@query("""WITH l AS (SELECT user_id, event_type, ts::DATE AS d, event_id % 9 AS k, arg_max(floor(value), (ts, event_id)) AS v FROM events GROUP BY ALL),
  s AS (SELECT event_type, v - lag(v) OVER w AS change, k - lag(k) OVER w AS stops FROM l WINDOW w AS (PARTITION BY user_id, event_type, d ORDER BY k))
  SELECT event_type AS mode, count(*) AS n, round(avg(change)::DECIMAL(18, 6), 3)::DOUBLE AS mean, round(stddev_samp(change)::DECIMAL(18, 6), 3)::DOUBLE AS sd, round(avg(stops)::DECIMAL(18, 6), 3)::DOUBLE AS stops FROM s WHERE stops > 0 GROUP BY 1""")
def calibration_steps(spark, sf_dir):
    updates = table(spark, sf_dir, "events").select(
        F.concat("user_id", F.lit("/"), "event_type").alias("trip_id"), F.to_date("ts").alias("service_date"), F.col("event_type").alias("mode"),
        (F.col("event_id") % 9).alias("stop_sequence"), F.floor("value").alias("arrival_delay_s"), F.struct("ts", "event_id").alias("updated_at"),
    )
    rows = calibration.stop_steps(updates)
    return rows.select("mode", "n", *(F.round(c, 3).alias(c) for c in ("mean", "sd", "stops")))


def polls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event as a poll whose message has one entity: a trip update with one stop and a vehicle's position."""
    text = lambda c: F.col(c).cast("string")
    second = F.unix_seconds(F.col("ts").cast("timestamp"))
    trip = F.struct(
        F.when(F.col("event_id") % 5 > 0, F.concat(F.lit("T"), (F.col("user_id") % 50).cast("string"))).alias("trip_id"),
        F.concat(F.lit("R"), (F.col("user_id") % 7).cast("string")).alias("route_id"), (F.col("event_id") % 2).cast("string").alias("direction_id"),
        F.date_format("ts", "yyyyMMdd").alias("start_date"), F.lit(None).cast("string").alias("start_time"), F.lit("SCHEDULED").alias("schedule_relationship"),
    )
    vehicle = F.struct(F.concat(F.lit("V"), text("user_id")).alias("id"))
    stop = F.struct(
        (F.col("event_id") % 9).alias("stop_sequence"), F.col("event_type").alias("stop_id"), F.when(F.col("event_id") % 11 == 0, "SKIPPED").alias("schedule_relationship"),
        F.struct((F.floor("value") - 120).alias("delay"), (second + F.floor("value").cast("long")).cast("string").alias("time")).alias("arrival"),
    )
    update = F.struct(trip.alias("trip"), vehicle.alias("vehicle"), second.cast("string").alias("timestamp"), F.array(stop).alias("stop_time_update"))
    place = F.struct((F.col("value") / 100 - 42).alias("latitude"), (F.col("user_id") / 50 + 174).alias("longitude"), F.lit(None).cast("double").alias("bearing"))
    position = F.struct(trip.alias("trip"), place.alias("position"), F.lit(None).cast("string").alias("occupancy_status"), second.cast("string").alias("timestamp"), vehicle.alias("vehicle"))
    entity = F.struct(text("event_id").alias("id"), update.alias("trip_update"), position.alias("vehicle"))
    return table(spark, sf_dir, "events").select(F.col("ts").cast("timestamp").alias("fetched_at"), F.struct(F.array(entity).alias("entity")).alias("feed_message"))


UPDATES = """updates AS (
  SELECT CASE WHEN event_id % 5 > 0 THEN 'T' || (user_id % 50) END AS trip_id, 'R' || (user_id % 7) AS route_id, (event_id % 2)::INTEGER AS direction_id,
    ts::DATE AS service_date, 'V' || user_id AS vehicle_id, event_type AS stop_id, (event_id % 9)::INTEGER AS stop_sequence,
    CASE WHEN event_id % 11 = 0 THEN 'SKIPPED' END AS skipped, (floor(value) - 120)::INTEGER AS arrival_delay_s, epoch(date_trunc('second', ts))::BIGINT AS updated_s,
    epoch(date_trunc('second', ts))::BIGINT + floor(value)::BIGINT AS predicted_s,
    date_trunc('second', ts)::TIMESTAMP AT TIME ZONE 'UTC' AT TIME ZONE 'Pacific/Auckland' AS updated_at_local, value, user_id
  FROM events)"""


@query(f"""WITH {UPDATES} SELECT trip_id, route_id, direction_id, service_date, vehicle_id, stop_id, stop_sequence, arrival_delay_s, updated_s, predicted_s, updated_at_local FROM updates""")
def flattened_trip_updates(spark, sf_dir):
    rows = feeds.trip_updates(polls(spark, sf_dir))
    seconds = [F.unix_seconds(c).alias(n) for c, n in (("updated_at", "updated_s"), ("predicted_arrival_at", "predicted_s"))]
    return rows.select("trip_id", "route_id", "direction_id", "service_date", "vehicle_id", "stop_id", "stop_sequence", "arrival_delay_s", *seconds, F.col("updated_at_local").cast("timestamp_ntz").alias("updated_at_local"))


@query(f"""WITH {UPDATES} SELECT vehicle_id, trip_id, route_id, service_date, value / 100 - 42 AS latitude, user_id / 50 + 174 AS longitude, updated_s AS position_s
  FROM updates WHERE value / 100 - 42 BETWEEN -42 AND -40 AND user_id / 50 + 174 BETWEEN 174 AND 177""")
def flattened_vehicle_positions(spark, sf_dir):
    rows = expectations.expected(feeds.vehicle_positions(polls(spark, sf_dir)), feeds.VEHICLE_RULES)[0]
    return rows.select("vehicle_id", "trip_id", "route_id", "service_date", "latitude", "longitude", F.unix_seconds("position_at").alias("position_s"))


@query(f"""WITH {UPDATES}, l AS (
    SELECT *, row_number() OVER (PARTITION BY trip_id, service_date, stop_sequence ORDER BY updated_s DESC, stop_id DESC, route_id DESC, direction_id DESC, vehicle_id DESC, arrival_delay_s DESC, predicted_s DESC) AS place,
      count(*) OVER (PARTITION BY trip_id, service_date, stop_sequence) AS prediction_count, max(stop_sequence) OVER (PARTITION BY trip_id, service_date) AS last_sequence
    FROM updates WHERE skipped IS NULL)
  SELECT trip_id, service_date, stop_sequence, stop_id, vehicle_id, arrival_delay_s, predicted_s AS arrival_s, predicted_s - arrival_delay_s AS scheduled_s, prediction_count,
    stop_sequence < last_sequence OR predicted_s < epoch(TIMESTAMP '2024-01-30 12:00:00') - 600 AS is_final FROM l WHERE place = 1""")
def stop_arrivals(spark, sf_dir):
    rows = feeds.last_predictions(feeds.trip_updates(polls(spark, sf_dir)), F.lit("2024-01-30 12:00:00").cast("timestamp"))
    seconds = [F.unix_seconds(c).alias(n) for c, n in (("arrival_at", "arrival_s"), ("scheduled_arrival_at", "scheduled_s"))]
    return rows.select("trip_id", "service_date", "stop_sequence", "stop_id", "vehicle_id", "arrival_delay_s", *seconds, "prediction_count", "is_final")


def alert_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each supplier as an alert in a poll of its own, with texts in two languages and two informed entities."""
    key = F.col("s_suppkey")
    text = lambda c: F.struct(F.array(F.struct(F.lit("mi").alias("language"), F.lit("he").alias("text")), F.struct(F.lit("en").alias("language"), c.alias("text"))).alias("translation"))
    none = F.lit(None).cast("string")
    trip = F.struct(none.alias("trip_id"), none.alias("route_id"), none.alias("direction_id"), none.alias("start_date"), none.alias("start_time"), none.alias("schedule_relationship"))
    entity = lambda route, stop: F.struct(route.alias("route_id"), (key % 4).cast("string").alias("route_type"), stop.alias("stop_id"), trip.alias("trip"))
    alert = F.struct(
        F.lit("OTHER_CAUSE").alias("cause"), F.when(key % 2 == 0, "DETOUR").alias("effect"), F.lit("INFO").alias("severity_level"), text(F.col("s_name")).alias("header_text"),
        text(none).alias("description_text"), text(none).alias("url"), F.array(F.struct((key * 10).cast("string").alias("start"), none.alias("end"))).alias("active_period"),
        F.array(entity(F.concat(F.lit("R"), (key % 7).cast("string")), none), entity(none, F.concat(F.lit("S"), (key % 11).cast("string")))).alias("informed_entity"),
    )
    message = F.struct(F.array(F.struct(key.cast("string").alias("id"), alert.alias("alert"))).alias("entity"))
    return table(spark, sf_dir, "supplier").select(F.lit("2024-01-01 00:00:00").cast("timestamp").alias("fetched_at"), (key * 100).alias("header_timestamp"), message.alias("feed_message"))


@query("""SELECT s_suppkey::VARCHAR AS alert_id, CASE WHEN s_suppkey % 2 = 0 THEN 'DETOUR' END AS effect, s_name AS header_text, s_suppkey * 10 AS start_s, s_suppkey * 100 AS feed_s FROM supplier""")
def flattened_alerts(spark, sf_dir):
    rows = feeds.alert_polls(alert_feed(spark, sf_dir))
    return rows.select("alert_id", "effect", "header_text", F.unix_seconds("active_start_at").alias("start_s"), F.unix_seconds("feed_at").alias("feed_s"))


@query("""SELECT s_suppkey::VARCHAR AS alert_id, 'R' || (s_suppkey % 7) AS route_id, (s_suppkey % 4)::INTEGER AS route_type, NULL::VARCHAR AS stop_id FROM supplier
  UNION ALL SELECT s_suppkey::VARCHAR, NULL, (s_suppkey % 4)::INTEGER, 'S' || (s_suppkey % 11) FROM supplier""")
def alert_entities(spark, sf_dir):
    return feeds.alert_entities(feeds.alert_polls(alert_feed(spark, sf_dir))).select("alert_id", "route_id", "route_type", "stop_id")


@query("""SELECT date_diff('day', DATE '1998-01-01', max(o_orderdate)::DATE)::INTEGER AS days_ahead, date_diff('day', DATE '1998-01-01', max(o_orderdate)::DATE) >= 3 AS passes FROM orders""")
def days_of_timetable(spark, sf_dir):
    calendar = table(spark, sf_dir, "orders").select(F.date_format("o_orderdate", "yyyyMMdd").alias("end_date"))
    return expectations.days_of_timetable(calendar, F.lit("1998-01-01").cast("date"))
