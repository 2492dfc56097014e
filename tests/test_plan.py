"""Timetable and simulated polls through the whole plan."""

from __future__ import annotations

from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from tramline.functions.columns import service_day_epoch
from tramline.ml import arrival
from tramline.operators import alerts, expectations, feeds, history, timetable
from tramline.plans.transit import transit_plan
from tramline.simulator import calibration, runs
from tramline.sources import files, schemas

PARAMETERS = {"bus": {"initial": [(0.0, -30), (0.5, 60), (1.0, 400)], "step_mean_s": 2.0, "step_sd_s": 15.0, "hourly": {}, "mean_s": 60.0, "occupancy": {"MANY_SEATS_AVAILABLE": 0.7, "null": 0.3}}}
DAYS = [date(2026, 9, 23), date(2026, 9, 24)]
TABLES = {
    "routes": "route_id,route_short_name,route_long_name,route_type\n10,1,City - Beach,3\n20,HVL,Hutt Valley Line (all stops),2\n30,X,Odd,99\n",
    "stops": "stop_id,stop_name,stop_lat,stop_lon\nA,Alpha,-41.28,174.77\nB,Beta,-41.29,174.78\nC,Gamma,-41.30,174.79\n",
    "trips": "route_id,service_id,trip_id,direction_id,trip_headsign\n" + "".join(f"10,WK,t{i},0,Beach\n" for i in range(8)) + "20,SAT,r1,1,Hutt\n",
    "stop_times": "trip_id,arrival_time,departure_time,stop_id,stop_sequence,timepoint\n"
    + "".join(f"t{i},{8 + i // 4:02d}:{15 * (i % 4) + 5 * k:02d}:00,x,{s},{k + 1},{int(k == 0)}\n" for i in range(8) for k, s in enumerate("ABC"))
    + "r1,25:10:00,x,A,1,1\nr1,25:20:00,x,C,2,0\nt0,,x,B,9,0\n",
    "calendar": "service_id,monday,tuesday,wednesday,thursday,friday,saturday,sunday,start_date,end_date\nWK,1,1,1,1,1,0,0,20260801,20261031\nSAT,0,0,0,0,0,1,0,20260801,20261031\n",
    "calendar_dates": "service_id,date,exception_type\nSAT,20260924,1\nWK,20260925,2\n",
}


@pytest.fixture(scope="module")
def static(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("gtfs")
    for version in ("20260101", "20260801"):
        (root / "in" / version).mkdir(parents=True)
        for name, text in TABLES.items():
            (root / "in" / version / f"{name}.txt").write_text("﻿" + text, encoding="utf-8")
    assert files.load_timetable(spark, str(root / "in"), str(root / "out"), schemas.STATIC) == "20260801"
    assert files.load_timetable(spark, str(root / "in"), str(root / "out"), schemas.STATIC) is None
    return {n: spark.read.parquet(str(root / "out" / n)) for n in schemas.STATIC}


def simulated(spark, static):
    dates = spark.createDataFrame([(d,) for d in DAYS], "service_date date")
    services = timetable.active_services(static["calendar"], static["calendar_dates"], dates)
    trips = services.join(static["trips"], "service_id").join(timetable.route_dimension(static["routes"]).select("route_id", "mode_group"), "route_id")
    stops = trips.join(timetable.stop_offsets(static["stop_times"]), "trip_id").join(timetable.stop_roles(static["stop_times"]), ["trip_id", "stop_sequence"])
    stops = stops.withColumns({"mode": F.col("mode_group"), "day_epoch": service_day_epoch("service_date")})
    return runs.with_vehicles(runs.simulate(stops, PARAMETERS, seed=5))


@pytest.fixture(scope="module")
def polls(spark, static, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("polls"))
    moving = runs.at_polls(simulated(spark, static), 60)
    for feed, made in (("tripupdates", runs.trip_update_polls(moving)), ("vehiclepositions", runs.vehicle_polls(moving, static["stops"]))):
        files.write_polls(made.select(*files.poll_envelope("feed_message", feed, F.timestamp_seconds("ts"))), root, feed)
    text = lambda lang, t: {"translation": [{"language": lang, "text": t}]}
    rows = []
    for i, (cause, header) in enumerate([("WEATHER", "Snow"), ("WEATHER", "Snow"), ("OTHER", "Road works on route 1"), ("WEATHER", "Snow")]):
        entity = {"id": "a1", "alert": {"cause": cause, "effect": "DETOUR", "severity_level": "INFO", "header_text": text("mi", header), "informed_entity": [{"route_id": "10"}, {"stop_id": "A", "trip": {"trip_id": "t1", "start_date": "20260923"}}]}}
        rows.append({"feed": "servicealerts", "fetched_at": f"2026-09-23T0{i}:00:00Z", "header_timestamp": 1000 + i, "entity_count": 1, "feed_message": {"entity": [entity]}, "date": "2026-09-23"})
    import json

    folder = tmp_path_factory.mktemp("alerts") / "servicealerts" / "date=2026-09-23"
    folder.mkdir(parents=True)
    (folder / "x.jsonl").write_text("".join(json.dumps({k: v for k, v in r.items() if k != "date"}) + "\n" for r in rows) + "not json\n")
    found = {f"bronze.{f}": files.read_polls(spark, root, f) for f in ("tripupdates", "vehiclepositions")}
    return found | {"bronze.servicealerts": files.read_polls(spark, str(folder.parent.parent), "servicealerts")}, root


@pytest.fixture(scope="module")
def tables(spark, static, polls, tmp_path_factory):
    folder = tmp_path_factory.mktemp("official")
    head = "week,route," + ",".join((*schemas.PUBLISHED_INTS, *schemas.PUBLISHED_DOUBLES)) + "\n"
    for to, k in (("2026-09-13", 1), ("2026-09-27", 90)):
        (folder / f"weekly-to-{to}.csv").write_text(head + f"2026-09-21,1,100,{k},100,40,50,0,n/a,0.9,0.9,0.9,1,0,0\n2026-09-14,2,1,0,0,0,0,0,1,0,0,0,0,0,0\n")
    published = files.published_performance(spark, str(folder), "week")
    inputs = {**polls[0], **{f"static.{n}": df for n, df in static.items()}, "official.weekly": published}
    as_of = F.lit("2026-09-30 00:00:00").cast("timestamp")
    return transit_plan(as_of).run(spark, inputs, str(tmp_path_factory.mktemp("plan")))


def test_services_follow_exceptions(spark, static):
    dates = spark.createDataFrame([(date(2026, 9, d),) for d in (24, 25, 26)], "service_date date")
    got = timetable.active_services(static["calendar"], static["calendar_dates"], dates).collect()
    assert sorted((str(r.service_date)[-2:], r.service_id) for r in got) == [("24", "SAT"), ("24", "WK"), ("26", "SAT")]


def test_routes_have_modes_and_labels(static):
    got = {r.route_id: (r.mode, r.mode_group, r.route_label) for r in timetable.route_dimension(static["routes"]).collect()}
    assert got == {"10": ("bus", "bus", "1 · City - Beach"), "20": ("rail", "rail", "Hutt Valley Line"), "30": ("other", "ferry & cable car", "X · Odd")}


def test_runs_are_reproducible_monotone_and_chained(spark, static):
    a = {(r.trip_id, r.service_date): r for r in simulated(spark, static).collect()}
    b = {(r.trip_id, r.service_date): r for r in simulated(spark, static).repartition(3).collect()}
    assert a == b and len(a) == 17
    for r in a.values():
        assert list(r.actual) == sorted(r.actual) and r.delays[0] >= runs.TIMEPOINT_FLOOR_S
    buses = sorted((r.actual[0], r.actual[-1], r.vehicle_id) for r in a.values() if r.mode == "bus" and r.service_date == DAYS[0])
    assert len({v for *_, v in buses}) < len(buses)
    last: dict = {}
    for start, end, v in buses:
        assert v not in last or start >= last[v] + runs.LAYOVER_S
        last[v] = end


def test_quantile_sampling_stays_in_range():
    got = runs.value_at([(0.0, -60), (0.5, 0), (1.0, 300)], runs.seeded("q").random(2000))
    assert -60 <= min(got) and max(got) <= 300 and abs(sum(got) / 2000 - 60) < 8


def test_entity_ids_are_name_based_uuids(spark):
    import uuid

    row = spark.createDataFrame([("t1", DAYS[0])], "trip_id string, service_date date").select(runs.entity_id().alias("e")).first()
    assert row.e == str(uuid.uuid5(uuid.NAMESPACE_URL, "t1/2026-09-23"))


def test_bad_lines_are_kept_apart(polls):
    rows = polls[0]["bronze.servicealerts"].cache()
    assert rows.where("_corrupt_record IS NOT NULL").count() == 1 and rows.where("date = '2026-09-23'").count() == 5


def test_arrivals_match_the_simulation(spark, static, tables):
    truth = {(r.trip_id, r.service_date, s): a for r in simulated(spark, static).collect() for s, a in zip(r.stop_sequences, r.actual, strict=True)}
    rows = tables["silver.stop_arrivals"].where("is_final").collect()
    assert len(rows) >= 40 and {r.route_label for r in rows} == {"1 · City - Beach", "Hutt Valley Line"}
    for r in rows:
        assert abs(r.arrival_at.timestamp() - truth[r.trip_id, r.service_date, r.stop_sequence]) <= 60 * 5
        assert (r.arrival_at - r.scheduled_arrival_at).total_seconds() == r.arrival_delay_s


def test_gold_reconciles_with_silver(tables):
    final = tables["silver.stop_arrivals"].where("is_final").count()
    hourly = tables["gold.route_ontime_hourly"]
    assert expectations.reconciled(tables["silver.stop_arrivals"].where("is_final"), hourly, "arrivals").first()["agrees"]
    assert hourly.where("early + on_time + late <> arrivals").count() == 0 and final > 0
    assert tables["gold.headways"].where("scheduled_headway_s NOT BETWEEN 1 AND 7200").count() == 0
    assert tables["gold.segment_runtimes"].count() > 0 and tables["gold.road_speeds"].count() > 0


def test_history_has_one_open_version_each(tables):
    h = tables["silver.trip_stop_delays"]
    keys = ["trip_id", "service_date", "stop_sequence"]
    assert h.where("__END_AT IS NULL").groupBy(*keys).count().where("count <> 1").count() == 0
    assert h.where("__END_AT <= __START_AT").count() == 0


def test_alert_versions_and_entities(tables):
    v = sorted((r["__START_AT"], r.header_text, r.last_seen_at.hour) for r in tables["silver.service_alerts"].collect())
    assert [x[1:] for x in v] == [("Snow", 1), ("Road works on route 1", 2), ("Snow", 3)]
    assert {(r.route_id, r.stop_id, r.trip_id) for r in tables["silver.service_alert_entities"].collect()} == {("10", None, None), (None, "A", "t1")}


def test_alerts_are_classified_once(spark, tables):
    now = F.lit("2026-09-30 00:00:00").cast("timestamp")
    assert set(alerts.CAUSE_WORDS) == set(alerts.CAUSES[:-1]) and set(alerts.IMPACT_WORDS) == set(alerts.IMPACTS[:-1])
    none = spark.createDataFrame([], "alert_id string, text_hash string")
    got = alerts.classify_new(tables["silver.service_alerts"], none, now)
    assert sorted((r.cause_category, r.impact_category) for r in got.collect()) == [("roadworks or construction", "information only"), ("weather", "information only")]
    assert alerts.classify_new(tables["silver.service_alerts"], got, now).count() == 0


def test_benchmark_uses_the_newest_release(tables):
    rows = {r.route_short_name: r for r in tables["gold.punctuality_benchmark"].collect()}
    assert set(rows) == {"1", "All routes"}
    assert rows["1"].comparison_basis == "same weeks" and rows["1"].official_same_period_punctuality == 0.9
    daily = tables["gold.route_punctuality_daily"].collect()
    assert all(r.scheduled_trips == 8 for r in daily) and len(daily) == 2


def test_features_examples_training_and_scoring(spark, static, tables):
    arrivals = tables["silver.stop_arrivals"]
    rows = arrival.with_route_features(arrival.examples(arrivals, one_in=1), tables["ml.route_delay_15min"])
    assert rows.where("stops_ahead NOT BETWEEN 1 AND 15").count() == 0
    model, metrics = arrival.train(rows, test_days=1, trees=2)
    assert metrics["test_rows"] > 0 and metrics["mae"] is not None
    seen = arrivals.where("is_final AND is_origin AND mode_group = 'bus'").orderBy("arrival_at").first()["arrival_at"]
    at = F.lit(seen)
    ahead = arrival.candidates(arrivals, timetable.stop_offsets(static["stop_times"]), at)
    scored = arrival.predictions(model, arrival.with_route_features(ahead, tables["ml.route_delay_15min"]), static["stops"], at).collect()
    assert scored and all((r.predicted_arrival_at - r.target_scheduled_at).total_seconds() == r.predicted_delay_s for r in scored)
    assert all(r.target_scheduled_at > seen - timedelta(minutes=15) and r.stops_ahead >= 1 for r in scored)


def test_promotion_needs_to_beat_both(spark):
    assert arrival.promoted({"mae": 5, "baseline_mae": 6}, None)
    assert not arrival.promoted({"mae": 6, "baseline_mae": 6}, None)
    assert not arrival.promoted({"mae": 5, "baseline_mae": 6}, {"mae": 4})


def test_expectations_count_drop_and_fail(spark):
    df = spark.createDataFrame([(1,), (None,), (-1,)], "x int")
    kept, seen = expectations.expected(df, [expectations.Expectation("pos", "x > 0"), expectations.Expectation("set", "x IS NOT NULL", "warn")])
    assert kept.count() == 1 and seen.get == {"rows": 3, "pos": 2, "set": 1}
    with pytest.raises(Exception, match="neg"):
        expectations.expected(df, [expectations.Expectation("neg", "x < 0", "fail")])[0].collect()


def test_failed_checks_are_logged_before_they_raise(spark, tmp_path):
    row = spark.range(1).withColumn("v", F.lit(0.5))
    made = expectations.result(F.lit("2026-01-01").cast("timestamp"), "c", "coverage", "s", row, "v", 0.9, F.lit(False), "d")
    with pytest.raises(expectations.ExpectationFailed, match="coverage"):
        expectations.log_results(made, str(tmp_path / "log"))
    assert spark.read.parquet(str(tmp_path / "log")).first()["status"] == "fail"


def test_release_links(spark):
    html = '<a href="/f/daily-to-2026.csv">a</a> <a href="https://x.org/weekly.csv">b</a> <a href="weekly.xlsx">c</a> <a href="other.csv">d</a>'
    got = files.release_links(spark.createDataFrame([(html,)], "html string"), "html", "https://y.org/p/index.html").collect()
    assert sorted(map(tuple, got)) == [("daily-to-2026.csv", "daily", "https://y.org/f/daily-to-2026.csv"), ("weekly.csv", "weekly", "https://x.org/weekly.csv")]


def test_calibration_describes_the_updates(spark, tables):
    routes = tables["silver.routes"].select("route_id", F.col("mode_group").alias("mode"))
    updates = tables["silver.trip_updates"].join(routes, "route_id")
    positions = tables["silver.vehicle_positions"].join(routes, "route_id")
    got = calibration.parameters(updates, tables["silver.stop_arrivals"].withColumn("mode", F.col("mode_group")), positions)
    assert {"bus", "rail"} <= set(got) and len(got["bus"]["initial"]) == 15 and got["bus"]["step_mean_s"] == 0.0


def test_vehicles_without_a_trip_are_not_in_service(spark, static):
    v = spark.createDataFrame([("v1", "10", "t1", 0), ("v2", None, None, 300), ("v3", "10", "t2", 5000)], "vehicle_id string, route_id string, trip_id string, s int")
    v = v.select("*", (F.lit("2026-01-01").cast("timestamp") - F.make_interval(secs=F.col("s"))).alias("position_at"))
    got = {r.vehicle_id: r.mode for r in feeds.latest_vehicles(v, timetable.route_dimension(static["routes"])).collect()}
    assert got == {"v1": "bus", "v2": "not in service"}


def test_current_filter(tables):
    assert history.current(tables["silver.service_alerts"]).count() == 1


def test_successions_equal_a_queue():
    """Against vehicles that wait in line, the one that has been ready longest in front."""
    import numpy as np

    rng = np.random.default_rng(7)
    for _ in range(60):
        n = int(rng.integers(1, 40))
        start = np.sort(rng.integers(0, 60, n))
        ready = start + rng.integers(1, 30, n)
        waiting, want = [], []
        for j in range(n):
            line = sorted((ready[i], i) for i in waiting if ready[i] <= start[j])
            want.append(line[0][1] if line else j)
            if line:
                waiting.remove(line[0][1])
            waiting.append(j)
        assert runs.successions(start, ready).tolist() == want
