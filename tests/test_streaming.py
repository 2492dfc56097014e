from __future__ import annotations

import random

from tramline.operators import expectations, history
from tramline.streaming import flows

SCHEMA = "k string, s timestamp, v string, u int"


def batches(spark, folder, rows, n):
    random.Random(7).shuffle(rows)
    for i in range(n):
        spark.createDataFrame(rows[i::n], "k string, t int, v string, u int").selectExpr("k", "timestamp_seconds(t) as s", "v", "u").coalesce(1).write.mode("append").parquet(str(folder))
    return spark.read.schema(SCHEMA).parquet(str(folder)), spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(str(folder))


def test_streams_give_what_batches_give(spark, tmp_path):
    rng = random.Random(2)
    rows = [(f"k{rng.randint(0, 4)}", t, rng.choice(["x", "y", None]), t) for t in range(60)]
    batch, stream = batches(spark, tmp_path / "in", rows, 3)
    now = flows.Store(spark, str(tmp_path / "now"))
    flows.current_state(stream, now, str(tmp_path / "c1"), ["k"], ["s"]).awaitTermination()
    assert sorted(map(str, now.read().collect())) == sorted(map(str, history.latest(batch, ["k"], ["s"]).collect()))
    log, past = flows.Store(spark, str(tmp_path / "log")), flows.Store(spark, str(tmp_path / "past"))
    flows.version_history(stream, log, past, str(tmp_path / "c2"), ["k"], "s", ["v"]).awaitTermination()
    assert sorted(map(str, past.read().collect())) == sorted(map(str, history.versions(batch, ["k"], "s", ["v"]).collect()))
    assert len(now.batches()) == 2


def test_repeats_are_dropped_within_the_watermark(spark, tmp_path):
    rows = [("a", 100, "x", 1), ("a", 100, "x", 2), ("b", 200, "y", 3), (None, 5, "z", 4)]
    _, stream = batches(spark, tmp_path / "in", rows, 2)
    made = flows.cleaned(stream, [expectations.Expectation("has_key", "k IS NOT NULL")], ["k", "s"], "s")
    flows.append(made, str(tmp_path / "out"), str(tmp_path / "c")).awaitTermination()
    assert sorted((r.k, r.v) for r in spark.read.parquet(str(tmp_path / "out")).collect()) == [("a", "x"), ("b", "y")]
    flows.append(made, str(tmp_path / "out"), str(tmp_path / "c")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 2
