"""Row constraints with counts, and the checks that run after an update."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


class ExpectationFailed(Exception):
    pass


@dataclass(frozen=True)
class Expectation:
    """A predicate in SQL. Rows that fail it are dropped, kept (warn) or an error (fail). Null is a failure."""

    name: str
    predicate: str
    action: str = "drop"

    @property
    def holds(self) -> Column:
        return F.coalesce(F.expr(self.predicate), F.lit(False))


def expected(df: DataFrame, rules: Sequence[Expectation], dataset: str | None = None) -> tuple[DataFrame, Observation | None]:
    """The rows that pass, and an observation that counts failures (<name>, and rows) while they are computed."""
    observation = None
    counts = [F.count_if(~r.holds).alias(r.name) for r in rules]
    if df.isStreaming:
        df = df.observe(dataset or "expectations", F.count(F.lit(1)).alias("rows"), *counts)
    else:
        observation = Observation(dataset) if dataset else Observation()
        df = df.observe(observation, F.count(F.lit(1)).alias("rows"), *counts)
    for r in rules:
        if r.action == "drop":
            df = df.where(r.holds)
        elif r.action == "fail":
            df = df.where(F.when(r.holds, True).otherwise(F.raise_error(F.lit(f"{r.name}: {r.predicate}")).cast("boolean")))
    return df, observation


def drop_rates(df: DataFrame, rules: Sequence[Expectation], dataset: str) -> DataFrame:
    """dataset, name, passed, failed and the failed share of each rule, in one pass."""
    counted = df.agg(F.count(F.lit(1)).alias("_n"), *(F.count_if(r.holds).alias(r.name) for r in rules))
    each = F.explode(F.array(*(F.struct(F.lit(r.name).alias("name"), F.col(r.name).alias("passed")) for r in rules)))
    rows = counted.select("_n", each.alias("_e")).select(F.lit(dataset).alias("dataset"), "_e.name", "_e.passed", (F.col("_n") - F.col("_e.passed")).alias("failed"))
    total = F.col("passed") + F.col("failed")
    return rows.withColumn("rate", F.coalesce(F.when(total > 0, F.col("failed") / total), F.lit(0.0)))


def freshness(polls: DataFrame, now: Column, at: str = "fetched_at", slot_s: int = 300) -> DataFrame:
    """One row: minutes since the newest poll, and the share of slots of the last day (or of the shorter history) that
    have one."""
    since = F.greatest(F.min(at), now - F.expr("INTERVAL 24 HOURS"))
    slot = F.when(F.col(at) >= now - F.expr("INTERVAL 24 HOURS"), F.floor(F.timestamp_diff("SECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), F.col(at)) / slot_s))
    row = polls.agg(
        (F.timestamp_diff("SECOND", F.max(at), now) / 60).alias("age_min"),
        F.count_distinct(slot).alias("slots"),
        F.greatest(F.floor(F.timestamp_diff("SECOND", since, now) / slot_s), F.lit(1)).alias("expected_slots"),
    )
    return row.withColumn("coverage", F.least(F.col("slots") / F.col("expected_slots"), F.lit(1.0)))


def reconciled(detail: DataFrame, summary: DataFrame, counted: str) -> DataFrame:
    """One row: rows of the detail, the sum that a summary has of them, and whether they agree."""
    both = detail.agg(F.count(F.lit(1)).alias("detail_rows")).crossJoin(summary.agg(F.coalesce(F.sum(counted), F.lit(0)).alias("summary_rows")))
    return both.withColumn("agrees", F.col("detail_rows") == F.col("summary_rows"))


def join_coverage(df: DataFrame, columns: Sequence[str], least: float = 0.99) -> DataFrame:
    """One row: the share of rows whose joined columns are all present. An empty table passes."""
    full = F.lit(True)
    for c in columns:
        full = full & F.col(c).isNotNull()
    share = df.agg((F.count_if(full) / F.nullif(F.count(F.lit(1)), F.lit(0))).alias("coverage"))
    return share.withColumn("passes", F.coalesce(F.col("coverage") >= least, F.lit(True)))


def days_of_timetable(calendar: DataFrame, today: Column, least: int = 3) -> DataFrame:
    left = F.datediff(F.max(F.to_date("end_date", "yyyyMMdd")), today)
    return calendar.agg(left.alias("days_ahead")).withColumn("passes", F.coalesce(F.col("days_ahead") >= least, F.lit(False)))


RESULT = "run_at timestamp, catalog string, check string, subject string, status string, value double, threshold double, detail string"


def result(run_at: Column, catalog: str, check: str, subject: str, row: DataFrame, value: str, threshold: float | None, passes: Column, detail: str) -> DataFrame:
    """A check's row in the form of the results log."""
    status = F.when(F.coalesce(passes, F.lit(False)), "pass").otherwise("fail")
    return row.select(
        run_at.alias("run_at"), F.lit(catalog).alias("catalog"), F.lit(check).alias("check"), F.lit(subject).alias("subject"),
        status.alias("status"), F.col(value).cast("double").alias("value"), F.lit(threshold).cast("double").alias("threshold"), F.lit(detail).alias("detail"),
    )


def log_results(results: DataFrame, path: str) -> None:
    """Appends the results, and raises afterwards if any check failed."""
    results = results.cache()
    results.write.mode("append").parquet(path)
    failed = [f"{r['check']}[{r['subject']}]={r['value']} (threshold {r['threshold']})" for r in results.where("status = 'fail'").collect()]
    results.unpersist()
    if failed:
        raise ExpectationFailed(f"{len(failed)} checks failed: {'; '.join(failed)}")
