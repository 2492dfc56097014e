"""Duplicates, current state, versioned history and keyed writes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def deduplicated(df: DataFrame, keys: Sequence[str], event_time: str | None = None, watermark: str = "30 minutes") -> DataFrame:
    """One row for each key. Streams drop repeats within the watermark of event_time, so their state stays bounded."""
    if df.isStreaming:
        return df.withWatermark(event_time, watermark).dropDuplicatesWithinWatermark(list(keys))
    return df.dropDuplicates(list(keys))


def latest(df: DataFrame, keys: Sequence[str], sequence: Sequence[str]) -> DataFrame:
    """SCD type 1: each key's row with the greatest sequence. One shuffle with partial aggregation; whole rows compare, so
    ties have one outcome whatever the input's order."""
    rest = [c for c in df.columns if c not in keys and c not in sequence]
    best = df.groupBy(*keys).agg(F.max(F.struct(*sequence, *rest)).alias("_row"))
    return best.select(*keys, *(F.col(f"_row.{c}").alias(c) for c in (*sequence, *rest))).select(*df.columns)


def versions(df: DataFrame, keys: Sequence[str], sequence: str, tracked: Sequence[str], start: str = "__START_AT", end: str = "__END_AT") -> DataFrame:
    """SCD type 2: a row for each run of rows of a key with equal tracked columns.

    start is the run's first sequence, end the next run's start or null. Other columns have the values of the run's last
    row. Nulls are equal to nulls, the input's order doesn't matter, and rows of one key and sequence are ordered by their
    tracked values. One shuffle on the keys serves all windows and the aggregation.
    """
    rest = [c for c in df.columns if c not in keys and c not in tracked and c != sequence]
    in_order = Window.partitionBy(*keys).orderBy(sequence, *tracked)
    state = F.struct(*tracked)
    changed = ~state.eqNullSafe(F.lag(state).over(in_order)) | (F.row_number().over(in_order) == 1)
    runs = df.withColumn("_new", changed.cast("int"))
    runs = runs.withColumn("_run", F.sum("_new").over(in_order.rowsBetween(Window.unboundedPreceding, 0)))
    folded = runs.groupBy(*keys, "_run").agg(
        F.min(sequence).alias(start), *(F.first(c).alias(c) for c in tracked), F.max(F.struct(sequence, *rest)).alias("_last")
    )
    next_start = F.lead(start).over(Window.partitionBy(*keys).orderBy("_run"))
    closed = folded.withColumn(end, next_start)
    return closed.select(*keys, *tracked, *(F.col(f"_last.{c}").alias(c) for c in rest), start, end)


def current(history: DataFrame, end: str = "__END_AT") -> DataFrame:
    return history.where(F.col(end).isNull())


def only_new(df: DataFrame, existing: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows to append: one for each key that the existing table lacks (insert-only merge)."""
    fresh = df.join(existing.select(*keys).distinct(), list(keys), "left_anti")
    return latest(fresh, keys, [c for c in df.columns if c not in keys])


def upserted(existing: DataFrame, df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The existing table with df's rows in place of those with equal keys (keyed merge). Null keys are equal to nulls; of
    several new rows of a key the greatest counts."""
    fresh = latest(df, keys, [c for c in df.columns if c not in keys])
    named = fresh.select(*(F.col(k).alias(f"_new_{k}") for k in keys))
    same = [existing[k].eqNullSafe(named[f"_new_{k}"]) for k in keys]
    return existing.join(named, same, "left_anti").unionByName(fresh)


def changes(before: DataFrame, after: DataFrame, keys: Sequence[str], into: str = "_change") -> DataFrame:
    """Change feed between two snapshots with unique keys: inserted and updated rows as after, deleted ones as before."""
    rest = [c for c in after.columns if c not in keys]
    a = before.select(*keys, F.struct(*rest).alias("_a"))
    b = after.select(*keys, F.struct(*rest).alias("_b"))
    both = a.join(b, list(keys), "full_outer").where(~F.col("_a").eqNullSafe(F.col("_b")))
    kind = F.when(F.col("_a").isNull(), "insert").when(F.col("_b").isNull(), "delete").otherwise("update")
    row = F.coalesce("_b", "_a")
    return both.select(*keys, row.alias("_row"), kind.alias(into)).select(*keys, *(F.col(f"_row.{c}").alias(c) for c in rest), into)


def without_unchanged(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str) -> DataFrame:
    """Without the rows whose value equals that of the row before (a poll of a feed that hasn't moved on)."""
    before = F.lag(value).over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_before", before).where(F.col("_before").isNull() | (F.col("_before") != F.col(value))).drop("_before")


def within_latest(df: DataFrame, at: str, interval: str, into: str) -> DataFrame:
    """Rows at most an interval before the newest, with that as a column: one aggregate row is joined, no row is moved."""
    newest = df.agg(F.max(at).alias(into))
    return df.crossJoin(F.broadcast(newest)).where(F.col(at) >= F.col(into) - F.expr(f"INTERVAL {interval}"))


def top_releases(df: DataFrame, version: str) -> DataFrame:
    """Rows of the greatest version."""
    newest = df.agg(F.max(version).alias("_newest"))
    return df.crossJoin(F.broadcast(newest)).where(F.col(version) == F.col("_newest")).drop("_newest")


def last_by(value: str, order: str) -> Column:
    """The value on the row with the greatest order, null included."""
    return F.max_by(value, order).alias(value)
