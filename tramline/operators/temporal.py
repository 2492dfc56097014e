"""Point-in-time joins, tumbling features, and pairs along a sequence."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def as_of_join(left: DataFrame, right: DataFrame, keys: Sequence[str], left_time: str, right_time: str, values: Sequence[str]) -> DataFrame:
    """left with the values of the latest right row of its keys with right_time <= left_time; null where there is none.

    Both sides are dealt by the keys once and swept in time order, so a key costs a sort and not a product of its rows.
    Rows on the right with equal keys and times are reduced to one first.
    """
    one = right.groupBy(*keys, right_time).agg(F.max(F.struct(*values)).alias("_v"))
    lean = one.select(*keys, F.col(right_time).alias("_at"), F.lit(0).alias("_side"), F.lit(None).cast(left.select(F.struct(*left.columns).alias("s")).schema["s"].dataType).alias("_row"), "_v")
    wide = left.select(*keys, F.col(left_time).alias("_at"), F.lit(1).alias("_side"), F.struct(*left.columns).alias("_row"), F.lit(None).cast(one.schema["_v"].dataType).alias("_v"))
    sweep = Window.partitionBy(*keys).orderBy("_at", "_side").rowsBetween(Window.unboundedPreceding, 0)
    swept = lean.unionByName(wide).withColumn("_found", F.last("_v", ignorenulls=True).over(sweep)).where("_side = 1")
    return swept.select("_row.*", *(F.col(f"_found.{v}").alias(v) for v in values))


def pairs_ahead(df: DataFrame, keys: Sequence[str], sequence: str, most: int, left: dict[str, str], right: dict[str, str], step: str = "steps_ahead") -> DataFrame:
    """Pairs of rows of a key, the second 1 to ``most`` further along the sequence (a band self-join).

    left and right map columns to their names in the result. The band is cut into buckets of its own width, so a row meets
    its own bucket and the next, and not all rows of its key.
    """
    bucket = F.floor(F.col(sequence) / most)
    a = df.select(*keys, F.col(sequence).alias("_s"), *(F.col(c).alias(n) for c, n in left.items()), F.explode(F.array(bucket, bucket + 1)).alias("_b"))
    b = df.select(*keys, F.col(sequence).alias("_t"), *(F.col(c).alias(n) for c, n in right.items()), bucket.alias("_b"))
    met = a.join(b, [*keys, "_b"]).where((F.col("_t") > F.col("_s")) & (F.col("_t") - F.col("_s") <= most))
    return met.withColumn(step, (F.col("_t") - F.col("_s")).cast("int")).drop("_b", "_s", "_t")


def tumbling(df: DataFrame, keys: Sequence[str], at: str, width: str, aggregates, into: str = "window_end") -> DataFrame:
    """Aggregates of each key and window, named by the window's end. On a stream the caller sets the watermark."""
    grouped = df.groupBy(*keys, F.window(at, width).alias("_w")).agg(*aggregates)
    return grouped.withColumn(into, F.col("_w.end")).drop("_w")


def hashed_sample(df: DataFrame, columns: Sequence[str], one_in: int) -> DataFrame:
    """One in so many rows, by a hash of columns: the same rows on every run."""
    return df.where(F.pmod(F.xxhash64(*columns), F.lit(one_in)) == 0)


def split_by_date(df: DataFrame, day: str, test_days: int) -> tuple[DataFrame, DataFrame]:
    """Rows before the last test_days dates, and rows of these dates. The cut is one row made of the distinct dates."""
    last = df.select(day).distinct().orderBy(F.desc(day)).limit(test_days)
    cut = F.broadcast(last.agg(F.min(day).alias("_cut")))
    both = df.crossJoin(cut)
    return both.where(F.col(day) < F.col("_cut")).drop("_cut"), both.where(F.col(day) >= F.col("_cut")).drop("_cut")
