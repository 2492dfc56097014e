"""Polls as JSON Lines, timetables and published figures as CSV, and the links by which these are found."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.history import top_releases
from .schemas import PUBLISHED_DOUBLES, PUBLISHED_INTS, poll_schema

LINKS = r'href\s*=\s*["\']([^"\']+\.csv)["\']'


def with_lineage(df: DataFrame) -> DataFrame:
    return df.withColumns({"_source_file": F.col("_metadata.file_path"), "_ingested_at": F.current_timestamp()})


def read_polls(spark: SparkSession, root: str, feed: str) -> DataFrame:
    """All polls of a feed, plain or gzipped; date comes from the folder."""
    return with_lineage(spark.read.schema(poll_schema(feed)).option("mode", "PERMISSIVE").json(f"{root}/{feed}"))


def stream_polls(spark: SparkSession, root: str, feed: str, files_per_trigger: int = 1000) -> DataFrame:
    """The same as a stream, each file once by the query's checkpoint."""
    reader = spark.readStream.schema(poll_schema(feed)).option("maxFilesPerTrigger", files_per_trigger)
    return with_lineage(reader.option("mode", "PERMISSIVE").json(f"{root}/{feed}"))


def poll_envelope(message: str, feed: str, fetched_at: Column) -> list[Column]:
    """Columns of a poll made from a parsed message."""
    return [
        F.lit(feed).alias("feed"), F.date_format(fetched_at, "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("fetched_at"),
        F.col(f"{message}.header.timestamp").try_cast("bigint").alias("header_timestamp"), F.coalesce(F.size(f"{message}.entity"), F.lit(0)).alias("entity_count"),
        F.col(message).alias("feed_message"), F.to_date(fetched_at).alias("date"),
    ]


def write_polls(polls: DataFrame, root: str, feed: str) -> None:
    """Gzipped JSON Lines under date folders; Spark's commit makes files appear whole."""
    columns = [c for c in polls.columns if not c.startswith("_")]
    polls.select(*columns).write.mode("append").partitionBy("date").option("compression", "gzip").json(f"{root}/{feed}")


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A CSV file with a header, every column text. A byte order mark is dropped by the reader."""
    return spark.read.option("header", True).option("inferSchema", False).csv(path)


def load_timetable(spark: SparkSession, root: str, out: str, names, force: bool = False) -> str | None:
    """Writes each file of the newest version folder under root as a Parquet snapshot with lineage. Returns the version, or
    None if it is the one that is there already."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(root)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    version = max(s.getPath().getName() for s in fs.listStatus(folder) if s.isDirectory())
    held = f"{out}/{names[0]}"
    if not force and fs.exists(spark._jvm.org.apache.hadoop.fs.Path(f"{held}/_SUCCESS")):
        if spark.read.parquet(held).agg(F.max("_feed_version")).first()[0] == version:
            return None
    for name in [*names[1:], names[0]]:  # the first tells what is loaded, so it comes last
        df = with_lineage(read_table(spark, f"{root}/{version}/{name}.txt")).withColumn("_feed_version", F.lit(version))
        df.write.mode("overwrite").parquet(f"{out}/{name}")
    return version


def published_performance(spark: SparkSession, path: str, period: str) -> DataFrame:
    """Published figures by route and period (day or week) of the newest release; cells that are no number are null."""
    rows = spark.read.option("header", True).csv(path).withColumn("_file", F.col("_metadata.file_path"))
    return top_releases(rows, "_file").select(
        F.to_date(period).alias(period), F.col("route").alias("route_short_name"), *(F.col(c).try_cast("int").alias(c) for c in PUBLISHED_INTS),
        *(F.col(c).try_cast("double").alias(c) for c in PUBLISHED_DOUBLES), F.regexp_extract("_file", r"to-(\d{4}-\d{2}-\d{2})", 1).alias("published_to"),
    )


def release_links(pages: DataFrame, html: str, base: str) -> DataFrame:
    """name, kind (daily or weekly) and absolute url of the CSV links of pages; other links are left out."""
    link = F.explode(F.regexp_extract_all(F.col(html), F.lit(LINKS), F.lit(1))).alias("href")
    name = F.element_at(F.split("href", "/"), -1)
    kind = F.when(F.lower(name).contains("daily"), "daily").when(F.lower(name).contains("weekly"), "weekly")
    host = F.regexp_extract(F.lit(base), r"^(https?://[^/]+)", 1)
    url = F.when(F.col("href").rlike("^https?://"), F.col("href")).when(F.col("href").startswith("/"), F.concat(host, "href")).otherwise(F.concat(F.regexp_replace(F.lit(base), "[^/]*$", ""), F.col("href")))
    return pages.select(link).select(name.alias("name"), kind.alias("kind"), url.alias("url")).where("kind IS NOT NULL").distinct()
