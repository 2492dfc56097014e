"""What the operators of this subpackage share: inputs, written tables, ranks and connected components."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share, as the session names it. On one machine, where it is unset, it is a folder of
    the warehouse; on a cluster a session without it is refused."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        held = spark.sparkContext._jsc.sc().getCheckpointDir()
        named = held.get() if held.isDefined() else None
    if not named:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir is not set: name a folder that all executors share")
        named = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/tramline-checkpoints"
        spark.sparkContext.setCheckpointDir(named)
    return named


BATCH_ROWS, BATCH_BYTES = 1000, 4 << 20


def small_batches(df: DataFrame) -> DataFrame:
    """df, after bounding what a Python worker is sent at once, where the session has no bounds of its own: whole texts
    are long, and a worker holds a batch several times over."""
    conf = df.sparkSession.conf
    for key, value in (("maxRecordsPerBatch", BATCH_ROWS), ("maxBytesPerBatch", BATCH_BYTES)):
        if conf.get(f"spark.sql.execution.arrow.{key}", None) is None:
            conf.set(f"spark.sql.execution.arrow.{key}", str(value))
    return df


def written(df: DataFrame, name: str) -> DataFrame:
    """df as a Parquet table in the shared folder: cuts lineage, survives lost executors, and is computed once."""
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/tramline-{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._tramline_path = path
    return out


def drop_written(df: DataFrame) -> None:
    """Deletes the files of a table made by written() that nothing reads any more."""
    spark, path = df.sparkSession, df._tramline_path
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def unused(df: DataFrame, name: str) -> str:
    """A column name that df doesn't have (Spark matches names without regard to case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def ranked(df: DataFrame, key: Sequence[str], spread: Sequence[Column], order: Sequence[Column], into: str, parts: int = 1024) -> DataFrame:
    """Adds ``into``: gapless ranks from 0 within each key, without sorting a key in one task.

    Each key is split into ``parts`` buckets by a hash of ``spread``; rows are ranked in their bucket and moved up by the
    sizes of the buckets before. The table of sizes has at most keys x parts rows and is joined on (key, bucket), by which
    the rows are already dealt. ``parts`` bounds what one task sorts: rows of the largest key / parts. Rows that agree in
    ``spread`` and ``order`` are interchangeable.
    """
    part, size, before = (unused(df, n) for n in ("_part", "_size", "_before"))
    df = df.withColumn(part, F.pmod(F.xxhash64(*spread), F.lit(parts)))
    sizes = df.groupBy(*key, part).agg(F.count(F.lit(1)).alias(size))
    offsets = sizes.withColumn(
        before, F.sum(size).over(Window.partitionBy(*key).orderBy(part).rowsBetween(Window.unboundedPreceding, -1))
    ).select(*(F.col(k).alias(f"{part}{i}") for i, k in enumerate(key)), F.col(part).alias(f"{part}p"), F.coalesce(before, F.lit(0)).alias(before))
    placed = df.withColumn(into, F.row_number().over(Window.partitionBy(*key, part).orderBy(*order)).cast("long") - 1)
    on = [F.col(k).eqNullSafe(F.col(f"{part}{i}")) for i, k in enumerate(key)] + [F.col(part) == F.col(f"{part}p")]
    joined = placed.join(offsets, on)
    return joined.withColumn(into, F.col(into) + F.col(before)).drop(part, before, f"{part}p", *(f"{part}{i}" for i in range(len(key))))


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(id, component) for every id of edges (a, b); component is the smallest id that is reachable.

    Alternating large-star and small-star contraction over written tables: each round needs a few shuffles of the edges
    that are left, and a hub's edges are reduced by partial aggregation before they are shuffled. The least neighbours are
    written, so that the joins with them read two plain exchanges, of which Spark splits a hub's partition.
    """
    edges = edges.where("a <> b").select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).distinct()
    edges = written(edges, "edges")
    before = None
    for _ in range(rounds):
        both = edges.unionByName(edges.select(F.col("lo").alias("hi"), F.col("hi").alias("lo")))
        least = written(both.groupBy("hi").agg(F.min("lo").alias("m")).select("hi", F.least("hi", "m").alias("m")), "least")
        # Large star: every neighbour that is larger than a vertex links to the vertex's smallest neighbour.
        large = both.join(least, "hi").where("lo > hi").select(F.col("lo").alias("hi"), F.col("m").alias("lo")).where("hi <> lo").distinct()
        large = written(large, "large")
        # Small star: the smaller neighbours of a vertex link to the smallest of them.
        small_least = written(large.groupBy("hi").agg(F.min("lo").alias("m")), "least")
        small = large.join(small_least, "hi")
        new = small.select(F.col("lo").alias("hi"), F.col("m").alias("lo")).where("hi <> lo").unionByName(small_least.select("hi", F.col("m").alias("lo"))).distinct()
        new = written(new, "edges")
        state = new.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)")).alias("h")).first()
        for t in (edges, least, large, small_least):
            drop_written(t)
        edges = new
        if before == tuple(state):
            break
        before = tuple(state)
    else:
        raise RuntimeError(f"connected components did not settle in {rounds} rounds")
    return edges.select(F.col("hi").alias("id"), F.col("lo").alias("component")).unionByName(
        edges.select(F.col("lo").alias("id"), F.col("lo").alias("component")).distinct()
    )


def joined_labels(label, a, b):
    """label: a whole number for each item, equal where items are known to be connected; a, b: items that are linked.
    (low, high): pairs of labels that join all that the links connect, one pair fewer than the labels that they connect."""
    import numpy as np

    names, at = np.unique(label, return_inverse=True)
    parent = np.arange(len(names))
    a, b = at[a], at[b]
    while len(a):
        low, high = np.minimum(parent[a], parent[b]), np.maximum(parent[a], parent[b])
        some = low < high
        a, b, low, high = a[some], b[some], low[some], high[some]
        np.minimum.at(parent, high, low)
        while (parent[parent] != parent).any():
            parent = parent[parent]
    moved = np.flatnonzero(parent != np.arange(len(names)))
    return names[parent[moved]], names[moved]
