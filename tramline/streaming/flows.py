"""Streams into append-only tables, current state and versioned history."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.expectations import Expectation, expected
from ..operators.history import deduplicated, latest, versions

ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def append(stream: DataFrame, path: str, checkpoint: str, partition_by: Sequence[str] = ()) -> StreamingQuery:
    """Everything that has come, once, into a Parquet table; stops when it is done."""
    writer = stream.writeStream.format("parquet").option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return writer.start(path)


def cleaned(stream: DataFrame, rules: Sequence[Expectation], keys: Sequence[str], event_time: str, watermark: str = "30 minutes") -> DataFrame:
    """Repeats within the watermark dropped, then the rules applied."""
    return expected(deduplicated(stream, keys, event_time, watermark), rules)[0]


class Store:
    """A table of whole snapshots: each commit writes a new folder and a pointer to it, so a batch that is run again
    replaces its own folder, and readers see one snapshot or the next."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root
        self.fs = self._path("").getFileSystem(spark._jsc.hadoopConfiguration())

    def _path(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def batches(self) -> list[int]:
        if not self.fs.exists(self._path("")):
            return []
        done = [s.getPath() for s in self.fs.listStatus(self._path(""))]
        return sorted(int(p.getName()) for p in done if p.getName().isdigit() and self.fs.exists(self._path(f"{p.getName()}/_SUCCESS")))

    def read(self, before: int | None = None) -> DataFrame | None:
        found = [b for b in self.batches() if before is None or b < before]
        return self.spark.read.parquet(f"{self.root}/{found[-1]}") if found else None

    def commit(self, df: DataFrame, batch: int, keep: int = 2) -> None:
        df.write.mode("overwrite").parquet(f"{self.root}/{batch}")
        for old in self.batches()[:-keep]:
            self.fs.delete(self._path(str(old)), True)


def into(stream: DataFrame, checkpoint: str, each: Callable[[DataFrame, int], None]) -> StreamingQuery:
    return stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def current_state(stream: DataFrame, store: Store, checkpoint: str, keys: Sequence[str], sequence: Sequence[str]) -> StreamingQuery:
    """SCD type 1: each key's row with the greatest sequence, whatever the order of arrival."""

    def each(batch: DataFrame, number: int) -> None:
        held = store.read(number)
        rows = batch if held is None else held.unionByName(batch)
        store.commit(latest(rows, keys, sequence), number)

    return into(stream, checkpoint, each)


def version_history(stream: DataFrame, log: Store, store: Store, checkpoint: str, keys: Sequence[str], sequence: str, tracked: Sequence[str]) -> StreamingQuery:
    """SCD type 2. The log keeps the distinct rows that came; histories of the keys in a batch are made anew from it, and
    those of other keys are carried over, so late rows end up in their place."""

    def each(batch: DataFrame, number: int) -> None:
        held, old = log.read(number), store.read(number)
        rows = batch.distinct() if held is None else held.unionByName(batch).distinct()
        log.commit(rows, number)
        rows = log.read()
        touched = batch.select(*keys).distinct()
        on = [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in keys]
        fresh = versions(rows.alias("a").join(touched.alias("b"), on, "left_semi"), keys, sequence, tracked)
        if old is not None:
            fresh = old.alias("a").join(touched.alias("b"), on, "left_anti").unionByName(fresh)
        store.commit(fresh, number)

    return into(stream, checkpoint, each)
