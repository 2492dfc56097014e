"""A graph of datasets: names, what each is made from, and runs in order."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass, field
from graphlib import TopologicalSorter

from pyspark.sql import DataFrame, SparkSession

from ..operators.expectations import Expectation, expected


@dataclass(frozen=True)
class Dataset:
    name: str
    needs: tuple[str, ...]
    make: Callable[..., DataFrame]
    rules: tuple[Expectation, ...] = ()
    partition_by: tuple[str, ...] = ()


@dataclass
class Plan:
    """Datasets are functions of the DataFrames that they need. Tables are Parquet folders under root."""

    datasets: dict[str, Dataset] = field(default_factory=dict)
    #: Of each dataset with rules that was run: its rows and the failures of each rule.
    failures: dict[str, dict[str, int]] = field(default_factory=dict)

    def add(self, name: str, *needs: str, rules: Iterable[Expectation] = (), partition_by: Iterable[str] = ()):
        def register(make):
            self.datasets[name] = Dataset(name, needs, make, tuple(rules), tuple(partition_by))
            return make

        return register

    def order(self, wanted: Iterable[str] | None = None) -> list[str]:
        """The wanted datasets and all that they need, each after what it needs."""
        todo, graph = list(wanted or self.datasets), {}
        while todo:
            name = todo.pop()
            if name in self.datasets and name not in graph:
                graph[name] = set(self.datasets[name].needs) & self.datasets.keys()
                todo += graph[name]
        return list(TopologicalSorter(graph).static_order())

    def run(self, spark: SparkSession, inputs: dict[str, DataFrame], root: str, wanted: Iterable[str] | None = None) -> dict[str, DataFrame]:
        """Writes each dataset (whole, or the partitions that it has rows of) and returns the tables."""
        tables = dict(inputs)
        for name in self.order(wanted):
            d = self.datasets[name]
            df, seen = d.make(*(tables[n] for n in d.needs)), None
            if d.rules:
                df, seen = expected(df, d.rules)
            path = f"{root}/{name.replace('.', '/')}"
            writer = df.write.mode("overwrite")
            if d.partition_by:
                writer = writer.option("partitionOverwriteMode", "dynamic").partitionBy(*d.partition_by)
            writer.parquet(path)
            if seen is not None:
                self.failures[name] = dict(seen.get)
            tables[name] = spark.read.parquet(path)
        return tables
