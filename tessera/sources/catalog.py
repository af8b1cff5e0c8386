"""Source registry (S7, S11): logical table name → lazily read DataFrame.

Reads are plain ``spark.read.parquet``; Catalyst prunes the columns and
pushes the filters of whatever query is built on top into the scan.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession

BASE_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


class Sources:
    """Map of logical names to readers.

    ``Sources.parquet_dir(spark, root)`` registers one parquet file per base
    table; further entries (views, derived tables, catalog tables) are added
    with ``register``.  Attribute and item access both return a DataFrame.
    """

    def __init__(self, spark: SparkSession, readers: Mapping[str, Callable[[], DataFrame]] | None = None):
        self.spark = spark
        self._readers: dict[str, Callable[[], DataFrame]] = dict(readers or {})
        self._cache: dict[str, DataFrame] = {}

    @classmethod
    def parquet_dir(cls, spark: SparkSession, root: str, names=BASE_TABLES) -> "Sources":
        src = cls(spark)
        for n in names:
            src.register(n, lambda n=n: spark.read.parquet(os.path.join(root, f"{n}.parquet")))
        src.root = root
        return src

    @classmethod
    def catalog(cls, spark: SparkSession, mapping: Mapping[str, str]) -> "Sources":
        """Logical name → catalog table name (``spark.table``)."""
        src = cls(spark)
        for logical, physical in mapping.items():
            src.register(logical, lambda p=physical: spark.table(p))
        return src

    def register(self, name: str, reader: Callable[[], DataFrame] | DataFrame) -> "Sources":
        if isinstance(reader, DataFrame):
            df = reader
            reader = lambda: df
        self._readers[name] = reader
        self._cache.pop(name, None)
        return self

    def names(self) -> list[str]:
        return sorted(self._readers)

    def __contains__(self, name: str) -> bool:
        return name in self._readers

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._cache:
            if name not in self._readers:
                raise KeyError(f"unknown source {name!r}; known: {self.names()}")
            self._cache[name] = self._readers[name]()
        return self._cache[name]

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        try:
            return self[name]
        except KeyError as e:
            raise AttributeError(str(e)) from None


def table(spark: SparkSession, name: str) -> DataFrame:
    """Whole-table scan of a catalog table or a parquet path."""
    if "/" in name or name.endswith(".parquet"):
        return spark.read.parquet(name)
    return spark.table(name)
