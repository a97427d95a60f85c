"""Table scan by name (SRC-1).

``Tables`` maps a logical name to a DataFrame. Paths and catalog names stay
here; operators only ever see DataFrames.
"""

from __future__ import annotations

import os
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession

TEST_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
               "events", "documents", "embeddings", "pages", "benchmark", "labels",
               "conversations")


class Tables(Mapping):
    """Lazy name → DataFrame mapping over a folder of ``<name>.parquet``."""

    def __init__(self, spark: SparkSession, root: str, layer_prefix: str = ""):
        self.spark = spark
        self.root = root
        self.prefix = layer_prefix
        self._cache: dict[str, DataFrame] = {}

    def path(self, name: str) -> str:
        return os.path.join(self.root, f"{self.prefix}{name}.parquet")

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._cache:
            self._cache[name] = self.spark.read.parquet(self.path(name))
        return self._cache[name]

    def __iter__(self):
        return iter(n for n in TEST_TABLES if os.path.exists(self.path(n)))

    def __len__(self) -> int:
        return sum(1 for _ in self)

    def register(self, names: Iterable[str] | None = None) -> None:
        """Expose tables as temp views for SQL callers."""
        for n in names or list(self):
            self[n].createOrReplaceTempView(n)


def layered_name(layer: str, schema: str, table: str) -> str:
    """``silver_<schema>_<table>`` style flat name of a layered table."""
    return f"{layer}_{schema}_{table}"
