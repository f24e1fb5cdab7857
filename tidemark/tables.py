"""Read access to the parquet tables of one directory."""

from __future__ import annotations

from collections.abc import Iterator, Mapping

from pyspark.sql import DataFrame, SparkSession

NAMES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


class Tables(Mapping):
    """``tables["orders"]`` is a lazy parquet scan; any mapping of DataFrames may stand in for it."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")

    def __getitem__(self, name: str) -> DataFrame:
        if name not in NAMES:
            raise KeyError(name)
        return self.spark.read.parquet(f"{self.path}/{name}.parquet")

    def __iter__(self) -> Iterator[str]:
        return iter(NAMES)

    def __len__(self) -> int:
        return len(NAMES)
