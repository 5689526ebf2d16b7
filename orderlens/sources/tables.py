"""A1: base-table scans. Parquet keeps filters and column pruning at the scan."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

DRIVER_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels",
    "conversations",
)


def read_table(spark: SparkSession, base_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{base_dir.rstrip('/')}/{name}.parquet")


class Tables:
    """Lazy accessor: ``t.orders`` reads ``<dir>/orders.parquet`` on first use."""

    def __init__(self, spark: SparkSession, base_dir: str):
        self._spark = spark
        self._dir = base_dir
        self._cache: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        if name not in self._cache:
            self._cache[name] = read_table(self._spark, self._dir, name)
        return self._cache[name]

    def __getitem__(self, name: str) -> DataFrame:
        return getattr(self, name)


def load_tables(spark: SparkSession, base_dir: str,
                names: tuple[str, ...] | list[str] | None = None) -> dict[str, DataFrame]:
    return {n: read_table(spark, base_dir, n) for n in (names or DRIVER_TABLES)}
