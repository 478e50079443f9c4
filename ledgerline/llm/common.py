"""Small helpers shared by the training-data operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.shared import cut, drop, drop_path, scratch_path, shared_dir, short_batches  # noqa: F401  used by the operators

#: What a remembered entry takes beside its text and value.
ENTRY_BYTES = 280


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/embeddings.parquet")


def own_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores before it until no column of ``df`` is called so (names differ in more than case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def bounded_broadcast(table: DataFrame, limit: int = 32 << 20, row_bytes: int = 64) -> DataFrame:
    """``table`` with a broadcast hint if ``table.count() * row_bytes`` is within ``limit``, else as it is (a shuffle join)."""
    return F.broadcast(table) if table.count() * row_bytes <= limit else table


class Memo(dict):
    """What a worker remembers, bounded by the bytes of keys and values; beyond them it starts afresh."""

    def __init__(self, most: int):
        super().__init__()
        self.most, self.size = most, 0

    def learn(self, keys: list, values: list, size: int) -> None:
        """Adds entries whose keys and values take about ``size`` bytes together."""
        self.update(zip(keys, values, strict=True))
        self.size += size + ENTRY_BYTES * len(keys)

    def room(self) -> None:
        """To be called between batches: forgets all once there is too much."""
        if self.size > self.most:
            self.clear()
            self.size = 0
