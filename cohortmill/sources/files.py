"""Parquet files as a source of operational tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import TableConfig


def zoned(df: DataFrame) -> DataFrame:
    """Zone-less timestamps as instants of the session zone (UTC).

    Done once, at the boundary: ``unix_micros`` rejects zone-less values, and the warehouse
    copy gets statistics that later scans can prune on.
    """
    casts = {
        f.name: F.col(f.name).cast("timestamp")
        for f in df.schema
        if isinstance(f.dataType, T.TimestampNTZType)
    }
    return df.withColumns(casts) if casts else df


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@dataclass(frozen=True)
class FileSource:
    """Tables as ``<folder>/<name>.parquet``; ``views`` replaces a table by an expression."""

    spark: SparkSession
    folder: str
    views: dict[str, Callable[[], DataFrame]] = field(default_factory=dict)

    def table(self, cfg: TableConfig, after: datetime | None = None) -> DataFrame:
        view = self.views.get(cfg.name)
        return zoned(view() if view else read_table(self.spark, self.folder, cfg.name))
