"""A relational database as a source, read in parallel with a bounded memory footprint.

Each partition is one query with its own cursor; ``fetchsize`` rows travel per round trip, so
neither the driver nor a task ever holds a whole table. Column pruning and the incremental
filter reach the database, because both stay ordinary DataFrame operations on the scan.

Without a range or slices given by hand, the keys of the rows to be read are asked for first
(one row of ``min`` and ``max``), so that an increment is spread over all strides too. Tables whose
keys are unevenly spread, are text, or are missing are named in ``uneven``: the database is asked
for quantiles of the key, or of the column by which the table grows, and text is dealt by hash.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import TableConfig
from .files import zoned


@dataclass(frozen=True)
class KeyRange:
    """Numeric key range split into equal strides."""

    low: int
    high: int
    partitions: int


@dataclass(frozen=True)
class JdbcSource:
    spark: SparkSession
    url: str
    properties: dict[str, str] = field(default_factory=dict)
    ranges: dict[str, KeyRange] = field(default_factory=dict)
    predicates: dict[str, list[str]] = field(default_factory=dict)
    partitions: int = 32
    uneven: frozenset[str] = frozenset()
    hash_sql: str = "CRC32({column})"  # a whole number of 0 or more for a text, in the words of the database

    def _cursor(self) -> dict[str, str]:
        """What makes the driver honour the fetch size. Connector/J buffers a whole result without it."""
        mysql = self.url.startswith(("jdbc:mysql:", "jdbc:mariadb:"))
        return {"useCursorFetch": "true"} if mysql else {}

    def _reader(self, cfg: TableConfig) -> dict[str, str]:
        return {
            "url": self.url,
            "fetchsize": str(cfg.fetch_size),
            "pushDownPredicate": "true",
            **self._cursor(),
            **self.properties,
        }

    def bounds_query(self, cfg: TableConfig, after: datetime | None) -> str:
        """The least and greatest key of the rows later than ``after``."""
        later = "" if after is None else f" WHERE {cfg.incremental_col} > '{after:%Y-%m-%d %H:%M:%S.%f}'"
        return f"SELECT MIN({cfg.pk}) AS low, MAX({cfg.pk}) AS high FROM {cfg.name}{later}"

    def _span(self, cfg: TableConfig, after: datetime | None) -> KeyRange | None:
        """Key range of the rows to read; none for tables without a key, without rows, or whose
        keys are no whole numbers."""
        if cfg.name in self.ranges or not cfg.pk:
            return self.ranges.get(cfg.name)
        found = self.spark.read.format("jdbc").options(
            **self._reader(cfg), query=self.bounds_query(cfg, after)).load()
        return key_range(found, self.partitions)

    def quantile_query(self, cfg: TableConfig, column: str, after: datetime | None) -> str:
        """Where slices of equal row counts begin, but the first: at most one row less than there are slices."""
        later = "" if after is None else f" AND {cfg.incremental_col} > '{after:%Y-%m-%d %H:%M:%S.%f}'"
        tiles = (f"SELECT {column} AS edge, NTILE({self.partitions}) OVER (ORDER BY {column}) AS tile"
                 f" FROM {cfg.name} WHERE {column} IS NOT NULL{later}")
        return f"SELECT MIN(edge) AS edge FROM ({tiles}) tiles WHERE tile > 1 GROUP BY tile"

    def slices(self, cfg: TableConfig, after: datetime | None = None) -> list[str]:
        """Predicates of an uneven table: every row meets exactly one of them."""
        column = cfg.pk or cfg.incremental_col
        if not column:
            return ["1 = 1"]
        found = self.spark.read.format("jdbc").options(
            **self._reader(cfg), preferTimestampNTZ="true", query=self.quantile_query(cfg, column, after)).load()
        return slices_of(column, found, self.partitions, self.hash_sql)

    def options(self, cfg: TableConfig, span: KeyRange | None = None) -> dict[str, str]:
        """Reader options of one table; a key range makes the read parallel."""
        options = {"dbtable": cfg.name, **self._reader(cfg)}
        span = span or self.ranges.get(cfg.name)
        if span and cfg.pk:
            options |= {
                "partitionColumn": cfg.pk,
                "lowerBound": str(span.low),
                "upperBound": str(span.high),
                "numPartitions": str(span.partitions),
            }
        return options

    def table(self, cfg: TableConfig, after: datetime | None = None) -> DataFrame:
        """The table; ``after`` tells which rows will be kept, to spread just those evenly."""
        slices = self.predicates.get(cfg.name) or (self.slices(cfg, after) if cfg.name in self.uneven else None)
        if slices:
            properties = {**self._cursor(), **self.properties, "fetchsize": str(cfg.fetch_size)}
            return zoned(self.spark.read.jdbc(self.url, cfg.name, predicates=slices, properties=properties))
        span = self._span(cfg, after)
        return zoned(self.spark.read.format("jdbc").options(**self.options(cfg, span)).load())


def key_range(found: DataFrame, partitions: int) -> KeyRange | None:
    """One row of ``low`` and ``high`` as a range; the strides' upper end is exclusive."""
    whole = all(isinstance(f.dataType, T.IntegralType) or
                isinstance(f.dataType, T.DecimalType) and f.dataType.scale == 0 for f in found.schema)
    row = found.first() if whole else None
    return None if row is None or row[0] is None else KeyRange(int(row[0]), int(row[1]) + 1, partitions)


def slices_of(column: str, edges: DataFrame, parts: int, hash_sql: str) -> list[str]:
    """Slices between the ``edge`` values found, whatever their type; text is dealt by its hash.

    A value that fills several slices is one edge: rows of one value stay together. Values travel
    as text, since Python would shift times to the zone of the host.
    """
    kind = edges.schema["edge"].dataType
    if isinstance(kind, T.StringType):
        return hash_slices(hash_sql.format(column=column), column, parts)
    rows = edges.select("edge").distinct().orderBy("edge").select(F.col("edge").cast("string")).collect()  # ``parts`` - 1 at most
    quote = "" if isinstance(kind, T.NumericType) else "'"
    return _between(column, [f"{quote}{row[0]}{quote}" for row in rows])


def hash_slices(number: str, column: str, parts: int) -> list[str]:
    """One predicate per remainder of a hash; NULLs, which have none, are in the first."""
    return [f"MOD({number}, {parts}) = {i}" + (f" OR {column} IS NULL" if i == 0 else "") for i in range(parts)]


def time_slices(column: str, edges: Iterable[datetime]) -> list[str]:
    """One predicate per slice between ascending edges, plus the open ends and NULLs.

    For tables without a numeric key, or whose keys are too unevenly spread for strides: the
    caller picks the edges so that a busy day is cut finer than a quiet one. Together the
    slices cover every row exactly once.
    """
    return _between(column, [f"'{edge:%Y-%m-%d %H:%M:%S.%f}'" for edge in edges])


def _between(column: str, marks: Sequence[str]) -> list[str]:
    if not marks:
        return ["1 = 1"]
    inner = [f"{column} >= {a} AND {column} < {b}" for a, b in zip(marks, marks[1:])]
    return [f"{column} < {marks[0]} OR {column} IS NULL", *inner, f"{column} >= {marks[-1]}"]


def even_edges(start: datetime, end: datetime, slices: int) -> list[datetime]:
    """``slices - 1`` edges that cut a time span into equal parts."""
    step = (end - start) / slices
    return [start + timedelta(seconds=step.total_seconds() * i) for i in range(1, slices)]
