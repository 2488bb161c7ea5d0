"""Stored tables on plain Parquet with replace, idempotent append and a sync log.

Parquet files offer neither an atomic overwrite nor an upsert, so a table is a set of
*batches* inside a *generation*, and a batch exists only once its row is in the log::

    <root>/<table>/gen-0/batch-20240115/   data files
    <root>/pipeline_sync_log/table_name=<table>/   one row per committed batch

Replace writes a new generation, append a new batch; readers resolve the log first, so a
job that dies half way leaves nothing visible and its retry overwrites its own leftovers.
A batch id that is already committed is never written again. The same log is the sync
state of the loads. One writer per table is assumed.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import UTC, datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.dates import utc_literal
from ..schemas import SYNC_LOG, SYNC_LOG_TABLE, Contract, empty_frame
from ..session import ensure_session, hadoop_path


# A log file names no table; its folder does.
_ENTRY = T.StructType([f for f in SYNC_LOG if f.name != "table_name"])


class SchemaDrift(ValueError):
    """An append whose columns differ from those of the stored table."""


class DuplicateKey(ValueError):
    """A batch that holds a key more than once."""


@dataclass(frozen=True)
class Commit:
    """One row of the log."""

    seq: int
    gen: int
    batch: str
    schema: T.StructType
    row_count: int
    last_synced_at: datetime


@dataclass(frozen=True)
class Batch:
    """Outcome of one write."""

    table: str
    rows: int
    committed: bool


def _shape(schema: T.StructType) -> list[tuple[str, str]]:
    return [(f.name, f.dataType.simpleString()) for f in schema]


class TableStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = ensure_session(spark)
        self.root = root.rstrip("/")
        self._seen: dict[str, tuple[set[str], list[Commit]]] = {}

    # ---- log -------------------------------------------------------------------------

    def _log_path(self, table: str | None = None) -> str:
        path = f"{self.root}/{SYNC_LOG_TABLE}"
        return path if table is None else f"{path}/table_name={table}"

    def log(self, table: str | None = None) -> DataFrame:
        """Committed batches of one table or all; empty when nothing was ever written."""
        schema = SYNC_LOG if table is None else _ENTRY
        path = self._log_path(table)
        if self._on_disk(path):
            log = self.spark.read.schema(schema).parquet(path)
        else:
            log = empty_frame(self.spark, schema)
        return log if table is None else log.withColumn("table_name", F.lit(table))

    def _on_disk(self, path: str) -> bool:
        files, location = hadoop_path(self.spark, path)
        return files.exists(location)

    def _log_files(self, table: str) -> set[str]:
        files, location = hadoop_path(self.spark, self._log_path(table))
        if not files.exists(location):
            return set()
        names = {status.getPath().getName() for status in files.listStatus(location)}
        return {name for name in names if name.startswith("part-")}

    def commits(self, table: str) -> list[Commit]:
        """Log of one table (its own folder, one small row per batch), oldest first.

        A log file never changes once it is there, so each is read once and no more: a listing,
        which is no Spark job, shows which files are new.
        """
        names = self._log_files(table)
        seen, known = self._seen.get(table, (set(), []))
        if not seen <= names:  # another table now has this name
            seen, known = set(), []
        if names - seen:
            known = sorted(known + self._entries(table, names - seen), key=lambda c: c.seq)
        self._seen[table] = names, known
        return list(known)

    def _entries(self, table: str, names: set[str]) -> list[Commit]:
        # The mark travels as text: Python would shift timestamps to the zone of the host.
        mark = F.col("last_synced_at").cast("string")
        entries = self.spark.read.schema(_ENTRY).parquet(*(f"{self._log_path(table)}/{name}" for name in sorted(names)))
        rows = entries.select("seq", "gen", "batch", "schema_json", "row_count", mark.alias("mark")).collect()
        return [
            Commit(r.seq, r.gen, r.batch, T.StructType.fromJson(json.loads(r.schema_json)),
                   r.row_count, datetime.fromisoformat(r.mark))
            for r in rows
        ]

    def sync_state(self) -> DataFrame:
        """Latest mark and row count per table."""
        latest = F.max_by(F.struct("last_synced_at", "row_count", "updated_at"), "seq")
        return self.log().groupBy("table_name").agg(latest.alias("s")).select("table_name", "s.*")

    def last_synced_at(self, table: str) -> datetime | None:
        commits = self.commits(table)
        return commits[-1].last_synced_at if commits else None

    def exists(self, table: str) -> bool:
        return bool(self.commits(table))

    def committed(self, table: str, batch: str) -> Commit | None:
        return next((c for c in self.commits(table) if c.batch == batch), None)

    def _commit(self, table: str, seq: int, gen: int, batch: str, schema: T.StructType,
                synced_at: datetime | None, rows: int) -> None:
        now = datetime.now(UTC).replace(tzinfo=None)
        synced_at = synced_at or now
        if synced_at.tzinfo is not None:
            synced_at = synced_at.astimezone(UTC).replace(tzinfo=None)
        values = {
            "seq": F.lit(seq), "gen": F.lit(gen),
            "batch": F.lit(batch), "schema_json": F.lit(schema.json()),
            "last_synced_at": utc_literal(synced_at),
            "row_count": F.lit(rows), "updated_at": utc_literal(now),
        }
        record = self.spark.range(1, numPartitions=1).select(
            *(values[f.name].cast(f.dataType).alias(f.name) for f in _ENTRY))
        # One task writes one file, and its rename is the commit. The folder belongs to the
        # table, so tables loaded at the same time do not meet.
        seen, known = self._seen.get(table, (set(), []))
        record.write.mode("append").parquet(self._log_path(table))
        names = self._log_files(table)
        if len(names - seen) == 1:  # what was just written need not be read
            self._seen[table] = names, [*known, Commit(seq, gen, batch, schema, rows, synced_at)]

    # ---- data ------------------------------------------------------------------------

    def _path(self, table: str, gen: int, batch: str) -> str:
        return f"{self.root}/{table}/gen-{gen}/batch-{batch}"

    def read(self, table: str, contract: Contract | None = None) -> DataFrame:
        """Committed rows of the current generation; an empty contract if never written."""
        commits = self.commits(table)
        if not commits:
            if contract is None:
                raise LookupError(f"no such table: {table}")
            return empty_frame(self.spark, contract.schema)
        return self.read_batches(table, self.live(table))

    def live(self, table: str) -> list[Commit]:
        """Batches of the current generation, oldest first."""
        commits = self.commits(table)
        return [c for c in commits if c.gen == commits[-1].gen]

    def read_batches(self, table: str, batches: Sequence[Commit]) -> DataFrame:
        """The rows of some batches of one table."""
        schema = batches[0].schema
        paths = [self._path(table, c.gen, c.batch) for c in batches if c.row_count]
        if not paths:
            return empty_frame(self.spark, schema)
        return self.spark.read.schema(schema).parquet(*paths)

    def replace(self, table: str, df: DataFrame, batch: str, synced_at: datetime | None = None,
                key: Sequence[str] = ()) -> Batch:
        """New generation holding ``df`` alone. ``df`` may read the table's current one."""
        return self._write(table, df, batch, synced_at, key, new_generation=True)

    def append(self, table: str, df: DataFrame, batch: str, synced_at: datetime | None = None,
               key: Sequence[str] = ()) -> Batch:
        """New batch; one that repeats a ``key`` is not committed."""
        return self._write(table, df, batch, synced_at, key, new_generation=False)

    def _write(self, table: str, df: DataFrame, batch: str, synced_at: datetime | None,
               key: Sequence[str], new_generation: bool) -> Batch:
        commits = self.commits(table)
        done = next((c for c in commits if c.batch == batch), None)
        if done is not None:
            return Batch(table, done.row_count, committed=False)
        last = commits[-1] if commits else None
        gen = 0 if last is None else last.gen + int(new_generation)
        if last is not None and not new_generation and _shape(last.schema) != _shape(df.schema):
            raise SchemaDrift(f"{table}: {df.schema.simpleString()} onto {last.schema.simpleString()}")
        # The metric sits in the writing stage itself, whose task results are taken once per
        # partition, so retried tasks are not counted twice and no second scan is needed.
        written, path = Observation(), self._path(table, gen, batch)
        df.observe(written, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(path)
        rows = written.get["rows"]
        if key and rows:
            keys = self.spark.read.schema(df.schema).parquet(path).groupBy(*key).count()
            if not keys.where(F.col("count") > 1).isEmpty():
                raise DuplicateKey(f"{table}: batch {batch} repeats {', '.join(key)}")
        seq = 0 if last is None else last.seq + 1
        self._commit(table, seq, gen, batch, df.schema, synced_at, rows)
        return Batch(table, rows, committed=True)

    def record(self, table: str, batch: str, schema: T.StructType, synced_at: datetime) -> Batch:
        """Commit an empty batch: the mark moves on, the data stays."""
        commits = self.commits(table)
        if any(c.batch == batch for c in commits):
            return Batch(table, 0, committed=False)
        seq, gen = (commits[-1].seq + 1, commits[-1].gen) if commits else (0, 0)
        self._commit(table, seq, gen, batch, schema, synced_at, 0)
        return Batch(table, 0, committed=True)

    def compact(self, table: str, batch: str) -> Batch:
        """Rewrite many small batches as one generation; the sync mark does not move.

        ``rebalance`` lets the adaptive planner choose well-sized output files.
        """
        return self.replace(table, self.read(table).hint("rebalance"), batch, self.last_synced_at(table))

    def purge(self, table: str, keep: int = 1) -> Sequence[int]:
        """Delete generations older than the newest ``keep``; returns those deleted.

        Each full reload leaves the previous generation behind for readers that already
        hold it; this gives the space back once they are done. An uncommitted generation, left
        by a run that died, is newer than all of them and stays for its retry.
        """
        if keep < 1:
            return []
        kept = {*sorted({c.gen for c in self.commits(table)})[-keep:]}
        files, location = hadoop_path(self.spark, f"{self.root}/{table}")
        names = [s.getPath().getName() for s in files.listStatus(location)] if files.exists(location) else []
        there = sorted(int(name.removeprefix("gen-")) for name in names if name.startswith("gen-"))
        old = [gen for gen in there if kept and gen < min(kept)]
        for gen in old:
            _, folder = hadoop_path(self.spark, f"{self.root}/{table}/gen-{gen}")
            files.delete(folder, True)
        return old
