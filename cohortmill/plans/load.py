"""Source tables into the warehouse: full or incremental by configuration."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime, timedelta
from functools import partial
from typing import Protocol

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import SEQUENTIAL_STAGES, STAGES, TableConfig
from ..functions.dates import utc_literal
from ..operators.cleaning import CLEANING, Cleaning
from ..operators.keys import one_per_key, unseen_in_slice
from ..session import ensure_session, run_together, written_once
from ..sources.store import TableStore

FULL, INCREMENTAL, SKIPPED = "FULL", "INCREMENTAL", "SKIPPED"


class Source(Protocol):
    def table(self, cfg: TableConfig, after: datetime | None = None) -> DataFrame:
        """A table. Only rows later than ``after`` will be kept of it, which a source may use."""


@dataclass(frozen=True)
class LoadOptions:
    """Deviations from the default behaviour, all off, and the upkeep of the stored tables.

    ``upper_bound``   leave rows beyond the new mark for the next run
    ``lookback``      reread this much before the old mark, for rows that arrived late
    ``dedupe_batch``  one row per key inside the batch too, not only against the target
    ``keep_on_empty`` an empty full load leaves the target as it is
    ``generations``   how many generations of a table stay; the last but one serves running readers
    ``compact_after`` so many batches are folded into one before the next is appended
    """

    upper_bound: bool = False
    lookback: timedelta = timedelta(0)
    dedupe_batch: bool = False
    keep_on_empty: bool = False
    generations: int = 2
    compact_after: int = 100


@dataclass(frozen=True)
class LoadResult:
    table: str
    rows: int
    mode: str


def choose_mode(cfg: TableConfig, last_synced_at: datetime | None) -> str:
    """Full without an incremental column or on the first run, else incremental."""
    return FULL if cfg.incremental_col is None or last_synced_at is None else INCREMENTAL


def incremental_scan(df: DataFrame, column: str, after: datetime, upto: datetime | None = None) -> DataFrame:
    """Rows strictly later than the mark; the literal takes the column's type, so the
    comparison is pushed to the scan."""
    kind = df.schema[column].dataType
    df = df.where(F.col(column) > utc_literal(after).cast(kind))
    return df if upto is None else df.where(F.col(column) <= utc_literal(upto).cast(kind))


def batch_id(sync_start: datetime) -> str:
    return f"{sync_start:%Y%m%dT%H%M%S%f}"


def load_table(
    spark: SparkSession,
    cfg: TableConfig,
    source: Source,
    store: TableStore,
    sync_start: datetime,
    *,
    batch: str | None = None,
    options: LoadOptions = LoadOptions(),
    cleaning: Mapping[str, Cleaning] = CLEANING,
) -> LoadResult:
    """Load one table and move its mark to ``sync_start``.

    Rerunning a committed batch does nothing. A keyed incremental batch is first written to
    the shared folder: the source is then read exactly once, however often the batch is
    consulted to find the keys that are already stored.
    """
    ensure_session(spark)
    target, batch = cfg.target, batch or batch_id(sync_start)
    commits = store.commits(target)
    done = next((c for c in commits if c.batch == batch), None)
    if done is not None:
        return LoadResult(cfg.name, done.row_count, SKIPPED)
    mark = commits[-1].last_synced_at if commits else None
    mode = choose_mode(cfg, mark)
    after = mark - options.lookback if mode == INCREMENTAL else None
    rows = source.table(cfg, after)
    upto = sync_start if options.upper_bound and cfg.incremental_col else None
    if mode == INCREMENTAL:
        rows = incremental_scan(rows, cfg.incremental_col, after, upto)
    elif upto is not None:
        later = F.col(cfg.incremental_col) > utc_literal(upto).cast(rows.schema[cfg.incremental_col].dataType)
        rows = rows.where(~F.coalesce(later, F.lit(False)))
    if cfg.cleaning:
        rows = rows.transform(cleaning[cfg.cleaning])
    if options.dedupe_batch and cfg.pk:
        rows = one_per_key(rows, [cfg.pk])

    # Folded before the load, so that the newest row of the log stays that of a load.
    if mode == INCREMENTAL and len(store.live(target)) >= options.compact_after:
        store.compact(target, f"{batch}-compact")
    if mode == FULL:
        if options.keep_on_empty and commits and rows.isEmpty():
            written = store.record(target, batch, commits[-1].schema, sync_start)
        else:
            written = store.replace(target, rows, batch, sync_start)
    elif cfg.pk and cfg.pk in rows.columns:
        with written_once(rows, f"{target}-{batch}") as staged:
            fresh = unseen_in_slice(staged, store.read(target), cfg.pk)
            written = store.append(target, fresh, batch, sync_start)
    else:
        written = store.append(target, rows, batch, sync_start)
    store.purge(target, options.generations)
    return LoadResult(cfg.name, written.rows, mode)


def load_warehouse(
    spark: SparkSession,
    source: Source,
    store: TableStore,
    sync_start: datetime,
    *,
    stages: Mapping[str, Sequence[TableConfig]] = STAGES,
    parallelism: int = 4,
    options: LoadOptions = LoadOptions(),
) -> list[LoadResult]:
    """Load every table, stage after stage.

    Tables of a stage overlap, so that small ones do not leave executors idle; those of the
    large stage run one at a time. A failure ends the run after its stage, and the next run
    skips what is committed.
    """
    results: list[LoadResult] = []
    for name, configs in stages.items():
        loads = [
            partial(load_table, spark, cfg, source, store, sync_start, options=options) for cfg in configs
        ]
        results += run_together(spark, loads, 1 if name in SEQUENTIAL_STAGES else parallelism)
    return results
