"""Warehouse tables into the three activity marts."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import WAREHOUSE_PREFIX, MartConfig
from ..operators import cleaning, clusters, profile, timeseries
from ..operators.keys import overwrite_rows, unseen
from ..schemas import CLUSTERS, SUPER_USERS, TIMESERIES, Contract, conform
from ..session import ensure_session, written_once
from ..sources.store import Batch, TableStore
from .load import batch_id
from .replica import sync_replica


TEXT_FAULTS = "activity_text_faults"


@dataclass(frozen=True)
class Warehouse:
    """The loaded tables the marts read."""

    store: TableStore

    def table(self, name: str) -> DataFrame:
        return self.store.read(WAREHOUSE_PREFIX + name)

    @property
    def users(self) -> DataFrame:
        return self.table("accounts_user")

    @property
    def votes(self) -> DataFrame:
        return self.table("accounts_userquestionrecord")

    @property
    def payments(self) -> DataFrame:
        return self.table("accounts_paymenthistory")

    @property
    def points(self) -> DataFrame:
        return self.table("accounts_pointhistory")

    @property
    def blocks(self) -> DataFrame:
        return self.table("accounts_blockrecord")

    @property
    def attendance(self) -> DataFrame:
        return self.table("accounts_attendance")


def append_new(store: TableStore, contract: Contract, df: DataFrame, batch: str,
               keys: Sequence[str] | None = None) -> Batch:
    """Append rows whose key the mart lacks; a second run adds nothing."""
    keys = keys or contract.key
    stored = store.read(contract.name, contract)
    rows = conform(unseen(conform(df, contract, enforce=False), stored, keys), contract)
    return store.append(contract.name, rows, batch, key=keys)


def refresh_rows(store: TableStore, contract: Contract, df: DataFrame, batch: str,
                 moved: DataFrame | None = None) -> Batch:
    """Rewrite rows by key as a new generation; keys in ``moved`` are taken out."""
    stored = store.read(contract.name, contract)
    if moved is not None:
        stored = unseen(stored, moved, contract.key)
    rows = overwrite_rows(stored, conform(df, contract), contract.key)
    return store.replace(contract.name, rows, batch, key=contract.key)


def record_text_faults(warehouse: Warehouse, mart: TableStore, batch: str) -> Batch:
    """Counts of list texts and dates that the run could not read, kept with the run."""
    faults = cleaning.text_faults(warehouse.users, warehouse.attendance)
    return mart.append(TEXT_FAULTS, faults.select(F.lit(batch).alias("run"), "*"), batch)


def build_weeks(warehouse: Warehouse, cfg: MartConfig, *, strict: bool = False) -> DataFrame:
    """All facts as one row per user and week: what profile and series are both summed from."""
    return timeseries.user_weeks(
        cfg, votes=warehouse.votes, payments=warehouse.payments, points=warehouse.points,
        attendance=cleaning.attendance_days(warehouse.attendance, strict=strict), blocks=warehouse.blocks)


def build_profile(warehouse: Warehouse, weeks: DataFrame, cfg: MartConfig, *, strict: bool = False) -> DataFrame:
    users = cleaning.clean_users(warehouse.users, cfg, strict=strict)
    return profile.profile_of(users, profile.summary_of_weeks(weeks), cfg)


def update_super_users(mart: TableStore, people: DataFrame, batch: str, *, refresh: bool = False) -> Batch:
    heavy = profile.super_users(people)
    if refresh:
        return refresh_rows(mart, SUPER_USERS, heavy, batch, moved=profile.general_users(people))
    return append_new(mart, SUPER_USERS, heavy, batch)


def stored_model(mart: TableStore) -> clusters.ClusterModel | None:
    if not mart.exists(clusters.MODEL_TABLE):
        return None
    return clusters.ClusterModel.from_rows(mart.read(clusters.MODEL_TABLE).collect())  # k x features rows


def update_clusters(mart: TableStore, people: DataFrame, cfg: MartConfig, batch: str, *,
                    refit: bool = False, refresh: bool = False) -> Batch:
    """Cluster ordinary users and append the new ones.

    The first run fits and stores a model; later runs score with it, so that a label keeps
    its meaning. ``refit`` fits anew and rewrites every label, also those of stored users who
    have left the profile: their features are in the table.
    """
    ordinary = profile.general_users(people)
    known = None if refit else stored_model(mart)
    labelled, model = clusters.cluster_users(ordinary, cfg, known)
    if model is not None and model is not known:
        mart.replace(clusters.MODEL_TABLE, model.to_frame(people.sparkSession), batch)
    if refit and model is not None:
        stored = unseen(mart.read(CLUSTERS.name, CLUSTERS), people.select("user_id"), CLUSTERS.key)
        labelled = labelled.unionByName(clusters.score(stored.drop("cluster"), model))
    if refit or refresh:
        return refresh_rows(mart, CLUSTERS, labelled, batch, moved=profile.super_users(people))
    return append_new(mart, CLUSTERS, labelled, batch)


def build_timeseries(warehouse: Warehouse, weeks: DataFrame, mart: TableStore, cfg: MartConfig, *,
                     strict: bool = False) -> DataFrame:
    return timeseries.series_of_weeks(
        weeks,
        cleaning.clean_users(warehouse.users, cfg, strict=strict),
        mart.read(CLUSTERS.name, CLUSTERS).where(F.col("cluster").isin(*cfg.targets)),
        cfg,
    )


def update_timeseries(warehouse: Warehouse, weeks: DataFrame, mart: TableStore, cfg: MartConfig, batch: str, *,
                      refresh: bool = False, strict: bool = False) -> Batch:
    series = build_timeseries(warehouse, weeks, mart, cfg, strict=strict)
    if refresh:
        return refresh_rows(mart, TIMESERIES, series, batch)
    return append_new(mart, TIMESERIES, series, batch)


def run_activity_mart(
    spark: SparkSession,
    warehouse: TableStore,
    mart: TableStore,
    replica: TableStore | None,
    run_at: datetime,
    cfg: MartConfig = MartConfig(),
    *,
    refit: bool = False,
    refresh: bool = False,
    strict: bool = False,
) -> list[Batch]:
    """Profile and clusters, then the time series, then the replica. Rows written per table.

    Text that cannot be read is counted in ``activity_text_faults``, or stops the run with
    ``strict``. A ``refit`` gives clusters another meaning, so the series is rewritten too.
    """
    ensure_session(spark)
    tables, batch = Warehouse(warehouse), batch_id(run_at)
    if not strict:
        record_text_faults(tables, mart, batch)
    # The facts are read once. Both user marts and every pass of the fit read the profile.
    with written_once(build_weeks(tables, cfg, strict=strict), "user-weeks") as weeks:
        with written_once(build_profile(tables, weeks, cfg, strict=strict), "profile") as people:
            written = [
                update_super_users(mart, people, batch, refresh=refresh),
                update_clusters(mart, people, cfg, batch, refit=refit, refresh=refresh),
            ]
        written.append(update_timeseries(
            tables, weeks, mart, cfg, batch, refresh=refresh or refit, strict=strict))
    if replica is not None:
        written += sync_replica(mart, replica, batch, refresh=refresh or refit)
    return written
