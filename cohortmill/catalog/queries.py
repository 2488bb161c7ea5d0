"""Named queries: each operator and job over whole test tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import TABLES, MartConfig, TableConfig
from ..functions import json_fault, json_field
from ..operators import asof, cleaning, clusters, profile, rankings, rollups, sessions, sketches, timeseries, transitions
from ..operators.keys import unseen_in_slice
from ..plans import load_table, load_warehouse, run_activity_mart, sync_replica
from ..plans.load import LoadOptions
from ..plans.load import incremental_scan as rows_since
from ..plans.mart import append_new, update_clusters, update_super_users
from ..plans.reconcile import reconcile
from ..schemas import CLUSTERS, SUPER_USERS, TIMESERIES, conform
from ..session import scratch_dir
from ..sources import BucketedTable
from ..sources.store import TableStore
from ..streaming import current_votes, run_vote_stream
from . import bindings as b
from .bindings import USER_POINTS, Bound

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn: Callable[[Bound], DataFrame]) -> Callable[[Bound], DataFrame]:
    QUERIES[fn.__name__] = lambda spark, sf: fn(Bound(spark, sf))
    return fn


def _doubles(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles rounded, so that the order of additions cannot show."""
    kinds = dict(df.dtypes)
    return df.selectExpr(*(f"round({n}, {digits}) as {n}" if kinds[n] == "double" else n for n in df.columns))


def _store(t: Bound, label: str) -> TableStore:
    return TableStore(t.spark, scratch_dir(t.spark, label))


def _timeseries(t: Bound, cfg: MartConfig = b.CONFIG) -> DataFrame:
    series = timeseries.activity_timeseries(t.votes, t.payments, t.points, t.days, t.clean, t.cluster_map, cfg)
    return conform(series, TIMESERIES)


# ---- cleaning --------------------------------------------------------------------------


@query
def preprocess_user(t):
    return cleaning.CLEANING["users"](t.users)


@query
def preprocess_point(t):
    return cleaning.CLEANING["points"](t.points)


@query
def clean_users(t):
    return t.clean


@query
def attendance_days(t):
    return t.days


@query
def broken_text_counts(t):
    return cleaning.text_faults(t.broken_users, t.broken_attendance)


@query
def typed_props(t):
    """A field of JSON text with its type, or what is wrong with it."""
    return t.broken_props.select(
        "event_id", json_field(F.col("props"), "$.k", "bigint").alias("k"), json_fault(F.col("props"), "$.k", "bigint").alias("fault"))


# ---- profile ---------------------------------------------------------------------------


@query
def vote_summary(t):
    return t.summary.where("frequency > 0").select(
        "user_id", profile.recency(F.col("last_vote"), b.CONFIG.window).alias("recency"), "frequency")


@query
def payment_summary(t):
    return t.summary.where("monetary > 0").select("user_id", "monetary")


@query
def block_summary(t):
    return t.summary.where("block_cnt > 0").select("user_id", "block_cnt")


@query
def point_summary(t):
    # Every event of the binding is a movement: whoever has any activity has a sum.
    return t.summary.select("user_id", F.col("point_flow").cast("decimal(28,2)").alias("point_flow"))


@query
def user_profile(t):
    return t.profile.withColumn("point_flow", F.col("point_flow").cast("decimal(28,2)"))


@query
def super_users(t):
    return conform(profile.super_users(t.profile), SUPER_USERS)


@query
def general_users(t):
    return t.general


@query
def user_type_counts(t):
    return profile.user_type_counts(t.profile)


# ---- clusters --------------------------------------------------------------------------


@query
def log_features(t):
    return _doubles(
        clusters.log_features(t.general).select("user_id", *clusters.FEATURES))


@query
def scaled_features(t):
    return _doubles(clusters.scaled_features(t.general))


@query
def score_clusters(t):
    """Labels of every ordinary user by a stored model."""
    return conform(clusters.score(t.general, b.MODEL), CLUSTERS)


@query
def cluster_users(t):
    """Labels by a model fitted to the data, whose groups are known."""
    labelled, _ = clusters.cluster_users(profile.general_users(t.grouped), b.CONFIG)
    return conform(labelled, CLUSTERS)


@query
def cluster_profiles(t):
    """A model fitted to the real profile. Its labels are no function of the data that SQL can state;
    that every ordinary user has one of them is."""
    labelled, model = clusters.cluster_users(t.general, b.CONFIG)
    return labelled.select("user_id", F.col("cluster").between(0, (model.k if model else 1) - 1).alias("labelled"))


# ---- time series -----------------------------------------------------------------------


@query
def week_frame(t):
    """Weeks of the span the events cover, times the target clusters."""
    span = t.events.agg(
        F.min("ts").cast("date").alias("start"), F.max("ts").cast("date").alias("end"))
    return timeseries.week_frame(span, b.CONFIG.targets)


@query
def cumulative_users(t):
    frame = timeseries.frame_of(t.spark, b.CONFIG)
    return timeseries.cumulative_users(t.clean, t.cluster_map, frame, b.CONFIG)


def _weekly(t: Bound, **facts: DataFrame) -> DataFrame:
    return timeseries.weekly_facts(timeseries.user_weeks(b.CONFIG, **facts), t.cluster_map, b.CONFIG)


@query
def weekly_revenue(t):
    return _weekly(t, payments=t.payments).select("week_start", "cluster", "revenue")


@query
def weekly_votes(t):
    """Votes and voters after the outlier cut."""
    return _weekly(t, votes=t.votes).where("vote_user_cnt > 0").select(
        "week_start", "cluster", "vote_cnt", "vote_user_cnt")


@query
def weekly_votes_raw(t):
    return _weekly(t, votes=t.votes).select("week_start", "cluster", "vote_cnt_raw")


@query
def weekly_points(t):
    return _weekly(t, points=t.points).select(
        "week_start", "cluster",
        F.col("point_burn").cast("decimal(28,2)").alias("point_burn"),
        F.col("net_flow").cast("decimal(28,2)").alias("net_flow"))


@query
def weekly_active_users(t):
    return _weekly(t, votes=t.votes, attendance=t.days).select(
        "week_start", "cluster", "active_users")


@query
def weekly_last_activity(t):
    return _weekly(t, votes=t.votes, attendance=t.days).select(
        "week_start", "cluster", "last_act")


@query
def activity_timeseries(t):
    return _doubles(_timeseries(t))


@query
def dashboard_extract(t):
    """Rows of a mart that also holds the partial week before the start of the analysis."""
    cfg = MartConfig(**{**b.CONFIG.__dict__, "include_partial_first_week": True})
    return _doubles(timeseries.dashboard_extract(_timeseries(t, cfg), cfg))


# ---- users over time -------------------------------------------------------------------


def _sessions(t: Bound) -> DataFrame:
    return sessions.user_sessions(t.events, measures={"votes": (F.col("event_type") == "click").cast("int")})


@query
def user_sessions(t):
    """Events of a user with no gap of more than half an hour."""
    return _doubles(_sessions(t))


@query
def daily_sessions(t):
    return _doubles(sessions.daily_sessions(_sessions(t)), 3)


@query
def payments_after_votes(t):
    """Each payment with the user's last vote before it."""
    return _doubles(asof.payments_after_votes(t.payments, t.votes))


@query
def stream_weekly_votes(t):
    """Weekly votes from a stream that is run twice, over what had landed by then."""
    landing, checkpoint, store = scratch_dir(t.spark, "landing"), scratch_dir(t.spark, "stream"), _store(t, "stream")
    mark = F.lit(str(b.MARK)).cast("timestamp")
    for part in (F.col("created_at") <= mark, F.col("created_at") > mark):
        t.votes.where(part).write.mode("append").parquet(landing)
        run_vote_stream(t.spark.readStream.schema(t.votes.schema).parquet(landing), store, checkpoint, b.CONFIG)
    weeks = current_votes(store).select("*", F.lit(0).cast("bigint").alias("revenue"), F.lit(0).alias("point_burn"),
                                        F.lit(0).alias("net_flow"), F.col("last_vote").alias("last_act"))
    return timeseries.weekly_facts(weeks, t.cluster_map, b.CONFIG).where("vote_user_cnt > 0").select(
        "week_start", "cluster", "vote_cnt", "vote_user_cnt")


@query
def status_stays(t):
    """How long each cluster stayed in a status, and where it came from."""
    return transitions.stays(_timeseries(t))


@query
def time_in_status(t):
    return transitions.time_in_status(transitions.stays(_timeseries(t)))


@query
def active_users_spans(t):
    """Distinct active users of every span of weeks, exactly, and whether stored sketches come as close
    as their error promises."""
    store = _store(t, "sketches")
    for cfg in (b.EARLY, b.LATE):
        fresh = sketches.weekly_sketches(t.active.where(F.col("week_start") <= F.lit(cfg.window.end)))
        if store.exists("activity_sketches"):
            fresh = fresh.join(store.read("activity_sketches"), ["week_start", "cluster"], "left_anti")
        store.append("activity_sketches", fresh, f"{cfg.window.end}", key=("week_start", "cluster"))
    sketched = sketches.sketched_spans(store.read("activity_sketches"), b.CONFIG)
    return sketches.compared(sketched, sketches.exact_spans(t.active, b.CONFIG))


@query
def kpi_cube(t):
    """Users, votes and revenue by week, cluster and gender, with every total."""
    return rollups.kpi_cube(t.weeks, t.clean, t.cluster_map, b.CONFIG)


@query
def top_voters(t):
    return rankings.top_voters(t.weeks, t.cluster_map, b.CONFIG)


@query
def week_over_week(t):
    return _doubles(rankings.week_over_week(_timeseries(t)))


@query
def retention(t):
    return _doubles(rankings.retention(t.active))


# ---- loads -----------------------------------------------------------------------------


@query
def incremental_scan(t):
    return rows_since(t.events, "ts", b.MARK)


@query
def incremental_new_rows(t):
    """Scan that looks back five days, less the keys loaded up to the mark."""
    events = t.events
    loaded = events.where(F.col("ts") <= F.lit(str(b.MARK)).cast("timestamp"))
    fresh = rows_since(events, "ts", b.MARK - timedelta(days=5))
    path = scratch_dir(t.spark, "increment")  # the lazy result reads it
    fresh.write.parquet(path)
    return unseen_in_slice(t.spark.read.schema(fresh.schema).parquet(path), loaded, "event_id")


@query
def full_load(t):
    """Users through their cleaning rule into the warehouse, read back."""
    store, cfg = _store(t, "full-load"), TABLES["accounts_user"]
    load_table(t.spark, cfg, t.source, store, b.MARK)
    return store.read(cfg.target)


def _two_loads(t: Bound, cfg: TableConfig, label: str) -> DataFrame:
    store = _store(t, label)
    for mark in (b.MARK, b.NEXT_MARK):
        load_table(t.spark, cfg, t.source, store, mark)
    return store.read(cfg.target)


@query
def keyed_reload(t):
    """Two runs of a keyed table: rows beyond the first mark are scanned twice, stored once."""
    return _two_loads(t, b.EVENTS, "keyed")


@query
def keyless_reload(t):
    """Two runs of a table without a key: rows beyond the first mark are stored twice."""
    return _two_loads(t, TABLES["hackle_events"], "keyless")


LOAD_STAGES = {
    "reference": [TableConfig("region", pk="r_regionkey"), TableConfig("nation", pk="n_nationkey"),
                  TableConfig("supplier", pk="s_suppkey"), TableConfig("part", pk="p_partkey")],
    "incremental": [TABLES[t] for t in (
        "accounts_user", "accounts_userquestionrecord", "accounts_blockrecord", "accounts_paymenthistory",
        "accounts_pointhistory")],
    "full_reload": [TABLES["accounts_attendance"], TableConfig("orders")],
    "large": [TABLES["hackle_events"]],
}


def _warehouse(t: Bound, label: str, *marks, **kwargs) -> TableStore:
    store = _store(t, label)
    for mark in marks:
        load_warehouse(t.spark, t.source, store, mark, stages=LOAD_STAGES, **kwargs)
    return store


@query
def load_all(t):
    """Rows written per table by the first run over all stages."""
    return _warehouse(t, "load-all", b.MARK).log().select("table_name", "row_count")


@query
def sync_state(t):
    """Marks and row counts after two runs that respect their upper bound."""
    store = _warehouse(t, "sync-state", b.MARK, b.NEXT_MARK, options=LoadOptions(upper_bound=True))
    return store.sync_state().select("table_name", "last_synced_at", "row_count")


# ---- marts -----------------------------------------------------------------------------


def _super_mart(t: Bound) -> TableStore:
    """Two weekly runs: the first sees two weeks of votes, the second all."""
    mart = _store(t, "mart")
    for cfg in (b.EARLY, b.LATE):
        append_new(mart, SUPER_USERS, profile.super_users(t.profile_of(cfg)), f"{cfg.window.end}")
    return mart


@query
def append_new_keys(t):
    """Heavy voters after two runs: those of the first keep their values."""
    return _super_mart(t).read(SUPER_USERS.name)


@query
def mart_refresh(t):
    """Heavy voters after a run and a refresh with later data: rewritten by key, all at their new values."""
    mart = _store(t, "refresh")
    for cfg, refresh in ((b.EARLY, False), (b.LATE, True)):
        update_super_users(mart, t.profile_of(cfg), f"{cfg.window.end}", refresh=refresh)
    return mart.read(SUPER_USERS.name)


@query
def mart_refit(t):
    """Labels after a refit: those of a stored model are rewritten, also of users who have left."""
    mart = _store(t, "refit")
    mart.replace(clusters.MODEL_TABLE, b.MODEL.to_frame(t.spark), "fixed")
    update_clusters(mart, t.grouped, b.CONFIG, "first")
    update_clusters(mart, t.grouped.where("user_id % 5 <> 0"), b.CONFIG, "second", refit=True)
    return mart.read(CLUSTERS.name).select("user_id", "cluster")


@query
def replica_reconciled(t):
    """What a replica with planted faults lacks, holds twice, or holds with other values."""
    return reconcile(t.clean, t.faulty_copy, ["user_id"])


@query
def bucketed_upsert(t):
    """Profiles in buckets of the key after an update of a hundredth, a batch with new users and a departure."""
    mart = BucketedTable(_store(t, "buckets"), USER_POINTS, buckets=32)
    users = t.clean.select("user_id", F.col("point").cast("bigint").alias("point"))
    mart.upsert(users.where("user_id % 7 <> 0"), "first")
    mart.upsert(users.where("user_id % 101 = 0").withColumn("point", F.col("point") + 1), "changed")
    mart.upsert(users.where("user_id % 14 = 0"), "new", gone=users.where("user_id % 103 = 0"))
    return mart.read()


@query
def timeseries_append(t):
    """Time series after two runs: a week written while it was running stays as it was."""
    mart = _store(t, "series")
    for cfg in (b.EARLY, b.LATE):
        append_new(mart, TIMESERIES, _timeseries(t, cfg), f"{cfg.window.end}")
    return _doubles(mart.read(TIMESERIES.name))


@query
def replica_sync(t):
    """Replica after a sync between the two runs and one after them."""
    mart, replica = _store(t, "local"), _store(t, "replica")
    for cfg in (b.EARLY, b.LATE):
        batch = f"{cfg.window.end}"
        append_new(mart, SUPER_USERS, profile.super_users(t.profile_of(cfg)), batch)
        sync_replica(mart, replica, batch, [SUPER_USERS])
    return replica.read(SUPER_USERS.name)


@query
def activity_mart_run(t):
    """All jobs in order, load to replica, with a stored model: the replica's time series."""
    warehouse = _warehouse(t, "warehouse", b.NEXT_MARK)
    mart, replica = _store(t, "mart"), _store(t, "replica")
    mart.replace(clusters.MODEL_TABLE, b.MODEL.to_frame(t.spark), "fixed")
    run_activity_mart(t.spark, warehouse, mart, replica, b.NEXT_MARK, b.CONFIG)
    return _doubles(replica.read(TIMESERIES.name))
