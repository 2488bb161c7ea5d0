"""Week x cluster KPI time series.

Facts are first reduced to one row per user and week, without looking at the cluster: the
reduction starts before the shuffle, so a user with a third of all rows is no hot key, and
the join with the cluster map sees at most one row per user and week. The second reduction
then needs no distinct count, since each user is one row per week.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import MartConfig
from ..functions import burned, cutoff_week, in_window, monday_of, price_of, ratio, tier, week_label

KEY = ("week_start", "cluster")

ADDITIVE = ("revenue", "vote_cnt", "vote_user_cnt", "vote_cnt_raw", "point_burn", "net_flow", "active_users")


def week_frame(span: DataFrame, targets: tuple[int, ...]) -> DataFrame:
    """Every Monday from ``start`` to ``end`` times every target cluster, with its label.

    ``span`` holds the two dates in one row; two generators over that row build the frame,
    so there is no join.
    """
    first = F.next_day(F.date_sub("start", 1), "MON")
    end = F.col("end")
    # A span without a Monday must not count downwards.
    weeks = F.when(first <= end, F.sequence(first, end, F.expr("interval 7 days")))
    return (
        span.select(first.alias("first"), F.explode(weeks).alias("week_start"))
        .select("first", "week_start", F.explode(F.array(*(F.lit(t) for t in targets))).alias("cluster"))
        .select("week_start", F.col("cluster").cast("tinyint").alias("cluster"),
                week_label(F.col("week_start"), F.col("first")).alias("week_label"))
    )


def frame_of(spark: SparkSession, cfg: MartConfig) -> DataFrame:
    window = cfg.frame_window
    span = spark.range(1, numPartitions=1).select(F.lit(window.start).alias("start"), F.lit(window.end).alias("end"))
    return week_frame(span, cfg.targets)


def target_map(cluster_map: DataFrame, cfg: MartConfig) -> DataFrame:
    return cluster_map.select("user_id", F.col("cluster").cast("tinyint").alias("cluster")).where(
        F.col("cluster").isin(*cfg.targets)
    )


def _facts(
    cfg: MartConfig,
    votes: DataFrame | None,
    payments: DataFrame | None,
    points: DataFrame | None,
    attendance: DataFrame | None,
    blocks: DataFrame | None,
) -> DataFrame:
    """Long rows of whichever sources are given: user, time and one measure each."""
    delta_type = points.schema["delta_point"].dataType if points is not None else T.LongType()

    def part(df: DataFrame, ts: str, *, vote: bool = False, block: bool = False, revenue: Column | None = None,
             delta: Column | None = None, acts: bool = False) -> DataFrame:
        known = F.col("user_id").isNotNull() & in_window(F.col(ts), cfg.window)
        return df.where(known).select(
            "user_id",
            monday_of(F.col(ts)).alias("week_start"),
            F.lit(int(vote)).alias("vote"),
            F.lit(int(block)).alias("blocked"),
            F.lit(int(revenue is not None)).alias("paid"),
            (F.lit(0).cast("long") if revenue is None else revenue).alias("revenue"),
            (F.lit(None).cast(delta_type) if delta is None else delta).alias("delta"),
            (F.col(ts) if acts else F.lit(None).cast("timestamp")).alias("acted_at"),
        )

    parts = []
    if votes is not None:
        parts.append(part(votes, "created_at", vote=True, acts=True))
    if payments is not None:
        parts.append(part(payments, "created_at", revenue=price_of(F.col("productId"), cfg.prices)))
    if points is not None:
        parts.append(part(points, "created_at", delta=F.col("delta_point")))
    if attendance is not None:
        parts.append(part(attendance, "attendance_date", acts=True))
    if blocks is not None:
        parts.append(part(blocks, "created_at", block=True))
    rows = parts[0]
    for other in parts[1:]:
        rows = rows.unionByName(other)
    return rows


def user_weeks(
    cfg: MartConfig,
    *,
    votes: DataFrame | None = None,
    payments: DataFrame | None = None,
    points: DataFrame | None = None,
    attendance: DataFrame | None = None,
    blocks: DataFrame | None = None,
) -> DataFrame:
    """One row per user and week over all given facts; ``last_act`` is NULL if not active.

    Blocks, payments and the last vote are there for the profile, which can be summed from these rows.
    """
    return _facts(cfg, votes, payments, points, attendance, blocks).groupBy("user_id", "week_start").agg(
        F.sum("vote").alias("votes"),
        F.sum("paid").alias("paid"),
        F.sum("blocked").alias("blocked"),
        F.max(F.when(F.col("vote") == 1, F.col("acted_at"))).alias("last_vote"),
        F.sum("revenue").alias("revenue"),
        F.sum(burned(F.col("delta"))).alias("point_burn"),
        F.sum("delta").alias("net_flow"),
        F.max("acted_at").alias("last_act"),
    )


def weekly_facts(weeks: DataFrame, cluster_map: DataFrame, cfg: MartConfig) -> DataFrame:
    """User-weeks of the target clusters, summed per week and cluster.

    Votes of a user-week at or above the outlier cut stay in ``vote_cnt_raw`` and in
    ``active_users`` but not in ``vote_cnt`` and ``vote_user_cnt``.
    """
    votes = F.col("votes")
    plausible = (votes > 0) & (votes < cfg.outlier_votes)
    return (
        weeks.join(target_map(cluster_map, cfg), "user_id")
        .groupBy(*KEY)
        .agg(
            F.sum("revenue").alias("revenue"),
            F.sum(F.when(plausible, votes).otherwise(0)).alias("vote_cnt"),
            F.count(F.when(plausible, 1)).alias("vote_user_cnt"),
            F.sum("votes").alias("vote_cnt_raw"),
            F.sum("point_burn").alias("point_burn"),
            F.sum("net_flow").alias("net_flow"),
            F.count("last_act").alias("active_users"),
            F.max("last_act").alias("last_act"),
        )
    )


def weekly_signups(users: DataFrame, cluster_map: DataFrame, cfg: MartConfig) -> DataFrame:
    """Distinct clean users of a cluster by the first week that includes their sign-up.

    Earlier users belong to the first week, later ones to none.
    """
    first_seen = (
        users.select("user_id", "created_at")
        .join(target_map(cluster_map, cfg), "user_id")
        .groupBy("user_id", "cluster")
        .agg(F.min("created_at").alias("created_at"))
    )
    week = F.greatest(
        cutoff_week(F.col("created_at"), cfg.signup_cutoff), F.lit(cfg.frame_window.first_monday))
    return (
        first_seen.select("cluster", week.alias("week_start"))
        .where(F.col("week_start") <= F.lit(cfg.window.end))
        .groupBy(*KEY)
        .agg(F.count(F.lit(1)).alias("joined"))
    )


def _running(column: str) -> Column:
    """Total up to the week: one row per week, a few dozen per cluster."""
    weeks = Window.partitionBy("cluster").orderBy("week_start")
    return F.sum(column).over(weeks.rowsBetween(Window.unboundedPreceding, Window.currentRow))


def _on_frame(frame: DataFrame, totals: DataFrame) -> DataFrame:
    """Weekly totals on the frame. Totals hold one row per week of the window and target
    cluster at most, a bound set by the parameters and not by the data, hence the broadcast."""
    return frame.join(F.broadcast(totals), list(KEY), "left")


def cumulative_users(
    users: DataFrame, cluster_map: DataFrame, frame: DataFrame, cfg: MartConfig
) -> DataFrame:
    """Clean users of a cluster signed up by each week's cutoff.

    Each user is counted once and a running sum over the frame does the rest; comparing
    every user with every week is not needed.
    """
    joined = _on_frame(frame, weekly_signups(users, cluster_map, cfg))
    return joined.select(*KEY, F.coalesce(_running("joined"), F.lit(0)).alias("cum_users"))


def kpis(base: DataFrame, cfg: MartConfig) -> DataFrame:
    """Running totals, ratios and status labels of a filled frame.

    ``vpu_status`` judges ``votes_per_user`` (after the outlier cut), not ``vpu`` (all votes).
    """
    active = F.col("active_users")
    return (
        base.withColumns({
            "cum_users": _running("joined"),
            "cumulative_net_flow": _running("net_flow"),
            "cumulative_burn": _running("point_burn"),
            "pure_attendance_cnt": active - F.col("vote_user_cnt"),
        })
        .withColumns({
            "war": ratio(active, F.col("cum_users"), 100),
            "arpu": ratio(F.col("revenue"), active),
            "votes_per_user": ratio(F.col("vote_cnt"), active),
            "vpu": ratio(F.col("vote_cnt_raw"), active),
            "vote_conversion_rate": ratio(F.col("vote_user_cnt"), active, 100),
            "pure_attendance_rate": ratio(F.col("pure_attendance_cnt"), active, 100),
        })
        .withColumns({
            "war_status": tier(F.col("war"), cfg.war),
            "arpu_status": tier(F.col("arpu"), cfg.arpu),
            "vpu_status": tier(F.col("votes_per_user"), cfg.vpu),
        })
    )


def activity_timeseries(
    votes: DataFrame,
    payments: DataFrame,
    points: DataFrame,
    attendance: DataFrame,
    users: DataFrame,
    cluster_map: DataFrame,
    cfg: MartConfig = MartConfig(),
) -> DataFrame:
    """One row per week and target cluster, active or not."""
    weeks = user_weeks(cfg, votes=votes, payments=payments, points=points, attendance=attendance)
    return series_of_weeks(weeks, users, cluster_map, cfg)


def series_of_weeks(
    weeks: DataFrame, users: DataFrame, cluster_map: DataFrame, cfg: MartConfig = MartConfig()
) -> DataFrame:
    """The series from rows per user and week.

    Facts meet the cluster map only; the clean users matter for ``cum_users`` alone. Weeks
    outside the frame (days before the first Monday) find no row and drop out.
    """
    frame = frame_of(users.sparkSession, cfg)
    base = _on_frame(frame, weekly_facts(weeks, cluster_map, cfg))
    base = _on_frame(base, weekly_signups(users, cluster_map, cfg))
    base = base.fillna(0, [*ADDITIVE, "joined"])
    return kpis(base, cfg)


def dashboard_extract(timeseries: DataFrame, cfg: MartConfig = MartConfig()) -> DataFrame:
    """Rows from the start of the analysis on, each cluster in order of its weeks."""
    return timeseries.where(F.col("week_start") >= F.lit(cfg.window.start)).orderBy("cluster", "week_start")
