"""Recency, frequency and monetary profile: one row per clean user."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import AnalysisWindow, MartConfig
from ..functions import in_window, whole_days_before

SUPER, GENERAL = "Super", "General"


def _events(df: DataFrame, window: AnalysisWindow, *extra: str) -> DataFrame:
    """In-window rows with a user; a NULL user belongs to no group."""
    known = F.col("user_id").isNotNull() & in_window(F.col("created_at"), window)
    return df.select("user_id", "created_at", *extra).where(known)


def recency(last_vote: Column, window: AnalysisWindow) -> Column:
    return whole_days_before(window.end_ts, last_vote)


def activity_summary(
    votes: DataFrame, payments: DataFrame, blocks: DataFrame, points: DataFrame, window: AnalysisWindow
) -> DataFrame:
    """The four summaries in one pass: a long union under a single ``groupBy``.

    Rows are counted before the shuffle, so a user holding a third of all rows sends one
    row per map task, and four aggregations cost one exchange. The result is partitioned by
    ``user_id``, which the join with the users reuses.
    """
    delta_type = points.schema["delta_point"].dataType

    def part(df: DataFrame, kind: str) -> DataFrame:
        extra = ("delta_point",) if kind == "point" else ()
        delta = F.col("delta_point") if extra else F.lit(None).cast(delta_type)
        return _events(df, window, *extra).select(
            "user_id",
            (F.col("created_at") if kind == "vote" else F.lit(None).cast("timestamp")).alias("voted_at"),
            F.lit(int(kind == "payment")).alias("paid"),
            F.lit(int(kind == "block")).alias("blocked"),
            delta.alias("delta"),
        )

    rows = (
        part(votes, "vote")
        .unionByName(part(payments, "payment"))
        .unionByName(part(blocks, "block"))
        .unionByName(part(points, "point"))
    )
    return rows.groupBy("user_id").agg(
        F.max("voted_at").alias("last_vote"),
        F.count("voted_at").alias("frequency"),
        F.sum("paid").alias("monetary"),
        F.sum("blocked").alias("block_cnt"),
        F.sum("delta").alias("point_flow"),
    )


def summary_of_weeks(weeks: DataFrame) -> DataFrame:
    """The same summary from rows per user and week, where those are there already."""
    return weeks.groupBy("user_id").agg(
        F.max("last_vote").alias("last_vote"),
        F.sum("votes").alias("frequency"),
        F.sum("paid").alias("monetary"),
        F.sum("blocked").alias("block_cnt"),
        F.sum("net_flow").alias("point_flow"),
    )


def user_profile(
    users: DataFrame,
    votes: DataFrame,
    payments: DataFrame,
    blocks: DataFrame,
    points: DataFrame,
    cfg: MartConfig = MartConfig(),
) -> DataFrame:
    """Profile of every clean user, from the facts themselves."""
    return profile_of(users, activity_summary(votes, payments, blocks, points, cfg.window), cfg)


def profile_of(users: DataFrame, summary: DataFrame, cfg: MartConfig = MartConfig()) -> DataFrame:
    """Profile of every clean user, active or not.

    Without a vote, recency counts from the sign-up, capped at the window's length; a
    sign-up after the end gives 0.
    """
    window = cfg.window
    since_signup = F.least(whole_days_before(window.end_ts, F.col("created_at")), F.lit(window.max_days))
    days = F.greatest(F.coalesce(recency(F.col("last_vote"), window), since_signup), F.lit(0))
    people = users.select(
        F.col("user_id").try_cast("bigint").alias("user_id"), "gender", "friend_cnt", "created_at"
    )
    joined = people.join(summary, "user_id", "left").fillna(0, ["frequency", "monetary", "block_cnt", "point_flow"])
    return joined.select(
        "user_id",
        F.when(F.col("frequency") >= cfg.super_votes, SUPER).otherwise(GENERAL).alias("user_type"),
        "gender",
        "friend_cnt",
        F.col("point_flow"),
        days.cast("long").alias("recency"),
        "frequency",
        "monetary",
        "block_cnt",
    )


def super_users(profile: DataFrame) -> DataFrame:
    """Heavy voters; their ``point`` is the net flow inside the window."""
    return profile.where(F.col("user_type") == SUPER).withColumnRenamed("point_flow", "point")


def general_users(profile: DataFrame) -> DataFrame:
    return profile.where(F.col("user_type") == GENERAL).drop("gender", "point_flow", "user_type")


def user_type_counts(profile: DataFrame) -> DataFrame:
    return profile.groupBy("user_type").agg(F.count(F.lit(1)).alias("users"))
