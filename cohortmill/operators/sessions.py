"""Sessions: a user's events with no gap longer than a bound between them.

Worked out in two steps. Events of a user and a day are merged first, so a user with a third of all
rows is as many groups as there are days, and tasks merge before they shuffle. What is left of a day
are at most as many sessions as gaps fit into it; these are then put together over midnight in order
of time, one narrow row each. Both steps treat events exactly ``gap`` apart as one session.

Events without a user or a time are in no session. Events at the same time and repeated rows count
each; a lone event is a session of no length.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def user_sessions(events: DataFrame, gap: str = "30 minutes", ts: str = "ts",
                  measures: dict[str, Column] | None = None) -> DataFrame:
    """``user_id, started_at, ended_at, seconds, n_events`` and a sum for each of the ``measures``."""
    sums = {"n_events": F.lit(1), **(measures or {})}
    daily = (
        events.where(F.col("user_id").isNotNull() & F.col(ts).isNotNull())
        .select("user_id", F.col(ts).alias("at"), F.to_date(ts).alias("day"), *(c.alias(n) for n, c in sums.items()))
        .groupBy("user_id", "day", F.session_window("at", gap))
        .agg(F.min("at").alias("started_at"), F.max("at").alias("ended_at"), *(F.sum(n).alias(n) for n in sums))
    )
    in_order = Window.partitionBy("user_id").orderBy("started_at")
    before = F.lag("ended_at").over(in_order)
    begins = (before.isNull() | (F.col("started_at") > before + F.expr(f"interval {gap}"))).cast("int")
    numbered = daily.withColumn("begins", begins).withColumn(
        "number", F.sum("begins").over(in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    # Grouped by user and number: the partitioning by user will do.
    return (
        numbered.groupBy("user_id", "number")
        .agg(F.min("started_at").alias("started_at"), F.max("ended_at").alias("ended_at"),
             *(F.sum(n).alias(n) for n in sums))
        .select("user_id", "started_at", "ended_at",
                ((F.unix_micros("ended_at") - F.unix_micros("started_at")) / 1_000_000).alias("seconds"), *sums)
    )


def daily_sessions(sessions: DataFrame) -> DataFrame:
    """Per day of their start: sessions, users, events, seconds, and how many go on after midnight."""
    day = F.to_date("started_at")
    # One row per user and day first: no distinct count over a hot day.
    per_user = sessions.groupBy(day.alias("day"), "user_id").agg(
        F.count(F.lit(1)).alias("sessions"), F.sum("n_events").alias("events"), F.sum("seconds").alias("seconds"),
        F.count_if(F.to_date("ended_at") > day).alias("over_midnight"))
    return per_user.groupBy("day").agg(
        F.sum("sessions").alias("sessions"), F.count(F.lit(1)).alias("users"), F.sum("events").alias("events"),
        F.sum("seconds").alias("seconds"), F.sum("over_midnight").alias("over_midnight"))
