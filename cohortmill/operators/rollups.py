"""KPIs by week, cluster and gender with all their totals."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import MartConfig
from .timeseries import target_map

LEVELS = ("week_start", "cluster", "gender")


def kpi_cube(weeks: DataFrame, users: DataFrame, cluster_map: DataFrame, cfg: MartConfig) -> DataFrame:
    """``week_start, cluster, gender`` and a flag per level that it is a total; active users, voters,
    votes and revenue.

    Users are not additive over weeks, so each user is reduced to one row per week and one for all
    weeks before the grouping sets; cluster and gender are one each per user, so the rest is additive.
    The cube then multiplies rows of users and weeks, not of facts, and only in partial aggregates.
    A null level with its flag unset is a missing value.
    """
    people = users.select("user_id", "gender").join(target_map(cluster_map, cfg), "user_id")
    first, last = cfg.frame_window.first_monday, cfg.window.end
    weekly = weeks.where(F.col("week_start").between(F.lit(first), F.lit(last))).select(
        "user_id", "week_start", F.lit(False).alias("all_weeks"), F.col("last_act").isNotNull().cast("int").alias("active"),
        (F.col("votes") > 0).cast("int").alias("voter"), "votes", "revenue")
    total = weekly.groupBy("user_id").agg(
        F.max("active").alias("active"), F.max("voter").alias("voter"), F.sum("votes").alias("votes"),
        F.sum("revenue").alias("revenue")).withColumns(
        {"week_start": F.lit(None).cast("date"), "all_weeks": F.lit(True)})
    return (
        weekly.unionByName(total).join(people, "user_id")
        .groupingSets([["week_start", "all_weeks", "cluster", "gender"], ["week_start", "all_weeks", "cluster"],
                       ["week_start", "all_weeks", "gender"], ["week_start", "all_weeks"]],
                      "week_start", "all_weeks", "cluster", "gender")
        .agg((F.grouping("cluster") == 1).alias("all_clusters"), (F.grouping("gender") == 1).alias("all_genders"),
             F.sum("active").alias("active_users"), F.sum("voter").alias("voters"), F.sum("votes").alias("votes"),
             F.sum("revenue").alias("revenue"))
    )
