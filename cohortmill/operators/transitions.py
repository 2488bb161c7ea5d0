"""Status histories: which status a cluster was in, since when, for how long, and from which it came.

A fold over the weeks of a cluster: a week whose status differs from the one before begins a new stay.
The weeks of a cluster are as many as the window has, whatever the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

STATUSES = ("war_status", "arpu_status", "vpu_status")


def stays(series: DataFrame, statuses: tuple[str, ...] = STATUSES) -> DataFrame:
    """``cluster, kpi, number, status, came_from, since, until, weeks``: unbroken runs of one status.

    A missing week ends a stay, since nothing is known of it; a missing status is a status of its own.
    """
    long = series.select("cluster", "week_start", F.explode(F.array(*(
        F.struct(F.lit(s.removesuffix("_status")).alias("kpi"), F.col(s).alias("status")) for s in statuses))).alias("s")).select(
        "cluster", "week_start", "s.*")
    weeks = Window.partitionBy("cluster", "kpi").orderBy("week_start")
    before, last = F.lag("status").over(weeks), F.lag("week_start").over(weeks)
    begins = last.isNull() | ~F.col("status").eqNullSafe(before) | (F.datediff("week_start", last) != 7)
    numbered = long.withColumns({"before": before, "begins": begins.cast("int")}).withColumn(
        "number", F.sum("begins").over(weeks.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    first = F.min_by("before", "week_start")
    return numbered.groupBy("cluster", "kpi", "number").agg(
        F.min_by("status", "week_start").alias("status"), first.alias("came_from"), F.min("week_start").alias("since"),
        F.date_add(F.max("week_start"), 7).alias("until"), F.count(F.lit(1)).alias("weeks"))


def time_in_status(history: DataFrame) -> DataFrame:
    """Weeks and stays per cluster, KPI and status, and the longest stay."""
    return history.groupBy("cluster", "kpi", "status").agg(
        F.count(F.lit(1)).alias("stays"), F.sum("weeks").alias("weeks"), F.max("weeks").alias("longest"))
