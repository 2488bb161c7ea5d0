"""Rankings and changes over time: top voters, week-over-week changes, retention."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import MartConfig
from ..functions import ratio
from .timeseries import KEY, target_map


def top_voters(weeks: DataFrame, cluster_map: DataFrame, cfg: MartConfig, k: int = 10) -> DataFrame:
    """The ``k`` users with most votes per week and cluster.

    Exactly ``k`` rows where there are as many voters: of equal votes the smaller user_id comes first.
    ``rank`` tells ties (equal votes, equal rank). The filter on the position lets every task keep its
    own ``k`` rows a group before the shuffle, so a week with all voters is no heavy task.
    """
    votes = weeks.where(F.col("votes") > 0).join(target_map(cluster_map, cfg), "user_id").select(*KEY, "user_id", "votes")
    best = Window.partitionBy(*KEY).orderBy(F.col("votes").desc(), "user_id")
    kept = votes.withColumn("place", F.row_number().over(best)).where(F.col("place") <= k)
    # Everybody with more votes is among the rows kept, so the rank is right.
    return kept.withColumn("rank", F.rank().over(Window.partitionBy(*KEY).orderBy(F.col("votes").desc())))


def week_over_week(series: DataFrame, measures: tuple[str, ...] = ("active_users", "vote_cnt", "revenue")) -> DataFrame:
    """Each measure with its change since the week before: absolute, and in percent (0 from nothing).

    Null in the first week, and where the week before is missing.
    """
    weeks = Window.partitionBy("cluster").orderBy("week_start")
    follows = F.datediff("week_start", F.lag("week_start").over(weeks)) == 7
    columns = []
    for name in measures:
        before = F.when(follows, F.lag(name).over(weeks))
        change = F.col(name) - before
        columns += [F.col(name), change.alias(f"{name}_change"),
                    F.when(before.isNotNull(), ratio(change, before, 100)).alias(f"{name}_change_pct")]
    return series.select(*KEY, *columns)


def retention(active: DataFrame) -> DataFrame:
    """Per week and cluster: users active, of them those active the week before (``returned``) and the
    week after (``retained``), and those seen for the first time (``new``).

    ``active`` holds every ``week_start, cluster, user_id`` once; a user has as many rows as weeks.
    """
    weeks = Window.partitionBy("user_id").orderBy("week_start")
    before, after = F.lag("week_start").over(weeks), F.lead("week_start").over(weeks)
    marked = active.select(*KEY, before.alias("before"), after.alias("after"))
    return marked.groupBy(*KEY).agg(
        F.count(F.lit(1)).alias("active"),
        F.count_if(F.datediff("week_start", "before") == 7).alias("returned"),
        F.count_if(F.datediff("after", "week_start") == 7).alias("retained"),
        F.count_if(F.col("before").isNull()).alias("new"),
    ).withColumn("retained_pct", ratio(F.col("retained"), F.col("active"), 100))
