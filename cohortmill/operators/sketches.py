"""Active users of any span of weeks, from stored sketches and exactly.

Distinct users are not additive over weeks, so a series of weekly counts cannot say how many users a
month had. A HyperLogLog sketch per week and cluster can: sketches are merged, a span costs as many
rows as it has weeks, and no fact is read again. The exact way beside it needs one pass over the
user-weeks for all spans together, without a distinct count.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import MartConfig
from .timeseries import target_map

LG_K = 12  # 4,096 registers: 4 kB a sketch
RELATIVE_ERROR = 1.04 / math.sqrt(1 << LG_K)


def active_user_weeks(weeks: DataFrame, cluster_map: DataFrame, cfg: MartConfig) -> DataFrame:
    """``week_start, cluster, user_id`` of the user-weeks with any activity, each once."""
    return weeks.where(F.col("last_act").isNotNull()).join(target_map(cluster_map, cfg), "user_id").select(
        "week_start", "cluster", "user_id")


def weekly_sketches(active: DataFrame, lg_k: int = LG_K) -> DataFrame:
    """``week_start, cluster, sketch``: mergeable, to be stored with each weekly run."""
    return active.groupBy("week_start", "cluster").agg(F.hll_sketch_agg("user_id", lg_k).alias("sketch"))


def _weeks(first: Column, last: Column) -> Column:
    return F.when(first <= last, F.sequence(first, last, F.expr("interval 7 days")))


def _spans(rows: DataFrame, first: Column, last: Column, until: Column) -> DataFrame:
    """Every row under every span that begins at or before its week and ends in ``[week, until]``."""
    return rows.withColumn("span_start", F.explode(_weeks(first, F.col("week_start")))).withColumn(
        "span_end", F.explode(_weeks(F.col("week_start"), F.least(until, last))))


def sketched_spans(sketches: DataFrame, cfg: MartConfig) -> DataFrame:
    """``span_start, span_end, cluster, estimate`` of every span of weeks of the window.

    Spans are bounded by the window: weeks squared, times clusters.
    """
    first, last = _ends(cfg)
    return _spans(sketches, first, last, last).groupBy("span_start", "span_end", "cluster").agg(
        F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("estimate"))


def exact_spans(active: DataFrame, cfg: MartConfig) -> DataFrame:
    """``span_start, span_end, cluster, active_users``.

    A user is counted in a span by the last active week in it: the one whose successor lies beyond the
    span. Users with equal (week, next week) are counted first, so what is spread over spans is bounded.
    """
    first, last = _ends(cfg)
    following = F.lead("week_start").over(Window.partitionBy("user_id").orderBy("week_start"))
    steps = active.where((F.col("week_start") >= first) & (F.col("week_start") <= last)).withColumn(
        "following", following).groupBy("cluster", "week_start", "following").agg(F.count(F.lit(1)).alias("n"))
    until = F.coalesce(F.date_sub("following", 7), last)
    return _spans(steps, first, last, until).groupBy("span_start", "span_end", "cluster").agg(
        F.sum("n").alias("active_users"))


def _ends(cfg: MartConfig) -> tuple[Column, Column]:
    first = cfg.frame_window.first_monday
    return F.lit(first), F.date_trunc("week", F.lit(cfg.window.end)).cast("date")


def compared(sketched: DataFrame, exact: DataFrame, sigmas: float = 3.0) -> DataFrame:
    """Both counts side by side, and whether the estimate is as close as its error promises."""
    bound = F.greatest(F.lit(0.5), F.lit(sigmas * RELATIVE_ERROR) * F.col("active_users"))
    return exact.join(sketched, ["span_start", "span_end", "cluster"], "full").select(
        "span_start", "span_end", "cluster", "active_users",
        F.coalesce(F.abs(F.col("estimate") - F.col("active_users")) <= bound, F.lit(False)).alias("close"))
