"""K-means clusters of the ordinary users, with a model that is stored and scored in SQL.

Users are counted per distinct feature combination first. All features are whole numbers,
so most users share theirs with many others: the fit iterates over the weighted
combinations, which gives the same objective as one row per user at a fraction of the
volume, and a group holding a third of all users is a single heavy row.
"""

from __future__ import annotations

import math
from collections.abc import Iterable
from dataclasses import dataclass
from functools import partial

from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from ..config import MartConfig
from ..session import run_together, shared_dir

LOGGED = ("friend_cnt", "frequency", "monetary", "block_cnt")
FEATURES = ("recency", *(f"{c}_log" for c in LOGGED))
MODEL_TABLE = "activity_cluster_model"

# Combinations per partition of the fit. The layout must not depend on the machine: the
# start of K-means is drawn per partition.
ROWS_PER_PARTITION = 250_000


def log_features(general: DataFrame) -> DataFrame:
    """Recency as it is, counts as ``log(1 + x)``."""
    logs = {f"{c}_log": F.log1p(F.coalesce(F.col(c), F.lit(0)).cast("double")) for c in LOGGED}
    return general.withColumns({"recency": F.col("recency").cast("double"), **logs})


@dataclass(frozen=True)
class ClusterModel:
    """Scaling and centres, both by position in ``FEATURES``; a cluster is its index."""

    means: tuple[float, ...]
    deviations: tuple[float, ...]
    centers: tuple[tuple[float, ...], ...]

    @property
    def k(self) -> int:
        return len(self.centers)

    def scaled(self, i: int) -> str:
        """SQL of one scaled feature. A constant feature has no spread: centred only."""
        return f"({FEATURES[i]} - {self.means[i]!r}D) / {self.deviations[i] or 1.0!r}D"

    def nearest(self) -> Column:
        """Index of the closest centre; the lower index on a tie."""

        def squared_distance(center: tuple[float, ...]) -> str:
            return " + ".join(f"pow({self.scaled(i)} - {c!r}D, 2)" for i, c in enumerate(center))

        choices = (f"struct({squared_distance(c)} as d, {i} as cluster)" for i, c in enumerate(self.centers))
        return F.expr(f"cast(array_min(array({', '.join(choices)})).cluster as tinyint)")

    def to_frame(self, spark: SparkSession) -> DataFrame:
        """``k x features`` rows, built from literals."""
        cells = (
            f"({i}, '{name}', {self.means[j]!r}D, {self.deviations[j]!r}D, {center[j]!r}D)"
            for i, center in enumerate(self.centers)
            for j, name in enumerate(FEATURES)
        )
        return spark.sql(f"select * from values {', '.join(cells)} as t(cluster, feature, mean, deviation, center)")

    @classmethod
    def from_rows(cls, rows: Iterable[Row]) -> ClusterModel | None:
        cells = {(r.cluster, r.feature): r for r in rows}
        if not cells:
            return None
        ids = sorted({cluster for cluster, _ in cells})
        first = ids[0]
        return cls(
            tuple(cells[first, f]["mean"] for f in FEATURES),
            tuple(cells[first, f]["deviation"] for f in FEATURES),
            tuple(tuple(cells[i, f]["center"] for f in FEATURES) for i in ids),
        )


def combinations(general: DataFrame) -> DataFrame:
    """Distinct feature combinations with the number of users holding each."""
    return log_features(general).groupBy(*FEATURES).agg(F.count(F.lit(1)).cast("double").alias("weight"))


def _moments(weighted: DataFrame) -> tuple[int, tuple[float, ...], tuple[float, ...]]:
    """Row count, means and population deviations, in two passes over few rows."""
    total = F.sum("weight")
    first = weighted.agg(
        F.count(F.lit(1)).alias("n"),
        *((F.sum(F.col(f) * F.col("weight")) / F.nullif(total, F.lit(0.0))).alias(f) for f in FEATURES),
    ).first()
    if not first["n"]:
        return 0, (), ()
    means = tuple(first[f] for f in FEATURES)
    spread = weighted.agg(*(
        F.sqrt(F.sum((F.col(f) - m) * (F.col(f) - m) * F.col("weight")) / total).alias(f)
        for f, m in zip(FEATURES, means)
    )).first()
    return first["n"], means, tuple(spread[f] for f in FEATURES)


def scaled_features(general: DataFrame) -> DataFrame:
    """Features with zero mean and unit (population) deviation, one row per user."""
    _, means, deviations = _moments(combinations(general))
    if not means:
        means, deviations = (0.0,) * len(FEATURES), (1.0,) * len(FEATURES)
    model = ClusterModel(means, deviations, ())
    scaled = (f"{model.scaled(i)} as {f}_scaled" for i, f in enumerate(FEATURES))
    return log_features(general).selectExpr("user_id", *scaled)


def fit_clusters(general: DataFrame, cfg: MartConfig = MartConfig()) -> ClusterModel | None:
    """Best of several starts; clusters are numbered by ascending centre.

    Same data, same model: combinations are laid out by their hash and sorted before the
    fit, so neither the input's partitioning nor a recomputed partition changes the start.
    Returns None for no users, and fewer clusters than asked for when there are fewer
    combinations.
    """
    spark = general.sparkSession
    shared_dir(spark)  # names the checkpoint folder
    weighted = combinations(general).checkpoint()
    n, means, deviations = _moments(weighted)
    if not n:
        return None
    scaling = ClusterModel(means, deviations, ())
    laid_out = weighted.repartition(math.ceil(n / ROWS_PER_PARTITION), *FEATURES).sortWithinPartitions(*FEATURES)
    vectors = (
        VectorAssembler(inputCols=list(FEATURES), outputCol="features")
        .transform(laid_out.selectExpr("weight", *(f"{scaling.scaled(i)} as {f}" for i, f in enumerate(FEATURES))))
        .select("features", "weight")
        .persist()
    )
    vectors.count()

    def fit(seed: int):
        # The row solver copes with fewer starting centres than asked for, the block one fails.
        trainer = KMeans(k=min(cfg.k, n), seed=seed, weightCol="weight", maxIter=300, tol=1e-4, solver="row")
        model = trainer.fit(vectors)
        return model.summary.trainingCost, seed, [tuple(float(x) for x in c) for c in model.clusterCenters()]

    seeds = range(cfg.seed, cfg.seed + cfg.restarts)
    try:
        if n == 1:  # K-means wants two distinct points
            centers = [(0.0,) * len(FEATURES)]
        else:
            runs = run_together(spark, [partial(fit, seed) for seed in seeds], cfg.restarts)
            _, _, centers = min(runs, key=lambda run: run[:2])
    finally:
        vectors.unpersist()
    return ClusterModel(means, deviations, tuple(sorted(set(centers))))


def score(general: DataFrame, model: ClusterModel | None) -> DataFrame:
    """Cluster of each user by a given model; all JVM expressions, no shuffle."""
    featured = log_features(general)
    if model is None or not model.centers:
        cluster = F.lit(None).cast("tinyint")
        featured = featured.where(F.lit(False))
    else:
        cluster = model.nearest()
    return featured.select("user_id", "friend_cnt", "recency", "frequency", "monetary", "block_cnt",
                           cluster.alias("cluster"))


def cluster_users(
    general: DataFrame, cfg: MartConfig = MartConfig(), model: ClusterModel | None = None
) -> tuple[DataFrame, ClusterModel | None]:
    """Clusters by ``model``, or by a newly fitted one."""
    model = model or fit_clusters(general, cfg)
    return score(general, model), model
