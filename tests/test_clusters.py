from dataclasses import replace

import pytest
from helpers import table, values

from cohortmill.config import MartConfig
from cohortmill.operators.clusters import (
    FEATURES, ClusterModel, cluster_users, combinations, fit_clusters, log_features, scaled_features, score,
)

COLUMNS = "user_id:bigint friend_cnt:int recency:bigint frequency:bigint monetary:bigint block_cnt:bigint"
# Six groups far apart; members differ by a day or a friend.
GROUPS = [(0, 10, 0, 0, 0), (400, 10, 0, 0, 0), (0, 300, 0, 0, 0), (400, 300, 300, 0, 0), (0, 10, 300, 50, 0),
          (400, 10, 300, 50, 40)]
CFG = replace(MartConfig(), restarts=4)


def blobs(spark, copies=5):
    rows = []
    for g, (friends, recency, votes, pays, blocks) in enumerate(GROUPS):
        for i in range(copies):
            rows.append((g * 100 + i, friends + i % 2, recency + i, votes + i % 3, pays, blocks))
    return table(spark, COLUMNS, *rows)


def labels(df):
    return {r.user_id: r.cluster for r in df.collect()}


def test_separable_groups_are_found(spark):
    got = labels(cluster_users(blobs(spark), CFG)[0])
    assert len(got) == 30
    by_group = [{got[g * 100 + i] for i in range(5)} for g in range(6)]
    assert all(len(s) == 1 for s in by_group) and len(set.union(*by_group)) == 6
    assert set.union(*by_group) == set(range(6))


def test_layout_of_the_input_does_not_matter(spark):
    df = blobs(spark)
    first = fit_clusters(df.repartition(1), CFG)
    second = fit_clusters(df.repartition(7, "frequency"), CFG)
    assert first.means == pytest.approx(second.means) and first.k == second.k
    for a, b in zip(first.centers, second.centers):
        assert a == pytest.approx(b)


def test_model_survives_storage_and_scores_new_users(spark, store):
    df = blobs(spark)
    scored, model = cluster_users(df, CFG)
    store.replace("model", model.to_frame(spark), "b0")
    again = ClusterModel.from_rows(store.read("model").collect())
    assert again == model
    assert labels(score(df, again)) == labels(scored)
    newcomer = table(spark, COLUMNS, (999, 0, 11, 0, 0, 0))
    assert labels(score(newcomer, again))[999] == labels(scored)[0]


def test_repeated_users_are_weights(spark):
    df = blobs(spark)
    many = df.crossJoin(spark.range(3)).drop("id")
    assert combinations(many).count() == combinations(df).count()
    once, thrice = fit_clusters(df, CFG), fit_clusters(many, CFG)
    for a, b in zip(once.centers, thrice.centers):
        assert a == pytest.approx(b)


def test_centres_are_means_of_their_members(spark):
    df = blobs(spark)
    scored, model = cluster_users(df, CFG)
    joined = scaled_features(df).join(scored.select("user_id", "cluster"), "user_id")
    means = joined.groupBy("cluster").avg(*(f"{f}_scaled" for f in FEATURES)).orderBy("cluster").collect()
    for row, center in zip(means, model.centers):
        assert tuple(row)[1:] == pytest.approx(center, abs=1e-9)


def test_too_few_users(spark):
    few = table(spark, COLUMNS, (1, 0, 10, 0, 0, 0), (2, 50, 300, 0, 0, 0), (3, 0, 10, 300, 9, 9))
    got = labels(cluster_users(few, CFG)[0])
    assert len(got) == 3 and set(got.values()) <= {0, 1, 2}


def test_one_kind_of_user(spark):
    same = table(spark, COLUMNS, *((i, 1, 5, 2, 0, 0) for i in range(10)))
    scored, model = cluster_users(same, CFG)
    assert set(labels(scored).values()) == {0} and model.k == 1


def test_no_users(spark):
    scored, model = cluster_users(blobs(spark).limit(0), CFG)
    assert model is None and scored.count() == 0
    assert scored.columns == ["user_id", "friend_cnt", "recency", "frequency", "monetary", "block_cnt", "cluster"]


def test_scaling(spark):
    rows = scaled_features(blobs(spark)).toPandas()
    for f in FEATURES:
        assert rows[f"{f}_scaled"].mean() == pytest.approx(0, abs=1e-9)
        assert rows[f"{f}_scaled"].std(ddof=0) == pytest.approx(1)


def test_logs(spark):
    df = table(spark, COLUMNS, (1, None, 3, 0, 1, 0))
    row = values(log_features(df), *FEATURES)[0]
    assert row == pytest.approx((3.0, 0.0, 0.0, 0.6931471805599453, 0.0))
