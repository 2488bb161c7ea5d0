"""Updates that rewrite the touched buckets and nothing else."""

import os

import pytest
from helpers import table, values

from cohortmill.catalog.bindings import USER_POINTS
from cohortmill.sources import BucketedTable
from cohortmill.sources.store import DuplicateKey


def rows(spark, *pairs):
    return table(spark, "user_id:bigint point:bigint", *pairs)


def files(mart):
    root = f"{mart.store.root}/{mart.contract.name}"
    return {os.path.join(at, name): os.stat(os.path.join(at, name)).st_mtime_ns
            for at, _, names in os.walk(root) for name in names if name.endswith(".parquet")}


@pytest.fixture
def mart(spark, store):
    mart = BucketedTable(store, USER_POINTS, buckets=16)
    mart.upsert(spark.sql("select id as user_id, id * 2 as point from range(1000)"), "b0")
    return mart


def test_an_update_leaves_other_buckets_in_place(spark, mart):
    before, old = files(mart), {p.bucket: p.version for p in mart.manifest()}
    assert len(old) == 16 and mart.read().count() == 1000
    got = mart.upsert(rows(spark, (5, -1), (2000, -2)), "b1")
    now = {p.bucket: p.version for p in mart.manifest()}
    changed = {b for b in now if now[b] != old[b]}
    assert 1 <= len(changed) <= 2 and got.rows < 250
    assert {path: at for path, at in files(mart).items() if path in before} == before
    assert all("/v-1/" in path for path in files(mart).keys() - before.keys())
    want = {i: 2 * i for i in range(1000)} | {5: -1, 2000: -2}
    assert values(mart.read()) == sorted(want.items(), key=str)
    # The plan of the read names no file of a bucket that was replaced.
    assert len(mart.read().inputFiles()) <= len(before) + len(changed)
    assert mart.purge(keep=1) == len(changed) and values(mart.read()) == sorted(want.items(), key=str)


def test_departures_and_an_emptied_bucket(spark, mart):
    everyone = mart.read().select("user_id")
    mart.upsert(rows(spark, (7, 70)), "b1", gone=everyone.selectExpr("cast(user_id as int) as user_id"))
    assert values(mart.read()) == [(7, 70)] and len(mart.manifest()) == 1
    mart.upsert(rows(spark), "b2", gone=everyone.where("user_id = 7"))
    assert values(mart.read()) == [] and mart.read().columns == ["user_id", "point"]
    mart.upsert(rows(spark, (1, 1)), "b3")
    assert values(mart.read()) == [(1, 1)]


def test_reruns_crashes_and_repeated_keys(spark, mart, monkeypatch):
    with pytest.raises(DuplicateKey):
        mart.upsert(rows(spark, (1, 1), (1, 2)), "b1")
    with monkeypatch.context() as patched:
        patched.setattr(type(mart.store), "_commit", lambda *args, **kwargs: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            mart.upsert(rows(spark, (1, 5), (2, 6)), "b1")
    assert mart.read().where("point <> user_id * 2").isEmpty()
    assert mart.upsert(rows(spark, (1, 5)), "b1").committed
    assert not mart.upsert(rows(spark, (1, 9)), "b1").committed
    assert values(mart.read().where("user_id in (1, 2)")) == [(1, 5), (2, 4)]
