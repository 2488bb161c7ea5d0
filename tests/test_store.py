from datetime import datetime

import pytest
from helpers import table, values
from pyspark.errors import PySparkException

from cohortmill.schemas import SUPER_USERS, TIMESERIES, conform
from cohortmill.sources.store import SchemaDrift

MARK = datetime(2024, 1, 15, 1, 2, 3, 456789)


def rows(spark, *pairs):
    return table(spark, "id:bigint x:string", *pairs)


def test_append_and_replace(spark, store):
    assert not store.exists("t")
    store.replace("t", rows(spark, (1, "a")), "b0", MARK)
    store.append("t", rows(spark, (2, "b")), "b1", MARK)
    assert values(store.read("t")) == [(1, "a"), (2, "b")]
    store.replace("t", rows(spark, (3, "c")), "b2", MARK)
    assert values(store.read("t")) == [(3, "c")]
    assert store.exists("t") and store.committed("t", "b1").row_count == 1


def test_replace_may_read_what_it_replaces(spark, store):
    store.replace("t", rows(spark, (1, "a"), (2, "b")), "b0")
    store.replace("t", store.read("t").where("id = 2"), "b1")
    assert values(store.read("t")) == [(2, "b")]


def test_a_committed_batch_is_a_no_op(spark, store):
    store.append("t", rows(spark, (1, "a")), "b0")
    again = store.append("t", rows(spark, (9, "z")), "b0")
    assert not again.committed and again.rows == 1 and values(store.read("t")) == [(1, "a")]


def test_a_crash_before_the_commit_is_invisible_and_retried(spark, store, monkeypatch):
    store.append("t", rows(spark, (1, "a")), "b0")

    def crash(*args):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(store, "_commit", crash)
        with pytest.raises(RuntimeError):
            store.append("t", rows(spark, (2, "b")), "b1")
    assert values(store.read("t")) == [(1, "a")]
    store.append("t", rows(spark, (2, "b")), "b1")
    assert values(store.read("t")) == [(1, "a"), (2, "b")]


def test_a_crashed_replace_leaves_the_old_generation(spark, store, monkeypatch):
    store.append("t", rows(spark, (1, "a")), "b0")
    with monkeypatch.context() as patch:
        patch.setattr(store, "_commit", lambda *args: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            store.replace("t", rows(spark, (2, "b")), "b1")
    assert values(store.read("t")) == [(1, "a")]
    store.replace("t", rows(spark, (3, "c")), "b2")
    assert values(store.read("t")) == [(3, "c")]


def test_empty_batches(spark, store):
    empty = rows(spark, (1, "a")).limit(0)
    assert store.append("t", empty, "b0").rows == 0
    assert store.read("t").columns == ["id", "x"] and store.read("t").count() == 0
    store.append("t", rows(spark, (1, "a")), "b1")
    store.append("t", empty, "b2")
    assert values(store.read("t")) == [(1, "a")]


def test_drift_is_an_error(spark, store):
    store.append("t", rows(spark, (1, "a")), "b0")
    with pytest.raises(SchemaDrift):
        store.append("t", table(spark, "id:bigint y:string", (1, "a")), "b1")


def test_state_keeps_the_latest_mark(spark, store):
    store.append("t", rows(spark, (1, "a")), "b0", datetime(2024, 1, 1))
    store.append("t", rows(spark, (2, "b"), (3, "c")), "b1", MARK)
    store.append("u", rows(spark, (1, "a")), "b0", datetime(2024, 1, 2))
    assert store.last_synced_at("t") == MARK and store.last_synced_at("nope") is None
    assert values(store.sync_state(), "table_name", "last_synced_at", "row_count") == [
        ("t", "2024-01-15 01:02:03.456789", 2), ("u", "2024-01-02 00:00:00", 1)]


def test_compact_keeps_rows_and_mark(spark, store):
    for i in range(3):
        store.append("t", rows(spark, (i, "a")), f"b{i}", MARK)
    store.compact("t", "compacted")
    assert values(store.read("t")) == [(0, "a"), (1, "a"), (2, "a")]
    assert store.last_synced_at("t") == MARK and len(store.read("t").inputFiles()) == 1
    assert store.purge("t") == [0] and store.read("t").count() == 3


def test_missing_tables(spark, store):
    assert store.read(TIMESERIES.name, TIMESERIES).columns == TIMESERIES.columns
    with pytest.raises(LookupError):
        store.read("nope")
    assert store.sync_state().count() == 0


def test_contract_checks(spark):
    columns = ("user_id:bigint user_type:string gender:string friend_cnt:int point:double recency:double"
               " frequency:double monetary:double block_cnt:int")
    good = (1, "Super", None, None, None, 3.0, None, 1.0, None)
    assert values(conform(table(spark, columns, good), SUPER_USERS)) == [(1, "Super", None, 0, 0.0, 3.0, 0.0, 1.0, 0)]
    for bad, message in [((None, *good[1:]), "user_id: NULL"), ((1, "Super", "toolong", *good[3:]), "longer than 5")]:
        with pytest.raises(PySparkException, match=message):
            conform(table(spark, columns, bad), SUPER_USERS).collect()


def test_whole_seconds(spark):
    df = table(spark, " ".join(f"{f.name}:{f.dataType.simpleString()}" for f in TIMESERIES.schema),
               tuple("2024-01-01 00:00:00.9" if f.name == "last_act" else
                     __import__("datetime").date(2024, 1, 1) if f.name == "week_start" else
                     "x" if f.dataType.simpleString() == "string" else
                     1.0 if f.dataType.simpleString() == "double" else 1 for f in TIMESERIES.schema))
    assert values(conform(df, TIMESERIES, whole_seconds=True), "last_act") == [("2024-01-01 00:00:00",)]


def test_written_timestamps_let_a_scan_skip_row_groups(spark, store):
    """INT64 micros keep statistics; the scan then reads fewer rows than it holds."""
    df = spark.range(200_000).selectExpr("id", "timestamp'2024-01-01' + make_dt_interval(0, 0, 0, id) as ts")
    spark.conf.set("parquet.block.size", "100000")
    try:
        store.replace("t", df.coalesce(1), "b0")
    finally:
        spark.conf.unset("parquet.block.size")
    late = store.read("t").where("ts > timestamp'2024-01-03 07:00:00'")
    late.collect()
    plan = late._jdf.queryExecution().executedPlan()
    scan = plan.collectLeaves().head()
    assert scan.metrics().apply("numOutputRows").value() < 100_000
