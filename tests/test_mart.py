from dataclasses import dataclass, replace
from datetime import date, datetime

import pytest
from helpers import ATTENDANCE, EVENT, PAYMENT, POINT, table, user, users, values
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from cohortmill import TABLES, AnalysisWindow, MartConfig, TableStore, load_table, run_activity_mart, sync_replica
from cohortmill.operators.cleaning import clean_users
from cohortmill.operators.clusters import MODEL_TABLE, score
from cohortmill.operators.profile import user_profile
from cohortmill.plans.mart import (
    TEXT_FAULTS, Warehouse, append_new, build_profile, build_timeseries, build_weeks, stored_model,
)
from cohortmill.schemas import CLUSTERS, MARTS, SUPER_USERS, TIMESERIES, conform
from cohortmill.session import hadoop_path, written_once
from cohortmill.sources.store import DuplicateKey

CFG = replace(
    MartConfig(), window=AnalysisWindow(date(2023, 5, 27), date(2023, 6, 21)), super_votes=10, k=2, restarts=2,
    targets=(0, 1))
RUN1, RUN2, RUN3 = datetime(2023, 6, 22), datetime(2023, 6, 29), datetime(2023, 7, 6)


@dataclass
class Source:
    content: dict

    def table(self, cfg, after=None):
        return self.content[cfg.name]


def content(spark, votes_of_1, newcomer=False):
    people = [user(i, friend_id_list="[1, 2, 3]" if i % 2 else "[]") for i in range(1, 9)]
    if newcomer:
        people.append(user(9, created_at="2023-06-20"))
    votes = [(i, 1, "2023-05-30") for i in range(votes_of_1)]
    votes += [(100 + i, 2 + i % 3, f"2023-06-{1 + i:02d}") for i in range(12)]
    return {
        "accounts_user": users(spark, *people),
        "accounts_userquestionrecord": table(spark, EVENT, *votes),
        "accounts_paymenthistory": table(spark, PAYMENT, (1, 2, "2023-06-06", "heart.777")),
        "accounts_pointhistory": table(spark, POINT, (1, 2, "2023-06-06", -5, 1), (2, 2, "2023-06-06", 50, None)),
        "accounts_blockrecord": table(spark, EVENT, (1, 3, "2023-06-06")),
        "accounts_attendance": table(spark, ATTENDANCE, (1, 5, "['2023-06-07']"), (2, 6, "[]")),
    }


class Service:
    def __init__(self, spark, folder):
        self.spark = spark
        self.warehouse, self.mart, self.replica = (TableStore(spark, f"{folder}/{n}") for n in ("w", "m", "r"))

    def run(self, when, *facts, **options):
        data = content(self.spark, *facts)
        for name in data:
            cfg = replace(TABLES[name], incremental_col=None)
            load_table(self.spark, cfg, Source(data), self.warehouse, when)
        return run_activity_mart(self.spark, self.warehouse, self.mart, self.replica, when, CFG, **options)

    def ids(self, contract, store=None):
        return [r[0] for r in values((store or self.mart).read(contract.name, contract), "user_id")]


@pytest.fixture(scope="module")
def service(spark, tmp_path_factory):
    """One run, a rerun of the same data, and a run in which user 1 turns heavy and 9 joins."""
    service = Service(spark, tmp_path_factory.mktemp("service"))
    service.written = [
        [b.rows for b in service.run(RUN1, 9)], [b.rows for b in service.run(RUN2, 9)],
        [b.rows for b in service.run(RUN3, 12, True)]]
    return service


def test_second_run_adds_nothing(service):
    assert service.written[0] == [0, 8, 8, 0, 8, 8]
    assert service.written[1] == [0] * 6


def test_new_users_are_appended_and_known_ones_stay(service):
    assert service.written[2] == [1, 1, 0, 1, 1, 0]
    assert service.ids(SUPER_USERS) == [1] and service.ids(CLUSTERS) == list(range(1, 10))


def test_replica_equals_mart(service):
    for contract in MARTS.values():
        local, remote = service.mart.read(contract.name), service.replica.read(contract.name)
        assert values(local) == values(remote)
        assert local.columns == contract.columns


def test_series_rows_are_weeks_times_clusters(service):
    rows = service.mart.read(TIMESERIES.name).collect()
    assert len(rows) == len({(r.week_start, r.cluster) for r in rows}) == 8
    assert sum(r.vote_cnt for r in rows) == 9 + 12
    assert sum(r.revenue for r in rows) == 1900
    assert sum(r.point_burn for r in rows) == 5  # movements without a vote never got loaded


def test_model_is_kept_between_runs(service):
    assert len(service.mart.commits(MODEL_TABLE)) == 1


def test_refresh_moves_a_user(spark, tmp_path):
    service = Service(spark, tmp_path)
    service.run(RUN1, 9)
    service.run(RUN2, 12, refresh=True)
    assert service.ids(SUPER_USERS) == [1] and 1 not in service.ids(CLUSTERS)
    assert service.ids(CLUSTERS, service.replica) == service.ids(CLUSTERS) == list(range(2, 9))
    frequency = dict(values(service.mart.read(SUPER_USERS.name), "user_id", "frequency"))
    assert frequency == {1: 12.0}
    service.run(RUN3, 12, refit=True)
    assert len(service.mart.commits(MODEL_TABLE)) == 2


def test_refit_relabels_leavers_and_rewrites_the_series(spark, tmp_path):
    service = Service(spark, tmp_path)
    service.run(RUN1, 9)
    before = values(service.mart.read(TIMESERIES.name), "week_start", "cluster")
    # User 1 turns Super and user 8 leaves the profile; both were labelled by the first model.
    data = content(spark, 12)
    data["accounts_user"] = data["accounts_user"].where("id <> 8")
    for name in data:
        load_table(spark, replace(TABLES[name], incremental_col=None), Source(data), service.warehouse, RUN2)
    run_activity_mart(spark, service.warehouse, service.mart, service.replica, RUN2, CFG, refit=True)
    model = stored_model(service.mart)
    stored = service.mart.read(CLUSTERS.name, CLUSTERS)
    assert service.ids(CLUSTERS) == list(range(2, 9))
    again = score(stored.drop("cluster"), model)
    assert values(again, "user_id", "cluster") == values(stored, "user_id", "cluster")
    tables = Warehouse(service.warehouse)
    fresh = conform(build_timeseries(tables, build_weeks(tables, CFG), service.mart, CFG), TIMESERIES)
    assert values(service.mart.read(TIMESERIES.name, TIMESERIES)) == values(fresh)
    assert before and values(service.replica.read(TIMESERIES.name, TIMESERIES)) == values(fresh)


def test_profile_of_weeks_equals_the_profile_of_facts(spark, tmp_path):
    service = Service(spark, tmp_path)
    data = content(spark, 12, True)
    for name in data:
        load_table(spark, replace(TABLES[name], incremental_col=None), Source(data), service.warehouse, RUN1)
    tables = Warehouse(service.warehouse)
    direct = user_profile(
        clean_users(tables.users, CFG), tables.votes, tables.payments, tables.blocks, tables.points, CFG)
    assert values(build_profile(tables, build_weeks(tables, CFG), CFG)) == values(direct)


def test_a_sync_without_news_reads_no_mart(spark, tmp_path):
    service = Service(spark, tmp_path)
    row = "select {} as user_id, 0 as friend_cnt, 1D as recency, 1D as frequency, 0D as monetary, 0 as block_cnt, 1 as cluster"
    append_new(service.mart, CLUSTERS, spark.sql(row.format(1)), "b0")
    assert [b.rows for b in sync_replica(service.mart, service.replica, "s0", [CLUSTERS])] == [1]
    files, location = hadoop_path(spark, f"{service.mart.root}/{CLUSTERS.name}/gen-0/batch-b0")
    files.delete(location, True)  # what the replica holds is never read again
    assert [b.committed for b in sync_replica(service.mart, service.replica, "s1", [CLUSTERS])] == [False]
    service.mart.append(CLUSTERS.name, conform(spark.sql(row.format(1) + " union all " + row.format(2)), CLUSTERS), "b1")
    assert [b.rows for b in sync_replica(service.mart, service.replica, "s2", [CLUSTERS])] == [1]
    assert service.ids(CLUSTERS, service.replica) == [1, 2]
    service.mart.replace(CLUSTERS.name, conform(spark.sql(row.format(3)), CLUSTERS), "b2")
    # A rewritten mart holds other values under known keys, or has lost some: the replica follows it.
    sync_replica(service.mart, service.replica, "s3", [CLUSTERS])
    assert service.ids(CLUSTERS, service.replica) == [3]
    relabelled = conform(spark.sql(row.format(3)).withColumn("cluster", F.lit(5)), CLUSTERS)
    service.mart.replace(CLUSTERS.name, relabelled, "b3")
    service.mart.append(CLUSTERS.name, conform(spark.sql(row.format(4)), CLUSTERS), "b4")
    sync_replica(service.mart, service.replica, "s4", [CLUSTERS])
    assert values(service.replica.read(CLUSTERS.name), "user_id", "cluster") == [(3, 5), (4, 1)]
    assert [b.committed for b in sync_replica(service.mart, service.replica, "s5", [CLUSTERS])] == [False]
    sync_replica(service.mart, service.replica, "s6", [CLUSTERS], refresh=True)
    assert service.ids(CLUSTERS, service.replica) == [3, 4]


def test_unreadable_text_is_counted_or_stops_the_run(spark, tmp_path):
    service = Service(spark, tmp_path)
    service.run(RUN1, 9)
    assert {r.n_values for r in service.mart.read(TEXT_FAULTS).collect()} == {0}
    data = content(spark, 9)
    data["accounts_attendance"] = table(spark, ATTENDANCE, (1, 5, "['2023-06-07'"), (2, 6, "['7 June']"))
    load_table(spark, replace(TABLES["accounts_attendance"], incremental_col=None), Source(data), service.warehouse, RUN2)
    run_activity_mart(spark, service.warehouse, service.mart, None, RUN2, CFG)
    counted = service.mart.read(TEXT_FAULTS).where("n_values > 0")
    assert values(counted, "source", "fault", "n_values") == [
        ("accounts_attendance", "date", 1), ("accounts_attendance", "list", 1)]
    with pytest.raises(PySparkException, match="broken list text"):
        run_activity_mart(spark, service.warehouse, service.mart, None, RUN3, CFG, strict=True, refresh=True)


def test_first_run_needs_no_tables(spark, store, tmp_path):
    assert [b.rows for b in sync_replica(store, TableStore(spark, str(tmp_path / "r")), "b0")] == [0, 0, 0]


def test_append_new_checks_the_contract(spark, store):
    df = table(spark, "user_id:bigint friend_cnt:int recency:double frequency:double monetary:double block_cnt:int"
                      " cluster:int", (1, None, 2.0, None, None, None, 3))
    append_new(store, CLUSTERS, df, "b0")
    assert values(store.read(CLUSTERS.name)) == [(1, 0, 2.0, 0.0, 0.0, 0, 3)]
    assert append_new(store, CLUSTERS, df, "b1").rows == 0


def test_a_repeated_key_is_not_committed(spark, store):
    row = (1, 0, 2.0, 0.0, 0.0, 0, 3)
    columns = ("user_id:bigint friend_cnt:int recency:double frequency:double monetary:double block_cnt:int"
               " cluster:int")
    with pytest.raises(DuplicateKey):
        append_new(store, CLUSTERS, table(spark, columns, row, row), "b0")
    assert not store.exists(CLUSTERS.name)


def test_scratch_data_is_gone_afterwards(spark):
    with written_once(table(spark, "x:int", (1,), (2,)), "test") as df:
        path = df.inputFiles()[0].rsplit("/", 1)[0]
        files, location = hadoop_path(spark, path)
        assert df.count() == 2 and files.exists(location)
    assert not files.exists(location)
