"""The vote stream: late rows, restarts and crashes; equal to the batch job on the same rows."""

from datetime import date

import pytest
from helpers import EVENT, table, values
from pyspark.errors import StreamingQueryException

from cohortmill.config import AnalysisWindow, MartConfig
from cohortmill.operators import timeseries
from cohortmill.streaming import current_votes, run_vote_stream
from cohortmill.streaming.votes import USER_WEEKS, vote_weeks

CFG = MartConfig(window=AnalysisWindow(date(2024, 1, 3), date(2024, 2, 29)))
FIRST = [(1, 1, "2024-01-08 00:00:00"), (2, 1, "2024-01-14 23:59:59"), (3, 1, "2024-01-15"), (4, None, "2024-01-15"),
         (5, 2, None), (6, 2, "2023-12-31"), (7, 2, "2024-01-24"), (7, 2, "2024-01-24")]


@pytest.fixture
def landed(spark, tmp_path):
    path = str(tmp_path / "landing")

    class Landing:
        @staticmethod
        def add(*rows):
            table(spark, EVENT, *rows).coalesce(1).write.mode("append").parquet(path)

        @staticmethod
        def stream():
            return spark.readStream.schema(spark.read.parquet(path).schema).parquet(path)

    return Landing


def weeks(store):
    return sorted((u, str(w), n) for u, w, n in values(current_votes(store), "user_id", "week_start", "votes"))


def test_open_weeks_are_corrected_and_closed_ones_are_not(spark, store, landed, tmp_path):
    checkpoint = str(tmp_path / "checkpoint")
    landed.add(*FIRST)
    run_vote_stream(landed.stream(), store, checkpoint, CFG)
    first = [(1, "2024-01-08", 2), (1, "2024-01-15", 1), (2, "2024-01-22", 2)]
    assert weeks(store) == first
    # The watermark stands at 17 January: the week of the 8th is closed, that of the 15th is open.
    landed.add((8, 1, "2024-01-09"), (9, 1, "2024-01-16"), (10, 3, "2024-02-20"))
    run_vote_stream(landed.stream(), store, checkpoint, CFG)
    second = [(1, "2024-01-08", 2), (1, "2024-01-15", 2), (2, "2024-01-22", 2), (3, "2024-02-19", 1)]
    assert weeks(store) == second
    # Without anything new nothing changes.
    run_vote_stream(landed.stream(), store, checkpoint, CFG)
    assert weeks(store) == second


def test_equal_to_the_batch_job(spark, store, landed, tmp_path):
    landed.add(*FIRST)
    run_vote_stream(landed.stream(), store, str(tmp_path / "checkpoint"), CFG)
    batch = timeseries.user_weeks(CFG, votes=table(spark, EVENT, *FIRST), points=table(
        spark, EVENT + " delta_point:bigint")).select("user_id", "week_start", "votes", "last_vote")
    assert values(current_votes(store)) == values(batch)
    assert values(vote_weeks(table(spark, EVENT, *FIRST), CFG)) == values(batch)


def test_a_crash_behind_the_write_counts_nothing_twice(spark, store, landed, tmp_path, monkeypatch):
    checkpoint = str(tmp_path / "checkpoint")
    landed.add(*FIRST)
    write = store.append

    def dies(*args, **kwargs):
        write(*args, **kwargs)
        raise RuntimeError("lost after the write")

    monkeypatch.setattr(store, "append", dies)
    with pytest.raises(StreamingQueryException):
        run_vote_stream(landed.stream(), store, checkpoint, CFG)
    monkeypatch.undo()
    found = weeks(store)
    run_vote_stream(landed.stream(), store, checkpoint, CFG)
    assert weeks(store) == found == [(1, "2024-01-08", 2), (1, "2024-01-15", 1), (2, "2024-01-22", 2)]
    rows = store.read(USER_WEEKS)
    assert rows.count() == rows.select("user_id", "week_start", "version").distinct().count()


def test_a_crash_before_the_write_loses_nothing(spark, store, landed, tmp_path, monkeypatch):
    checkpoint = str(tmp_path / "checkpoint")
    landed.add(*FIRST)

    def dies(*args, **kwargs):
        raise RuntimeError("lost before the write")

    monkeypatch.setattr(store, "append", dies)
    with pytest.raises(StreamingQueryException):
        run_vote_stream(landed.stream(), store, checkpoint, CFG)
    monkeypatch.undo()
    run_vote_stream(landed.stream(), store, checkpoint, CFG)
    assert weeks(store) == [(1, "2024-01-08", 2), (1, "2024-01-15", 1), (2, "2024-01-22", 2)]
