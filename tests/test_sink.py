"""Only what is sent to a database, and in which order, is checked here; none is started."""

import pytest
from helpers import values

from cohortmill.plans.publish import publish
from cohortmill.schemas import CLUSTERS, SUPER_USERS, TIMESERIES, conform
from cohortmill.sources.sink import JdbcSink


class Recorder(JdbcSink):
    """Keeps what would be sent; its log holds the batches whose transaction was run."""

    def __init__(self, spark, fail=()):
        super().__init__(spark, "jdbc:mysql://host/replica", self.ran)
        object.__setattr__(self, "held", {})
        object.__setattr__(self, "events", [])
        object.__setattr__(self, "fail", list(fail))

    def batches(self, contract):
        return set(self.held.get(contract.name, ()))

    def stage(self, contract, rows):
        self.events.append(("stage", contract.name, sorted(r[0] for r in rows.select(contract.key[0]).collect())))

    def ran(self, statements):
        if self.fail:
            raise self.fail.pop()
        self.events.append(("run", list(statements)))
        table, batch = statements[0].split("VALUES ('")[1].rstrip("')").split("', '")
        self.held.setdefault(table, []).append(batch)


def users(spark, *ids):
    rows = spark.createDataFrame([(i, "super", "M", 1, 2.0, 3.0, 4.0, 5.0, 0) for i in ids], ", ".join(
        f"{f.name} {f.dataType.simpleString()}" for f in SUPER_USERS.schema))
    return conform(rows, SUPER_USERS)


def test_options():
    sink = JdbcSink(None, "jdbc:mysql://host/replica", print, {"user": "u"}, batch_size=500, partitions=4)
    got = sink.options("t")
    assert (got["dbtable"], got["batchsize"], got["numPartitions"], got["user"]) == ("t", "500", "4", "u")
    assert got["isolationLevel"] == "READ_COMMITTED" and got["rewriteBatchedStatements"] == "true"
    assert JdbcSink.column_types(SUPER_USERS) == "user_type VARCHAR(10), gender VARCHAR(5)"
    assert "rewriteBatchedStatements" not in JdbcSink(None, "jdbc:postgresql://host/replica", print).options("t")


def test_rows_are_staged_before_one_transaction_notes_and_moves_them(spark):
    sink = Recorder(spark)
    assert sink.write(SUPER_USERS, users(spark, 1, 2), "run-1")
    staged, (kind, statements) = sink.events
    assert staged == ("stage", SUPER_USERS.name, [1, 2]) and kind == "run"
    assert statements[0].endswith(f"VALUES ('{SUPER_USERS.name}', 'run-1')")
    assert statements[1].startswith(f"INSERT INTO {SUPER_USERS.name} (user_id, ") and len(statements) == 2
    assert not sink.write(SUPER_USERS, users(spark, 1, 2), "run-1") and len(sink.events) == 2


@pytest.mark.parametrize("contract", [SUPER_USERS, TIMESERIES])
def test_the_query_takes_rows_with_a_new_key_only(spark, contract):
    def frame(*keys):
        return spark.createDataFrame([(k,) for k in keys], "k int").selectExpr(*[
            f"cast({'k' if f.name in contract.key and f.dataType.typeName() != 'date' else 'null'} as {f.dataType.simpleString()}) as {f.name}"
            if f.dataType.typeName() != "date" else f"date'2024-01-01' + k as {f.name}" for f in contract.schema])

    frame(1, 2, 3).createOrReplaceTempView(contract.name)
    frame(2, 3, 4, 5).createOrReplaceTempView(JdbcSink.staging(contract))
    sink = JdbcSink(spark, "jdbc:mysql://host/replica", print)
    taken = spark.sql(sink.rows_query(contract))
    assert taken.columns == contract.columns
    assert values(taken) == values(frame(4, 5))
    assert spark.sql(sink.rows_query(contract, replace=True)).count() == 4
    frame().createOrReplaceTempView(contract.name)
    assert spark.sql(sink.rows_query(contract)).count() == 4


def test_publish_sends_what_the_database_lacks(spark, store):
    sink, only = Recorder(spark), [SUPER_USERS]
    assert publish(store, sink, only) == {SUPER_USERS.name: "none"} and not sink.events
    store.append(SUPER_USERS.name, users(spark, 1, 2), "b0")
    assert publish(store, sink, only) == {SUPER_USERS.name: "replace"}
    assert sink.events[0][2] == [1, 2] and any(s.startswith("DELETE") for s in sink.events[1][1])
    store.append(SUPER_USERS.name, users(spark, 3), "b1")
    store.append(SUPER_USERS.name, users(spark, 4), "b2")
    assert publish(store, sink, only) == {SUPER_USERS.name: "append"}
    assert sink.events[2][2] == [3, 4] and not any(s.startswith("DELETE") for s in sink.events[3][1])
    assert publish(store, sink, only) == {SUPER_USERS.name: "none"} and len(sink.events) == 4
    store.replace(SUPER_USERS.name, users(spark, 1, 4), "b3")
    assert publish(store, sink, only) == {SUPER_USERS.name: "replace"} and sink.events[4][2] == [1, 4]


def test_a_crash_before_the_transaction_is_retried_whole(spark, store):
    sink = Recorder(spark, fail=[RuntimeError("lost")])
    store.append(SUPER_USERS.name, users(spark, 1), "b0")
    with pytest.raises(RuntimeError):
        publish(store, sink, [SUPER_USERS])
    assert not sink.held
    publish(store, sink, [SUPER_USERS])
    assert [e[0] for e in sink.events] == ["stage", "stage", "run"] and sink.held == {SUPER_USERS.name: ["b0"]}


def test_all_marts_have_a_staging_table_of_their_own():
    assert len({JdbcSink.staging(c) for c in (SUPER_USERS, CLUSTERS, TIMESERIES)}) == 3
