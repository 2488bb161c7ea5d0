from dataclasses import dataclass, field
from datetime import datetime, timedelta

import pytest
from helpers import EVENT, at, table, user, users, values

from cohortmill import STAGES, TABLES, TableConfig, load_table, load_warehouse
from cohortmill.plans.load import FULL, INCREMENTAL, SKIPPED, LoadOptions, choose_mode
from cohortmill.session import hadoop_path
from cohortmill.sources import TableStore

DAY1, DAY2, DAY3 = datetime(2024, 1, 1), datetime(2024, 1, 2), datetime(2024, 1, 3)
KEYED = TableConfig("facts", "created_at", "id")
KEYLESS = TableConfig("facts", "created_at", None)
WHOLE = TableConfig("facts", None, "id")


@dataclass
class Tables:
    """A source whose tables the test can change between runs."""

    content: dict = field(default_factory=dict)
    order: list = field(default_factory=list)

    def table(self, cfg, after=None):
        self.order.append(cfg.name)
        return self.content[cfg.name]


def facts(spark, *pairs):
    return table(spark, EVENT, *((i, 1, t) for i, t in pairs))


def ids(store):
    return [r[0] for r in values(store.read("raw_facts"), "id")]


def runner(spark, store, cfg, **options):
    source = Tables()

    def run(df, mark, batch=None):
        source.content["facts"] = df
        return load_table(spark, cfg, source, store, mark, batch=batch, options=LoadOptions(**options))

    return run


def test_registry():
    assert len(TABLES) == 25
    assert sum(c.incremental_col is not None for c in TABLES.values()) == 14
    assert sum(c.pk is None for c in TABLES.values()) == 5
    assert [len(s) for s in STAGES.values()] == [6, 12, 5, 2]
    assert sum(c.fetch_size == 5000 for c in TABLES.values()) == 2


def test_mode():
    assert choose_mode(KEYED, None) == FULL and choose_mode(KEYED, DAY1) == INCREMENTAL
    assert choose_mode(WHOLE, DAY1) == FULL


def test_incremental_is_strict_to_the_microsecond(spark, store):
    run = runner(spark, store, KEYED)
    assert run(facts(spark, (1, "2023-12-31")), DAY1).mode == FULL
    got = run(facts(spark, (1, "2023-12-31"), (2, "2024-01-01"), (3, "2024-01-01 00:00:00.000001")), DAY2)
    assert (got.mode, got.rows) == (INCREMENTAL, 1) and ids(store) == [1, 3]


def test_rerun(spark, store):
    run = runner(spark, store, KEYED)
    df = facts(spark, (1, "2023-12-31"), (2, "2024-01-01 12:00:00"))
    run(df, DAY1)
    assert run(df, DAY1).mode == SKIPPED and ids(store) == [1, 2]
    assert run(df, DAY1, batch="again").rows == 0 and ids(store) == [1, 2]


def test_keyless_overlap(spark, store):
    run = runner(spark, store, KEYLESS)
    df = facts(spark, (1, "2023-12-31"), (2, "2024-01-01 12:00:00"))
    run(df, DAY1)
    run(df, DAY2)
    assert ids(store) == [1, 2, 2]


def test_keyless_without_overlap(spark, store):
    run = runner(spark, store, KEYLESS, upper_bound=True)
    df = facts(spark, (1, "2023-12-31"), (2, "2024-01-01 12:00:00"), (3, None))
    run(df, DAY1)
    run(df, DAY2)
    assert ids(store) == [1, 2, 3]


def test_late_rows_need_a_lookback(spark, tmp_path):
    from cohortmill.sources import TableStore

    for name, lookback, expected in [("none", timedelta(0), [1]), ("day", timedelta(days=1), [1, 2])]:
        store = TableStore(spark, str(tmp_path / name))
        run = runner(spark, store, KEYED, lookback=lookback)
        run(facts(spark, (1, "2023-12-31")), DAY1)
        run(facts(spark, (1, "2023-12-31"), (2, "2023-12-31 20:00:00")), DAY2)
        assert ids(store) == expected


def test_duplicates_inside_a_batch(spark, tmp_path):
    from cohortmill.sources import TableStore

    for name, dedupe, expected in [("keep", False, [1, 2, 2]), ("drop", True, [1, 2])]:
        store = TableStore(spark, str(tmp_path / name))
        run = runner(spark, store, KEYED, dedupe_batch=dedupe)
        run(facts(spark, (1, "2023-12-31")), DAY1)
        run(facts(spark, (2, "2024-01-01 01:00:00"), (2, "2024-01-01 02:00:00")), DAY2)
        assert ids(store) == expected


def test_changed_rows_are_not_recaptured(spark, store):
    run = runner(spark, store, KEYED)
    run(facts(spark, (1, "2023-12-31")), DAY1)
    assert run(facts(spark, (1, "2024-01-01 12:00:00")), DAY2).rows == 0


def test_null_keys_match(spark, store):
    run = runner(spark, store, KEYED)
    run(facts(spark, (None, "2023-12-31"), (1, "2023-12-31")), DAY1)
    assert run(facts(spark, (None, "2024-01-01 12:00:00"), (2, "2024-01-01 12:00:00")), DAY2).rows == 1
    assert ids(store) == [1, 2, None]


def test_only_null_keys_in_the_batch(spark, store):
    run = runner(spark, store, KEYED)
    run(facts(spark, (1, "2023-12-31")), DAY1)
    assert run(facts(spark, (None, "2024-01-01 12:00:00")), DAY2).rows == 1
    assert run(facts(spark, (None, "2024-01-02 12:00:00")), DAY3).rows == 0


def test_empty_source(spark, store):
    run = runner(spark, store, WHOLE)
    run(facts(spark, (1, "2023-12-31")), DAY1)
    assert run(facts(spark, (1, "2023-12-31")).limit(0), DAY2).rows == 0
    assert ids(store) == [] and store.last_synced_at("raw_facts") == DAY2


def test_empty_source_can_keep_the_target(spark, store):
    run = runner(spark, store, WHOLE, keep_on_empty=True)
    run(facts(spark, (1, "2023-12-31")), DAY1)
    run(facts(spark, (1, "2023-12-31")).limit(0), DAY2)
    assert ids(store) == [1] and store.last_synced_at("raw_facts") == DAY2


def test_empty_increment_moves_the_mark(spark, store):
    run = runner(spark, store, KEYED)
    df = facts(spark, (1, "2023-12-31"))
    run(df, DAY1)
    assert run(df, DAY2).rows == 0
    assert store.last_synced_at("raw_facts") == DAY2 and ids(store) == [1]


def test_full_load_drops_vanished_rows(spark, store):
    run = runner(spark, store, WHOLE)
    run(facts(spark, (1, "2023-12-31"), (2, "2023-12-31")), DAY1)
    run(facts(spark, (2, "2023-12-31")), DAY2)
    assert ids(store) == [2]


def test_daily_full_loads_leave_two_generations(spark, store):
    run = runner(spark, store, WHOLE)
    for day in range(1, 5):
        run(facts(spark, (day, "2023-12-31")), datetime(2024, 1, day))
    assert ids(store) == [4] and store.last_synced_at("raw_facts") == datetime(2024, 1, 4)
    files, folder = hadoop_path(spark, f"{store.root}/raw_facts")
    assert sorted(s.getPath().getName() for s in files.listStatus(folder)) == ["gen-2", "gen-3"]


def test_many_small_batches_are_folded(spark, store):
    run = runner(spark, store, KEYED, compact_after=2)
    for day in range(1, 6):
        run(facts(spark, (day, f"2024-01-0{day} 01:00:00")), datetime(2024, 1, day, 2))
    assert ids(store) == [1, 2, 3, 4, 5] and len(store.live("raw_facts")) <= 3
    assert values(store.sync_state(), "row_count") == [(1,)]
    assert run(facts(spark, (5, "2024-01-05 01:00:00")), datetime(2024, 1, 5, 2)).mode == SKIPPED


def test_the_log_is_read_once(spark, store):
    run = runner(spark, store, KEYED)
    run(facts(spark, (1, "2023-12-31")), DAY1)
    other = TableStore(spark, store.root)
    assert other.commits("raw_facts") == store.commits("raw_facts")
    run(facts(spark, (2, "2024-01-01 12:00:00")), DAY2)
    assert other.commits("raw_facts") == store.commits("raw_facts") and len(other.commits("raw_facts")) == 2


def test_cleaning_rule_is_applied(spark, store):
    source = Tables({"accounts_user": users(spark, user(1), user(2, gender=None))})
    load_table(spark, TABLES["accounts_user"], source, store, DAY1)
    assert values(store.read("raw_accounts_user"), "id") == [(1,)]


def test_own_cleaning_rule(spark, store):
    cfg = TableConfig("facts", "created_at", "id", cleaning="odd")
    source = Tables({"facts": facts(spark, (1, "2023-12-31"), (2, "2023-12-31"))})
    load_table(spark, cfg, source, store, DAY1, cleaning={"odd": lambda df: df.where("id % 2 = 1")})
    assert ids(store) == [1]


def test_a_repeated_stored_key_does_not_multiply_rows(spark, store):
    run = runner(spark, store, KEYED)
    run(facts(spark, *[(7, "2023-12-31")] * 50, (8, "2023-12-31")), DAY1)
    got = run(facts(spark, (7, "2024-01-01 12:00:00"), (9, "2024-01-01 12:00:00")), DAY2)
    assert got.rows == 1 and ids(store).count(7) == 50


def test_warehouse_keeps_stage_order(spark, store):
    stages = {
        "reference": [TableConfig("a"), TableConfig("b")],
        "large": [TableConfig("c", "created_at", "id"), TableConfig("d", "created_at")],
    }
    source = Tables({name: facts(spark, (1, "2023-12-31")) for name in "abcd"})
    got = load_warehouse(spark, source, store, DAY1, stages=stages)
    assert [(r.table, r.rows, r.mode) for r in got] == [(n, 1, FULL) for n in "abcd"]
    assert sorted(source.order[:2]) == ["a", "b"] and source.order[2:] == ["c", "d"]
    again = load_warehouse(spark, source, store, at("2024-01-02"), stages=stages)
    assert [(r.rows, r.mode) for r in again] == [(1, FULL)] * 2 + [(0, INCREMENTAL)] * 2


def test_a_failed_table_stops_after_its_stage_and_the_rest_is_kept(spark, store):
    stages = {"reference": [TableConfig("a"), TableConfig("b")], "large": [TableConfig("c")]}
    source = Tables({"a": facts(spark, (1, "2023-12-31")), "c": facts(spark, (1, "2023-12-31"))})
    with pytest.raises(KeyError):
        load_warehouse(spark, source, store, DAY1, stages=stages)
    assert not store.exists("raw_c")
    source.content["b"] = facts(spark, (1, "2023-12-31"))
    modes = [r.mode for r in load_warehouse(spark, source, store, DAY1, stages=stages)]
    assert modes[0] in (SKIPPED, FULL) and modes[1:] == [FULL, FULL]
