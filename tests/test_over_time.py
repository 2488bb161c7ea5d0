"""Sessions, as-of joins, statuses, spans, rankings and cubes on small tables with every odd case."""

import random

from datetime import date, timedelta

import pytest
from helpers import table, values
from pyspark.sql import functions as F

from cohortmill.config import AnalysisWindow, MartConfig
from cohortmill.operators import asof, rankings, rollups, sessions, sketches, transitions

CFG = MartConfig(window=AnalysisWindow(date(2024, 1, 1), date(2024, 2, 4)), targets=(1, 2))
MONDAYS = [date(2024, 1, 1) + timedelta(days=7 * i) for i in range(5)]
EVENTS = "user_id:bigint ts:timestamp n:int"


def ordered(*rows):
    return sorted(rows, key=str)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


# ---- sessions --------------------------------------------------------------------------


def test_sessions_over_midnight_and_at_the_very_gap(spark):
    events = table(
        spark, EVENTS, (1, "2024-01-01 23:40:00", 1), (1, "2024-01-02 00:10:00", 2), (1, "2024-01-02 00:40:00", 4),
        (1, "2024-01-02 01:10:00.000001", 8), (2, "2024-01-02 00:10:00", 16), (2, "2024-01-02 00:10:00", 16),
        (None, "2024-01-02 00:10:00", 1), (3, None, 1), (4, "2024-01-01 23:59:59", 32), (4, "2024-01-03 00:00:00", 64))
    found = sessions.user_sessions(events, measures={"sum": F.col("n")})
    assert values(found, "user_id", "started_at", "ended_at", "n_events", "sum") == [
        (1, "2024-01-01 23:40:00", "2024-01-02 00:40:00", 3, 7),
        (1, "2024-01-02 01:10:00.000001", "2024-01-02 01:10:00.000001", 1, 8),
        (2, "2024-01-02 00:10:00", "2024-01-02 00:10:00", 2, 32),
        (4, "2024-01-01 23:59:59", "2024-01-01 23:59:59", 1, 32),
        (4, "2024-01-03 00:00:00", "2024-01-03 00:00:00", 1, 64)]
    assert values(sessions.daily_sessions(found), "day", "sessions", "users", "events", "over_midnight") == [
        (date(2024, 1, 1), 2, 2, 4, 1), (date(2024, 1, 2), 2, 2, 3, 0), (date(2024, 1, 3), 1, 1, 1, 0)]
    assert sessions.user_sessions(events.limit(0)).count() == 0


def test_a_session_of_several_days(spark):
    rows = [(1, f"2024-01-{2 + m // 1440:02d} {m // 60 % 24:02d}:{m % 60:02d}:00", 1) for m in range(0, 3 * 1440, 20)]
    (session,) = sessions.user_sessions(table(spark, EVENTS, *rows)).collect()
    assert session.n_events == 216 and session.seconds == (215 * 20) * 60


def test_a_hot_user_is_dealt_by_day_and_merged_before_the_shuffle(spark):
    text = plan(sessions.user_sessions(table(spark, EVENTS, (1, "2024-01-01", 1))))
    assert "hashpartitioning(user_id" in text and "MergingSessions" in text
    assert text.count("Exchange hashpartitioning") == 2


# ---- as-of -----------------------------------------------------------------------------

SIDE = "id:bigint user_id:bigint created_at:timestamp"


def plain_as_of(left, right, allow_exact):
    out = []
    for id, user, at in left:
        fits = [(t, i) for i, u, t in right if user is not None and at is not None and t is not None and u == user
                and (t < at or allow_exact and t == at)]
        out.append((id, max(fits)[1] if fits else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("allow_exact", [False, True])
@pytest.mark.parametrize("span", ["hour", "day", "month"])
def test_as_of_equals_a_search(spark, allow_exact, span):
    draw = random.Random(7)

    def side(n):
        return [(i, draw.choice([1, 1, 1, 2, 3, None]),
                 draw.choice([None, *(f"2024-01-{draw.randint(1, 28):02d} {draw.randint(0, 3):02d}:00:00" for _ in range(9))]))
                for i in range(n)]

    left, right = side(120), side(40)
    left.append(left[0])
    got = asof.as_of(table(spark, SIDE, *left), table(spark, SIDE, *right), "user_id", "created_at", "created_at", "id",
                     span=span, allow_exact=allow_exact)
    assert values(got.select(F.col("l.id").alias("l"), F.col("r.id").alias("r"))) == plain_as_of(left, right, allow_exact)


def test_as_of_of_empty_sides(spark):
    one, none = table(spark, SIDE, (1, 1, "2024-01-01")), table(spark, SIDE)
    assert values(asof.payments_after_votes(one, none), "payment_id", "vote_id") == [(1, None)]
    assert asof.payments_after_votes(none, one).count() == 0


def test_as_of_has_no_join(spark):
    one = table(spark, SIDE, (1, 1, "2024-01-01"))
    text = plan(asof.payments_after_votes(one, one))
    assert "Join" not in text and "CartesianProduct" not in text


# ---- statuses --------------------------------------------------------------------------


def test_stays_end_with_a_change_or_a_missing_week(spark):
    rows = [(1, MONDAYS[i], s) for i, s in ((0, "Exit"), (1, "Exit"), (2, "Safe"), (4, "Safe"))]
    rows += [(2, MONDAYS[0], None), (2, MONDAYS[1], None), (2, MONDAYS[2], "Exit")]
    series = table(spark, "cluster:tinyint week_start:date war_status:string", *rows)
    history = transitions.stays(series, ("war_status",))
    assert values(history, "cluster", "number", "status", "came_from", "since", "until", "weeks") == ordered(
        (1, 1, "Exit", None, MONDAYS[0], MONDAYS[2], 2), (1, 2, "Safe", "Exit", MONDAYS[2], MONDAYS[3], 1),
        (1, 3, "Safe", "Safe", MONDAYS[4], date(2024, 2, 5), 1), (2, 1, None, None, MONDAYS[0], MONDAYS[2], 2),
        (2, 2, "Exit", None, MONDAYS[2], MONDAYS[3], 1))
    assert values(transitions.time_in_status(history), "cluster", "status", "stays", "weeks", "longest") == ordered(
        (1, "Exit", 1, 2, 2), (1, "Safe", 2, 2, 1), (2, None, 1, 2, 2), (2, "Exit", 1, 1, 1))
    assert transitions.stays(series.limit(0), ("war_status",)).count() == 0


# ---- spans -----------------------------------------------------------------------------


def plain_spans(rows):
    out = []
    for c in {c for _, c, _ in rows}:
        for i, a in enumerate(MONDAYS):
            for z in MONDAYS[i:]:
                users = {u for w, k, u in rows if k == c and a <= w <= z}
                if users:
                    out.append((a, z, c, len(users)))
    return sorted(out, key=str)


def test_spans_exactly_and_from_sketches(spark):
    draw = random.Random(1)
    rows = sorted({(draw.choice(MONDAYS), 1 + u % 2, u) for u in range(60) for _ in range(draw.randint(1, 4))})
    active = table(spark, "week_start:date cluster:tinyint user_id:bigint", *rows)
    exact = sketches.exact_spans(active, CFG)
    assert values(exact, "span_start", "span_end", "cluster", "active_users") == plain_spans(rows)
    found = sketches.compared(sketches.sketched_spans(sketches.weekly_sketches(active), CFG), exact)
    assert values(found, "span_start", "span_end", "cluster", "active_users") == plain_spans(rows)
    assert {r.close for r in found.collect()} == {True}
    assert sketches.exact_spans(active.limit(0), CFG).count() == 0


def test_error_of_sketches_and_a_lost_week(spark):
    """Of 300,000 users, half a week's worth at a time, all estimates are within three deviations."""
    active = spark.range(300_000).select(
        F.explode(F.array(*map(F.lit, MONDAYS))).alias("week_start"), F.lit(1).cast("tinyint").alias("cluster"),
        F.col("id").alias("user_id")).where("xxhash64(user_id, week_start) % 2 = 0")
    stored, exact = sketches.weekly_sketches(active), sketches.exact_spans(active, CFG)
    both = exact.join(sketches.sketched_spans(stored, CFG), ["span_start", "span_end", "cluster"]).collect()
    assert len(both) == 15
    errors = [abs(r.estimate / r.active_users - 1) for r in both]
    assert 0 < max(errors) < 3 * sketches.RELATIVE_ERROR
    lost = stored.where(F.col("week_start") != F.lit(MONDAYS[2]))
    close = {r.close for r in sketches.compared(sketches.sketched_spans(lost, CFG), exact).collect()}
    assert close == {True, False}


# ---- rankings and cubes ----------------------------------------------------------------

WEEKS = "user_id:bigint week_start:date votes:bigint revenue:bigint last_act:timestamp"
MAP = "user_id:bigint cluster:int"


def test_top_voters_and_ties(spark):
    weeks = table(spark, WEEKS, *((u, MONDAYS[0], v, 0, None) for u, v in ((5, 3), (4, 3), (3, 9), (2, 1), (1, 3), (6, 0), (9, 99))))
    people = table(spark, MAP, *((u, 1) for u in range(1, 7)), (9, 7))
    assert values(rankings.top_voters(weeks, people, CFG, 3), "place", "user_id", "votes", "rank") == [
        (1, 3, 9, 1), (2, 1, 3, 2), (3, 4, 3, 2)]
    assert "WindowGroupLimit" in plan(rankings.top_voters(weeks, people, CFG, 3))


def test_changes_need_the_week_before(spark):
    series = table(spark, "week_start:date cluster:tinyint active_users:int vote_cnt:int revenue:bigint",
                   (MONDAYS[0], 1, 4, 0, 10), (MONDAYS[1], 1, 5, 3, 0), (MONDAYS[3], 1, 7, 3, 0))
    assert values(rankings.week_over_week(series), "week_start", "active_users_change", "active_users_change_pct",
                  "vote_cnt_change_pct", "revenue_change") == ordered(
        (MONDAYS[0], None, None, None, None), (MONDAYS[1], 1, 25.0, 0.0, -10), (MONDAYS[3], None, None, None, None))


def test_retention(spark):
    active = table(spark, "week_start:date cluster:tinyint user_id:bigint", (MONDAYS[0], 1, 1), (MONDAYS[1], 1, 1),
                   (MONDAYS[3], 1, 1), (MONDAYS[1], 1, 2))
    assert values(rankings.retention(active), "week_start", "active", "returned", "retained", "new", "retained_pct") == ordered(
        (MONDAYS[0], 1, 0, 1, 1, 100.0), (MONDAYS[1], 2, 1, 0, 1, 0.0), (MONDAYS[3], 1, 0, 0, 0, 0.0))


def test_totals_of_users_are_distinct_and_a_missing_gender_is_no_total(spark):
    seen = "2024-01-01"
    weeks = table(spark, WEEKS, (1, MONDAYS[0], 2, 5, seen), (1, MONDAYS[1], 0, 7, seen), (2, MONDAYS[0], 0, 0, None),
                  (3, MONDAYS[1], 4, 1, seen), (4, MONDAYS[0], 9, 9, seen), (1, date(2023, 12, 25), 50, 50, seen))
    users = table(spark, "user_id:bigint gender:string", (1, "F"), (2, "F"), (3, None), (4, "M"))
    people = table(spark, MAP, (1, 1), (2, 1), (3, 2), (4, 6))
    cube = rollups.kpi_cube(weeks, users, people, CFG)
    cells = {(r.week_start, r.cluster, r.gender, r.all_weeks, r.all_clusters, r.all_genders):
             (r.active_users, r.voters, r.votes, r.revenue) for r in cube.collect()}
    assert cells[None, None, None, True, True, True] == (2, 2, 6, 13)
    assert cells[None, 1, "F", True, False, False] == (1, 1, 2, 12)
    assert cells[None, 2, None, True, False, False] == (1, 1, 4, 1) == cells[None, None, None, True, True, False]
    assert cells[MONDAYS[0], None, None, False, True, True] == (1, 1, 2, 5)
    assert len(cells) == cube.count()
    assert rollups.kpi_cube(weeks.limit(0), users, people, CFG).count() == 0


def test_the_cube_shuffles_no_fact_twice(spark):
    weeks = table(spark, WEEKS, (1, MONDAYS[0], 2, 5, None))
    text = plan(rollups.kpi_cube(weeks, table(spark, "user_id:bigint gender:string", (1, "F")), table(spark, MAP, (1, 1)), CFG))
    assert "Expand" in text and "partial_sum" in text and "distinct" not in text.lower()
