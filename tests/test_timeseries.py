from dataclasses import replace
from datetime import date

import pytest
from helpers import ATTENDANCE, events, payments, points, table, user, users, values

from cohortmill.config import AnalysisWindow, MartConfig
from cohortmill.operators.cleaning import attendance_days, clean_users
from cohortmill.operators.timeseries import (
    activity_timeseries, cumulative_users, dashboard_extract, frame_of, user_weeks, weekly_facts,
)
from cohortmill.schemas import TIMESERIES, conform, duplicate_keys

CFG = replace(MartConfig(), window=AnalysisWindow(date(2023, 5, 27), date(2023, 6, 21)))
W1, W2, W3, W4 = (date(2023, 5, 29), date(2023, 6, 5), date(2023, 6, 12), date(2023, 6, 19))


def cluster_map(spark, *pairs):
    return table(spark, "user_id:bigint cluster:int", *pairs)


def series(spark, *, people=(), clusters=((1, 1),), votes=(), pays=(), moves=(), attended=(), cfg=CFG):
    got = activity_timeseries(
        events(spark, *votes), payments(spark, *pays), points(spark, *moves),
        attendance_days(table(spark, ATTENDANCE, *((u, u, t) for u, t in attended))),
        clean_users(users(spark, *people)), cluster_map(spark, *clusters), cfg)
    return conform(got, TIMESERIES)


def week(df, monday, cluster=1):
    rows = [r for r in df.collect() if r.week_start == monday and r.cluster == cluster]
    assert len(rows) == 1
    return rows[0]


def test_default_frame_has_50_mondays(spark):
    rows = values(frame_of(spark, MartConfig()), "week_label", "cluster")
    assert len(rows) == 150 and len({label for label, _ in rows}) == 50
    assert ("2023-05-29 (W1)", 1) in rows and ("2024-05-06 (W50)", 5) in rows


def test_a_span_without_a_monday_is_empty(spark):
    cfg = replace(CFG, window=AnalysisWindow(date(2023, 5, 30), date(2023, 6, 3)))
    assert frame_of(spark, cfg).count() == 0


def test_partial_first_week_is_dropped_unless_asked_for(spark):
    facts = dict(people=[user(1)], votes=[(1, "2023-05-28")])
    got = series(spark, **facts)
    assert got.count() == 12 and all(r.vote_cnt == 0 for r in got.collect())
    wide = series(spark, **facts, cfg=replace(CFG, include_partial_first_week=True))
    assert week(wide, date(2023, 5, 22)).vote_cnt == 1 and week(wide, W1).week_label.endswith("(W2)")
    assert dashboard_extract(wide, CFG).count() == 12


def test_outlier_week_counts_as_pure_attendance(spark):
    votes = [(1, "2023-05-30")] * 99 + [(2, "2023-05-30")] * 100
    got = series(spark, votes=votes, clusters=[(1, 1), (2, 4)])
    below, above = week(got, W1, 1), week(got, W1, 4)
    assert (below.vote_cnt, below.vote_user_cnt, below.active_users, below.pure_attendance_cnt, below.vpu) == (
        99, 1, 1, 0, 99.0)
    assert (above.vote_cnt, above.vote_user_cnt, above.active_users, above.pure_attendance_cnt, above.vpu) == (
        0, 0, 1, 1, 100.0)
    assert above.votes_per_user == 0.0 and above.vpu_status == "Exit" and below.vpu_status == "Safe"


def test_revenue_maps_products(spark):
    got = series(spark, pays=[(1, "2023-05-30", "heart.200"), (1, "2023-05-31", "heart.4000"), (1, "2023-05-31", "other"),
                              (1, "2023-06-06", None)])
    assert week(got, W1).revenue == 900 + 9900 and week(got, W2).revenue == 0


def test_arpu_needs_active_users(spark):
    got = series(spark, pays=[(1, "2023-05-30", "heart.200")])
    assert week(got, W1).arpu == 0.0 and week(got, W1).active_users == 0


def test_empty_weeks(spark):
    row = week(series(spark), W3)
    assert row.last_act is None
    assert (row.revenue, row.active_users, row.cum_users, row.war, row.vpu) == (0, 0, 0, 0.0, 0.0)
    assert (row.war_status, row.arpu_status, row.vpu_status) == ("Exit",) * 3


def test_points_and_running_totals(spark):
    got = series(spark, moves=[(1, "2023-05-30", 10), (1, "2023-05-30", -4), (1, "2023-06-13", -6)])
    rows = sorted((r for r in got.collect() if r.cluster == 1), key=lambda r: r.week_start)
    assert [r.point_burn for r in rows] == [4, 0, 6, 0]
    assert [r.net_flow for r in rows] == [6, 0, -6, 0]
    assert [r.cumulative_burn for r in rows] == [4, 4, 10, 10]
    assert [r.cumulative_net_flow for r in rows] == [6, 6, 0, 0]


def test_active_is_attendance_or_vote_and_last_act_the_latest(spark):
    got = series(
        spark, clusters=[(1, 1), (2, 1), (3, 1)], votes=[(1, "2023-05-30 08:00:00"), (2, "2023-05-31 09:00:00")],
        attended=[(1, "['2023-06-01', '2023-06-01']"), (3, "[]")], pays=[(3, "2023-06-02", "heart.200")])
    row = week(got, W1)
    assert (row.active_users, row.vote_user_cnt, row.pure_attendance_cnt) == (2, 2, 0)
    assert str(row.last_act) == "2023-06-01 00:00:00"


def test_last_day(spark):
    late = series(spark, votes=[(1, "2023-06-21 00:00:01")])
    assert week(late, W4).active_users == 0
    on_time = series(spark, votes=[(1, "2023-06-21 00:00:00")])
    assert week(on_time, W4).active_users == 1
    attended = series(spark, attended=[(1, "['2023-06-21']")])
    assert week(attended, W4).active_users == 1


def test_only_target_clusters_and_known_users(spark):
    got = series(spark, clusters=[(1, 0), (2, 1)], votes=[(1, "2023-05-30"), (2, "2023-05-30"), (None, "2023-05-30"),
                                                          (9, "2023-05-30")])
    assert {r.cluster for r in got.collect()} == {1, 4, 5} and week(got, W1).vote_cnt == 1


@pytest.mark.parametrize(("created", "cutoff", "counts"), [
    ("2023-06-04 00:00:00", "sunday_start", [1, 1, 1, 1]),
    ("2023-06-04 10:00:00", "sunday_start", [0, 1, 1, 1]),
    ("2023-06-04 10:00:00", "week_end", [1, 1, 1, 1]),
    ("2001-01-01", "sunday_start", [1, 1, 1, 1]),
    ("2023-06-30", "sunday_start", [0, 0, 0, 0]),
])
def test_signup_cutoff(spark, created, cutoff, counts):
    cfg = replace(CFG, signup_cutoff=cutoff)
    people = clean_users(users(spark, user(1, created_at=created)))
    got = cumulative_users(people, cluster_map(spark, (1, 1)), frame_of(spark, cfg), cfg).where("cluster = 1")
    assert [r.cum_users for r in got.orderBy("week_start").collect()] == counts


def test_a_user_listed_twice_counts_once_from_the_first_signup(spark):
    people = clean_users(users(spark, user(1, created_at="2023-06-07"), user(1, created_at="2023-06-14")))
    got = cumulative_users(people, cluster_map(spark, (1, 1)), frame_of(spark, CFG), CFG).where("cluster = 1")
    assert [r.cum_users for r in got.orderBy("week_start").collect()] == [0, 1, 1, 1]


def test_war_can_exceed_100_and_unclean_users_stay_active(spark):
    got = series(spark, people=[user(1)], clusters=[(1, 1), (2, 1)], votes=[(1, "2023-05-30"), (2, "2023-05-30")])
    assert week(got, W1).war == 200.0


def test_status_bounds(spark):
    crowd = range(1, 1001)

    def war(active):
        got = series(spark, people=[user(i) for i in crowd], clusters=[(i, 1) for i in crowd],
                     votes=[(i, "2023-05-30") for i in range(1, active + 1)])
        return week(got, W1).war_status

    assert (war(200), war(50), war(49)) == ("Safe", "Warning", "Exit")


def test_contract_and_key(spark):
    got = series(spark, people=[user(1)], votes=[(1, "2023-05-30")])
    assert got.columns == TIMESERIES.columns and len(got.columns) == 23
    assert duplicate_keys(got, TIMESERIES).count() == 0


def test_a_third_of_all_rows_under_one_user(spark):
    """The hot user is one row per task and week by the time anything is joined."""
    hot = spark.range(30_000).selectExpr("7 as user_id", "timestamp'2023-05-30' as created_at")
    rest = spark.range(60_000).selectExpr("id % 3000 as user_id", "timestamp'2023-06-06' as created_at")
    cmap = spark.range(3000).selectExpr("id as user_id", "1 as cluster")
    weeks = user_weeks(CFG, votes=hot.unionByName(rest))
    got = {r.week_start: r for r in weekly_facts(weeks, cmap, CFG).collect()}
    assert (got[W1].vote_cnt_raw, got[W1].vote_cnt, got[W1].active_users) == (30_000, 0, 1)
    assert (got[W2].vote_cnt_raw, got[W2].vote_cnt, got[W2].active_users) == (60_000, 60_000, 3000)
