from helpers import events, payments, points, table, user, users, values

from cohortmill.config import MartConfig
from cohortmill.operators.cleaning import clean_users
from cohortmill.operators.profile import (
    activity_summary, general_users, super_users, user_profile, user_type_counts,
)

CFG = MartConfig()


def profile(spark, people, votes=(), pays=(), blocks=(), moves=(), cfg=CFG):
    return user_profile(
        clean_users(users(spark, *people)), events(spark, *votes), payments(spark, *pays), events(spark, *blocks),
        points(spark, *moves), cfg)


def test_recency_counts_whole_days(spark):
    got = profile(spark, [user(1), user(2)], votes=[(1, "2024-05-07 23:00:00"), (2, "2024-05-07 00:00:00")])
    assert values(got, "user_id", "recency", "frequency") == [(1, 0, 1), (2, 1, 1)]


def test_without_votes_recency_counts_from_signup(spark):
    got = profile(spark, [user(1, created_at="2020-01-01"), user(2, created_at="2024-05-10"),
                          user(3, created_at="2024-05-01 12:00:00")])
    assert values(got, "user_id", "recency") == [(1, 347), (2, 0), (3, 6)]


def test_last_day_ends_at_midnight_and_first_days_count(spark):
    got = profile(spark, [user(1), user(2), user(3)],
                  votes=[(1, "2024-05-08 00:00:00"), (2, "2024-05-08 00:00:01"), (3, "2023-05-28")])
    assert values(got, "user_id", "frequency") == [(1, 1), (2, 0), (3, 1)]


def test_super_threshold(spark):
    votes = [(1, "2024-01-01")] * 506 + [(2, "2024-01-01")] * 507
    got = profile(spark, [user(1), user(2)], votes=votes)
    assert values(got, "user_id", "user_type") == [(1, "General"), (2, "Super")]
    assert values(user_type_counts(got)) == [("General", 1), ("Super", 1)]
    heavy, rest = super_users(got), general_users(got)
    assert values(heavy, "user_id") == [(2,)] and values(rest, "user_id") == [(1,)]
    assert "point" in heavy.columns and not {"gender", "point_flow", "user_type"} & set(rest.columns)


def test_counts_flow_and_defaults(spark):
    got = profile(
        spark, [user(1), user(2)],
        pays=[(1, "2024-01-01", "heart.200"), (1, "2024-01-02", "other"), (1, "2020-01-01", "heart.200")],
        blocks=[(1, "2024-01-01")], moves=[(1, "2024-01-01", 10), (1, "2024-01-02", -25), (1, "2025-01-01", 99)])
    assert values(got, "user_id", "monetary", "block_cnt", "point_flow") == [(1, 2, 1, -15), (2, 0, 0, 0)]


def test_unknown_users_are_ignored(spark):
    got = profile(spark, [user(1)], votes=[(None, "2024-01-01"), (9, "2024-01-01")])
    assert values(got, "user_id", "frequency") == [(1, 0)]


def test_one_pass_sums_each_kind(spark):
    votes = events(spark, (1, "2024-01-01"), (2, "2024-01-02"), (1, "2024-02-01"), (None, "2024-01-01"))
    pays = payments(spark, (1, "2024-01-01", "a"), (3, "2024-01-01", "b"))
    blocks, moves = events(spark, (2, "2024-01-01")), points(spark, (2, "2024-01-01", -5), (4, "2024-01-01", 1))
    got = activity_summary(votes, pays, blocks, moves, CFG.window)
    assert values(got, "user_id", "frequency", "monetary", "block_cnt", "point_flow") == [
        (1, 2, 1, 0, None), (2, 1, 0, 1, -5), (3, 0, 1, 0, None), (4, 0, 0, 0, 1)]


def test_user_ids_that_are_no_numbers_become_null(spark):
    people = table(spark, "user_id:string gender:string friend_cnt:int created_at:timestamp",
                   ("7", "M", 0, "2024-01-01"), ("x", "M", 0, "2024-01-01"))
    got = user_profile(people, events(spark, (7, "2024-01-01")), payments(spark, (1, "2024-01-01", "a")),
                       events(spark, (1, "2024-01-01")), points(spark, (1, "2024-01-01", 1)))
    assert values(got, "user_id", "frequency") == [(7, 1), (None, 0)]
