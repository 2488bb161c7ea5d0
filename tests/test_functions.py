import pytest
from helpers import one, table, values
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from cohortmill.config import PRICE_MAP, AnalysisWindow, Tier
from cohortmill.functions import (
    burned, cutoff_week, in_window, list_length, monday_of, parse_list_text, parse_timestamp, price_of, ratio, tier,
    whole_days_before,
)

WINDOW = AnalysisWindow()


@pytest.mark.parametrize(("text", "count"), [
    ("[1,2,3]", 3), ("[]", 0), ("[1,2,]", 2), ("['a','b']", 2), ("[None,1]", 2), ("[None, None,]", 2),
    (" [1]", 0), ("{}", 0), ("(1, 2)", 0), ("[[1, 2], 3]", 2), (None, 0), ("[1", None), ("[ ]", 0),
    ("['a', None, ]", 2), ("[\"it's\"]", 1), ("[1, 2]  ", 2),
    ("[1,2]xyz", None), ("[1] [2]", None), ("[1], [2]", None),
])
def test_list_length(spark, text, count):
    df = table(spark, "x:string", (text,))
    assert one(df.select(list_length(F.col("x")).alias("n")), "n") == count


@pytest.mark.parametrize(("text", "items"), [
    ("['2024-01-03', None,]", ["2024-01-03", None]), (" [\"a\"]", ["a"]), ("('a', 'b')", ["a", "b"]), ("('a',)", ["a"]),
    (None, []), ("[]", []), ("abc", None), ("[1", None), ("['a,]']", ["a,]"]), ("['a', 'b,]',]", ["a", "b,]"]),
    ("[1]}", None), ("[1], \"w\": [2]", None), ("[1]]", None),
])
def test_parse_list_text(spark, text, items):
    df = table(spark, "x:string", (text,))
    assert one(df.select(parse_list_text(F.col("x")).alias("v")), "v") == items


def test_broken_list_text_raises_when_strict(spark):
    df = table(spark, "x:string", ("[1",))
    with pytest.raises(PySparkException, match="broken list text"):
        df.select(parse_list_text(F.col("x"), strict=True)).collect()


def test_window_length_and_mondays():
    assert WINDOW.max_days == 347
    assert str(WINDOW.first_monday) == "2023-05-29"
    assert str(AnalysisWindow().from_monday().start) == "2023-05-22"


@pytest.mark.parametrize(("ts", "days"), [
    ("2024-05-07 23:00:00", 0), ("2024-05-07 00:00:00", 1), ("2024-05-08 00:00:00", 0), ("2024-05-08 00:00:01", -1),
    ("2023-05-27 00:00:00", 347), ("2024-05-06 23:59:59.999999", 1), ("1970-01-01 00:00:00.000001", 19850),
])
def test_whole_days_are_floored(spark, ts, days):
    df = table(spark, "t:timestamp", (ts,))
    assert one(df.select(whole_days_before(WINDOW.end_ts, F.col("t")).alias("d")), "d") == days


def test_window_ends_at_midnight(spark):
    df = table(spark, "t:timestamp", ("2023-05-26 23:59:59",), ("2023-05-27",), ("2024-05-08",),
               ("2024-05-08 00:00:01",))
    assert values(df.where(in_window(F.col("t"), WINDOW))) == [("2023-05-27 00:00:00",), ("2024-05-08 00:00:00",)]


@pytest.mark.parametrize(("ts", "monday"), [
    ("2023-05-29", "2023-05-29"), ("2023-06-04 23:59:59", "2023-05-29"), ("2023-05-28", "2023-05-22"),
])
def test_monday(spark, ts, monday):
    df = table(spark, "t:timestamp", (ts,))
    assert str(one(df.select(monday_of(F.col("t")).alias("d")), "d")) == monday


@pytest.mark.parametrize(("ts", "cutoff", "monday"), [
    ("2023-06-04 00:00:00", "sunday_start", "2023-05-29"),
    ("2023-06-04 10:00:00", "sunday_start", "2023-06-05"),
    ("2023-06-03 10:00:00", "sunday_start", "2023-05-29"),
    ("2023-06-05 00:00:00", "sunday_start", "2023-06-05"),
    ("2023-06-04 10:00:00", "week_end", "2023-05-29"),
])
def test_cutoff_week(spark, ts, cutoff, monday):
    df = table(spark, "t:timestamp", (ts,))
    assert str(one(df.select(cutoff_week(F.col("t"), cutoff).alias("d")), "d")) == monday


def test_unknown_cutoff():
    with pytest.raises(ValueError, match="cutoff"):
        cutoff_week(None, "noon")


def test_timestamp_spellings(spark):
    df = table(spark, "x:string", ("2024-01-03",), ("2024-01-03 04:05:06",), ("2024-01-03T04:05:06.123456",),
               ("03.01.2024",), (None,))
    got = values(df.select(parse_timestamp(F.col("x")).alias("t")))
    assert got == [("2024-01-03 00:00:00",), ("2024-01-03 04:05:06",), ("2024-01-03 04:05:06.123456",), (None,), (None,)]


def test_prices(spark):
    df = table(spark, "p:string", *((p,) for p in (*PRICE_MAP, "other", None)))
    got = [r[0] for r in df.select(price_of(F.col("p"), PRICE_MAP)).collect()]
    assert got == [900, 1900, 2900, 9900, 0, 0]


def test_ratio_guards_its_denominator(spark):
    df = table(spark, "a:bigint b:bigint", (1, 4), (1, 0), (0, 3))
    assert [r[0] for r in df.select(ratio(F.col("a"), F.col("b"), 100)).collect()] == [25.0, 0.0, 0.0]


@pytest.mark.parametrize(("value", "label"), [(20.0, "Safe"), (19.99, "Warning"), (5.0, "Warning"), (4.99, "Exit")])
def test_tier(spark, value, label):
    assert one(table(spark, "v:double", (value,)).select(tier(F.col("v"), Tier(20, 5)).alias("t")), "t") == label


def test_burned(spark):
    df = table(spark, "d:bigint", (-3,), (4,), (0,), (None,))
    assert [r[0] for r in df.select(burned(F.col("d"))).collect()] == [3, 0, 0, 0]
