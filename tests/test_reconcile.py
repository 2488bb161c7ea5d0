"""Two copies compared, and JSON fields with their faults."""

import random
from collections import Counter

from helpers import table, values
from pyspark.sql import functions as F

from cohortmill.functions import json_fault, json_field
from cohortmill.plans import reconcile as plan
from cohortmill.plans.reconcile import reconcile

ROW = "a:bigint b:string v:int"


def plain(left, right):
    out = []
    for key in {r[:2] for r in left + right}:
        l, r = (Counter(x[2] for x in side if x[:2] == key) for side in (left, right))
        n, m = sum(l.values()), sum(r.values())
        if l != r:
            out.append((*key, "lost" if not m else "extra" if not n else "doubled" if m > n else "thinned" if m < n else "changed",
                        n, m))
    return sorted(out, key=str)


def test_every_fault_is_found(spark):
    draw = random.Random(2)
    left = [(i if i % 9 else None, draw.choice(["x", None]), draw.choice([1, 2, None])) for i in range(300)] * 1
    right = [r for r in left if draw.random() < 0.95] + draw.sample(left, 10) + [(i, "new", 1) for i in range(5)]
    right = [(a, b, 7 if draw.random() < 0.05 else v) for a, b, v in right]
    for buckets in (1, 16, 1 << 12):
        got = reconcile(table(spark, ROW, *left), table(spark, ROW, *right), ["a", "b"], buckets)
        assert values(got, "a", "b", "fault", "source_rows", "copy_rows") == plain(left, right)


def test_a_row_twice_on_one_side_and_values_that_swap_places(spark):
    one = table(spark, ROW, (1, "x", 1), (1, "x", 1), (2, None, 3), (3, "y", None))
    two = table(spark, ROW, (1, "x", 1), (2, "3", None), (3, None, None))
    assert values(reconcile(one, two, ["a"]), "a", "fault") == [(1, "thinned"), (2, "changed"), (3, "changed")]


def test_equal_tables_are_read_once(spark, monkeypatch):
    df = table(spark, ROW, (1, "x", 1), (None, "y", 2), (None, "y", 2))
    again = reconcile(df, df.orderBy("v"), ["a"])
    assert again.count() == 0
    # Nothing is left of either side.
    text = again._jdf.queryExecution().optimizedPlan().toString()
    assert "xxhash64" not in text
    assert reconcile(df.limit(0), df.limit(0), ["a"]).count() == 0
    assert plan.checksums(df, ["a"]).agg(F.sum("n")).first()[0] == 3


def test_only_rows_of_buckets_that_differ_are_matched(spark):
    left = spark.range(10_000).select(F.col("id").alias("a"), F.lit("x").alias("b"), F.lit(1).alias("v"))
    right = left.withColumn("v", F.when(F.col("a") == 77, 2).otherwise(1))
    got = reconcile(left, right, ["a"])
    assert [tuple(r) for r in got.select("a", "fault").collect()] == [(77, "changed")]
    bucket = left.where("a = 77").select(F.pmod(F.xxhash64("a"), F.lit(plan.BUCKETS))).first()[0]
    assert str(bucket) in got._jdf.queryExecution().optimizedPlan().toString()


def test_json_fields(spark):
    texts = [None, "", "{", "{}", '{"k": null}', '{"k": 5}', '{"k": "5"}', '{"k": 1.5}', '{"k": [1]}', '{"k": true}', "[1]", "7",
             '{"k": 9223372036854775807}', '{"j": {"k": 1}}']
    df = table(spark, "i:int t:string", *enumerate(texts))
    got = {r.i: (r.k, r.f) for r in df.select(
        "i", json_field(F.col("t"), "$.k", "bigint").alias("k"), json_fault(F.col("t"), "$.k", "bigint").alias("f")).collect()}
    faults = ["no text", "broken", "broken", "missing", "null", None, "wrong type", "wrong type", "wrong type", "wrong type",
              "missing", "missing", None, "missing"]
    assert [got[i][1] for i in range(len(texts))] == faults
    assert got[5][0] == 5 and got[12][0] == 2 ** 63 - 1 and sum(k is not None for k, _ in got.values()) == 2
    shown = {r.i: r.k for r in df.select("i", json_field(F.col("t"), "$.k", "double").alias("k")).collect()}
    assert shown[5] == 5.0 and shown[7] == 1.5 and shown[6] is None
