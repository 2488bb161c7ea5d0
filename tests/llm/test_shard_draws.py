"""Shards against a plain walk down the tree, and the law over many counts."""

import math
import struct
from collections import Counter

import brute
import xxhash
from pyspark.sql import functions as F

from cohortmill.llm import sharding


def draw(name, key, weight):
    seed = xxhash.xxh64(name.encode(), seed=42).intdigest()
    bits = seed if key is None else xxhash.xxh64(struct.pack("<q", key), seed=seed).intdigest()
    return -math.log(((bits >> 11) + 0.5) / (1 << 53)) / weight


def walk(node, key):
    while node.children:
        node = min(node.children, key=lambda child: draw(child.name, key, child.weight)) if len(node.children) > 1 else node.children[0]
    return node.shard


def test_draws_equal_a_plain_walk(spark):
    keys = [None, 0, -1, 2 ** 62, *range(1, 400)]
    docs = spark.createDataFrame([(k, None if k == 5 else f"text {k}") for k in keys], "doc_id long, text string")
    got = {r.doc_id: r for r in sharding.place(docs, sharding.tree(40)).collect()}
    for key in keys:
        assert got[key].shard == walk(sharding.tree(40), key) and got[key].grown_shard == walk(sharding.tree(41), key)
        assert got[key].law == "key"
    for shard in {r.shard for r in got.values()}:
        assert sorted(r.slot for r in got.values() if r.shard == shard) == list(range(sum(r.shard == shard for r in got.values())))


def test_every_further_shard_takes_rows_only_into_itself(spark):
    ids = spark.range(20_000)
    rows = ids.select(*[sharding.shard_of(F.col("id"), sharding.tree(n)).alias(f"s{n}") for n in range(40, 45)]).collect()
    for n in range(40, 44):
        moved = Counter(r[f"s{n + 1}"] for r in rows if r[f"s{n}"] != r[f"s{n + 1}"])
        assert set(moved) == {n} and 0.5 < moved[n] / (len(rows) / (n + 1)) < 1.5
    assert max(Counter(r.s40 for r in rows).values()) < 1.3 * len(rows) / 40


def test_equal_rows_and_an_empty_table(spark):
    docs = spark.createDataFrame([(1, "x")] * 50 + [(1, None)], "doc_id long, text string")
    rows = sharding.place(docs, sharding.tree(40)).collect()
    assert sorted(r.slot for r in rows) == list(range(51)) and {r.shard for r in rows} == {walk(sharding.tree(40), 1)}
    assert brute.count(sharding.place(docs.limit(0), sharding.tree(40))) == 0
