"""The pair of filters against plain counts, and what it holds in memory."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortmill.llm import bloom


def _rows(spark, n, parts=3):
    return spark.range(0, n, 1, parts).select(F.xxhash64("id").alias("h"))


def _seen(rows, times):
    def column(batch):
        return batch.column(0).to_numpy().view(np.uint64)

    return bloom.twice_seen(rows, column, times)


def _numbers(rows):
    return np.array([row.h for row in rows.collect()], dtype=np.int64).view(np.uint64)


def test_filters_take_eight_megabytes_each_in_memory(spark):
    pair = bloom.Pair()
    pair.add(np.arange(1000, dtype=np.uint64))
    assert pair.once.nbytes == pair.twice.nbytes == 8 << 20
    seen = _seen(_rows(spark, 5), 1)
    assert seen.holds(_numbers(_rows(spark, 5))).all() and seen._bits.nbytes == 8 << 20


@pytest.mark.parametrize("times", [1, 2])
@pytest.mark.parametrize("n", [90, 1_800_000])  # chunks travel as positions, and as bits
def test_all_that_were_seen_often_enough_are_held(spark, n, times):
    seen = _seen(_rows(spark, n).union(_rows(spark, n // 3, 2)), times)
    assert seen.holds(_numbers(_rows(spark, n if times == 1 else n // 3).limit(100_000))).all()
    if n < 1000:
        others = _numbers(_rows(spark, 3 * n).exceptAll(_rows(spark, n if times == 1 else n // 3)))
        assert not seen.holds(others).any()
