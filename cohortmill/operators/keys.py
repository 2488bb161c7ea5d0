"""Keyed set differences behind idempotent appends."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Words of 64 bits in the filter of an increment's keys, and so the most rows it can have: 16 bytes
# each before the broadcast. Four million keys set a sixteenth of the bits.
FILTER_WORDS = 1 << 20


def unseen(candidates: DataFrame, stored: DataFrame, keys: Sequence[str], *, nullable: bool = False) -> DataFrame:
    """Candidates whose key is not stored. Only the key columns of ``stored`` are read.

    Duplicates inside the candidates are kept. The planner broadcasts the stored keys when
    their measured size allows, else both sides meet by hash of the key. ``nullable`` makes
    NULL equal NULL, for keys that no contract declares NOT NULL.
    """
    keys = list(keys)
    if not nullable:
        return candidates.join(stored.select(*keys), keys, "left_anti")
    same = reduce(Column.__and__, (F.col(f"c.{k}").eqNullSafe(F.col(f"s.{k}")) for k in keys))
    return candidates.alias("c").join(stored.select(*keys).alias("s"), same, "left_anti")


def unseen_in_slice(candidates: DataFrame, stored: DataFrame, key: str) -> DataFrame:
    """``unseen`` for few candidates against a large table, without shuffling the table.

    Only stored keys inside the candidates' key range can match, a filter that skips the
    row groups (usually all old ones, since keys ascend) by their statistics. Of the rest
    only those that pass a bit filter of the candidates' keys are shuffled, and only those
    that do match are kept before the difference is taken, so what is compared is bounded by
    the candidates even where one stray key widens the range to the whole table. Rows without a key take no part in the join: one look at
    the table tells whether it holds such a row already. ``candidates`` is read more than
    once: pass written data.
    """
    bounds = candidates.agg(
        F.min(key).alias("low"), F.max(key).alias("high"),
        F.count(F.lit(1)).alias("rows"), F.count(key).alias("keyed"),
    ).first()
    low, high, rows, keyed = bounds
    fresh = candidates.where(F.col(key).isNotNull())
    if keyed:
        near = stored.select(key).where(F.col(key).between(F.lit(low), F.lit(high)))
        if stored.schema[key].dataType == candidates.schema[key].dataType:
            near = _possible(near, fresh, key)
        # A key may repeat without limit on either side; one copy of it says as much.
        hits = near.join(fresh.select(key).distinct(), key, "left_semi").distinct()
        fresh = fresh.join(hits, key, "left_anti")
    if keyed == rows:
        return fresh
    missing = F.col(key).isNull()
    if stored.select(key).where(missing).isEmpty():
        fresh = fresh.unionByName(candidates.where(missing))
    return fresh


def _possible(stored: DataFrame, wanted: DataFrame, key: str) -> DataFrame:
    """Stored keys whose bit is set by a wanted key: all that match, and few others.

    The filter is a table of words, bounded by ``FILTER_WORDS`` whatever the number of keys,
    and so fit for a broadcast; a fuller one lets more keys pass and never stops a right one.
    """
    place = F.pmod(F.xxhash64(key), F.lit(64 * FILTER_WORDS))
    bit = F.expr(f"shiftleft(1L, cast(pmod(xxhash64(`{key}`), 64) as int))")
    words = wanted.groupBy(F.floor(place / 64).alias("_word")).agg(F.bit_or(bit).alias("_bits"))
    marked = stored.select(key, F.floor(place / 64).alias("_at"), bit.alias("_bit"))
    met = (F.col("_at") == F.col("_word")) & (F.col("_bits").bitwiseAND(F.col("_bit")) != 0)
    return marked.join(F.broadcast(words), met, "left_semi").select(key)


def one_per_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Any one row of each key. Rows without a key are no copies of one another and all stay."""
    keys = list(keys)
    keyless = reduce(Column.__or__, (F.col(key).isNull() for key in keys))
    return df.where(~keyless).dropDuplicates(keys).unionByName(df.where(keyless))


def overwrite_rows(stored: DataFrame, fresh: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Stored rows with those of equal key replaced by the fresh ones."""
    return unseen(stored, fresh, keys).unionByName(fresh)
