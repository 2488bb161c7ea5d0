"""Chat formatting with cumulative-snapshot collapse.

Chat logs often store a conversation again after every turn. Each turn gets a hash of its rank,
role and text; their running XOR is the hash of the conversation up to that turn. A conversation
whose last hash is the hash of a shorter stretch of another one is a snapshot of it; an anti-join
removes it. Among equal conversations the smallest conv_id stays. What remains is rendered.

Hashes are two independent 64-bit ones, compared together with the length.

Defined results: turns are ordered by (turn, role, text), nulls first, so ties cannot change the
outcome; a null role renders as ``user``, a null text as an empty one; exact repeats of a row count
as one turn (a log written twice). Rows without conv_id form one conversation. An empty table gives
no row. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import scratch_table, whole

OPEN, MIDDLE, CLOSE = "<|", "|>\n", "\n"


def _turns(conversations: DataFrame) -> DataFrame:
    """One row per turn, ranked from 1, with the hashes of the conversation up to it."""
    plain = conversations.select(
        "conv_id", "turn", F.coalesce("role", F.lit("user")).alias("role"), whole("text").alias("text")).distinct()
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    ranked = plain.withColumn("rank", F.row_number().over(order))
    so_far = Window.partitionBy("conv_id").orderBy("rank").rowsBetween(Window.unboundedPreceding, 0)
    h = F.xxhash64("rank", "role", "text")
    other = F.xxhash64(F.lit("second"), "text", "role", "rank")
    return ranked.select(
        "conv_id", "rank", "role", "text",
        F.bit_xor(h).over(so_far).alias("h1"), F.bit_xor(other).over(so_far).alias("h2"))


def maximal(turns: DataFrame) -> DataFrame:
    """``conv_id, n_turns, n_equal`` of the conversations that no longer one begins with."""
    ends = turns.groupBy("conv_id").agg(
        F.max_by(F.struct("rank", "h1", "h2"), "rank").alias("end")).select("conv_id", "end.*")
    # Equal conversations fold into one row before any join, so a hot one is one row as well.
    unique = ends.groupBy("rank", "h1", "h2").agg(
        F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_equal"))
    last = F.max("rank").over(Window.partitionBy("conv_id"))
    inner = turns.select("rank", "h1", "h2", last.alias("last")).where("rank < last")
    return unique.join(inner.select("rank", "h1", "h2").distinct(), ["rank", "h1", "h2"], "left_anti").select(
        "conv_id", F.col("rank").cast("bigint").alias("n_turns"), "n_equal")


def rendered(turns: Column) -> Column:
    """Text of an ordered array of turns."""
    return F.array_join(F.transform(turns, lambda t: F.concat(
        F.lit(OPEN), t["role"], F.lit(MIDDLE), t["text"], F.lit(CLOSE))), "")


def format_chats(conversations: DataFrame) -> DataFrame:
    """``conv_id, n_turns, n_equal, text`` of every maximal conversation."""
    turns = scratch_table(_turns(conversations), "turns")
    kept = maximal(turns)
    texts = turns.alias("t").join(
        kept.alias("k"), F.col("t.conv_id").eqNullSafe(F.col("k.conv_id"))).groupBy(
        "k.conv_id", "k.n_turns", "k.n_equal").agg(
        F.sort_array(F.collect_list(F.struct("rank", "role", "text"))).alias("turns"))
    return texts.select("conv_id", "n_turns", "n_equal", rendered(F.col("turns")).alias("text"))
