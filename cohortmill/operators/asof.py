"""As-of join: every row of one side with the last earlier row of the other side.

No range join: both sides are put into one stream per key, ordered by time, and the last row of the
right side is carried along. A key is cut into spans of time (``span``), so one with a third of all
rows is many groups. What a span inherits, the last right row of the spans before it, is found on one
narrow row per key and span, and enters the span as its first row.

Left rows without a key or a time find nothing and are kept; such right rows are never found. Of right
rows at the same time the one with the largest ``tie`` wins. With ``allow_exact`` a right row at the very
time of a left row counts as earlier.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def as_of(left: DataFrame, right: DataFrame, key: str, left_ts: str, right_ts: str, tie: str, *,
          span: str = "day", allow_exact: bool = False) -> DataFrame:
    """``l`` with all columns of the left row, and ``r`` with those of the right one or null."""
    known = left.where(F.col(key).isNotNull() & F.col(left_ts).isNotNull())
    lost = left.where(F.col(key).isNull() | F.col(left_ts).isNull())
    kind = f"struct<{', '.join(f'`{f.name}`:{f.dataType.simpleString()}' for f in right.schema)}>"
    own = f"struct<{', '.join(f'`{f.name}`:{f.dataType.simpleString()}' for f in left.schema)}>"

    def part(df: DataFrame, ts: str, order: int, l: Column, r: Column, tie: Column) -> DataFrame:
        return df.select(F.col(key).alias("key"), F.col(ts).alias("at"), F.date_trunc(span, F.col(ts)).alias("span"),
                         F.lit(order).alias("order"), tie.alias("tie"), l.alias("l"), r.alias("r"))

    nothing_left, nothing_right = F.lit(None).cast(own), F.lit(None).cast(kind)
    no_tie = F.lit(None).cast(right.schema[tie].dataType)
    lefts = part(known, left_ts, 2 if allow_exact else 0, F.struct(*left.columns), nothing_right, no_tie)
    rights = part(right.where(F.col(key).isNotNull() & F.col(right_ts).isNotNull()), right_ts, 1, nothing_left,
                  F.struct(*right.columns), F.col(tie))

    # The last right row of every span, null where a span has none; then of all spans before.
    last = lefts.select("key", "span", "at", "tie", "r").unionByName(rights.select("key", "span", "at", "tie", "r")).groupBy(
        "key", "span").agg(F.max_by("r", F.when(F.col("r").isNotNull(), F.struct("at", "tie"))).alias("r"))
    earlier = Window.partitionBy("key").orderBy("span").rowsBetween(Window.unboundedPreceding, -1)
    inherited = last.select("key", "span", F.last("r", ignorenulls=True).over(earlier).alias("r")).where("r is not null")
    carried = inherited.select("key", F.lit(None).cast(left.schema[left_ts].dataType).alias("at"), "span",
                               F.lit(-1).alias("order"), no_tie.alias("tie"), nothing_left.alias("l"), "r")

    so_far = Window.partitionBy("key", "span").orderBy("at", "order", "tie").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    met = lefts.unionByName(rights).unionByName(carried).withColumn("r", F.last("r", ignorenulls=True).over(so_far))
    return met.where("l is not null").select("l", "r").unionByName(
        lost.select(F.struct(*left.columns).cast(own).alias("l"), nothing_right.alias("r")))


def payments_after_votes(payments: DataFrame, votes: DataFrame) -> DataFrame:
    """Each payment with the user's last vote before it, and the time between them."""
    pairs = as_of(payments.select("id", "user_id", "created_at"), votes.select("id", "user_id", "created_at"),
                  "user_id", "created_at", "created_at", "id")
    return pairs.select(
        F.col("l.id").alias("payment_id"), "l.user_id", F.col("l.created_at").alias("paid_at"),
        F.col("r.id").alias("vote_id"), F.col("r.created_at").alias("voted_at"),
        ((F.unix_micros("l.created_at") - F.unix_micros("r.created_at")) / 1_000_000).alias("seconds"))
