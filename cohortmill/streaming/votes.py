"""Weekly votes per user as an event-time stream into a store.

Each micro-batch writes the user-weeks it changed as one batch of the store, named by the batch id of
the stream. Spark may hand a batch over again after a crash; the store does not write a committed id
twice, so every batch counts once. Readers take the newest version of a user-week, so weeks that are
still open can be read, and closed ones leave the state once the watermark has passed them.

A vote later than the watermark (``delay`` behind the newest vote seen) is dropped; any other late one
corrects its week. Rows without a user or a time, or outside the analysis window, are dropped as in the
batch job. The state holds the user-weeks inside the delay, whatever the length of the stream.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import MartConfig
from ..functions import in_window
from ..sources.store import TableStore

USER_WEEKS = "stream_vote_weeks"
KEY = ("user_id", "week_start")

# Windows are counted from 1970-01-01, a Thursday; weeks begin on Mondays.
_MONDAY = "4 days"


def vote_weeks(votes: DataFrame, cfg: MartConfig, delay: str = "7 days") -> DataFrame:
    """``user_id, week_start, votes, last_vote`` of a stream (or a table) of votes."""
    known = F.col("user_id").isNotNull() & in_window(F.col("created_at"), cfg.window)
    week = F.window("created_at", "7 days", startTime=_MONDAY)
    return (
        votes.where(known)
        .withWatermark("created_at", delay)
        .groupBy("user_id", week.alias("week"))
        .agg(F.count(F.lit(1)).alias("votes"), F.max("created_at").alias("last_vote"))
        .select("user_id", F.col("week.start").cast("date").alias("week_start"), "votes", "last_vote")
    )


def run_vote_stream(votes: DataFrame, store: TableStore, checkpoint: str, cfg: MartConfig,
                    delay: str = "7 days", table: str = USER_WEEKS) -> None:
    """Everything that has arrived since the last run with this checkpoint, then stop."""
    def write(changed: DataFrame, number: int) -> None:
        rows = changed.select(F.lit(number).cast("long").alias("version"), "*")
        if not store.append(table, rows, f"stream-{number:09d}", key=KEY).committed:
            # Written before a crash; the state of the stream must still pass over the batch.
            changed.write.format("noop").mode("overwrite").save()

    query = (
        vote_weeks(votes, cfg, delay).writeStream.foreachBatch(write).outputMode("update")
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    query.awaitTermination()


def current_votes(store: TableStore, table: str = USER_WEEKS) -> DataFrame:
    """One row per user and week: its newest version."""
    newest = F.max_by(F.struct("votes", "last_vote"), "version").alias("newest")
    return store.read(table).groupBy(*KEY).agg(newest).select(*KEY, "newest.*")
