"""Helpers shared by the operators: table access, words, scratch tables, streamed groups.

Text conventions, the same everywhere in this subpackage: a null text is an empty text; white
space is the six characters of ``WS``; a word is a maximal run of anything else; positions are
code points.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import hadoop_path, scratch_dir, shared_dir

WS = " \t\n\x0b\x0c\r"
SLICE_BYTES = 2 << 20
WS_RUN = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One of the given tables, whole."""
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def whole(text: str | Column) -> Column:
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def words_of(text: str | Column) -> Column:
    """The words of a text, in order; none for an empty one."""
    trimmed = F.btrim(whole(text), F.lit(WS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, WS_RUN))


def sha256(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def scratch_table(df: DataFrame, label: str) -> DataFrame:
    """``df`` computed once, as Parquet in the shared folder, and read back.

    Cuts the lineage in a way that outlives executors. The files stay for as long as lazy
    results may read them; ``clear_scratch`` removes all of a session's files.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, f"llm/{label}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def with_lookup(rows: DataFrame, table: DataFrame, key: str, how: str, parts: int = 1000) -> DataFrame:
    """``rows`` joined (``inner`` or ``left``) with a ``table`` that holds every key once.

    A key with at least one of ``parts`` parts of all rows would be one heavy task. There are at most
    ``parts`` such keys, whatever the input, so their rows of the table are broadcast; all other keys
    meet by shuffle. Rows without a key find nothing. ``rows`` is read three times.
    """
    counts = rows.groupBy(key).agg(F.count(F.lit(1)).alias("n_rows"))
    least = F.lit(rows.count() / parts)
    hot = scratch_table(counts.where(F.col(key).isNotNull() & (F.col("n_rows") >= least)).select(key).coalesce(1), "hot")
    heavy = rows.join(F.broadcast(hot), key, "left_semi").join(
        F.broadcast(table.join(F.broadcast(hot), key, "left_semi")), key, how)
    light = rows.where(F.col(key).isNotNull()).join(F.broadcast(hot), key, "left_anti").join(
        table.join(F.broadcast(hot), key, "left_anti").hint("shuffle_hash"), key, how)
    out = heavy.unionByName(light)
    return out if how == "inner" else out.unionByName(rows.where(F.col(key).isNull()), allowMissingColumns=True)


def clear_scratch(spark: SparkSession) -> None:
    """Delete the scratch tables; results that still read them must be written first."""
    files, location = hadoop_path(spark, f"{shared_dir(spark)}/cohortmill/llm")
    files.delete(location, True)


def in_slices(batches: Iterator[pa.RecordBatch], size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``size`` bytes, or one longer row: Python objects made of a
    batch take ten times its bytes, and Spark's own batches grow to tens of megabytes."""
    for batch in batches:
        step = max(1, batch.num_rows * size // max(batch.nbytes, 1))
        for start in range(0, batch.num_rows, step):
            yield batch.slice(start, step)


def record_groups(batches: Iterator[pa.RecordBatch], keys: Sequence[str]) -> Iterator[pa.Table]:
    """Runs of rows with equal keys, from batches sorted by them; each group as one table.

    Only the group at hand is held, so a task needs memory for its largest group alone.
    """
    held: list[pa.RecordBatch] = []
    current: tuple | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(batch.schema.get_field_index(k)).to_pylist() for k in keys]
        start, rows = 0, list(zip(*columns, strict=True))
        for i, key in enumerate(rows):
            if key != current:
                if i > start:
                    held.append(batch.slice(start, i - start))
                if held:
                    yield pa.Table.from_batches(held)
                held, current, start = [], key, i
        held.append(batch.slice(start))
    if held:
        yield pa.Table.from_batches(held)
