"""Line dedup by two Bloom filters.

A line's key is the line without white space at its ends, A-Z in lower case. One pass over the
texts fills a filter of keys seen once and one of keys seen twice; a second pass sends on only the
keys that the latter holds. Those are counted exactly, by the key itself, and of a key found in
enough documents all lines go but those in the largest doc_id that holds it.

Defined results: a null or empty text is one empty line; keys shorter than ``MIN_CHARS`` never
count. Every row counts as a document; rows that share a doc_id share its fate, so both copies of a
repeated row keep their lines when their doc_id is the largest. A row without doc_id cannot be
ranked: it does not count and is returned whole. An empty table gives no row. Other columns travel
in the struct ``row``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .bloom import twice_seen
from .common import WS, in_slices, scratch_table, whole

MIN_CHARS = 40
MIN_DOCUMENTS = 5
HOT_SHARE = 1000  # a key with a thousandth of all rows is joined without a shuffle
_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


def key_of(line: str) -> str:
    line = line.strip(WS)
    return line.lower() if line.isascii() else line.translate(_LOWER)


def _keys(text: str | None, least: int) -> dict[str, list[int]]:
    """The keys of a text that are long enough, and their line numbers."""
    found: dict[str, list[int]] = {}
    for number, line in enumerate((text or "").split("\n")):
        if len(line) >= least:
            key = key_of(line)
            if len(key) >= least:
                found.setdefault(key, []).append(number)
    return found


def _hash(keys: list[str]) -> np.ndarray:
    digest = xxhash.xxh3_64_intdigest
    return np.fromiter((digest(key.encode("utf-8", "surrogatepass")) for key in keys), np.uint64, len(keys))


def suspects(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """``doc_id, text_hash, key, places`` of the keys that may occur in more than one document."""
    rows = docs.where(F.col("doc_id").isNotNull()).select("doc_id", "text")

    def hashes(batch: pa.RecordBatch) -> np.ndarray:
        # Distinct within a document, so that twice means two documents.
        return _hash([key for text in batch.column(1).to_pylist() for key in _keys(text, min_chars)])

    twice = twice_seen(rows, hashes)
    kind = docs.schema["doc_id"].dataType
    schema = T.StructType([
        T.StructField("doc_id", kind), T.StructField("text_hash", T.LongType()),
        T.StructField("key", T.StringType()), T.StructField("places", T.ArrayType(T.IntegerType()))])

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches):
            ids, marks, places, keys = [], [], [], []
            for row, text in enumerate(batch.column(2).to_pylist()):
                for key, numbers in _keys(text, min_chars).items():
                    ids.append(row)
                    keys.append(key)
                    places.append(numbers)
            held = np.flatnonzero(twice.holds(_hash(keys)))
            marks = pa.array(np.array(ids, dtype=np.int64)[held])
            yield pa.RecordBatch.from_arrays([
                batch.column(0).take(marks), batch.column(1).take(marks),
                pa.array([keys[i] for i in held], pa.string()),
                pa.array([places[i] for i in held], pa.list_(pa.int32()))],
                names=["doc_id", "text_hash", "key", "places"])

    return rows.select("doc_id", F.xxhash64(whole("text")).alias("text_hash"), "text").mapInArrow(emit, schema)


def condemned(found: DataFrame, min_documents: int = MIN_DOCUMENTS) -> DataFrame:
    """``key, n, keeper`` of the keys that truly are in enough documents."""
    return found.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.max("doc_id").alias("keeper")).where(
        F.col("n") >= min_documents)


def _with_keeper(found: DataFrame, min_documents: int) -> DataFrame:
    """Rows of ``found`` whose key is condemned, with the keeper of that key.

    A key that holds at least one of ``HOT_SHARE`` parts of all rows would be one heavy task of a
    join by key. There are at most ``HOT_SHARE`` such keys, whatever the input, so their digests and
    keepers go to the rows by broadcast; all other keys meet by shuffle.
    """
    judged = scratch_table(condemned(found, min_documents), "condemned")
    least = max(found.count() / HOT_SHARE, 1.0)
    digest = F.sha2(F.col("key").cast("binary"), 256).alias("digest")
    hot = F.broadcast(judged.where(F.col("n") >= least).select(digest, "keeper"))
    marked = found.withColumn("digest", digest)
    cold = marked.join(hot.select("digest"), "digest", "left_anti").join(
        judged.where(F.col("n") < least).select("key", "keeper"), "key")
    columns = ("doc_id", "text_hash", "places", "keeper")
    return marked.join(hot, "digest").select(*columns).union(cold.select(*columns))


def drop_repeated_lines(
    docs: DataFrame, min_chars: int = MIN_CHARS, min_documents: int = MIN_DOCUMENTS
) -> DataFrame:
    """``row`` with all columns of a document, ``n_lines``, ``n_dropped`` and the ``text`` kept."""
    found = scratch_table(suspects(docs, min_chars), "suspects")  # read twice: to count, and to drop
    losses = _with_keeper(found, min_documents).where("doc_id <> keeper").groupBy(
        "doc_id", "text_hash").agg(F.array_distinct(F.flatten(F.collect_list("places"))).alias("drop"))
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").alias("id"),
                       F.xxhash64(whole("text")).alias("mark"))
    # The losses are the small side and hold one row per document at most: no sort of the texts.
    match = (F.col("id") == F.col("doc_id")) & (F.col("mark") == F.col("text_hash"))
    marked = rows.join(losses.hint("shuffle_hash"), match, "left").select("row", "drop")

    schema = T.StructType([
        T.StructField("row", docs.schema), T.StructField("n_lines", T.LongType()),
        T.StructField("n_dropped", T.LongType()), T.StructField("text", T.StringType())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches):
            texts = batch.column(0).field("text").to_pylist()
            drops = batch.column(1).to_pylist()
            total, lost, kept = [], [], []
            for text, drop in zip(texts, drops, strict=True):
                lines = (text or "").split("\n")
                total.append(len(lines))
                lost.append(len(drop or ()))
                if drop:
                    gone = set(drop)
                    kept.append("\n".join(line for i, line in enumerate(lines) if i not in gone))
                else:
                    kept.append(text or "")
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(total, pa.int64()), pa.array(lost, pa.int64()), pa.array(kept, pa.string())],
                names=["row", "n_lines", "n_dropped", "text"])

    return marked.mapInArrow(cut, schema)


def dedupe_documents(docs: DataFrame) -> DataFrame:
    """The documents without their repeated lines, n_chars brought up to date."""
    columns = [
        F.when(F.col("row.text").isNotNull(), F.col("text")).alias("text") if name == "text"
        else F.length("text").cast(docs.schema[name].dataType).alias(name) if name == "n_chars"
        else F.col(f"row.`{name}`").alias(name)
        for name in docs.columns]
    return drop_repeated_lines(docs).select(*columns)
