"""Fill-in-the-middle: texts cut into prefix, middle and suffix, and put in another order.

Cuts are drawn in units (tokens or code points) from a hash of the key, so a rerun or a lost executor
changes nothing. Work is done on the UTF-8 bytes of a whole batch at once. A sparse exception index
holds the multibyte characters alone, their byte positions and excess bytes: ``searchsorted`` in it
turns bytes into code points and back, and between two entries both differ by a constant. A text in
plain ASCII has an empty index.

Text that holds a marker stays plain, hence markers in the output are the operator's own, and
``restore`` finds the text again from output and form alone.

Defined results: a null or empty text has no unit, is plain and gives an empty output; a null key
draws as the empty key; repeated rows are cut alike; other columns are carried in ``row``, where no
name clashes. An empty table gives no row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import WS, whole

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SEED, RATE, SPM = 42, 50, 80  # the rates in percent: of texts that are cut, and of those in the order spm
PIECE = 4 << 20  # bytes of text looked at together

_WHITE = np.isin(np.arange(256), [ord(c) for c in WS])


class SparseIndex:
    """Multibyte characters of a byte array; everything between them is arithmetic."""

    def __init__(self, data: np.ndarray):
        self.lead = np.flatnonzero(data >= 0xC0)
        first = data[self.lead]
        excess = 1 + (first >= 0xE0).astype(np.int64) + (first >= 0xF0)
        self.before = np.concatenate([[0], np.cumsum(excess)])
        self.lead_chars = self.lead - self.before[:-1]

    def chars(self, places: np.ndarray) -> np.ndarray:
        """Code points before byte positions that begin a character."""
        return places - self.before[np.searchsorted(self.lead, places, "left")]

    def bytes(self, places: np.ndarray) -> np.ndarray:
        """Byte positions of code points."""
        return places + self.before[np.searchsorted(self.lead_chars, places, "left")]


def utf8(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of an array of texts in one piece, and the positions between them."""
    _, offsets, data = texts.buffers()
    bounds = np.frombuffer(offsets, np.int32)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    held = np.frombuffer(data, np.uint8) if data else np.empty(0, np.uint8)
    return held[bounds[0]:bounds[-1]], bounds - bounds[0]


def token_ends(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Where tokens end: behind a run of other characters, or behind white space that closes a text."""
    white = _WHITE[data]
    closes = np.zeros(len(data), dtype=bool)
    closes[bounds[1:][np.diff(bounds) > 0] - 1] = True
    before_white = np.append(white[1:], True)
    return np.flatnonzero(np.where(white, closes, closes | before_white)) + 1


def cut(data: np.ndarray, bounds: np.ndarray, draws: np.ndarray, unit: str) -> tuple[np.ndarray, ...]:
    """Per text its number of units, the byte positions of its two cuts, and the code points of
    prefix and middle. ``bounds`` are the byte positions between texts, ``draws`` two rows of hashes."""
    index = SparseIndex(data)
    if unit == "token":
        ends = token_ends(data, bounds)
        first, behind = np.searchsorted(ends, bounds[:-1], "right"), np.searchsorted(ends, bounds[1:], "right")
        n = behind - first
    else:
        first = index.chars(bounds[:-1])
        n = index.chars(bounds[1:]) - first
    low, high = np.sort(draws % (n + 1), axis=0)

    def place(units: np.ndarray) -> np.ndarray:
        if unit == "char":
            return index.bytes(first + units)
        out = bounds[:-1].copy()
        some = units > 0
        out[some] = ends[(first + units - 1)[some]]
        return out

    a, b = place(low), place(high)
    chars = index.chars(a)
    return n, a, b, chars - index.chars(bounds[:-1]), index.chars(b) - chars


def draws(key: Column, seed: int = SEED) -> list[Column]:
    """Four hashes of a key as unsigned 32-bit numbers."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))).cast("binary"), 256)
    return [F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("bigint") for i in range(4)]


def form_of(text: Column, h3: Column, h4: Column, rate: int, spm: int) -> Column:
    marked = text.contains(PREFIX) | text.contains(SUFFIX) | text.contains(MIDDLE)
    return F.when((text == "") | marked | (h3 % 100 >= rate), "plain").when(h4 % 100 < spm, "spm").otherwise("psm")


def transform(docs: DataFrame, unit: str = "token", seed: int = SEED, rate: int = RATE, spm: int = SPM,
              key: str = "doc_id") -> DataFrame:
    """``row`` with all columns but the text, ``n`` units, ``form``, ``prefix_chars``, ``middle_chars``, ``output``."""
    if unit not in ("token", "char"):
        raise ValueError(f"unknown unit: {unit}")
    others = [name for name in docs.columns if name != "text"]
    h1, h2, h3, h4 = draws(F.col(key), seed)
    rows = docs.select(F.struct(*others).alias("row"), whole("text").alias("text"), h1.alias("h1"), h2.alias("h2"),
                       form_of(whole("text"), h3, h4, rate, spm).alias("form"))
    schema = T.StructType([
        rows.schema["row"], T.StructField("n", T.LongType()), T.StructField("form", T.StringType()),
        T.StructField("prefix_chars", T.LongType()), T.StructField("middle_chars", T.LongType()),
        T.StructField("output", T.StringType())])
    p, s, m = (mark.encode() for mark in (PREFIX, SUFFIX, MIDDLE))

    def arranged(text: bytes, a: int, b: int, form: str) -> bytes:
        if form == "plain":
            return text
        if form == "psm":
            return b"".join((p, text[:a], s, text[b:], m, text[a:b]))
        return b"".join((s, text[b:], p, text[:a], m, text[a:b]))

    def piece(batch: pa.RecordBatch) -> pa.RecordBatch:
        data, bounds = utf8(batch.column(1))
        h = np.array([batch.column(2).to_numpy(), batch.column(3).to_numpy()])
        n, a, b, before, inside = cut(data, bounds, h, unit)
        forms, held = batch.column(4).to_pylist(), data.tobytes()
        output = [arranged(held[start:end], i - start, j - start, form) for start, end, i, j, form in zip(
            bounds[:-1].tolist(), bounds[1:].tolist(), a.tolist(), b.tolist(), forms, strict=True)]
        plain = np.array([form == "plain" for form in forms])
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(n), batch.column(4), pa.array(before, mask=plain), pa.array(inside, mask=plain),
             pa.array(output, pa.binary()).cast(pa.string())], names=schema.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Some megabytes of text at a time, or one longer text."""
        for batch in batches:
            _, bounds = utf8(batch.column(1))
            start = 0
            while start < batch.num_rows:
                end = max(int(np.searchsorted(bounds, bounds[start] + PIECE, "right")) - 1, start + 1)
                yield piece(batch.slice(start, end - start))
                start = end

    return rows.mapInArrow(run, schema)


def restore(output: Column, form: Column) -> Column:
    """The text that an output of some form was made of."""
    size = len(PREFIX)

    def parts(inner: str) -> tuple[Column, Column, Column]:
        """What stands behind the first marker, behind the ``inner`` one, and behind the last."""
        body = F.substring(output, F.lit(size + 1), F.length(output))
        one = F.substring_index(body, inner, 1)
        rest = F.substring(body, F.length(one) + (size + 1), F.length(body))
        two = F.substring_index(rest, MIDDLE, 1)
        return one, two, F.substring(rest, F.length(two) + (size + 1), F.length(rest))

    prefix, suffix, middle = parts(SUFFIX)
    psm = F.concat(prefix, middle, suffix)
    suffix, prefix, middle = parts(PREFIX)
    return F.when(form == "plain", output).when(form == "psm", psm).otherwise(F.concat(prefix, middle, suffix))
