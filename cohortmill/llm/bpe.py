"""Byte-pair encoding with content-defined chunk reuse, and decoding.

A rolling hash over the bytes cuts texts into chunks, so equal stretches of different documents are
cut alike. Two Bloom filters tell which chunks may occur more than once; each of those is encoded
once and its ids join the documents that share it. Documents without any such chunk are encoded
where they are read and never shuffled.

Joins. The ids of a stretch equal those inside the whole text if it begins and ends at a *seam*, an
ASCII printable character followed by a blank or line feed: no piece that byte-level BPE merges in
(an optional blank and a run of one kind, or a run of white space) reaches across one, and nothing
looks back over it. So of a chunk only its *core*, first seam to last, is taken from the shared
encoding. At every join the text from the last seam before it to the first one after it is
encoded again, across as many chunks as it takes to reach a seam; then both sides agree exactly.

Defined results: a null or empty text has no ids; repeated rows are encoded each, from one encoding
of their chunks; strings of special tokens become their ids, as the library does. An empty table
gives no row. Other columns travel in the struct ``row``.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from hashlib import sha256

import numpy as np
import pyarrow as pa
import tiktoken
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from .bloom import twice_seen
from .common import in_slices, scratch_table, whole

CHUNK_BITS = 11  # a boundary every 2 KB on average
LEAST_CHUNK = 256
PIECE = 1 << 16  # own text goes to the encoder in pieces of about this size, cut at seams
_MIX = np.uint32(0x9E3779B1)
_OTHER = re.compile("[^\x00-\u024f]")
# Fixed value: the pattern that byte-level BPE splits text by.
_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def boundaries(data: np.ndarray) -> np.ndarray:
    """Positions after which the rolling hash of the last 16 bytes has ``CHUNK_BITS`` zeros."""
    if len(data) < 16:
        return np.empty(0, np.int64)
    rolling = (data.astype(np.uint32) + np.uint32(1)) * _MIX
    rolling ^= rolling >> np.uint32(15)
    factor, width = _MIX, 1
    while width < 16:
        # A window twice as wide: the newer half, and the older half times a power of the factor.
        rolling = rolling[width:] + rolling[:-width] * factor
        factor = np.uint32((int(factor) * int(factor)) & 0xFFFFFFFF)
        width *= 2
    rolling ^= rolling >> np.uint32(16)
    cuts = np.flatnonzero((rolling & np.uint32((1 << CHUNK_BITS) - 1)) == 0) + 16
    inside = cuts[cuts < len(data)]
    return inside[(data[inside] & 0xC0) != 0x80]


def seams(data: np.ndarray) -> np.ndarray:
    """Positions of blanks and line feeds that follow an ASCII printable character."""
    blank = (data[1:] == 0x20) | (data[1:] == 0x0A)
    return np.flatnonzero(blank & (data[:-1] > 0x20) & (data[:-1] < 0x7F)) + 1


def cores(text: bytes) -> list[tuple[int, int]]:
    """Per chunk that has one, its core as byte positions."""
    data = np.frombuffer(text, np.uint8)
    edges, last = [0], 0
    for cut in boundaries(data).tolist():
        if cut - last >= LEAST_CHUNK:
            edges.append(cut)
            last = cut
    edges.append(len(data))
    at = seams(data)
    first = np.searchsorted(at, np.array(edges[:-1]) + 1, "left")
    final = np.searchsorted(at, np.array(edges[1:]), "left") - 1
    return [(int(at[a]), int(at[b])) for a, b in zip(first, final, strict=True) if a < b]


def _key(core: bytes) -> bytes:
    return xxhash.xxh3_128_digest(core)


def _hash(keys: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(key[:8] for key in keys), np.uint64)


@dataclass(frozen=True)
class Vocabulary:
    """A byte-level tokenizer file, read once by the driver and sent to the tasks."""

    definition: str
    ranks: dict[bytes, int]
    special: dict[str, int]

    @classmethod
    def read(cls, path: str | None) -> Vocabulary:
        with open(path or default_tokenizer(), encoding="utf-8") as file:
            definition = file.read()
        parsed = json.loads(definition)
        special = {token["content"]: token["id"] for token in parsed["added_tokens"]}
        # Byte-level vocabularies write bytes as printable characters: those that are printable
        # as themselves, the others from 256 on.
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        others = sorted(set(range(256)) - set(plain))
        byte = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}
        ranks = {bytes(byte[c] for c in token): number
                 for token, number in parsed["model"]["vocab"].items() if token not in special}
        return cls(definition, ranks, special)

    @property
    def parts(self) -> tuple:
        """What a broadcast carries: built-in types only."""
        return self.definition, self.ranks, self.special

    def bytes_of(self) -> list[bytes]:
        """The bytes of every id."""
        table = [b""] * (1 + max(*self.ranks.values(), *self.special.values()))
        for token, number in self.ranks.items():
            table[number] = token
        for token, number in self.special.items():
            table[number] = token.encode()
        return table


class Encoder:
    """Ids as the tokenizers library gives them.

    tiktoken computes the same ids from the same vocabulary six times as fast. Both split text by
    Unicode classes, each by its own Unicode version; below U+0250 the versions agree. A piece with
    any other character goes to the library itself.
    """

    def __init__(self, vocabulary: Vocabulary):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self._definition = vocabulary.definition
        self._special = set(vocabulary.special)
        self._library: Tokenizer | None = None
        self._fast = tiktoken.Encoding(
            "byte level", pat_str=_PATTERN, mergeable_ranks=vocabulary.ranks, special_tokens=vocabulary.special)

    def ids(self, text: str) -> np.ndarray:
        if _OTHER.search(text) is None:
            return np.asarray(
                self._fast.encode_to_numpy(text, allowed_special=self._special, disallowed_special=()), np.uint32)
        if self._library is None:
            self._library = Tokenizer.from_str(self._definition)
            self._library.no_truncation()
            self._library.no_padding()
        return np.array(self._library.encode(text, add_special_tokens=False).ids, np.uint32)


def _pieces(text: bytes) -> list[str]:
    """A text cut at seams into pieces of about ``PIECE`` bytes."""
    if len(text) <= PIECE:
        return [text.decode()] if text else []
    at, out, start = seams(np.frombuffer(text, np.uint8)), [], 0
    while start < len(text):
        i = int(np.searchsorted(at, start + PIECE))
        stop = int(at[i]) if i < len(at) else len(text)
        out.append(text[start:stop].decode())
        start = stop
    return out


def _encode_text(
    encoder: Encoder, text: bytes, spans: list[tuple[int, int, bytes]], known: dict[bytes, bytes]
) -> np.ndarray:
    """Ids of a text. Cores with known codes are copied, the stretches between them encoded."""
    parts: list[np.ndarray] = []
    at = 0
    for start, end, key in [*(s for s in spans if s[2] in known), (len(text), len(text), b"")]:
        parts.extend(map(encoder.ids, _pieces(text[at:start])))
        if key:
            parts.append(np.frombuffer(known[key], np.uint32))
        at = end
    return np.concatenate(parts) if parts else np.empty(0, np.uint32)


Result = Callable[[Vocabulary], Callable[[np.ndarray], tuple]]


def _apply(docs: DataFrame, tokenizer: str | None, fields: list[tuple[str, T.DataType, pa.DataType]],
           result: Result, carry: Sequence[str] | None) -> DataFrame:
    """``row``, with the columns to ``carry`` (all unless given), and what ``result`` makes of a text's ids.

    The text itself travels beside the row, so a caller that does not want it back leaves it out.
    """
    spark = docs.sparkSession
    vocabulary = spark.sparkContext.broadcast(Vocabulary.read(tokenizer).parts)  # a few MB
    rows = docs.select(F.struct(*(carry or ["*"])).alias("row"), whole("text").alias("text"))
    row_type = rows.schema["row"].dataType

    def hashes(batch: pa.RecordBatch) -> np.ndarray:
        keys: list[bytes] = []
        for text in batch.column(0).to_pylist():
            data = text.encode("utf-8", "surrogatepass")
            keys.extend(_key(data[a:b]) for a, b in cores(data))
        return _hash(keys)

    twice = twice_seen(rows.select("text"), hashes)

    span = T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType()),
                         T.StructField("key", T.BinaryType())])
    flagged_schema = T.StructType([T.StructField("row", row_type), T.StructField("text", T.StringType()),
                                   T.StructField("shared", T.ArrayType(span))])
    span_arrow = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("key", pa.binary())]))

    def flag(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches):
            found, owner = [], []
            for number, text in enumerate(batch.column(1).to_pylist()):
                data = text.encode("utf-8", "surrogatepass")
                for a, b in cores(data):
                    found.append((a, b, _key(data[a:b])))
                    owner.append(number)
            held = twice.holds(_hash([key for _, _, key in found]))
            lists: list[list[dict]] = [[] for _ in range(batch.num_rows)]
            for (a, b, key), number, yes in zip(found, owner, held.tolist(), strict=True):
                if yes:
                    lists[number].append({"start": a, "end": b, "key": key})
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(lists, span_arrow)], names=["row", "text", "shared"])

    flagged = rows.mapInArrow(flag, flagged_schema)

    def core_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            once: dict[bytes, str] = {}
            for text, spans in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                data = text.encode("utf-8", "surrogatepass")
                for s in spans:
                    once.setdefault(s["key"], data[s["start"]:s["end"]].decode())
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(once), pa.binary()), pa.array(list(once.values()), pa.string())], names=["key", "core"])

    def encode_cores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(Vocabulary(*vocabulary.value))
        for batch in batches:
            ids = [encoder.ids(core).tobytes() for core in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.binary())], names=["key", "ids"])

    sharing = scratch_table(flagged.where(F.size("shared") > 0).withColumn(
        "text_key", F.md5(F.col("text").cast("binary"))), "bpe")
    codes = sharing.select("text", "shared").mapInArrow(core_texts, "key binary, core string").dropDuplicates(
        ["key"]).mapInArrow(encode_cores, "key binary, ids binary")
    # Copies of a text need the same codes: one list per text, whatever the number of copies.
    wanted = sharing.select("text_key", F.explode("shared.key").alias("key")).distinct()
    lists = wanted.join(codes, "key").groupBy("text_key").agg(
        F.collect_list(F.struct("key", "ids")).alias("codes"))
    empty = F.array().cast("array<struct<key:binary,ids:binary>>")
    mixed = sharing.join(lists, "text_key", "left").select("row", "text", "shared", F.coalesce("codes", empty).alias("codes"))
    plain = flagged.where(F.size("shared") == 0).select("row", "text", "shared", empty.alias("codes"))

    schema = T.StructType([T.StructField("row", row_type), *[T.StructField(n, t) for n, t, _ in fields]])

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, make = Encoder(Vocabulary(*vocabulary.value)), result(Vocabulary(*vocabulary.value))
        for whole_batch in batches:
            # A few rows at a time keep the arrays of long texts small.
            for start in range(0, whole_batch.num_rows, 256):
                batch = whole_batch.slice(start, 256)
                texts = [t.encode("utf-8", "surrogatepass") for t in batch.column(1).to_pylist()]
                spans = [[(s["start"], s["end"], s["key"]) for s in x] for x in batch.column(2).to_pylist()]
                known = [{c["key"]: c["ids"] for c in x} for x in batch.column(3).to_pylist()]
                out = [make(_encode_text(encoder, *row)) for row in zip(texts, spans, known, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), *[pa.array(column, kind) for column, (_, _, kind) in
                                        zip(zip(*out, strict=True), fields, strict=True)]],
                    names=["row", *[name for name, _, _ in fields]])

    # mapInArrow on each side and not on their union: a union would pull the shuffled side's
    # partitions and the scan's into one stage.
    return plain.mapInArrow(finish, schema).unionByName(mixed.mapInArrow(finish, schema))


def encode(docs: DataFrame, tokenizer: str | None = None, carry: Sequence[str] | None = None) -> DataFrame:
    """``row`` (the columns to ``carry``, or all), ``n_tokens`` and ``ids`` of every text."""
    def result(vocabulary: Vocabulary) -> Callable[[np.ndarray], tuple]:
        return lambda ids: (len(ids), ids.astype(np.int32))

    return _apply(docs, tokenizer, [("n_tokens", T.LongType(), pa.int64()),
                                    ("ids", T.ArrayType(T.IntegerType()), pa.list_(pa.int32()))], result, carry)


def decode(rows: DataFrame, tokenizer: str | None = None, ids: str = "ids") -> DataFrame:
    """``row`` with all columns, and ``text``, what the ids stand for."""
    vocabulary = rows.sparkSession.sparkContext.broadcast(Vocabulary.read(tokenizer).parts)

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = Vocabulary(*vocabulary.value).bytes_of()
        for batch in batches:
            lists = batch.column(0).field(ids).to_pylist()
            out = [b"".join(map(table.__getitem__, x or ())).decode("utf-8", "replace") for x in lists]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.string())], names=["row", "text"])

    schema = T.StructType([T.StructField("row", rows.schema), T.StructField("text", T.StringType())])
    return rows.select(F.struct("*").alias("row")).mapInArrow(texts, schema)


def digest(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256``: encoded, and decoded again."""
    def result(vocabulary: Vocabulary) -> Callable[[np.ndarray], tuple]:
        table = vocabulary.bytes_of()
        decimal = [str(i) for i in range(len(table))]

        def make(ids: np.ndarray) -> tuple:
            numbers = ids.tolist()
            return (len(numbers), sha256(",".join(map(decimal.__getitem__, numbers)).encode()).hexdigest(),
                    sha256(b"".join(map(table.__getitem__, numbers))).hexdigest())

        return make

    return _apply(docs, tokenizer, [("n_tokens", T.LongType(), pa.int64()),
                                    ("ids_sha256", T.StringType(), pa.string()),
                                    ("decoded_sha256", T.StringType(), pa.string())], result, ["doc_id"]).select(
        "row.doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
