"""Benchmark decontamination by latent semantic retrieval.

Benchmark items are the queries; every passage of every document is searched for each of them.

1. Words of the items make the vocabulary; documents become sequences of its ids, 0 for any other
   word, written once. All further passes read those.
2. Document frequencies of the vocabulary over all documents give TF-IDF weights.
3. A randomised SVD of the passage-term matrix over all passages: every task adds up its share of
   ``A'A W`` for one random ``W``; the sum is vocabulary x rank, and Nystrom's formula turns it into
   the leading right singular vectors.
4. Passages are windows of 8-word blocks, as long as the item they are compared with: the shortest
   has 2 blocks, and lengths double until they cover the longest item. Long windows begin at every
   eighth of their length and have margins of a quarter, so that one of them holds all of an item,
   however long, wherever it stands. Those whose latent vector has a cosine of at least ``COSINE`` with the item's, and at least ``PROJECTION`` of
   its length in that direction, are candidates. The first ``SKIP`` directions, in which all
   passages of a language point, are left out.
5. A candidate is a leak if the longest common subsequence of words covers ``VERBATIM`` of the item,
   or, for a paraphrase, ``PARAPHRASE`` of it and ``ANSWER`` of its end, where the answer stands.

Items are taken in blocks of at most ``ITEMS`` items and ``TERMS`` different words, which bounds the
vocabulary whatever the size of the benchmark; every block is searched for in all documents. An item
with more words than that is a block of its own, with wider ids.

Words are compared in lower case and without ASCII punctuation. Defined results: a null or empty
text leaks nothing, an item without words is found nowhere; repeated rows are reported once per
doc_id and text for every item; items with one item_id, or without any, but different texts are items
of their own. Other columns are not read. Empty tables
give no row.
"""

from __future__ import annotations

import string
from collections.abc import Iterator
from functools import reduce
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import scratch_table, whole

ITEMS = 4000
TERMS = (1 << 16) - 1  # what 16-bit ids can tell apart, beside 0 for any other word
BLOCK = 8
SHORTEST = 2  # blocks of the shortest window; longer ones double
RANK, SKIP, OVERSAMPLE = 128, 8, 16
COSINE, PROJECTION = 0.45, 0.35
VERBATIM, PARAPHRASE, ANSWER = 0.8, 0.6, 0.8
SLICE = 1 << 14  # words whose vectors are held at once: they fit a core's cache
FREQUENT = 128  # words that are multiplied as a dense matrix
TURNS = 4 * BLOCK  # rows of one sum that are added along with those of all others
CELLS = 1 << 22  # words of candidates that are compared at once

# Lower case and blanks for punctuation, on UTF-8 bytes.
_CLEAN = bytes(ord(" ") if chr(i) in string.punctuation else i for i in range(256))


def words_of(text: str | None) -> list[bytes]:
    return (text or "").lower().encode("utf-8", "surrogatepass").translate(_CLEAN).split()


def _scale(length: int) -> int:
    """Blocks of the windows that an item of so many words is compared with."""
    scale = SHORTEST
    while scale * BLOCK < 0.8 * length:
        scale *= 2
    return scale


def _margin(scale: int) -> int:
    """Words on either side of a window that belong to its candidate."""
    return max(2 * BLOCK, scale * BLOCK // 4)


class Item:
    """An item as ids, with what the common subsequence needs."""

    def __init__(self, item_id: object, ids: list[int]):
        self.item_id, self.ids, self.kinds = item_id, ids, set(ids)
        self.scale = _scale(len(ids))
        self.answer = ids[-max(3, len(ids) // 4):]

    def common(self, words: list[int], part: list[int] | None = None) -> float:
        """Share of the item, or of a part of it, in the longest common subsequence with ``words``."""
        part = part or self.ids
        masks: dict[int, int] = {}
        for i, word in enumerate(part):
            masks[word] = masks.get(word, 0) | 1 << i
        row = full = (1 << len(part)) - 1
        for word in words:
            if hit := row & masks.get(word, 0):
                row = ((row + hit) | (row - hit)) & full
        return (len(part) - row.bit_count()) / len(part)

    def verdict(self, words: list[int]) -> tuple[float, str] | None:
        share = self.common(words)
        if share >= VERBATIM:
            return share, "verbatim"
        if share >= PARAPHRASE and self.common(words, self.answer) >= ANSWER:
            return share, "paraphrase"
        return None


def _id_type(size: int) -> type:
    """Numbers for the words of a vocabulary and 0."""
    return np.uint16 if size <= TERMS + 1 else np.uint32


def _blocks(items: list[tuple[object, int, list[bytes]]]) -> Iterator[tuple[list[tuple], dict[bytes, int]]]:
    """Items in turn, in as few blocks as ``TERMS`` allows, each with the numbers of its words."""
    held: list[tuple] = []
    vocabulary: dict[bytes, int] = {}
    for item in items:
        fresh = set(item[2]).difference(vocabulary)
        if held and len(vocabulary) + len(fresh) > TERMS:
            yield held, vocabulary
            held, vocabulary = [], {}
        held.append(item)
        for word in item[2]:
            vocabulary.setdefault(word, len(vocabulary) + 1)
    yield held, vocabulary


def _encoded(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """``doc_id, mark, ids``: the words of every text that has any, as ids."""
    kind = _id_type(len(vocabulary) + 1)
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)
    schema = T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType),
                           T.StructField("mark", T.LongType()), T.StructField("ids", T.BinaryType())])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = shared.value.get
        for batch in batches:
            ids = []
            for text in batch.column(2).to_pylist():
                words = words_of(text)
                ids.append(np.fromiter(map(number, words, repeat(0)), kind, len(words)).tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(ids, pa.binary())], names=["doc_id", "mark", "ids"])

    return docs.select("doc_id", F.xxhash64(whole("text")).alias("mark"), "text").mapInArrow(encode, schema)


def _id_arrays(batch: pa.RecordBatch, size: int) -> list[np.ndarray]:
    kind = _id_type(size)
    return [np.frombuffer(x.as_buffer(), kind) for x in batch.column(batch.schema.get_field_index("ids"))]


def _frequencies(encoded: DataFrame, size: int) -> np.ndarray:
    """Number of documents with each id; the last entry counts the documents."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size + 1, np.int64)
        for batch in batches:
            for ids in _id_arrays(batch, size):
                present = np.zeros(size, dtype=bool)
                present[ids] = True
                total[:size] += present
            total[size] += batch.num_rows
        terms = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(terms, pa.int64()), pa.array(total[terms])], names=["term", "n"])

    out = np.zeros(size + 1, np.int64)
    for row in encoded.mapInArrow(count, "term bigint, n bigint").groupBy("term").agg(F.sum("n").alias("n")).collect():
        out[row["term"]] = row["n"]
    return out


def _slices(arrays: list[np.ndarray], overlap: int = 0) -> Iterator[tuple[list[int], list[int], list[np.ndarray]]]:
    """Stretches of documents, about ``SLICE`` words at a time: document, first word, words.

    A longer document is cut into stretches that overlap, so that no window is lost. The step is
    never shorter than the overlap: no word is in more than two stretches.
    """
    step = max(SLICE, overlap)
    docs: list[int] = []
    firsts: list[int] = []
    parts: list[np.ndarray] = []
    size = 0
    for doc, ids in enumerate(arrays):
        for first in range(0, len(ids), step):
            part = ids[first:first + step + overlap]
            if size and size + len(part) > SLICE:
                yield docs, firsts, parts
                docs, firsts, parts, size = [], [], [], 0
            docs.append(doc)
            firsts.append(first)
            parts.append(part)
            size += len(part)
    if size:
        yield docs, firsts, parts


def _blocked(parts: list[np.ndarray], block: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All words, the block of each, the stretch of each block and each stretch's first block."""
    lengths = np.array([len(x) for x in parts])
    counts = -(-lengths // block)
    first = np.concatenate([[0], np.cumsum(counts)])
    begin = np.concatenate([[0], np.cumsum(lengths)])[:-1]
    stretch = np.repeat(np.arange(len(parts)), lengths)
    within = np.arange(int(lengths.sum())) - begin[stretch]
    return np.concatenate(parts), first[stretch] + within // block, np.repeat(np.arange(len(parts)), counts), first


def _summed(source: np.ndarray, picked: np.ndarray, keys: np.ndarray, size: int) -> np.ndarray:
    """Sums of the ``picked`` rows of ``source`` with the same key; keys are in order.

    The first row of every key is added, then the second of every key that has one, and so on: whole
    rows at a time. What a key has beyond ``TURNS`` rows is summed key by key.
    """
    out = np.zeros((size, source.shape[1]), source.dtype)
    if not len(keys):
        return out
    edges = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    counts = np.diff(np.append(edges, len(keys)))
    for turn in range(min(int(counts.max()), TURNS)):
        at = edges if turn == 0 else edges[counts > turn] + turn
        out[keys[at]] += source[picked[at]]
    for edge, count in zip(edges[counts > TURNS], counts[counts > TURNS], strict=True):
        out[keys[edge]] += source[picked[edge + TURNS:edge + count]].sum(axis=0)
    return out


def _moments(encoded: DataFrame, weights: np.ndarray, test: np.ndarray) -> np.ndarray:
    """``A'A W`` over all passages of 32 words, ``A`` their normalised TF-IDF rows.

    The ``FREQUENT`` words in most documents make up half of a text: they are counted per passage and
    multiplied as one small dense matrix, all others are summed word by word.
    """
    size, width = test.shape
    frequent = np.argsort(weights[1:], kind="stable")[:FREQUENT] + 1
    spots = np.full(size, -1)
    spots[frequent] = np.arange(len(frequent))
    shared = encoded.sparkSession.sparkContext.broadcast((weights, test))

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight, random = shared.value
        weighted = (random * weight[:, None]).astype(np.float32)
        total = np.zeros((size, width))
        for batch in batches:
            for _, _, parts in _slices(_id_arrays(batch, size)):
                flat, passage, owner, _ = _blocked(parts, 4 * BLOCK)
                known = np.flatnonzero(flat)
                flat, passage = flat[known], passage[known]
                squares = np.bincount(passage, weight[flat] ** 2, len(owner))
                spot = spots[flat]
                common, other = np.flatnonzero(spot >= 0), np.flatnonzero(spot < 0)
                counts = np.bincount(passage[common] * len(frequent) + spot[common], minlength=len(owner) * len(frequent))
                counts = counts.reshape(len(owner), len(frequent)).astype(np.float32)
                flat, passage = flat[other], passage[other]
                rows = _summed(weighted, flat, passage, len(owner)) + counts @ weighted[frequent]
                rows /= np.maximum(squares, 1e-6)[:, None].astype(np.float32)
                total[frequent] += counts.T @ rows
                order = np.argsort(flat, kind="stable")
                terms, numbers = np.unique(flat[order], return_inverse=True)
                total[terms] += _summed(rows, passage[order], numbers, len(terms))
        total *= weight[:, None]
        terms = np.flatnonzero(total.any(axis=1))
        yield pa.RecordBatch.from_arrays(
            [pa.array(terms, pa.int64()), pa.array([total[t].tobytes() for t in terms], pa.binary())],
            names=["term", "sums"])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for term, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                sums[term] = sums.get(term, 0) + np.frombuffer(data)
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(sums), pa.int64()), pa.array([x.tobytes() for x in sums.values()], pa.binary())],
            names=["term", "sums"])

    kind = "term bigint, sums binary"
    out = np.zeros((size, width))
    for row in encoded.mapInArrow(add, kind).repartition("term").mapInArrow(merge, kind).collect():
        out[row["term"]] = np.frombuffer(row["sums"])  # vocabulary x rank numbers, whatever the corpus
    return out


def latent_basis(encoded: DataFrame, weights: np.ndarray, rank: int = RANK, skip: int = SKIP) -> np.ndarray:
    """Leading right singular vectors of the passage-term matrix but the very first, vocabulary x rank."""
    size = len(weights)
    width = min(size, skip + rank + OVERSAMPLE)
    test, _ = np.linalg.qr(np.random.default_rng(11).standard_normal((size, width)))
    sketch = _moments(encoded, weights, test)
    shift = 1e-9 * max(float(np.linalg.norm(sketch)), 1e-9)
    sketch = sketch + shift * test
    core = test.T @ sketch
    values, turned = np.linalg.eigh((core + core.T) / 2)
    # Below this there is nothing but rounding: passages that span few directions give fewer.
    sound = values > 1e-6 * values[-1]
    vectors, _, _ = np.linalg.svd(sketch @ (turned[:, sound] / np.sqrt(values[sound])), full_matrices=False)
    if vectors.shape[1] < skip + rank + OVERSAMPLE:
        skip = 0  # a vocabulary or corpus this small is kept whole
    return vectors[:, skip:skip + rank]


def _search(encoded: DataFrame, items: list[tuple], weights: np.ndarray, basis: np.ndarray, item_type: T.DataType,
            cosine: float) -> DataFrame:
    shared = encoded.sparkSession.sparkContext.broadcast(
        (items, (basis * weights[:, None]).astype(np.float32)))
    schema = T.StructType([*encoded.schema.fields[:2], T.StructField("number", T.LongType()),
                           T.StructField("place", T.LongType()), T.StructField("share", T.DoubleType()),
                           T.StructField("kind", T.StringType())])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        given, vectors = shared.value
        made = [Item(item_id, ids) for item_id, _, ids in given]
        scaled = {}
        for scale in sorted({item.scale for item in made}):
            numbers = [i for i, item in enumerate(made) if item.scale == scale]
            latent = np.stack([vectors[made[i].ids].sum(axis=0) for i in numbers])
            length = np.maximum(np.linalg.norm(latent, axis=1), 1e-9)
            member = np.zeros((len(numbers), len(vectors)), dtype=bool)
            for row, i in enumerate(numbers):
                member[row, made[i].ids] = True
            # What must be there of an item's distinct words if PARAPHRASE of all its words is.
            needed = np.array([len(made[i].kinds) - (1 - PARAPHRASE) * len(made[i].ids) for i in numbers])
            scaled[scale] = np.array(numbers), (latent / length[:, None]).T, PROJECTION * length, member, needed
        outer = _margin(max(scaled, default=SHORTEST))
        longest = max(scaled, default=SHORTEST) * BLOCK + 2 * outer
        for batch in batches:
            best: dict[tuple[int, int], tuple] = {}
            for docs, firsts, parts in _slices(_id_arrays(batch, len(vectors)), longest):
                flat, block, owner, first = _blocked(parts, BLOCK)
                known = np.flatnonzero(flat)
                sums, reach = _summed(vectors, flat[known], block[known], len(owner)), 1
                padded = np.concatenate([np.zeros(outer, flat.dtype), flat, np.zeros(longest, flat.dtype)])
                begins = np.searchsorted(block, np.arange(len(owner)))
                for scale in scaled:
                    while reach < scale:
                        # Twice as many blocks, as far as the stretch goes.
                        more = np.zeros_like(sums)
                        same = np.flatnonzero(owner[reach:] == owner[:-reach])
                        more[same] = sums[same + reach]
                        sums, reach = sums + more, 2 * reach
                    numbers, latent, least, member, needed = scaled[scale]
                    starts = np.flatnonzero((np.arange(len(owner)) - first[owner]) % max(1, scale // 8) == 0)
                    sought = sums if len(starts) == len(sums) else sums[starts]
                    least_along = np.maximum(least, cosine * np.linalg.norm(sought, axis=1)[:, None])
                    rows, columns = np.nonzero(sought @ latent >= least_along)
                    # The window and a margin, of which words of neighbouring texts are blanked.
                    margin = _margin(scale)
                    span = np.arange(scale * BLOCK + 2 * margin)
                    step = max(1, CELLS // len(span))
                    for begin in range(0, len(rows), step):
                        windows, column = starts[rows[begin:begin + step]], columns[begin:begin + step]
                        places = begins[windows][:, None] + span - margin
                        stretch = owner[windows]
                        low = begins[first[stretch]][:, None]
                        high = low + np.array([len(x) for x in parts])[stretch][:, None]
                        seen = np.where((places >= low) & (places < high), padded[places + outer], 0)
                        ordered = np.sort(seen, axis=1)
                        fresh = np.concatenate([np.ones((len(seen), 1), dtype=bool), ordered[:, 1:] != ordered[:, :-1]], axis=1)
                        hits = (member[column[:, None], ordered] & fresh).sum(axis=1)
                        for i in np.flatnonzero(hits >= needed[column]).tolist():
                            number, part = int(numbers[column[i]]), int(stretch[i])
                            found = made[number].verdict(seen[i].tolist())
                            if found and found[0] > best.get((docs[part], number), (0, 0.0))[1]:
                                place = firsts[part] + BLOCK * (int(windows[i]) - int(first[part]))
                                best[docs[part], number] = (place, *found)
            out = [(doc, number, *value) for (doc, number), value in best.items()]
            if out:
                rows, numbers, places, shares, kinds = zip(*out, strict=True)
                take = pa.array(rows, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(take), batch.column(1).take(take), pa.array(numbers, pa.int64()),
                     pa.array(places, pa.int64()), pa.array(shares, pa.float64()), pa.array(kinds, pa.string())],
                    names=["doc_id", "mark", "number", "place", "share", "kind"])

    spark = encoded.sparkSession
    names = spark.createDataFrame(
        [(i, item_id, item_mark) for i, (item_id, item_mark, _) in enumerate(items)],
        T.StructType([T.StructField("number", T.LongType()), T.StructField("item_id", item_type),
                      T.StructField("item_mark", T.LongType())]))
    return encoded.mapInArrow(search, schema).join(F.broadcast(names), "number").select(
        "doc_id", "mark", "item_id", "item_mark", "place", "share", "kind").dropDuplicates(
        ["doc_id", "mark", "item_id", "item_mark"])


def leaks(docs: DataFrame, benchmark: DataFrame, cosine: float = COSINE) -> DataFrame:
    """``doc_id, mark, item_id, item_mark, place, share, kind``: every item found in a document.

    ``place`` is the word where the window begins, ``share`` the part of the item found there and
    ``mark`` and ``item_mark`` are hashes of the texts.
    """
    items = benchmark.select("item_id", whole("text").alias("text")).distinct()
    blocks = -(-max(items.count(), 1) // ITEMS)
    item_type = benchmark.schema["item_id"].dataType
    found = []
    for block in range(blocks):
        # At most about ITEMS rows: a hash deals the items out evenly.
        part = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).orderBy("item_id", "text").select(
            "item_id", F.xxhash64("text").alias("item_mark"), "text").collect()
        worded = [(row["item_id"], row["item_mark"], words) for row in part if (words := words_of(row["text"]))]
        for held, vocabulary in _blocks(worded):
            encoded = scratch_table(_encoded(docs, vocabulary), "passages")
            counts = _frequencies(encoded, len(vocabulary) + 1)
            weights = np.log((1.0 + counts[-1]) / (1.0 + counts[:-1])) + 0.1
            weights[0] = 0.0
            basis = latent_basis(encoded, weights)
            listed = [(item_id, mark, [vocabulary[word] for word in words]) for item_id, mark, words in held]
            found.append(_search(encoded, listed, weights, basis, item_type, cosine))
    return reduce(DataFrame.unionByName, found)


def drop_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that hold no benchmark item."""
    bad = leaks(docs, benchmark).select(F.col("doc_id").alias("bad_id"), F.col("mark").alias("bad_mark")).distinct()
    rows = docs.select(F.struct("*").alias("row"), F.xxhash64(whole("text")).alias("mark"))
    match = F.col("row.doc_id").eqNullSafe(F.col("bad_id")) & (F.col("mark") == F.col("bad_mark"))
    return rows.join(bad.hint("shuffle_hash"), match, "left_anti").select("row.*")
