"""N-gram Jaccard join by MinHash banding.

Texts are sets of word shingles. Each set is reduced to ``bands * rows`` minima, numbers chosen so
that a pair at the threshold shares a band with the wanted probability. Sets that share a band meet
in a bucket, and every pair of a bucket is verified on the full sets.

* Texts with the same words in the same order are one class and go on as one row.
* Buckets with the same members, as near copies have in most bands, are one bucket.
* A large bucket is dealt out in blocks; two blocks at a time meet in a task. A pair that meets in
  several buckets is counted in the first of them only, so no list of pairs is ever made: a task
  returns links per text and a spanning forest of its links.
* Only texts that share a bucket send their shingles; a Bloom filter of fixed size tells which.

Words are cut at white space, case and punctuation kept. Defined results: a text of one to four words
has one shingle, all its words; a text without words has none, is equal to others of that kind and links
to nothing. Null texts are empty. Repeated rows and equal texts share a class; rows without doc_id
too, and such a row names a class only if the class has no other. Other columns are not read. An
empty table gives no row.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .bloom import twice_seen
from .common import in_slices, record_groups, scratch_table, whole
from .graph import components

SHINGLE = 5
SIMILARITY = 0.8
RECALL = 0.9999  # of pairs exactly at the threshold; more similar ones are missed far more rarely
ROWS = 4
BLOCK = 400  # texts of a bucket that go to a task together, twice
GROUP_BYTES = 2 << 20  # text hashed at once; the arrays for it take 30 times as much

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_STEP = np.uint64(0xD6E8FEB86659FD93)
_BLANK = np.zeros(256, dtype=bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True


def bands_for(similarity: float = SIMILARITY, recall: float = RECALL, rows: int = ROWS) -> int:
    """The fewest bands of ``rows`` minima that find a pair at the threshold with that recall."""
    return math.ceil(math.log(1 - recall) / math.log(1 - similarity ** rows))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Shingler:
    """Shingle hashes of many texts at once, straight from their bytes."""

    def __init__(self, width: int):
        self.width = width
        self._powers = self._inverses = np.ones(1, np.uint64)

    def _grow(self, size: int) -> None:
        if len(self._powers) < size:
            for name, factor in (("_powers", _BASE), ("_inverses", _INVERSE)):
                steps = np.full(size, factor, np.uint64)
                steps[0] = 1
                setattr(self, name, np.multiply.accumulate(steps))

    def __call__(self, texts: list[bytes]) -> list[np.ndarray]:
        """Per text, the hashes of its shingles in order, repeats included."""
        lengths = np.array([len(text) for text in texts], np.int64)
        # A blank after every text keeps words of neighbours apart.
        data = np.frombuffer(b" ".join([*texts, b""]), np.uint8)
        starts_of = np.concatenate([[0], np.cumsum(lengths + 1)])
        self._grow(len(data) + 1)
        inside = np.zeros(len(data) + 2, np.int8)
        inside[1:-1] = ~_BLANK[data]
        edges = np.diff(inside)
        first, after = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * self._powers[:len(data)], out=sums[1:])
        words = _mixed((sums[after] - sums[first]) * self._inverses[first])
        at = np.searchsorted(first, starts_of)
        counts = np.diff(at)
        rolled = np.zeros(max(len(words) - self.width + 1, 0), np.uint64)
        for k in range(self.width):
            rolled = rolled * _STEP + words[k:k + len(rolled)]
        rolled = _mixed(rolled)
        out = []
        for start, n in zip(at[:-1].tolist(), counts.tolist(), strict=True):
            if n >= self.width:
                out.append(rolled[start:start + n - self.width + 1])
            elif n:
                short = np.uint64(n)
                with np.errstate(over="ignore"):
                    for word in words[start:start + n]:
                        short = short * _STEP + word
                out.append(_mixed(np.array([short], np.uint64)))
            else:
                out.append(np.empty(0, np.uint64))
        return out


def _in_groups(texts: list[str]) -> Iterator[list[bytes]]:
    group, size = [], 0
    for text in texts:
        data = text.encode("utf-8", "surrogatepass")
        if group and size + len(data) > GROUP_BYTES:
            yield group
            group, size = [], 0
        group.append(data)
        size += len(data)
    if group:
        yield group


def _class_key(shingles: np.ndarray) -> str:
    return xxhash.xxh3_128_hexdigest(shingles.tobytes())


def _band_hashes(shingles: list[np.ndarray], bands: int, rows: int) -> np.ndarray:
    """One row per text that has shingles, one column per band."""
    full = [x for x in shingles if len(x)]
    flat = np.concatenate(full)
    starts = np.concatenate([[0], np.cumsum([len(x) for x in full])[:-1]])
    draw = np.random.default_rng(7)
    salts = draw.integers(0, 1 << 63, (bands * rows, 2), dtype=np.int64).astype(np.uint64)
    out = np.zeros((len(full), bands), np.uint64)
    for i, (flip, factor) in enumerate(salts):
        low = np.minimum.reduceat((flat ^ flip) * (factor | np.uint64(1)), starts)
        out[:, i // rows] = _mixed(out[:, i // rows] ^ low) + np.uint64(i)
    return out.astype(np.int64)


def sketches(docs: DataFrame, shingle: int, bands: int, rows: int) -> DataFrame:
    """``doc_id, mark, key, band_0 ...``: the class of every row and its band hashes."""
    names = [f"band_{i}" for i in range(bands)]
    schema = T.StructType([
        T.StructField("doc_id", docs.schema["doc_id"].dataType), T.StructField("mark", T.LongType()),
        T.StructField("key", T.StringType()), *[T.StructField(name, T.LongType()) for name in names]])

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(shingle)
        for batch in in_slices(batches):
            done = 0
            for group in _in_groups(batch.column(2).to_pylist()):
                sets = shingler(group)
                full = np.array([len(x) > 0 for x in sets])
                columns = np.zeros((len(sets), bands), np.int64)
                if full.any():
                    columns[full] = _band_hashes(sets, bands, rows)
                part = batch.slice(done, len(group))
                done += len(group)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array([_class_key(x) for x in sets]),
                     *[pa.array(columns[:, i], mask=~full) for i in range(bands)]],
                    names=["doc_id", "mark", "key", *names])

    return docs.select("doc_id", F.xxhash64(whole("text")).alias("mark"), whole("text").alias("text")).mapInArrow(
        sketch, schema)


def _shared_buckets(classes: DataFrame, bands: int) -> DataFrame:
    """``key, buckets``: per class, the bands it shares with others, each with a bucket and its size.

    A bucket is named by its members, whatever the band, so equal buckets have one name.
    """
    members = classes.where("band_0 is not null").select(
        "key", F.posexplode(F.array(*[f"band_{i}" for i in range(bands)])).alias("band", "hash"))
    buckets = members.groupBy("band", "hash").agg(
        F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("key")).alias("x"),
        F.bit_xor(F.xxhash64(F.lit("second"), "key")).alias("y")).where("n > 1").select(
        "band", "hash", F.xxhash64("n", "x", "y").alias("bucket"), "n")
    return members.join(buckets, ["band", "hash"]).groupBy("key").agg(
        F.collect_list(F.struct("band", "bucket", "n")).alias("buckets"))


def _full_sets(docs: DataFrame, candidates: DataFrame, shingle: int) -> DataFrame:
    """``key, shingles``: the full set of every candidate, sorted, as bytes; once per class."""
    def from_keys(batch: pa.RecordBatch) -> np.ndarray:
        return np.array([int(key[:16], 16) for key in batch.column(0).to_pylist()], np.uint64)

    wanted = twice_seen(candidates.select("key"), from_keys, times=1)

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, sent = Shingler(shingle), set()
        for batch in in_slices(batches):
            for group in _in_groups(batch.column(0).to_pylist()):
                sets = shingler(group)
                keys = [_class_key(x) for x in sets]
                held = wanted.holds(np.array([int(key[:16], 16) for key in keys], np.uint64))
                rows = []
                for i in np.flatnonzero(held).tolist():
                    if keys[i] not in sent:
                        sent.add(keys[i])
                        rows.append(i)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([keys[i] for i in rows], pa.string()),
                     pa.array([np.unique(sets[i]).tobytes() for i in rows], pa.binary())], names=["key", "shingles"])

    return docs.select(whole("text").alias("text")).mapInArrow(emit, "key string, shingles binary").dropDuplicates(["key"])


def _overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all pairwise intersections. Only shingles that two sets share make a column."""
    n = len(sets)
    flat = np.concatenate(sets)
    owner = np.repeat(np.arange(n), [len(x) for x in sets])
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    new = np.concatenate([[True], flat[1:] != flat[:-1]])
    column = np.cumsum(new) - 1
    shared = np.bincount(column) > 1
    held = shared[column]
    owner, column = owner[held], (np.cumsum(shared) - 1)[column[held]]
    out = np.zeros((n, n), np.float32)
    width = 4096
    edges = np.searchsorted(column, np.arange(0, int(shared.sum()) + width, width))
    for i, (a, b) in enumerate(zip(edges[:-1], edges[1:], strict=True)):
        if b > a:
            part = np.zeros((n, width), np.float32)
            part[owner[a:b], column[a:b] - i * width] = 1
            out += part @ part.T
    return out


def _forest(linked: np.ndarray) -> np.ndarray:
    """Per node the first node of its component."""
    root = np.full(len(linked), -1)
    for i in range(len(linked)):
        if root[i] < 0:
            front = np.zeros(len(linked), dtype=bool)
            front[i] = True
            while front.any():
                root[front] = i
                front = linked[front].any(axis=0) & (root < 0)
    return root


def _verify(members: DataFrame, similarity: float, bands: int) -> DataFrame:
    """``key, n_links, root`` from every pair of blocks: links counted there, and a spanning forest."""
    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in record_groups(batches, ["bucket", "low", "high"]):
            keys, block = group.column("key").to_pylist(), np.array(group.column("block").to_pylist())
            if len(keys) < 2:
                continue
            bucket = group.column("bucket")[0].as_py()
            sets = [np.frombuffer(x.as_buffer(), np.uint64) for x in group.column("shingles")]
            names = np.zeros((len(keys), bands), np.int64)
            for i, own in enumerate(group.column("buckets").to_pylist()):
                for b in own:
                    names[i, b["band"]] = b["bucket"]
            sizes = np.array([len(x) for x in sets], np.float64)
            common = _overlaps(sets).astype(np.float64)
            linked = common >= similarity * (sizes[:, None] + sizes[None, :] - common) - 1e-9
            np.fill_diagonal(linked, False)
            if group.column("low")[0].as_py() != group.column("high")[0].as_py():
                linked &= block[:, None] != block[None, :]
            left, right = np.nonzero(np.triu(linked))
            links = np.zeros(len(keys), np.int64)
            for start in range(0, len(left), 1 << 16):
                a, b = left[start:start + (1 << 16)], right[start:start + (1 << 16)]
                both = (names[a] == names[b]) & (names[a] != 0)
                here = names[a, both.argmax(axis=1)] == bucket
                links += np.bincount(a[here], minlength=len(keys)) + np.bincount(b[here], minlength=len(keys))
            rows = np.flatnonzero(linked.any(axis=1))
            root = _forest(linked)
            yield pa.RecordBatch.from_arrays(
                [pa.array([keys[i] for i in rows], pa.string()), pa.array(links[rows], pa.int64()),
                 pa.array([keys[root[i]] for i in rows], pa.string())], names=["key", "n_links", "root"])

    return members.repartition("bucket", "low", "high").sortWithinPartitions("bucket", "low", "high").mapInArrow(
        verify, "key string, n_links bigint, root string")


def join(
    docs: DataFrame, similarity: float = SIMILARITY, shingle: int = SHINGLE, recall: float = RECALL,
    rows: int = ROWS, block: int = BLOCK,
) -> DataFrame:
    """``doc_id, mark, class_id, n_links, n_copies, group_id`` of every row.

    ``class_id`` is the smallest doc_id with the same words, ``n_copies`` the size of that class,
    ``n_links`` the number of other classes at least that similar, and ``group_id`` the smallest
    doc_id that chains of such links reach. ``mark`` is a hash of the text.
    """
    bands = bands_for(similarity, recall, rows)
    sketched = scratch_table(sketches(docs, shingle, bands, rows), "sketches")
    names = [f"band_{i}" for i in range(bands)]
    classes = scratch_table(sketched.groupBy("key").agg(
        F.min("doc_id").alias("class_id"), F.count(F.lit(1)).alias("n_copies"),
        *[F.min(name).alias(name) for name in names]), "classes")
    candidates = scratch_table(_shared_buckets(classes, bands), "candidates")
    sets = candidates.join(_full_sets(docs, candidates, shingle), "key")
    blocks = F.ceil(F.col("b.n") / block).cast("int")
    own = F.pmod(F.xxhash64("key", F.lit("block")), blocks).cast("int")
    distinct = F.array_distinct(F.transform("buckets", lambda b: F.struct(b["bucket"].alias("bucket"), b["n"].alias("n"))))
    dealt = sets.select("key", "shingles", "buckets", F.explode(distinct).alias("b")).select(
        "key", "shingles", "buckets", F.col("b.bucket").alias("bucket"), own.alias("block"),
        F.explode(F.sequence(F.lit(0), blocks - 1)).alias("other"))
    found = scratch_table(_verify(dealt.select(
        "key", "shingles", "buckets", "bucket", "block", F.least("block", "other").alias("low"),
        F.greatest("block", "other").alias("high")), similarity, bands), "links")
    links = found.groupBy("key").agg(F.sum("n_links").alias("n_links"))
    roots = components(found.select(F.col("key").alias("a"), F.col("root").alias("b")))
    ids = classes.select("key", "class_id", "n_copies")
    grouped = roots.join(ids, roots.node == ids.key).select("node", "root", "class_id")
    groups = grouped.join(grouped.groupBy("root").agg(F.min("class_id").alias("group_id")), "root").select(
        F.col("node").alias("key"), "group_id")
    full = ids.join(links, "key", "left").join(groups, "key", "left").select(
        "key", "class_id", "n_copies", F.coalesce("n_links", F.lit(0)).alias("n_links"),
        F.coalesce("group_id", "class_id").alias("group_id"))
    return sketched.select("doc_id", "mark", "key").join(full, "key").select(
        "doc_id", "mark", "class_id", "n_links", "n_copies", "group_id")


def keep_one_of_each(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """The documents without near copies: of each group the row with the smallest doc_id stays."""
    keepers = join(docs, similarity).where(F.col("doc_id").eqNullSafe(F.col("group_id"))).groupBy(
        F.col("doc_id").alias("keep_id"), F.col("mark").alias("keep_mark")).agg(F.count(F.lit(1)).alias("n"))
    keepers = scratch_table(keepers, "keepers")
    rows = docs.select(F.struct("*").alias("row"), F.xxhash64(whole("text")).alias("mark"))
    match = F.col("row.doc_id").eqNullSafe(F.col("keep_id")) & (F.col("mark") == F.col("keep_mark"))
    kept = rows.join(keepers.hint("shuffle_hash"), match, "left_semi")
    if keepers.where("n > 1").limit(1).count():  # repeated rows: one of them
        kept = kept.select("*", F.col("row.doc_id").alias("keep_id")).dropDuplicates(["keep_id", "mark"])
    return kept.select("row.*")
