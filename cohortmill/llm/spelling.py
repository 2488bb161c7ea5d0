"""Spelling variants: words one edit apart, found by walking a trie of the vocabulary.

Words that occur often enough are put into two tries, one of the words and one of the reversed words.
A state is (word, position, node): a word at a node of its own path, no edit made yet. Where its path
runs needs no join: which prefixes are nodes is known, so every word puts a state at each of its nodes
from the middle on that leads anywhere. An edit lies in the later half of the word or of its reversal, so
the first half is matched exactly and the branches near the root are never tried. The states are joined
with the edge table on the node, and spend their edit on every edge that does not match (replace, insert,
delete); of all ways to align two words one edit apart one has its edit there. From there on all letters
must match, so a state with its edit spent has one way to go, and the hash of the node at its end follows
from those of the edge's child and of the rest. If that is no node the state is dropped, else the words
that end there are joined on it and are the neighbours.

Edges are compressed: a node is a prefix with two continuations or the end of a word.
Nodes are known by a polynomial hash of their prefix. Which prefixes are nodes, and which of those lead on, is
kept in Bloom filters of fixed size, so edges are cut in one pass over the words without a join; a false alarm
makes a node more for all words alike. Neighbours are compared as texts in the end, so colliding hashes add none.

Hashes of all prefixes of a batch of words come from one running sum, since the factor has an inverse;
whether an edge matches is compared by Spark, letter by letter.

Adaptive execution splits a node with very many states or edges. A word is carried once for every
node on the later half of its path that leads on.

Defined results: a null text has no word; a null key draws as the empty key; repeated rows count each;
no other column is read, so none can clash. An empty table gives no row. Of equal counts the word that
is smallest in code-point order is the form. Runs of any length are whole words.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .bloom import Seen, twice_seen
from .common import scratch_table, whole

MIN_CHARS, MIN_COUNT = 7, 2
RATIO = 10  # a form is so many times as frequent
NOISE = 31  # one run in so many loses a letter; None: none does
_LETTER = "[A-Za-z\\u00C0-\\u00FF]"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

_STEP = 0x9E3779B97F4A7C15  # any odd number: it has an inverse modulo 2^64
_SIDES = np.array([0x243F6A8885A308D3, 0x13198A2E03707344], dtype=np.uint64)  # where the hashes of the two tries begin
PIECE = 1 << 20  # letters looked at together


def words(docs: DataFrame, key: str = "doc_id", min_chars: int = MIN_CHARS, noise: int | None = NOISE) -> DataFrame:
    """``word`` for every run of letters that is long enough, after a letter was lost in some."""
    number = F.coalesce(F.col(key).cast("string"), F.lit(""))
    runs = F.regexp_extract_all(whole("text"), F.lit(f"{_LETTER}{{{min_chars},}}+"), F.lit(0))

    def lost(run: Column) -> Column:
        h = F.crc32(F.concat(number, F.lit(":"), run).cast("binary"))
        at = F.pmod(h, F.length(run).cast("bigint")).cast("int")
        return F.when(h % noise == 0, F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.length(run)))).otherwise(run)

    # Inside the generator every step is worked out once; filters behind it see its result.
    low = F.transform(runs, lambda run: F.when(run.rlike("[A-Z]"), F.translate(run, _UPPER, _UPPER.lower())).otherwise(run))
    found = docs.select(F.explode(F.transform(low, lost) if noise else low).alias("word"))
    return found.where(F.length("word") >= min_chars)


def vocabulary(found: DataFrame, min_count: int = MIN_COUNT) -> DataFrame:
    """``word, n``."""
    return found.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_count)


# ---- the tries ------------------------------------------------------------------------


def _powers(factor: int, n: int) -> np.ndarray:
    factors = np.full(n + 1, factor, dtype=np.uint64)
    factors[0] = 1
    return np.cumprod(factors)


class Prefixes:
    """Hashes of all prefixes of some texts, as unsigned 64-bit numbers."""

    def __init__(self, texts: list[str], side: int | np.ndarray):
        self.joined = "".join(texts)
        self.letters = np.frombuffer(self.joined.encode("utf-32-le"), np.uint32).astype(np.int64)
        self.sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        self.starts = np.cumsum(self.sizes) - self.sizes
        longest = int(self.sizes.max(initial=0)) + 1
        self.powers = _powers(_STEP, longest)
        place = np.arange(len(self.letters)) - np.repeat(self.starts, self.sizes)
        weighed = self.letters.astype(np.uint64) * _powers(pow(_STEP, -1, 1 << 64), longest)[place + 1]
        self._sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(weighed, dtype=np.uint64)])
        self._begin = np.broadcast_to(_SIDES[side], len(texts))

    def of(self, text: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Hash of the first ``size`` letters of the text with some number."""
        start = self.starts[text]
        return self.powers[size] * (self._begin[text] + self._sums[start + size] - self._sums[start])

    def goal(self, text: np.ndarray, size: np.ndarray, node: np.ndarray) -> np.ndarray:
        """Hash of what a node stands for, with the letters of a text from ``size`` on behind it."""
        left = self.powers[self.sizes[text] - size]
        return (node - self.of(text, size)) * left + self.of(text, self.sizes[text])

    def later_half(self, middles: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Text and size of every prefix from one letter before the middle on."""
        counts = self.sizes - middles + 2
        text = np.repeat(np.arange(len(counts)), counts)
        first = np.cumsum(counts) - counts
        return text, np.arange(len(text)) - first[text] + middles[text] - 1


def _runs(sizes: np.ndarray) -> Iterator[slice]:
    """Slices of texts with a bounded number of letters in all, or one longer text."""
    ends, start = np.cumsum(np.concatenate([[0], sizes])), 0
    while start < len(sizes):
        end = max(int(np.searchsorted(ends, ends[start] + PIECE, "right")) - 1, start + 1)
        yield slice(start, end)
        start = end


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Slices with a bounded number of letters in the first column, or one longer word."""
    for batch in batches:
        texts = batch.column(0).to_pylist()
        for part in _runs(np.fromiter(map(len, texts), np.int64, len(texts))):
            yield batch.slice(part.start, part.stop - part.start), texts[part]


def _sides(words: list[str]) -> Iterator[tuple[int, Prefixes, np.ndarray]]:
    """The words as both tries read them, and their middles."""
    for side in (0, 1):
        prefixes = Prefixes([word[::-1] for word in words] if side else words, side)
        half = prefixes.sizes // 2
        yield side, prefixes, (prefixes.sizes - half if side else half)


def _signed(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64))


def _branches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``node, letter``: every prefix of the later half with the letter behind it; 0 where a word ends."""
    for _, words in _pieces(batches):
        for _, prefixes, middles in _sides(words):
            text, size = prefixes.later_half(middles)
            letters = np.append(prefixes.letters, 0)[np.minimum(prefixes.starts[text] + size, len(prefixes.letters))]
            letters[size == prefixes.sizes[text]] = 0
            yield pa.RecordBatch.from_arrays(
                [_signed(prefixes.of(text, size)), pa.array(letters.astype(np.int32))], names=["node", "letter"])


_EDGE = "node long, label string, child long"
_STATE = "node long, text string, position int, side int"
_SPENT = "goal long, text string, side int"
_END = "goal long, near string, near_n long"


def _nodes(known: DataFrame) -> DataFrame:
    """``node, inner``: prefixes where paths part or words end, and whether any leads on from there."""
    letters = known.select("word").mapInArrow(_branches, "node long, letter int").groupBy("node").agg(
        F.min("letter").alias("low"), F.max("letter").alias("high"))
    return letters.where("low = 0 or low <> high").select("node", (F.col("high") > 0).alias("inner"))


def _edges(known: DataFrame, is_node: Seen, is_inner: Seen) -> DataFrame:
    """``node, label, child``; an empty label leads from a node where a word ends to itself."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, words in _pieces(batches):
            for _, prefixes, middles in _sides(words):
                text, size = prefixes.later_half(middles)
                hashes = prefixes.of(text, size)
                held = np.flatnonzero(is_node.holds(hashes))
                text, size, hashes = text[held], size[held], hashes[held]
                a = np.flatnonzero(text[1:] == text[:-1])
                b, begin = a + 1, prefixes.starts[text]
                # A leaf leads nowhere.
                last = np.flatnonzero((size == prefixes.sizes[text]) & is_inner.holds(hashes))
                a, b = np.concatenate([a, last]), np.concatenate([b, last])
                labels = [prefixes.joined[i:j] for i, j in zip(
                    (begin + size)[a].tolist(), (begin + size)[b].tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [_signed(hashes[a]), pa.array(labels, pa.string()), _signed(hashes[b])],
                    names=["node", "label", "child"])

    return known.select("word").mapInArrow(cut, _EDGE).groupBy("node", "child").agg(F.max("label").alias("label"))


def _starts(is_inner: Seen) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A state for every node of a word's path from the middle on."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, words in _pieces(batches):
            for side, prefixes, middles in _sides(words):
                text, size = prefixes.later_half(middles)
                behind = size >= middles[text]
                text, size = text[behind], size[behind]
                hashes = prefixes.of(text, size)
                held = np.flatnonzero(is_inner.holds(hashes))
                text, size, hashes = text[held], size[held], hashes[held]
                texts = pa.array([word[::-1] for word in words] if side else words, pa.string())
                for part in _runs(prefixes.sizes[text]):
                    n = len(text[part])
                    yield pa.RecordBatch.from_arrays(
                        [_signed(hashes[part]), texts.take(pa.array(text[part])), pa.array(size[part].astype(np.int32)),
                         pa.array(np.full(n, side, np.int32))], names=["node", "text", "position", "side"])

    return run


def _hopeful() -> Column:
    """Whether a state can spend its edit on an edge: the edge does not match, and if it begins with another
    letter than the one at hand, what stands behind an edit there must match; if with the same, only a look
    at all letters tells. An empty label, where a word ends, is for a state with one letter to go."""
    label = F.col("label")
    tail, onward = F.substring(label, F.lit(2), F.length(label)), F.substring("rest", F.lit(2), F.length("rest"))
    behind = F.startswith("rest", tail) | ((F.col("rest") != "") & (F.startswith(onward, tail) | F.startswith(onward, label)))
    same = F.substring(label, 1, 1) == F.substring("rest", 1, 1)
    return F.when(label == "", F.length("rest") == 1).otherwise(~F.startswith("rest", label) & (same | behind))


def _spend(is_node: Seen) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """From a state and an edge that does not match to the nodes where the words it may reach end."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in _pieces(batches):
            at, side, width = (batch.column(i).to_numpy().astype(np.int64) for i in range(1, 4))
            child = batch.column(4).to_numpy().view(np.uint64)
            own = Prefixes(texts, side)
            off, less = np.flatnonzero(width > 0), np.flatnonzero(width == 0)  # at a word's end: the last letter less
            # Another letter, a letter more, a letter less.
            state = np.concatenate([less, off, off, off])
            reach = at[off] + width[off]
            there = np.concatenate([own.sizes[less], reach, reach - 1, reach + 1])
            inside = there <= own.sizes[state]
            state, there = state[inside], there[inside]
            goals = own.goal(state, there, child[state])
            held = np.flatnonzero(is_node.holds(goals))
            yield pa.RecordBatch.from_arrays(
                [_signed(goals[held]), batch.column(0).take(pa.array(state[held])),
                 pa.array(side[state[held]].astype(np.int32))], names=["goal", "text", "side"])

    return run


def _ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The node where each word ends, in both tries."""
    for batch, words in _pieces(batches):
        for _, prefixes, _ in _sides(words):
            ends = prefixes.of(np.arange(len(words)), prefixes.sizes)
            yield pa.RecordBatch.from_arrays(
                [_signed(ends), batch.column(0), batch.column(1)], names=["goal", "near", "near_n"])


def neighbours(known: DataFrame) -> DataFrame:
    """``word, near, near_n``: every pair of words one edit apart, from both ends."""
    def node_hashes(batch: pa.RecordBatch) -> np.ndarray:
        return batch.column(0).to_numpy().view(np.uint64)

    nodes = scratch_table(_nodes(known), "nodes")
    is_node = twice_seen(nodes.select("node"), node_hashes, times=1)
    is_inner = twice_seen(nodes.where("inner").select("node"), node_hashes, times=1)
    edges = scratch_table(_edges(known, is_node, is_inner), "trie")
    rest = F.substring("text", F.col("position") + 1, F.length("text"))
    met = known.select("word").mapInArrow(_starts(is_inner), _STATE).join(edges.hint("shuffle_hash"), "node").withColumn(
        "rest", rest).where(_hopeful())
    spent = met.select("text", "position", "side", F.length("label").alias("width"), "child").mapInArrow(
        _spend(is_node), _SPENT)
    ends = known.select("word", "n").mapInArrow(_ends, _END)
    word = F.when(F.col("side") == 1, F.reverse("text")).otherwise(F.col("text")).alias("word")
    found = spent.join(ends.hint("shuffle_hash"), "goal").select(word, "near", "near_n")
    return found.where(F.levenshtein("word", "near") == 1).distinct()


# ---- forms and roots -------------------------------------------------------------------


def roots(forms: DataFrame) -> DataFrame:
    """``word, root``: the end of each word's chain of forms. A step doubles what is behind a word; as
    every form is ``RATIO`` times as frequent, chains are as short as a logarithm of the count."""
    current = forms.select("word", F.col("form").alias("root"))
    while True:
        current = scratch_table(current, "roots")
        onward = current.select(F.col("word").alias("root"), F.col("root").alias("further"))
        longer = current.join(onward, "root", "left")
        if longer.where("further is not null").isEmpty():
            return current
        current = longer.select("word", F.coalesce("further", "root").alias("root"))


def variants(docs: DataFrame, key: str = "doc_id", min_chars: int = MIN_CHARS, min_count: int = MIN_COUNT,
             ratio: int = RATIO, noise: int | None = NOISE) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of every word that is long and frequent enough."""
    if min_chars < 3:
        raise ValueError("the halves of a word need a letter each, whatever the edit")
    known = scratch_table(vocabulary(words(docs, key, min_chars, noise), min_count), "vocabulary")
    best = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("form")))
    near = neighbours(known).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    taken = F.when(-F.col("best.less") >= ratio * F.col("n"), F.col("best"))
    judged = scratch_table(known.join(near, "word", "left").withColumn("best", taken).select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
        F.col("best.form").alias("form"), (-F.col("best.less")).alias("form_n")), "forms")
    ends = roots(judged.where(F.col("form").isNotNull()))
    return judged.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
