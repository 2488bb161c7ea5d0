"""Secret scans: patterns, and a guess-cost judgement of values in a credential context.

Patterns find assignments, access keys and hex strings. Beside them, any value that a credential
word introduces ("pwd is ...", "passphrase: ...") is judged by how many guesses it would take: the
cheapest way to spell it as words, dates, repeats, keyboard walks and brute-force characters, found
by dynamic programming. From ``STRONG`` on (powers of ten) it is reported as ``guess``; a
placeholder such as ``changeme`` is not.

The cost of a word is its rarity in the corpus, counted over all documents. Only words that occur
inside some value are looked up, by a join, so no dictionary is sent around. A value of any length
is judged whole; its stretches stream past, a bounded number at a time.

Defined results: a null or empty text has no span; repeated rows get the same spans each; only
doc_id and text are read. An empty table gives no row.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import scratch_table, sha256, whole, words_of

KINDS = ("assign", "access", "hex", "guess")
STRONG = 8.0
WORD = (3, 20)  # letters of a word inside a value
STARTS = 4096  # places of a value whose stretches are held at once

_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")  # the runs of 24 and more: a shorter one cannot begin a longer one
_CONTEXT = re.compile(
    r"""(?:pass(?:word|wd|phrase|code)|pwd|secret|token|api[_-]?key|credential|private[_-]?key|login)s?["']?"""
    r"""(?:\x20*(?::|=>?|->)\x20*|\x20+(?:is|was)\x20+)["'`]?([^\s"'`,;<>()]{6,})""", re.I | re.A)
# A text without any of these has no match of the expression; lower case, found at memory speed.
_ASSIGN_HINTS = ("password", "passwd", "secret", "token", "apikey", "api_key")
_CONTEXT_HINTS = (*_ASSIGN_HINTS, "passphrase", "passcode", "pwd", "api-key", "credential", "private", "login")
_RUNS = re.compile("[A-Za-z]+")

# The rows of a keyboard, and orders that people type along.
_WALKS = ("qwertyuiop", "asdfghjkl", "zxcvbnm", "1234567890", "abcdefghijklmnopqrstuvwxyz", "qazwsxedcrfvtgbyhnujm")
_NEXT = {a + b for walk in _WALKS for line in (walk, walk[::-1]) for a, b in zip(line, line[1:], strict=False)}
_DATE = re.compile(r"(?:19|20)\d\d([-/._]?)(?:0[1-9]|1[0-2])\1(?:0[1-9]|[12]\d|3[01])"
                   r"|(?:0[1-9]|[12]\d|3[01])([-/._]?)(?:0[1-9]|1[0-2])\2(?:19|20)\d\d|(?:19|20)\d\d")
_TENTH = math.log10(2)


def base_matches(text: str) -> list[tuple[int, int, int]]:
    """``start, kind, end`` of the pattern matches, in order."""
    found = []
    low = text.lower()
    if any(hint in low for hint in _ASSIGN_HINTS):
        found += [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    return sorted(found)


def context_values(text: str) -> list[tuple[str, int, int]]:
    low = text.lower()
    if not any(hint in low for hint in _CONTEXT_HINTS):
        return []
    return [(m[1], m.start(1), m.end(1)) for m in _CONTEXT.finditer(text)]


def _brute(text: str) -> float:
    """Guesses per character, from the kinds of characters in the whole value."""
    size = (10 * any(c.isdigit() for c in text) + 26 * any(c.islower() for c in text)
            + 26 * any(c.isupper() for c in text) + 33 * any(not c.isalnum() for c in text))
    return math.log10(max(size, 10))


def guess_cost(value: str, words: dict[str, float]) -> float:
    """Powers of ten of the guesses for the cheapest segmentation.

    ``words`` gives the cost of a word in lower case. A capital doubles a word's guesses; every
    segment after the first doubles them for where it is cut. Steps look back a bounded way, but
    for repeats and walks, which are runs: their starts are kept while scanning.
    """
    n, low, single = len(value), value.lower(), _brute(value)
    dates = {(m.end(), m.start()) for i in range(n) if value[i].isdigit() and (m := _DATE.match(value, i))}
    ends: dict[int, list[int]] = {}
    for end, start in dates:
        ends.setdefault(end, []).append(start)
    best = [0.0] + [math.inf] * n
    walk = same = 0
    for end in range(1, n + 1):
        if end > 1:
            if low[end - 2:end] not in _NEXT:
                walk = end - 1
            if value[end - 2] != value[end - 1]:
                same = end - 1
        cut = [(best[end - 1] + single, end - 1)]
        if end - walk >= 3:
            cut.append((best[walk] + math.log10(47 * (end - walk)), walk))
        if end - same >= 3:
            cut.append((best[same] + single + math.log10(end - same), same))
        for start in ends.get(end, ()):
            cut.append((best[start] + math.log10(200 if end - start == 4 else 200 * 366), start))
        for start in range(max(0, end - WORD[1]), end - WORD[0] + 1):
            cost = words.get(low[start:end])
            if cost is not None:
                cut.append((best[start] + cost + _TENTH * (value[start:end] != low[start:end]), start))
        # A block typed twice costs the block and one choice more.
        for size in range(2, min(12, end // 2) + 1):
            if value[end - size:end] == value[end - 2 * size:end - size]:
                cut.append((best[end - size] + _TENTH, end - size))
        best[end] = min(cost + _TENTH * (0 < start < end - 1) for cost, start in cut)
    return best[n]


def _parts(value: str) -> Iterator[list[str]]:
    """All stretches of letters of a value that could be a word, ``STARTS`` places at a time.

    A stretch comes once per piece: what is held is bounded by the piece, however long the value.
    """
    least, most = WORD
    held: set[str] = set()
    places = 0
    for run in _RUNS.finditer(value.lower()):
        first, last = run.span()
        for i in range(first, last - least + 1):
            held.update(run.string[i:j] for j in range(i + least, min(i + most, last) + 1))
            places += 1
            if places == STARTS:
                yield sorted(held)
                held, places = set(), 0
    if held:
        yield sorted(held)


def _scan(docs: DataFrame) -> DataFrame:
    """``doc_id, base, values`` of every row."""
    base = pa.list_(pa.struct([("start", pa.int64()), ("order", pa.int32()), ("end", pa.int64())]))
    values = pa.list_(pa.struct([("value", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [text or "" for text in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([
                batch.column(0),
                pa.array([[{"start": a, "order": k, "end": b} for a, k, b in base_matches(t)] for t in texts], base),
                pa.array([[{"value": v, "start": a, "end": b} for v, a, b in context_values(t)] for t in texts], values),
            ], names=["doc_id", "base", "values"])

    schema = T.StructType([
        T.StructField("doc_id", docs.schema["doc_id"].dataType),
        T.StructField("base", T.ArrayType(T.StructType([
            T.StructField("start", T.LongType()), T.StructField("order", T.IntegerType()),
            T.StructField("end", T.LongType())]))),
        T.StructField("values", T.ArrayType(T.StructType([
            T.StructField("value", T.StringType()), T.StructField("start", T.LongType()),
            T.StructField("end", T.LongType())])))])
    return docs.select("doc_id", "text").mapInArrow(scan, schema)


def value_costs(docs: DataFrame, values: DataFrame) -> DataFrame:
    """``value_key, cost`` of every distinct value, words priced by their share of the corpus.

    ``values`` holds ``value_key``, a hash of the value, beside the value. Stretches travel with the
    hash, never with the value, so a long value costs no more than its length times the longest word.
    """
    distinct = values.select("value_key", "value").dropDuplicates(["value_key"])

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, value in zip(batch.column(0), batch.column(1), strict=True):
                for words in _parts(value.as_py()):
                    yield pa.RecordBatch.from_arrays(
                        [pa.repeat(key, len(words)), pa.array(words, pa.string())], names=["value_key", "word"])

    def price(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            costs = [guess_cost(value, {w["word"]: w["cost"] for w in words or ()})
                     for value, words in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(costs, pa.float64())], names=["value_key", "cost"])

    inside = distinct.mapInArrow(parts, "value_key string, word string")
    counts = docs.select(F.explode(words_of(F.lower(whole("text")))).alias("word")).where(
        F.length("word").between(*WORD)).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    counts = scratch_table(counts, "word-counts")
    total = counts.agg(F.sum("n").alias("n")).first()["n"] or 1
    wanted = counts.join(inside.select("word").distinct(), "word", "left_semi")
    priced = wanted.select("word", F.log10(F.lit(float(total)) / F.col("n")).alias("cost"))
    # The words of one value, once each: a set bounded by the length of that value.
    known = inside.join(priced, "word").groupBy("value_key").agg(F.collect_set(F.struct("word", "cost")).alias("words"))
    return distinct.join(known, "value_key", "left").select("value_key", "value", "words").mapInArrow(
        price, "value_key string, cost double")


def find_secrets(docs: DataFrame, strong: float = STRONG) -> DataFrame:
    """``doc_id, base, spans``: matches of the patterns, and all spans, as ``start, order, kind, end``."""
    scanned = scratch_table(_scan(docs).withColumn("row", F.monotonically_increasing_id()), "secrets")
    values = scanned.select("row", F.explode("values").alias("v")).select(
        "row", "v.*", sha256(F.col("v.value")).alias("value_key"))
    strongest = values.drop("value").join(value_costs(docs, values), "value_key").where(F.col("cost") >= strong).groupBy("row").agg(
        F.collect_list(F.struct("start", F.lit(3).alias("order"), "end")).alias("added"))
    empty = F.array().cast("array<struct<start:bigint,order:int,end:bigint>>")

    def named(spans: Column) -> Column:
        return F.transform(F.array_sort(spans), lambda s: F.struct(
            s["start"].alias("start"), s["order"].alias("order"),
            F.get(F.array(*map(F.lit, KINDS)), s["order"]).alias("kind"), s["end"].alias("end")))

    return scanned.join(strongest, "row", "left").select(
        "doc_id", named(F.col("base")).alias("base"),
        named(F.concat("base", F.coalesce("added", empty))).alias("spans"))


def digest(found: DataFrame) -> DataFrame:
    def joined(spans: str) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(
            ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    return found.select("doc_id", *[count(kind) for kind in KINDS[:3]],
                        sha256(joined("base")).alias("base_sha256"), joined("spans").alias("spans"))
