"""Quality rules as a bitmask ledger.

Each text is measured once and each rule evaluated once: the ledger keeps the measurements and
one bit per failed rule. What is kept is decided afterwards, by a versioned policy that is only a
mask over those bits, so a policy can be changed, compared or ablated without reading a text again.

Defined results: a null or empty text has no words, measures 0 everywhere and fails ``few_words``;
repeated rows and repeated ids each get a row of their own; other columns travel in the struct
``row`` and cannot clash with the ledger's. An empty table gives an empty ledger.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WS, whole, words_of

SYMBOLS = "#*$%&|<>"


@dataclass(frozen=True)
class Rule:
    """A rule fails where ``failure``, SQL over the measurements, holds."""

    bit: int
    name: str
    failure: str

    @property
    def mask(self) -> int:
        return 1 << self.bit


# Bits are never reused: a ledger written by an earlier version stays readable.
RULES = (
    Rule(0, "few_words", "n_words < 50"),
    Rule(1, "repeated_words", "100 * n_repeat_words > 50 * n_words"),
    Rule(2, "symbols", "4 * n_symbols > n_words"),
    Rule(3, "repeated_lines", "100 * n_dup_lines > 50 * n_lines"),
    Rule(4, "long_words", "word_chars > 25 * n_words"),
    Rule(5, "short_words", "word_chars < 2 * n_words"),
)
MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")


def mask_of(*names: str) -> int:
    known = {rule.name: rule.mask for rule in RULES}
    return sum(known[name] for name in names)


BASE = mask_of("few_words", "repeated_words")
POLICIES = {
    "v1": BASE,
    "v2": BASE | mask_of("symbols", "repeated_lines", "long_words", "short_words"),
}
CURRENT = "v2"


def _windows(words: Column) -> Column:
    """One 64-bit hash per 3-word window, in order."""
    def window(i: Column) -> Column:
        return F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2))

    none = F.array().cast("array<bigint>")
    return F.when(F.size(words) < 3, none).otherwise(
        F.transform(F.sequence(F.lit(0), F.size(words) - 3), window))


def _measured(docs: DataFrame) -> DataFrame:
    """``row`` with all columns of a document, and its measurements.

    Words in repeated windows: windows are sorted by hash together with their position, those
    with an equal neighbour are kept, and the stretches they cover are added up. A text without
    any repeat, the usual case, skips the sort.
    """
    def neighbours(ordered: Column) -> Column:
        return F.filter(ordered, lambda w, i: (
            (w["h"] == F.get(ordered, i - 1)["h"]) | (w["h"] == F.get(ordered, i + 1)["h"])))

    def covered(places: Column) -> Column:
        start = F.struct(F.lit(-3).alias("last"), F.lit(0).cast("bigint").alias("n"))
        return F.aggregate(
            places, start,
            lambda acc, p: F.struct(p.alias("last"), (acc["n"] + F.least(F.lit(3), p - acc["last"])).alias("n")),
            lambda acc: acc["n"])

    split = docs.select(
        F.struct("*").alias("row"), whole("text").alias("text"), words_of("text").alias("words"),
        F.split(whole("text"), "\n", -1).alias("lines"))
    marked = split.select(
        "row", F.size("words").cast("bigint").alias("n_words"),
        F.length(F.regexp_replace("text", r"[\x20\x09-\x0D]+", "")).cast("bigint").alias("word_chars"),
        (F.length("text") - F.length(F.translate("text", SYMBOLS, ""))).cast("bigint").alias("n_symbols"),
        F.filter("lines", lambda line: F.btrim(line, F.lit(WS)) != "").alias("lines"),
        _windows(F.col("words")).alias("windows"))
    ordered = marked.select(
        "row", "n_words", "word_chars", "n_symbols", F.size("lines").cast("bigint").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"),
        F.when(F.size(F.array_distinct("windows")) < F.size("windows"), F.sort_array(
            F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))).alias("ordered"))
    places = ordered.withColumn("places", F.sort_array(
        F.transform(neighbours(F.col("ordered")), lambda w: w["i"])))
    repeats = F.coalesce(covered(F.col("places")), F.lit(0)).cast("bigint").alias("n_repeat_words")
    # The generator of one row keeps the optimizer from moving a filter on the measurements below
    # the projections above, where it would work them all out again for every window.
    return places.select("row", F.explode(F.array(F.struct(*MEASURES[:-1], repeats))).alias("m")).select("row", "m.*")


def ledger(docs: DataFrame) -> DataFrame:
    """``row``, the measurements and ``failed``, the bits of the rules that the text fails."""
    bits = [F.when(F.expr(rule.failure), F.lit(rule.mask)).otherwise(0) for rule in RULES]
    failed = bits[0]
    for bit in bits[1:]:
        failed = failed.bitwiseOR(bit)
    return _measured(docs).withColumn("failed", failed.cast("bigint"))


def passes(policy: str = CURRENT, failed: str = "failed") -> Column:
    """Whether a ledger row is kept under a policy."""
    return F.col(failed).bitwiseAND(F.lit(POLICIES[policy])) == 0


def filter_documents(docs: DataFrame, policy: str = CURRENT) -> DataFrame:
    """The documents that a policy keeps, with the columns they came with."""
    return ledger(docs).where(passes(policy)).select("row.*")


def ablations(book: DataFrame, policy: str = CURRENT) -> DataFrame:
    """Per rule of a policy: how many it fails, and how many only it keeps out.

    The ledger is first reduced to one row per bit pattern, of which there are at most two to
    the number of rules; the rest is bit arithmetic on those.
    """
    patterns = book.groupBy("failed").count()
    rules = F.explode(F.array(*[
        F.struct(F.lit(rule.name).alias("rule"), F.lit(rule.mask).cast("bigint").alias("mask"))
        for rule in RULES if POLICIES[policy] & rule.mask]))
    within = F.col("failed").bitwiseAND(F.lit(POLICIES[policy]))
    hit = F.col("r.mask").bitwiseAND(F.col("failed")) != 0
    return patterns.select("*", rules.alias("r")).groupBy(F.col("r.rule").alias("rule")).agg(
        F.sum(F.when(hit, F.col("count")).otherwise(0)).alias("n_failed"),
        F.sum(F.when(within == F.col("r.mask"), F.col("count")).otherwise(0)).alias("n_only"),
        F.sum(F.when(within == 0, F.col("count")).otherwise(0)).alias("n_kept"))


def compare_policies(book: DataFrame, old: str, new: str) -> DataFrame:
    """How many documents move between kept and dropped, per reason mask under the new policy."""
    return book.groupBy("failed").count().select(
        passes(old).alias("kept_before"), passes(new).alias("kept_after"),
        F.col("failed").bitwiseAND(F.lit(POLICIES[new])).alias("reasons"), "count",
    ).groupBy("kept_before", "kept_after", "reasons").agg(F.sum("count").alias("n"))
