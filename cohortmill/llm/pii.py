"""Personal data: patterns, and terms that give a protected entity away.

Patterns find emails, addresses, card and phone numbers; every value found is a protected entity.
Terms of the texts that hold an entity are then judged by information theory, as in C-sanitisation:
the pointwise mutual information of a term and an entity, as a share of the information the entity
itself carries. A term that reveals at least ``GENERALISE`` of it is replaced by its class, one that
reveals ``REMOVE`` goes, wherever it stands in a text with that entity. Counts cover all documents,
and all of them are counts of distinct texts: neither copies of a text nor repeats inside one change
what is disclosed. What stands inside an email is no term.

An entity and a term must share ``SUPPORT`` texts, or all texts of an entity that has fewer. So an
entity of one text is judged by the same estimate: a term that n of N texts hold reveals
1 - ln n / ln N of it. The terms of a text are its whole text's, however far from the entity.

Entities that the same texts hold have the same counts with every term, so they are judged as one:
a list of ten thousand numbers costs what one number costs.

All of it is column expressions. Spark's regular expressions give matches but not where they are;
positions come from the lengths of the matches and of the gaps between them (``split`` by the same
expression). Expressions are written so that no text makes them slow: a run of characters is tried
from its start only (or from where the last match ended), and repeats are possessive.

Defined results: a null or empty text has no span; repeated rows get the same spans each; only
doc_id and text are read, so other columns cannot clash. An empty table gives no row.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import scratch_table, sha256, whole

KINDS = ("email", "ip", "card", "phone")
ADDED = ("generalised", "removed")
SUPPORT = 3  # distinct texts that must show an entity and a term together, where the entity has so many
BLOCK = 512  # matches that are put together at a time
GENERALISE, REMOVE = 0.6, 0.9

_LOCAL = "[A-Za-z0-9._%+-]"
_PATTERNS = {
    "email": rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?+[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# What a text must contain for a pattern to be worth trying.
_HINTS = {"email": "@", "ip": ".", "card": None, "phone": "+"}
_BYTE = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
_TERM = r"\p{L}[\p{L}\p{N}_'-]{2,}+"
_SPANS = "array<struct<start:bigint,end:bigint,value:string>>"


def _located(text: Column, pattern: str, keep: Callable[[Column], Column] | None = None) -> Column:
    """All matches, or those with a value to ``keep``, leftmost first, as ``start, end, value``.

    Positions are summed inside blocks of matches first, then over the blocks, so that no array of
    all matches so far is copied with each match.
    """
    begin = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast(_SPANS).alias("out"))

    def step(acc: Column, piece: Column) -> Column:
        start = acc["at"] + F.length(piece["gap"])
        end = start + F.length(piece["hit"])
        more = F.concat(acc["out"], F.array(F.struct(start.alias("start"), end.alias("end"), piece["hit"].alias("value"))))
        out = F.when(keep(piece["hit"]), more).otherwise(acc["out"]) if keep else more
        # The last gap has no match behind it.
        return F.when(piece["hit"].isNull(), acc).otherwise(F.struct(end.alias("at"), out.alias("out")))

    def append(acc: Column, block: Column) -> Column:
        moved = F.transform(block["out"], lambda m: F.struct(
            (acc["at"] + m["start"]).alias("start"), (acc["at"] + m["end"]).alias("end"), m["value"].alias("value")))
        return F.struct((acc["at"] + block["at"]).alias("at"), F.concat(acc["out"], F.array(moved)).alias("out"))

    def joined_up(pieces: Column) -> Column:
        blocks = F.transform(F.sequence(F.lit(1), F.size(pieces), F.lit(BLOCK)),
                             lambda first: F.aggregate(F.slice(pieces, first, BLOCK), begin, step))
        start = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast(f"array<{_SPANS}>").alias("out"))
        return F.flatten(F.aggregate(blocks, start, append, lambda acc: acc["out"]))

    pieces = F.arrays_zip(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("hit"),
                          F.split(text, pattern, -1).alias("gap"))
    # As an argument of a function the pieces are worked out once.
    return F.get(F.transform(F.array(pieces), joined_up), F.lit(0))


def _luhn(digits: Column) -> Column:
    def worth(d: Column, i: Column) -> Column:
        number = d.cast("int")
        return F.when(i % 2 == 0, number).when(number > 4, number * 2 - 9).otherwise(number * 2)

    values = F.transform(F.split(F.reverse(digits), ""), worth)
    return F.aggregate(values, F.lit(0), lambda a, v: a + v) % 10 == 0


def _holds(kind: str, value: Column) -> Column:
    """The condition beyond the pattern; a match that fails it is dropped."""
    if kind == "ip":
        return value.rlike(rf"^{_BYTE}(?:\.{_BYTE}){{3}}$")
    if kind == "card":
        digits = F.regexp_replace(value, r"[\x20-]", "")
        return F.when(F.length(digits).between(14, 19), _luhn(digits)).otherwise(False)
    if kind == "phone":
        return F.length(F.regexp_replace(value, "[^0-9]", "")).between(10, 15)
    return F.lit(True)


def _matches(text: Column, kind: str) -> Column:
    hint = text.contains(_HINTS[kind]) if _HINTS[kind] else text.rlike("[0-9]")
    keep = None if kind == "email" else lambda value: _holds(kind, value)
    return F.when(hint, _located(text, _PATTERNS[kind], keep)).otherwise(F.array().cast(_SPANS))


def _terms(text: Column) -> Column:
    """The different terms of a text, in lower case, beside those inside emails."""
    plain = F.when(text.contains(_HINTS["email"]), F.regexp_replace(text, _PATTERNS["email"], " ")).otherwise(text)
    return F.array_distinct(F.transform(F.regexp_extract_all(plain, F.lit(_TERM), F.lit(0)), lambda t: F.lower(t)))


def base_spans(docs: DataFrame) -> DataFrame:
    """``doc_id, text_hash``, one array of matches per kind, the different entities, and the text if it has any."""
    text = docs.select("doc_id", whole("text").alias("text"))
    found = text.select("*", *[_matches(F.col("text"), kind).alias(kind) for kind in KINDS])
    matches = F.concat(*KINDS)
    return found.select("doc_id", F.xxhash64("text").alias("text_hash"), *KINDS,
                        F.array_distinct(F.transform(matches, lambda m: F.lower(m["value"]))).alias("entities"),
                        F.when(F.size(matches) > 0, F.col("text")).alias("text"))


def _term_counts(docs: DataFrame, found: DataFrame) -> DataFrame:
    """``term, n_term``: the number of distinct texts with a term. A copy counts as its share of them."""
    copies = scratch_table(found.groupBy("text_hash").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "copies")
    texts = docs.select(whole("text").alias("text")).select("text", F.xxhash64("text").alias("text_hash"))
    return texts.join(copies, "text_hash", "left").select(
        (1 / F.coalesce("n", F.lit(1))).alias("share"), F.explode(_terms(F.col("text"))).alias("term")).groupBy(
        "term").agg(F.round(F.sum("share")).cast("bigint").alias("n_term"))


def _holders(held: DataFrame) -> DataFrame:
    """``text_hash, n_entity, set_a, set_b``: per text the sets of texts whose entities it holds.

    A set is named by its size and two order-free hashes; of one text, by that text alone.
    """
    entities = held.select("text_hash", F.explode("entities").alias("entity"))
    sets = scratch_table(entities.groupBy("entity").agg(
        F.count(F.lit(1)).alias("n_entity"), F.bit_xor("text_hash").alias("set_a"),
        F.bit_xor(F.xxhash64("text_hash", F.lit(1))).alias("set_b")), "entities")
    alone = sets.where("n_entity = 1").select(F.col("set_a").alias("text_hash"), "n_entity", "set_a", "set_b")
    shared = entities.join(sets.where("n_entity > 1"), "entity").drop("entity")
    return alone.unionByName(shared).distinct()


def disclosures(docs: DataFrame, found: DataFrame, held: DataFrame, support: int = SUPPORT,
                least: float = GENERALISE) -> DataFrame:
    """``text_hash, term, disclosed`` for the terms of a text that reveal at least the share ``least``
    of one of its entities.

    ``found`` has a row per document, ``held`` each text with an entity once. All counts are of
    distinct texts.
    """
    number = max(found.select("text_hash").distinct().count(), 2)
    total = math.log(number)
    holders = scratch_table(_holders(held), "holders")
    # Even if all texts with the term have the entity, one in more texts reveals too little.
    limit = float(number) ** (1 - least) * F.pow(F.col("n_entity").cast("double"), F.lit(least)) + 0.5
    most = holders.agg(F.max(limit)).first()[0] or 0.0
    terms = _term_counts(docs, found).where(F.col("n_term") <= most)
    known = scratch_table(held.select("text_hash", F.explode(_terms(F.col("text"))).alias("term")).join(terms, "term"), "known")

    pairs = holders.join(known, "text_hash").where(F.col("n_term") <= limit)
    information = total - F.log("n_entity")
    mutual = F.log("n_both") + total - F.log("n_entity") - F.log("n_term")
    share = F.when(information > 0, F.least(mutual / information, F.lit(1.0))).otherwise(0.0)

    alone = pairs.where("n_entity = 1").withColumn("n_both", F.lit(1)).select("text_hash", "term", share.alias("disclosed"))
    keys = ["n_entity", "set_a", "set_b", "term"]
    shared = pairs.where("n_entity > 1")
    judged = shared.groupBy(*keys, "n_term").agg(F.count(F.lit(1)).alias("n_both")).where(
        F.col("n_both") >= F.least(F.lit(support), "n_entity")).select(*keys, share.alias("disclosed")).where(
        F.col("disclosed") >= least)
    return alone.where(F.col("disclosed") >= least).unionByName(
        shared.join(judged, keys).select("text_hash", "term", "disclosed")).groupBy("text_hash", "term").agg(
        F.max("disclosed").alias("disclosed"))


def _revealing(docs: DataFrame, found: DataFrame, support: int) -> DataFrame:
    """``text_hash, added``: where terms stand that disclose an entity of the same text."""
    # Only texts with an entity, each once: tasks fold copies before anything is shuffled.
    held = scratch_table(found.where(F.size("entities") > 0).groupBy("text_hash").agg(
        F.first("text").alias("text"), F.first("entities").alias("entities")), "held")
    told = scratch_table(disclosures(docs, found, held, support), "disclosing")
    hits = held.select("text_hash", F.explode(_located(F.col("text"), _TERM)).alias("hit")).select(
        "text_hash", F.lower("hit.value").alias("term"), "hit.start", "hit.end")
    kind = F.when(F.col("disclosed") >= REMOVE, 1).otherwise(0)
    return hits.join(told, ["text_hash", "term"]).groupBy("text_hash").agg(F.collect_list(F.struct(
        "start", (F.lit(len(KINDS)) + kind).alias("order"), F.get(F.array(*map(F.lit, ADDED)), kind).alias("kind"), "end",
    )).alias("added"))


def _named(order: int, name: str) -> Column:
    return F.transform(name, lambda m: F.struct(
        m["start"].alias("start"), F.lit(order).alias("order"), F.lit(name).alias("kind"), m["end"].alias("end")))


def find_spans(docs: DataFrame, support: int = SUPPORT) -> DataFrame:
    """``doc_id, text_hash``, the matches per kind, and ``spans``: all of them and the terms that
    disclose them, as ``start, order, kind, end``, in order."""
    found = scratch_table(base_spans(docs), "pii")
    own = F.concat(*[_named(order, name) for order, name in enumerate(KINDS)])
    # A term that overlaps an entity goes with it.
    outside = F.filter("added", lambda a: ~F.exists(own, lambda s: (s["start"] < a["end"]) & (a["start"] < s["end"])))
    # Written first: a small table is broadcast, so a group of copies is not one task.
    revealing = scratch_table(_revealing(docs, found, support), "revealing")
    return found.join(revealing, "text_hash", "left").select(
        "doc_id", "text_hash", *KINDS, F.array_sort(own).alias("base"),
        F.array_sort(F.concat(own, F.coalesce(outside, F.array()))).alias("spans"))


def joined(spans: Column) -> Column:
    """``kind:start:end`` of every span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def digest(found: DataFrame) -> DataFrame:
    return found.select(
        "doc_id", *[F.size(k).cast("bigint").alias(f"n_{k}") for k in KINDS],
        sha256(joined(F.col("base"))).alias("base_sha256"), joined(F.col("spans")).alias("spans"))


def sanitise(docs: DataFrame, support: int = SUPPORT) -> DataFrame:
    """The documents with every span replaced: by ``<KIND>``, ``<TERM>``, or by nothing."""
    spans = find_spans(docs, support).select("doc_id", "text_hash", "spans").dropDuplicates(["doc_id", "text_hash"])
    text = F.col("d.row.text")

    def step(acc: Column, s: Column) -> Column:
        instead = F.when(s["kind"] == "removed", "").when(s["kind"] == "generalised", "<TERM>").otherwise(
            F.concat(F.lit("<"), F.upper(s["kind"]), F.lit(">")))
        kept = F.substring(text, (acc["at"] + 1).cast("int"), (s["start"] - acc["at"]).cast("int"))
        return F.struct(
            F.greatest(acc["at"], s["end"]).alias("at"),
            F.when(s["start"] >= acc["at"], F.concat(acc["out"], kept, instead)).otherwise(acc["out"]).alias("out"))

    begin = F.struct(F.lit(0).cast("bigint").alias("at"), F.lit("").alias("out"))
    clean = F.aggregate("s.spans", begin, step, lambda acc: F.concat(
        acc["out"], F.substring(text, (acc["at"] + 1).cast("int"), F.length(text))))
    rows = docs.select(F.struct("*").alias("row"), F.xxhash64(whole("text")).alias("text_hash"))
    match = F.col("d.row.doc_id").eqNullSafe(F.col("s.doc_id")) & (F.col("d.text_hash") == F.col("s.text_hash"))
    joined_rows = rows.alias("d").join(spans.alias("s"), match, "left")
    return joined_rows.select(*[
        F.when(text.isNotNull(), clean).alias("text") if name == "text" else F.col(f"d.row.`{name}`").alias(name)
        for name in docs.columns])
