"""The operators over their whole tables as named queries, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, chat, decontam, fim, html, linededup, ngrams, pii, quality, secrets, sharding, spelling, warc
from .common import sha256, table

SHARDS = 40


def op1_pii(spark: SparkSession, folder: str) -> DataFrame:
    return pii.digest(pii.find_spans(table(spark, folder, "documents")))


def op2_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.digest(table(spark, folder, "documents"))


def op3_chat(spark: SparkSession, folder: str) -> DataFrame:
    return chat.format_chats(table(spark, folder, "conversations"))


def op4_quality(spark: SparkSession, folder: str) -> DataFrame:
    base = F.col("failed").bitwiseAND(F.lit(quality.BASE)) != 0
    return quality.ledger(table(spark, folder, "documents")).select(
        "row.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        base.alias("base_failed"), quality.passes().alias("kept"), "failed")


def op5_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return linededup.drop_repeated_lines(table(spark, folder, "documents").select("doc_id", "text")).select(
        "row.doc_id", "n_lines", "n_dropped", sha256(F.col("text")).alias("kept_sha256"))


def op6_secrets(spark: SparkSession, folder: str) -> DataFrame:
    return secrets.digest(secrets.find_secrets(table(spark, folder, "documents")))


def op7_html(spark: SparkSession, folder: str) -> DataFrame:
    return html.extract(table(spark, folder, "pages")).select(
        "page_id", "url", "text", F.length("text").cast("bigint").alias("n_chars"))


def op8_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontam.leaks(table(spark, folder, "documents"), table(spark, folder, "benchmark")).select(
        "doc_id", "item_id", "place", "share", "kind")


def op9_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.place(table(spark, folder, "documents"), sharding.tree(SHARDS))


def op10_ngram_join(spark: SparkSession, folder: str) -> DataFrame:
    """``class_id``: the smallest doc_id that links reach; ``copy_id``: the smallest with the same words."""
    return ngrams.join(table(spark, folder, "documents")).select(
        "doc_id", F.col("group_id").alias("class_id"), "n_links", F.col("class_id").alias("copy_id"), "n_copies")


def op11_fim(spark: SparkSession, folder: str) -> DataFrame:
    cut = fim.transform(table(spark, folder, "documents").select("doc_id", "text"))
    return cut.select(
        "row.doc_id", "n", "form", "prefix_chars", "middle_chars", sha256(F.col("output")).alias("output_sha256"),
        sha256(fim.restore(F.col("output"), F.col("form"))).alias("restored_sha256"))


def op12_warc(spark: SparkSession, folder: str) -> DataFrame:
    return warc.archive_pages(table(spark, folder, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op13_spelling(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.variants(table(spark, folder, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_pii, op2_bpe, op3_chat, op4_quality, op5_line_dedup, op6_secrets, op7_html, op8_decontamination,
        op9_sharding, op10_ngram_join, op11_fim, op12_warc, op13_spelling)}

_BLANKS = r"chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ' '"

_CHAT = r"""
with plain as (
  select distinct conv_id, turn, coalesce(role, 'user') as role, coalesce(text, '') as text from conversations
), listed as (
  select conv_id, count(*) as n_turns,
         list(struct_pack(role := role, text := text)
              order by turn nulls first, role, text) as turns
  from plain group by conv_id
), equal as (
  select turns, n_turns, min(conv_id) as conv_id, count(*) as n_equal from listed group by turns, n_turns
), prefixes as (
  select distinct turns[1:k] as turns
  from listed, unnest(range(1, n_turns)) as r(k)
)
select e.conv_id, e.n_turns, e.n_equal,
       array_to_string(list_transform(e.turns, lambda t: '<|' || t.role || '|>' || chr(10) || t.text || chr(10)), '') as text
from equal e where not exists (select 1 from prefixes p where p.turns = e.turns)
"""

_QUALITY = rf"""
with base as (
  select row_number() over () as row, doc_id, coalesce(text, '') as text from documents
), split as (
  select row, doc_id, text,
         list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda w: w <> '') as words,
         list_filter(string_split(text, chr(10)), lambda l: trim(l, {_BLANKS}) <> '') as lines
  from base
), windows as (
  select row, i, words[i:i + 2] as w from split, unnest(range(1, len(words) - 1)) as r(i)
), repeated as (
  select row, i, count(*) over (partition by row, w) as n from windows
), covered as (
  select row, count(distinct i + d) as n from repeated, unnest([0, 1, 2]) as t(d) where n > 1 group by row
), measured as (
  select doc_id, len(words)::bigint as n_words,
         length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g'))::bigint as word_chars,
         (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::bigint as n_symbols,
         len(lines)::bigint as n_lines,
         (len(lines) - len(list_distinct(lines)))::bigint as n_dup_lines,
         coalesce(c.n, 0)::bigint as n_repeat_words
  from split left join covered c using (row)
), judged as (
  select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed,
         ((n_words < 50)::bigint + 2 * (100 * n_repeat_words > 50 * n_words)::bigint
          + 4 * (4 * n_symbols > n_words)::bigint + 8 * (100 * n_dup_lines > 50 * n_lines)::bigint
          + 16 * (word_chars > 25 * n_words)::bigint + 32 * (word_chars < 2 * n_words)::bigint)::bigint as failed
  from measured
)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, failed = 0 as kept, failed
from judged
"""

_LINE_DEDUP = rf"""
with lines as (
  select d.doc_id, i, string_split(coalesce(d.text, ''), chr(10))[i] as line
  from documents d, unnest(range(1, len(string_split(coalesce(d.text, ''), chr(10))) + 1)) as r(i)
), keyed as (
  select *, translate(trim(line, {_BLANKS}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key from lines
), repeated as (
  select key, max(doc_id) as keeper from keyed where length(key) >= 40
  group by key having count(distinct doc_id) >= 5
), marked as (
  select k.doc_id, k.i, k.line, r.key is not null and k.doc_id <> r.keeper as gone
  from keyed k left join repeated r using (key)
)
select doc_id, count(*) as n_lines, count(*) filter (where gone) as n_dropped,
       sha256(coalesce(string_agg(line, chr(10) order by i) filter (where not gone), '')) as kept_sha256
from marked group by doc_id
"""


_FIM = r"""
with drawn as (
  select doc_id, coalesce(text, '') as text, sha256('42:' || doc_id) as h,
         regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') as t
  from documents
), numbered as (
  select *, len(t)::bigint as n, ('0x' || h[1:8])::bigint % (len(t) + 1) as c1, ('0x' || h[9:16])::bigint % (len(t) + 1) as c2,
         case when text = '' or contains(text, '<P>') or contains(text, '<S>') or contains(text, '<M>')
                   or ('0x' || h[17:24])::bigint % 100 >= 50 then 'plain'
              when ('0x' || h[25:32])::bigint % 100 < 80 then 'spm' else 'psm' end as form
  from drawn
), parts as (
  select *, array_to_string(t[1:least(c1, c2)], '') as p, array_to_string(t[least(c1, c2) + 1:greatest(c1, c2)], '') as m,
         array_to_string(t[greatest(c1, c2) + 1:], '') as s
  from numbered
)
select doc_id, n, form, case when form <> 'plain' then length(p) end::bigint as prefix_chars,
       case when form <> 'plain' then length(m) end::bigint as middle_chars,
       sha256(case form when 'plain' then text when 'psm' then '<P>' || p || '<S>' || s || '<M>' || m
                        else '<S>' || s || '<P>' || p || '<M>' || m end) as output_sha256,
       sha256(text) as restored_sha256
from parts
"""

# Five hexadecimal digits are four of base 32.
_WARC = """
with measured as (
  select page_id, octet_length(encode(coalesce(html, '')))::bigint as payload_bytes, sha1(coalesce(html, '')) as h from pages
), digests as (
  select page_id, payload_bytes, array_to_string(list_transform(range(0, 8), lambda i:
    array_to_string(list_transform([15, 10, 5, 0], lambda b:
      substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((('0x' || substr(h, 1 + 5 * i::int, 5))::int >> b) & 31), 1)), '')), '')
    as payload_digest
  from measured
)
select page_id, payload_bytes, payload_digest,
       case when page_id = max(page_id) over same then 'response' else 'revisit' end as record_type,
       case when page_id <> max(page_id) over same then max(page_id) over same end as refers_to
from digests window same as (partition by payload_digest, payload_bytes)
"""


def oracle_sql() -> dict[str, str]:
    """Without SQL: what positions of matches, hash draws, vocabularies, wrappers or sketches decide.
    Those are tested against brute force."""
    return {"op3_chat": _CHAT, "op4_quality": _QUALITY, "op5_line_dedup": _LINE_DEDUP, "op11_fim": _FIM,
            "op12_warc": _WARC}
