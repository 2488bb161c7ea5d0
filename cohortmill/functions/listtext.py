"""Lists serialised as text, e.g. ``[1, 2]`` or ``['2024-01-03', None,]``.

The text is a list literal, which differs from JSON in three legal spellings: a trailing
comma, ``None`` and round brackets. These are rewritten and the rest is left to
``from_json``, which accepts single quotes and nesting. Text that still does not parse
gives NULL, so callers can count it, or raises when ``strict``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_ARRAY = "array<string>"
_QUOTED = r"""('(?:[^'\\]++|\\.)*+'|"(?:[^"\\]++|\\.)*+")"""


def is_list_text(text: Column) -> Column:
    return text.startswith("[")


def parse_list_text(text: Column, *, strict: bool = False) -> Column:
    """Array of strings; an empty array for NULL; NULL (or an error) for broken text."""
    tuple_text = F.regexp_replace(text, r"(?s)^\s*\((.*)\)\s*$", "[$1]")
    json = F.when(F.ltrim(text).startswith("("), tuple_text).otherwise(text)
    json = F.regexp_replace(json, r"([\[,]\s*)None(?=\s*[,\]])", "$1null")
    # A comma before the closing bracket goes, unless it stands inside quotes.
    json = F.regexp_replace(json, _QUOTED + r"|,(?=\s*\])", "$1")
    # The list must be all there is: inside other brackets, text behind it is an error, or a
    # second element.
    outer = F.from_json(F.concat(F.lit('{"v": ['), json, F.lit("]}")), f"struct<v:array<{_ARRAY}>>")["v"]
    parsed = F.when((F.size(outer) == 1) & F.rtrim(json).endswith("]"), F.get(outer, F.lit(0)))
    if strict:
        error = F.raise_error(F.concat(F.lit("broken list text: "), text)).cast(_ARRAY)
        parsed = F.coalesce(parsed, error)
    return F.when(text.isNull(), F.array().cast(_ARRAY)).otherwise(parsed)


def list_length(text: Column, *, strict: bool = False) -> Column:
    """Number of elements; 0 unless the text starts with ``[``; NULL for broken text."""
    size = F.array_size(parse_list_text(text, strict=strict))
    return F.when(is_list_text(text), size).otherwise(0)
