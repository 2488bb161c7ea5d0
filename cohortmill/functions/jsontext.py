"""Fields of JSON text with a stated type, and what is wrong where there is none."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Types that a JSON value shows as, by the type that is wanted of it.
_SHOWN = {"bigint": ("BIGINT",), "double": ("BIGINT", "DOUBLE", "DECIMAL"), "string": ("STRING",), "boolean": ("BOOLEAN",)}
FAULTS = ("no text", "broken", "missing", "null", "wrong type")


def _shown(text: Column, path: str) -> Column:
    """The type a field shows, VOID for a JSON null, null where there is none."""
    return F.schema_of_variant(F.try_variant_get(F.try_parse_json(text), path, "variant"))


def json_field(text: Column, path: str, kind: str) -> Column:
    """The field as ``kind``; null unless it is there and has that type: no text is read as a number."""
    return F.when(json_fault(text, path, kind).isNull(), F.try_variant_get(F.try_parse_json(text), path, kind))


def json_fault(text: Column, path: str, kind: str) -> Column:
    """One of ``FAULTS``, or null for a field that is as it should be."""
    shown = _shown(text, path)
    right = F.regexp_extract(shown, "^[A-Z]+", 0).isin(*_SHOWN[kind])
    return (
        F.when(text.isNull(), "no text")
        .when(F.try_parse_json(text).isNull(), "broken")
        .when(shown.isNull(), "missing")
        .when(shown == "VOID", "null")
        .when(~right, "wrong type"))
