"""Fill-in-the-middle against a plain version, in both units."""

import brute
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cohortmill.llm import fim

ODD = ["<P>", "has <M> in it", "< P > <S", "tail \n\t ", "  lead", "　  ", "é", "汉字 x 漢 yé\U0001F600 z " * 300,
       "a\U0001F600", "\U0001F600", "ab\x00c d", "x " * 20_000 + "é" * 50]
ROWS = brute.rows() + [(1000 + 7 * i + j, text) for i, text in enumerate(ODD) for j in range(7)]


@pytest.mark.parametrize("unit", ["token", "char"])
def test_cuts_and_order(spark, unit):
    docs = brute.docs(spark, ROWS).selectExpr("*", "'n' as form", "'o' as output", "1 as h1")
    out = fim.transform(docs, unit, rate=90)
    got = brute.collected(out.withColumn("back", fim.restore(F.col("output"), F.col("form"))),
                          "row.doc_id", "n", "form", "prefix_chars", "middle_chars", "output", "back", "row.output")
    want = [(i, *brute.filled(i, text, rate=90, unit=unit), text or "", "o") for i, text in ROWS]
    assert got == sorted(want, key=repr)
    assert {row[2] for row in got} == {"plain", "psm", "spm"}
    assert brute.count(fim.transform(docs.limit(0), unit)) == 0


def test_an_unknown_unit_is_refused(spark):
    with pytest.raises(ValueError):
        fim.transform(brute.docs(spark), "line")


@settings(max_examples=200, deadline=None)
@given(st.text(st.sampled_from("ab é汉\U0001F600"), max_size=40))
def test_the_index_converts_both_ways(text):
    index = fim.SparseIndex(np.frombuffer(text.encode(), np.uint8))
    chars = np.arange(len(text) + 1)
    places = np.array([len(text[:i].encode()) for i in chars])
    assert index.bytes(chars).tolist() == places.tolist() and index.chars(places).tolist() == chars.tolist()
    assert len(index.lead) == sum(ord(c) > 127 for c in text)


def test_pieces_of_a_batch_change_nothing(spark, monkeypatch):
    docs = brute.docs(spark, ROWS)
    whole = brute.collected(fim.transform(docs), "row.doc_id", "n", "prefix_chars", "output")
    monkeypatch.setattr(fim, "PIECE", 50)
    assert brute.collected(fim.transform(docs), "row.doc_id", "n", "prefix_chars", "output") == whole
