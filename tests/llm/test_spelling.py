"""Spelling variants against a comparison with every one-edit text."""

import random
import zlib

import brute
import numpy as np
import pyarrow as pa

from cohortmill.llm import spelling

COLUMNS = ("word", "form", "root", "n", "n_near", "form_n")


def check(spark, table, **options):
    got = brute.collected(spelling.variants(brute.docs(spark, table), **options), *COLUMNS)
    assert got == sorted(brute.spelled(table, **options), key=repr)
    return got


def test_whole_table_of_odd_rows(spark):
    long = "abcdefg" * 700
    table = brute.rows() + [(50, long), (51, long), (52, long + "x y " + long + "x"), (53, "ÀÉÎõüÿ÷×aÀ " * 3),
                            (54, "ABCdefgh abcDEFGH ÀBCDEFGH"), (None, "samesame samesame Samesame")]
    got = check(spark, table)
    assert any(len(row[0]) > 4000 for row in got)
    assert brute.count(spelling.variants(brute.docs(spark).limit(0))) == 0
    assert brute.count(spelling.variants(brute.docs(spark, [(1, None), (2, "short words")]))) == 0


def test_dense_words(spark):
    """Few letters, so that every kind of edit at every place occurs, also inside runs."""
    draw = random.Random(3)
    words = ["".join(draw.choices("aé", k=draw.choice((7, 8, 9)))) for _ in range(400)]
    words += ["a" * n for n in range(7, 60)]
    table = [(i, " ".join(draw.choices(words, k=60))) for i in range(60)]
    got = check(spark, table, min_count=1)
    assert max(row[4] for row in got) > 8
    check(spark, table, min_count=2, noise=None)
    check(spark, table, min_chars=3, noise=3)


def test_chains_of_forms_ties_and_lost_letters(spark):
    chain = {"wanderers": 1, "wanderer": 12, "wandered": 130, "bandereda": 2, "candereda": 2, "zandereda": 25, "yandereda": 25}
    text = " ".join(word for word, n in chain.items() for _ in range(n))
    rows = {row[0]: row for row in check(spark, [(1, text)], min_count=1, noise=None)}
    assert rows["wanderers"][1:3] == ("wanderer", "wandered")
    assert rows["bandereda"][1] == "yandereda"
    lost = next(i for i in range(10_000) if zlib.crc32(f"{i}:misprints".encode()) % 31 == 0)
    rows = check(spark, [(lost, "misprints MisPrints"), (lost + 1, "misprints")], min_count=1)
    assert ("misprints", 1) in [(row[0], row[3]) for row in rows] and len(rows) == 2


def test_a_false_alarm_makes_a_node_more_and_no_other_result(spark, monkeypatch):
    class All:
        def holds(self, hashes):
            return np.ones(len(hashes), dtype=bool)

    monkeypatch.setattr(spelling, "twice_seen", lambda *args, **kwargs: All())
    draw = random.Random(4)
    words = ["".join(draw.choices("ab", k=draw.choice((7, 8, 9)))) for _ in range(60)]
    check(spark, [(1, " ".join(words))], min_count=1)


def test_hashes_of_prefixes_and_goals():
    texts = ["abc", "", "xbcd", "é" * 50]
    got = spelling.Prefixes(texts, 1)
    for i, text in enumerate(texts):
        value = int(spelling._SIDES[1])
        for size in range(len(text) + 1):
            assert int(got.of(np.array([i]), np.array([size]))[0]) == value
            if size < len(text):
                value = (value * spelling._STEP + ord(text[size])) % (1 << 64)
    # "x" with the letters of "abc" from 1 on is a prefix of "xbcd".
    node = got.of(np.array([2]), np.array([1]))
    assert got.goal(np.array([0]), np.array([1]), node) == got.of(np.array([2]), np.array([3]))


def test_pieces_change_nothing(spark, monkeypatch):
    monkeypatch.setattr(spelling, "PIECE", 20)
    check(spark, [(1, "wanderers wanderer wandered candered anderers"), (2, "a" * 30 + " " + "a" * 31)], min_count=1)


def test_one_join_whatever_the_nodes_on_a_path(spark, monkeypatch):
    tables = []
    kept = spelling.scratch_table
    monkeypatch.setattr(spelling, "scratch_table", lambda df, label: tables.append(label) or kept(df, label))
    known = spark.createDataFrame([("a" * n, n) for n in range(7, 40)], "word string, n long")
    got = brute.collected(spelling.neighbours(known), "word", "near", "near_n")
    assert got == sorted((("a" * n, "a" * m, m) for n in range(7, 40) for m in (n - 1, n + 1) if 7 <= m < 40), key=repr)
    assert len(tables) == 2


def test_states_leave_in_batches_of_bounded_letters(monkeypatch):
    class All:
        def holds(self, hashes):
            return np.ones(len(hashes), dtype=bool)

    monkeypatch.setattr(spelling, "PIECE", 100)
    words = ["a" * 90, "b" * 8, "c" * 300, "d" * 9]
    batches = list(spelling._starts(All())(iter([pa.RecordBatch.from_arrays([pa.array(words)], names=["word"])])))
    sizes = [[len(text) for text in batch.column(1).to_pylist()] for batch in batches]
    assert all(sum(s) <= 100 or len(s) == 1 for s in sizes)
    # A node for every prefix from the middle on, in both tries.
    assert sum(map(len, sizes)) == sum(2 * len(word) + 2 - len(word) // 2 - (len(word) - len(word) // 2) for word in words)
