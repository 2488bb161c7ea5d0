"""The whole chain of stages against the plain versions put one after the other."""

import random

import brute
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from cohortmill.llm import bpe

ITEM = "the quick brown fox jumps over a lazy dog while seven wizards brew strong potions near cold rivers tonight"
DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


def documents():
    draw = random.Random(12)
    pool = [f"{a}{b}{c}" for a in ("ka", "lo", "mi", "né") for b in ("sta", "ren", "dol") for c in ("vik", "tor", "um", "á")]

    def prose(n=120):
        return "\n".join(" ".join(draw.choices(pool, k=12)) for _ in range(n // 12))

    texts = [prose() for _ in range(40)]
    texts += [f"{prose()}\n{brute.LONG}\n {brute.LONG.upper()}" for _ in range(6)]
    copied = prose()
    texts += [copied, copied, copied + " more", " ".join(copied.split()[1:]), copied.replace("\n", "  ")]
    texts += [f"{prose()} {ITEM} {prose()}", prose().replace("\n", f" {ITEM} ", 1)]
    texts += [None, "", "few words only", "same words again " * 40, "# | $ " * 60, prose() + "\n" + "\n".join(["a line"] * 30)]
    texts += [prose(12_000)]
    rows = list(enumerate(texts))
    return rows + [rows[3], rows[46], (None, prose()), (None, None)]


def plain(rows, item):
    def good(text):
        n, chars, symbols, dup, repeat = brute.quality(text)
        lines = [x for x in (text or "").split("\n") if x.strip(" \t\n\x0b\x0c\r")]
        return n >= 50 and 100 * repeat <= 50 * n and 4 * symbols <= n and 100 * dup <= 50 * len(lines) and 2 * n <= chars <= 25 * n

    kept = [(i, text) for i, text in rows if good(text)]
    kept = [(i, text) for i, _, _, text in brute.line_dedup(kept)]
    groups = {}
    for (i, text), (_, _, _, group) in zip(kept, brute.similar(kept)):
        if i is None or i == group:
            groups.setdefault((i, text), text)
    library = Tokenizer.from_file(bpe.default_tokenizer())
    out = []
    for (i, text) in groups:
        if item.split() and " ".join(item.split()) not in " ".join(text.split()):
            ids = library.encode(text, add_special_tokens=False).ids
            out.append((i, len(ids), ids))
    return sorted(out, key=repr)


@pytest.fixture
def folder(spark, tmp_path):
    def write(rows, more=()):
        docs = spark.createDataFrame([(i, t, "en", "s", None if t is None else len(t)) for i, t in rows], DOCUMENTS)
        docs.selectExpr("*", *more).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
        spark.createDataFrame([(1, ITEM), (2, None)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
        return str(tmp_path)

    return write


def test_all_stages_on_odd_rows_and_clashing_columns(spark, folder):
    rows = documents()
    found = corpus_pipeline.run(spark, folder(rows, ["1 as row", "2 as mark", "3 as key", "4 as failed", "5 as n", "6 as ids"]))
    want = plain(rows, ITEM)
    assert brute.collected(found, "doc_id", "n_tokens", "ids") == want
    ids = {row[0] for row in want}
    assert len(ids) > 40 and 46 in ids and not ids & {47, 48, 49, 50, 51, 52, 53, 54, 55, 56, 57}


def test_every_stage_keeps_the_columns(spark, folder):
    path = folder(documents()[:12], ["1 as row"])
    docs = spark.read.parquet(f"{path}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, path).columns == docs.columns


def test_an_empty_table(spark, folder):
    found = corpus_pipeline.run(spark, folder([]))
    assert found.columns == ["doc_id", "n_tokens", "ids"] and found.count() == 0
