"""Every operator against a plain version, over nulls, empty and long texts, copies, ties and
clashing columns, and over empty tables."""

import os
import random
import re
import subprocess
import sys
import zlib
from collections import defaultdict
from pathlib import Path

import brute
import pytest

from cohortmill.llm import bpe, chat, decontam, html, linededup, ngrams, pii, quality, secrets, sharding

ROWS = brute.rows()
ITEM = "the quick brown fox jumps over a lazy dog while seven wizards brew strong potions near cold rivers tonight"
CONVERSATION = "conv_id long, turn int, role string, text string, rank int"


@pytest.fixture(scope="module")
def docs(spark):
    return brute.docs(spark)


@pytest.fixture(scope="module")
def empty(spark):
    return brute.docs(spark).limit(0)


def test_quality(docs, empty):
    got = brute.collected(
        quality.ledger(docs), "row.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    assert got == sorted(((i, *brute.quality(t)) for i, t in ROWS), key=repr)
    kept = quality.filter_documents(docs)
    assert kept.columns == docs.columns
    assert brute.collected(kept, "doc_id") == [(6,), (6,), (7,), (8,), (None,)]
    assert brute.count(quality.ledger(empty)) == 0


def test_quality_ablations_and_policies(docs):
    book = quality.ledger(docs)
    failed = [r.failed for r in book.select("failed").collect()]
    for r in quality.ablations(book).collect():
        mask = quality.mask_of(r.rule)
        inside = [f & quality.POLICIES["v2"] for f in failed]
        assert (r.n_failed, r.n_only, r.n_kept) == (
            sum(bool(f & mask) for f in failed), sum(f == mask for f in inside), sum(f == 0 for f in inside))
    assert sum(r.n for r in quality.compare_policies(book, "v1", "v2").collect()) == len(ROWS)


def test_pii(docs, empty):
    got = brute.collected(pii.digest(pii.find_spans(docs)), "doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256")
    want = []
    for doc_id, text in ROWS:
        if doc_id == 14:  # a run of 20,000 characters: the plain expression is quadratic there
            text = "@"
        n, joined = brute.spans(text, brute.PII)
        want.append((doc_id, *(n[k] for k, _, _ in brute.PII), brute.sha(joined)))
    assert got == sorted(want, key=repr)
    assert brute.count(pii.find_spans(empty)) == 0


def test_pii_terms_that_disclose_an_entity(spark):
    noise = [(100 + i, f"plain text number {i} wrote about the item") for i in range(60)]
    told = [(i, f"note {i} the Zorbax agent wrote bob@corp.org about item {i}") for i in range(4)]
    table = spark.createDataFrame(noise + told, "doc_id long, text string")
    found = {r.doc_id: r.spans for r in pii.digest(pii.find_spans(table)).collect()}
    assert all(":11:17" in found[i] and "email:30:42" in found[i] for i in range(4))
    assert not any(found[i] for i, _ in noise)
    clean = dict(brute.collected(pii.sanitise(table), "doc_id", "text"))
    assert "Zorbax" not in clean[0] and "<EMAIL>" in clean[0] and clean[100] == noise[0][1]


def test_copies_and_repeats_change_no_disclosure(spark):
    noise = [(100 + i, f"plain text number {i} wrote about the item") for i in range(60)]
    told = [(i, f"note {i} the Zorbax agent wrote bob@corp.org about item {i}") for i in range(4)]
    lone = [(10, "\n".join(f"the Quendor desk {i} wrote ann@corp.org" for i in range(9)))]

    def spans(rows):
        table = spark.createDataFrame(rows, "doc_id long, text string")
        return {r.doc_id: r.spans for r in pii.digest(pii.find_spans(table)).collect()}

    once = spans(noise + told + lone)
    copied = spans(noise + told + lone + [(1000 + i, told[0][1]) for i in range(500)])
    assert all(":11:17" in once[i] for i in range(4))
    assert {i: copied[i] for i in once} == once and {copied[1000 + i] for i in range(500)} == {once[0]}


def test_pii_terms_on_other_lines_and_of_rare_entities(spark):
    far = "words " * 40
    texts = [f"plain text number {i} wrote and signed about the item words agent" for i in range(60)]
    texts += [f"Zorbax leads\n{far}\nagent bob@corp.org\n{far}\nsigned, zorbax"]
    texts += [f"{far}{i}\nwrote bob@corp.org {far}\nsigned, Zorbax" for i in range(3)]
    texts += [f"Quendor Ltd.\nann@corp.org\n{far} Farrow", "plain Vexley text about\n+1 415 555 0199 \nitem",
              "text about item +1 415 555 0199 Vexley"]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    marked = {i: [texts[i][int(a):int(b)] for kind, a, b in (x.split(":") for x in spans.split(",") if x) if kind in pii.ADDED]
              for i, spans in brute.collected(pii.digest(pii.find_spans(table)), "doc_id", "spans")}
    assert marked[60] == ["Zorbax", "zorbax"]
    assert all(marked[i] == ["Zorbax"] for i in (61, 62, 63))
    assert marked[64] == ["Quendor", "Ltd", "Farrow"] and marked[65] == marked[66] == ["Vexley"]
    assert not any(marked[i] for i in range(60))


def test_pii_estimate_equals_a_plain_one(spark, monkeypatch):
    draw = random.Random(5)
    pool = [f"term{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(300)]
    mails = [f"user{i}@corp.org" for i in range(12)]
    texts = [" ".join(pool[min(int(draw.expovariate(0.02)), 299)] for _ in range(12)) for _ in range(150)]
    for i in range(0, 150, 2):  # from every second text down to one: common, shared and single entities
        texts[i] += f" {mails[min(int(draw.expovariate(0.25)), 11)]} {mails[i % 3]} agent{chr(97 + i % 3)} Agent{chr(97 + i % 3)}"
    texts[1] += " 10.0.0.1 10.0.0.2 10.0.0.3"  # three entities of one set of texts
    table = list(enumerate(texts)) + [(500 + i, texts[2]) for i in range(40)] + [(None, texts[1]), (900, None), (901, "")]
    frame = spark.createDataFrame(table, "doc_id long, text string")
    monkeypatch.setattr(pii, "BLOCK", 5)
    got = brute.collected(pii.find_spans(frame), "doc_id", pii.joined(pii.F.col("spans")))
    want = brute.disclosed(table, pii.SUPPORT, pii.GENERALISE, pii.REMOVE)
    assert got == sorted(want, key=repr)
    kinds = [kind for _, spans in want for kind in re.findall("generalised|removed", spans)]
    assert kinds.count("generalised") > 20 and kinds.count("removed") > 20
    # The estimate decides: all but few of the terms beside entities stay.
    beside = sum(len(text.split()) for _, text in table if text and "@" in text)
    assert len(kinds) < beside / 2


def test_pii_positions_of_very_many_matches(spark):
    text = "\u00e9 " + " ".join(f"{i} w{i % 7}@corp.org" for i in range(20_000))
    row = pii.find_spans(spark.createDataFrame([(1, text)], "doc_id long, text string")).select("email", "card").first()
    assert [(m.start, m.end) for m in row.email] == [m.span() for m in re.finditer(r"w[0-9]@corp\.org", text)] and not row.card


def test_secrets(docs, empty):
    out = secrets.digest(secrets.find_secrets(docs))
    got = brute.collected(out, "doc_id", "n_assign", "n_access", "n_hex", "base_sha256")
    want = []
    for doc_id, text in ROWS:
        n, joined = brute.spans(text, brute.SECRETS)
        want.append((doc_id, *(n[k] for k, _, _ in brute.SECRETS), brute.sha(joined)))
    assert got == sorted(want, key=repr)
    spans = {r.doc_id: r.spans for r in out.collect()}
    assert spans[11] == "guess:7:17"  # the strong value, not the repeated letter
    assert brute.count(secrets.find_secrets(empty)) == 0


def test_guess_cost_prefers_the_cheapest_segmentation():
    words = {"dragon": 4.0, "password": 2.0}
    cost = {v: secrets.guess_cost(v, words) for v in ("password", "Dragon1999", "qwertyuiop", "aaaaaaaaaa", "x9#Qk2!vL0")}
    assert cost["password"] == 2.0 and cost["Dragon1999"] < 8 < cost["x9#Qk2!vL0"]
    assert cost["qwertyuiop"] < 4 and cost["aaaaaaaaaa"] < 4


def test_guess_cost_equals_the_plain_programme():
    draw = random.Random(5)
    words = {"dragon": 4.0, "drag": 3.1, "pass": 2.5, "word": 2.6, "password": 2.0, "qwe": 5.0}
    pieces = [*words, "Dragon", "1999", "2024-05-08", "08.05.2024", "qwerty", "4321", "aaaa", "abab", "x9", "#", "Q", "0", "é"]
    values = ["".join(draw.choices(pieces, k=draw.randint(1, 6))) for _ in range(400)]
    values += ["".join(draw.choices("ab1!", k=draw.randint(1, 14))) for _ in range(200)]
    for value in values:
        want = brute.guesses(value, words, secrets._WALKS, secrets._DATE)
        assert secrets.guess_cost(value, words) == pytest.approx(want), value


def test_secrets_in_very_long_values(spark):
    draw = random.Random(6)
    blob = "".join(draw.choices("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", k=1 << 20))
    letters = "changeme" * 4000
    pieces = list(secrets._parts(blob))
    assert max(map(len, pieces)) <= secrets.STARTS * (secrets.WORD[1] - secrets.WORD[0] + 1)
    rows = [(1, f"passphrase: {blob}"), (2, f"passphrase: {blob}"), (3, f"pwd = {letters}"), (4, "changeme and more")]
    found = {r.doc_id: r.spans for r in secrets.digest(secrets.find_secrets(
        spark.createDataFrame(rows, "doc_id long, text string"))).collect()}
    assert f"guess:12:{12 + len(blob)}" in found[1] and found[1] == found[2]
    assert found[4] == ""


def test_line_dedup(docs, empty, monkeypatch):
    got = brute.collected(linededup.drop_repeated_lines(docs), "row.doc_id", "n_lines", "n_dropped", "text")
    assert got == sorted(brute.line_dedup(ROWS), key=repr)
    for share in (1, 4):  # no key is hot, only the most common ones are
        monkeypatch.setattr(linededup, "HOT_SHARE", share)
        assert brute.collected(
            linededup.drop_repeated_lines(docs), "row.doc_id", "n_lines", "n_dropped", "text") == got
    monkeypatch.undo()
    again = linededup.dedupe_documents(docs)
    assert again.columns == docs.columns and brute.count(linededup.drop_repeated_lines(empty)) == 0


def test_bpe_equals_the_library_and_decodes(docs, empty):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(bpe.default_tokenizer())
    encoded = bpe.encode(docs.select("doc_id", "text"))
    want = sorted(((i, library.encode(t or "", add_special_tokens=False).ids) for i, t in ROWS), key=repr)
    assert brute.collected(encoded, "row.doc_id", "ids") == want
    decoded = bpe.decode(encoded.select("row.doc_id", "ids"))
    assert brute.collected(decoded, "row.doc_id", "text") == sorted(((i, t or "") for i, t in ROWS), key=repr)
    assert brute.count(bpe.digest(empty)) == 0
    # Whole rows, with names that clash with the operator's own, come back as they were.
    whole_rows = brute.collected(bpe.encode(docs), "row.doc_id", "row.text", "row.shared", "ids")
    assert whole_rows == sorted(
        ((i, t, 5, library.encode(t or "", add_special_tokens=False).ids) for i, t in ROWS), key=repr)


def test_bpe_digests_equal_the_library(docs):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(bpe.default_tokenizer())
    draw = random.Random(11)
    common = " ".join(f"shared{draw.randrange(500)} passage" for _ in range(1500))  # of many chunks
    texts = [f"{i} {common[:9000 + i]} tail {draw.random()}" for i in range(6)]
    texts += ["".join(draw.choices("aB1 \n\t.,'é漢😀\u0301\u00a0", k=400)) for _ in range(40)]
    table = ROWS + list(enumerate(texts, 100))

    def row(doc_id, text):
        ids = library.encode(text or "", add_special_tokens=False).ids
        return doc_id, len(ids), brute.sha(",".join(map(str, ids))), brute.sha(library.decode(ids, skip_special_tokens=False))

    got = brute.collected(bpe.digest(brute.docs(docs.sparkSession, table)), "doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
    assert got == sorted((row(*r) for r in table), key=repr)


def test_chunks_that_documents_share_are_cut_alike():
    shared = " ".join(f"w{i * i % 9973}" for i in range(6000)).encode()
    a, b = b"first " + shared, b"another beginning, longer " + shared
    cut = [{text[s:e] for s, e in bpe.cores(text)} for text in (a, b)]
    assert len(cut[0] & cut[1]) > 10


def test_ngram_join(docs, empty):
    got = brute.collected(ngrams.join(docs, block=2), "doc_id", "class_id", "n_links", "group_id")
    assert got == sorted(brute.similar(ROWS), key=repr)
    assert brute.count(ngrams.join(empty)) == 0


def test_ngram_join_recall_by_similarity(spark):
    """Planted pairs of known similarity; those close to the threshold are counted by themselves too."""
    draw, rows, pairs = random.Random(17), [], []
    for changed in range(1, 13):
        for _ in range(25):
            words = [f"w{draw.randrange(10 ** 6)}" for _ in range(draw.randrange(60, 400))]
            other = list(words)
            for place in draw.sample(range(len(words)), min(changed, len(words) // 40 + 1)):
                other[place] = f"x{draw.randrange(10 ** 6)}"
            a, b = (brute.shingles(" ".join(w)) for w in (words, other))
            pairs.append((len(rows), len(rows) + 1, len(a & b) / len(a | b)))
            rows += [(len(rows), " ".join(words)), (len(rows) + 1, " ".join(other))]
    got = {i: (links, group) for i, links, group in brute.collected(
        ngrams.join(brute.docs(spark, rows)), "doc_id", "n_links", "group_id")}
    near = [(i, j) for i, j, share in pairs if share >= ngrams.SIMILARITY]
    edge = [(i, j) for i, j, share in pairs if ngrams.SIMILARITY <= share < 0.85]
    assert len(near) > 100 and len(edge) > 20
    for some in (near, edge):
        found = sum(got[i] == (1, i) and got[j] == (1, i) for i, j in some)
        assert found >= 0.99 * len(some)
    assert all(got[i] == (0, i) for i, j, share in pairs if share < ngrams.SIMILARITY)


def test_one_of_each_group_stays(docs):
    kept = ngrams.keep_one_of_each(docs)
    groups = {(g,) for *_, g in brute.similar(ROWS)}
    assert kept.columns == docs.columns
    assert brute.collected(kept, "doc_id") == sorted(groups, key=repr)


def test_decontamination(spark, docs, empty):
    from random import Random

    draw = Random(3)
    pool = [f"{a}{b}" for a in ("ka", "lo", "mi", "nu", "pe") for b in ("sta", "ren", "dol", "vik", "tor")] + ITEM.split()
    prose = [(i, " ".join(draw.choices(pool, k=150))) for i in range(60)]
    swapped = ITEM.replace("lazy", "sleepy").replace("seven", "eight").replace("strong", "weak")
    planted = [(100, prose[0][1] + " " + ITEM.upper() + ". " + prose[1][1]), (101, ITEM), (102, swapped + " " + prose[2][1]),
               (103, " ".join(reversed(ITEM.split()))), (104, None), (105, "")]
    table = brute.docs(spark, prose + planted)
    items = spark.createDataFrame([(1, ITEM), (2, None), (3, "")], "item_id long, text string")
    found = {(r.doc_id, r.item_id) for r in decontam.leaks(table, items).collect()}
    assert found == {(100, 1), (101, 1), (102, 1)}
    kept = decontam.drop_leaks(table, items)
    assert kept.columns == table.columns and brute.count(kept) == 63
    assert brute.count(decontam.leaks(empty, items)) == 0
    assert brute.count(decontam.leaks(table, items.limit(0))) == 0


@pytest.mark.parametrize("length", [130, 161, 400, 3000])
def test_decontamination_finds_long_items(spark, length):
    from random import Random

    draw = Random(length)
    pool = [f"{a}{b}{c}" for a in ("ka", "lo", "mi", "nu") for b in ("sta", "ren", "dol", "vik", "tor") for c in "aeiou"]
    words = draw.choices(pool, k=length)
    told = [w if draw.random() < 0.8 or i > 0.7 * length else "changed" for i, w in enumerate(words)]
    before, after = (" ".join(draw.choices(pool, k=n)) for n in (4001, 133))
    planted = [(100, " ".join(words)), (101, f"{before} {' '.join(words)} {after}"), (102, f"{before} {' '.join(told)} {after}"),
               (103, " ".join(draw.choices(pool, k=16_200)) + " " + " ".join(words)), (104, " ".join(words[:length // 2]))]
    table = brute.docs(spark, [(i, " ".join(draw.choices(pool, k=150))) for i in range(40)] + planted)
    items = spark.createDataFrame([(1, " ".join(words)), (2, ITEM)], "item_id long, text string")
    found = {(r.doc_id, r.item_id): r for r in decontam.leaks(table, items).collect()}
    assert set(found) == {(100, 1), (101, 1), (102, 1), (103, 1)}
    assert all(found[i, 1].kind == "verbatim" and found[i, 1].share == 1.0 for i in (100, 101, 103))


def test_sharding(docs, empty):
    tree = sharding.regrouped(40)
    out = sharding.place(docs, tree).collect()
    sizes = sorted((len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for _, t in ROWS)
    assert sorted((r.size, r.text_crc32) for r in out) == sizes
    slots = defaultdict(list)
    for r in out:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert brute.count(sharding.place(empty, tree)) == 0


def test_growth_moves_keys_into_the_new_shard_only(spark):
    trees = [sharding.regrouped(40)]
    for _ in range(3):
        trees.append(sharding.grown(trees[-1]))
    keys = spark.range(20_000).select(*[sharding.shard_of(sharding.F.col("id"), t).alias(f"s{i}") for i, t in enumerate(trees)])
    rows = keys.collect()
    for i in range(3):
        moved = [r[i + 1] for r in rows if r[i] != r[i + 1]]
        assert set(moved) == {40 + i} and 300 < len(moved) < 700
    counts = defaultdict(int)
    for r in rows:
        counts[r[0]] += 1
    assert len(counts) == 40 and min(counts.values()) > 400 and max(counts.values()) < 600


def test_chats(spark):
    def turns(conv, *texts):
        return [(conv, i, "user" if i % 2 else "assistant", t, 9) for i, t in enumerate(texts)]

    data = (turns(1, "a", "b", "c") + turns(2, "a", "b") + turns(3, "a") + turns(4, "a", "b", "c") + turns(5, "a", "x")
            + turns(6, None, "y") + turns(6, None, "y") + [(7, None, None, "z", 9)])
    got = {r.conv_id: r for r in chat.format_chats(spark.createDataFrame(data, CONVERSATION)).collect()}
    assert set(got) == {1, 5, 6, 7} and (got[1].n_turns, got[1].n_equal) == (3, 2) and got[6].n_turns == 2
    assert got[5].text == "<|assistant|>\na\n<|user|>\nx\n" and got[7].text == "<|user|>\nz\n"
    assert brute.count(chat.format_chats(spark.createDataFrame([], CONVERSATION))) == 0


PAGE = """<!DOCTYPE html><html><head><title>t</title><script>var x="</p><p>no";</script></head><body><header>Site</header>
<nav><ul><li><a href="/a">one</a><li><a href="/b">two</a></ul></nav><!-- <p>no</p> --><div class="ad">buy {n}</div>
<article><h1>Title {n}</h1><p>First &amp; &lt;best&gt;  <b>bold</b>ly<br>broken {n}<p>Second&nbsp;{n}</p>{more}</article>
<section id="comments"><p>reader {n}</p></section><form><p>mail</p></form><footer>(c)</footer></body></html>"""


def test_html(spark):
    pages = [(i, f"http://a.org/{i}", PAGE.replace("{n}", f"n{i}").replace("{more}", "<p>third</p>" * (i % 3)))
             for i in range(9)]
    plain = "<html><body><div class='menu'><p>home</p></div><div><p>{0} long text of page {0}</p><p>more</p></div></body></html>"
    pages += [(20 + i, "https://b.org:80/x", plain.format(f"w{i}")) for i in range(3)]
    pages += [(30, None, None), (31, "no url", ""), (32, "http://c.org", "<article><p>cut <a href='x"), (0, *pages[0][1:])]
    table = spark.createDataFrame(pages, "page_id long, url string, html string").selectExpr("*", "'h' as host", "1 as content")
    out = html.extract(table).collect()
    got = {r.page_id: r.text for r in out}
    assert len(out) == len(pages)
    for i in range(9):
        lines = [f"Title n{i}", f"First & <best> boldly broken n{i}", f"Second n{i}"] + ["third"] * (i % 3)
        assert got[i] == "\n".join(lines)
    assert got[20] == "w0 long text of page w0\nmore" and got[30] == got[31] == "" and got[32] == "cut"
    wrapper = next(r.wrapper for r in html.wrappers(table).collect() if r.host == "a.org")
    assert '["+"' in wrapper
    assert brute.count(html.extract(table.limit(0))) == 0


def test_html_of_hosts_that_mix_templates(spark):
    marked = "<html><body><nav><p>menu</p></nav><article><p>marked {0} {1}</p></article></body></html>"
    plain = "<html><body><div class='top'><p>welcome</p></div><div class='x'><p>plain {0} {1}</p></div></body></html>"
    table = "<html><body><div class='top'><p>welcome</p></div><table><tr><td>cell {0}</td></tr></table></body></html>"
    nested = "<html><body><div class='a'><p>{1}</p></div><div class='b'><div class='c'><p>deep</p></div></div></body></html>"
    long = "many words that make up the text of this page " * 3
    pages, want = [], {}

    def add(url, html, text, *values):
        want[len(pages)] = text.format(*values).strip()
        pages.append((len(pages), url, html.format(*values)))

    for i in range(4):
        add("http://mixed.org/", marked, "marked {0} {1}", i, long)
        add("http://mixed.org/", plain, "plain {0} {1}", i, long)
        add("http://plain.org/", plain, "plain {0} {1}", i, long)
        add("http://plain.org/", table, "cell {0}", i, long)
        add("http://copies.org/", nested, "{1}", 0, long)
        add(None, plain, "plain {0} {1}", i, long * 50)
    add("no host", nested, "{1}", 0, long)
    add("no host", marked, "marked {0} {1}", 0, long)
    add("http://once.org/", nested, "{1}", 0, long)
    got = html.extract(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()
    assert {r.page_id: r.text for r in got} == want


def test_every_slot_of_a_wrapper_stands_in_a_page():
    from random import Random

    draw = Random(5)

    def body(depth):
        return "".join(
            "text" if draw.random() < 0.4 or not depth else f"<{tag}>{body(depth - 1)}</{tag}>"
            for tag in draw.choices(["div", "section", "ul", "blockquote"], k=draw.randint(1, 4)))

    for _ in range(60):
        whole, paths = None, set()
        for _ in range(5):
            stream, blocks = html.parse(f"<html><body>{body(3)}</body></html>")
            paths |= {block.path for block in blocks}
            whole = html.fold(stream) if whole is None else html.align(whole, html.fold(stream))
        assert set(html.slots(whole)) == paths


def test_alignment_is_a_longest_one_at_any_length(monkeypatch):
    draw = random.Random(8)
    for cells in (1 << 30, 50, 1):
        monkeypatch.setattr(html, "CELLS", cells)
        for _ in range(150):
            p, q = (draw.choices(range(4), k=draw.randint(0, 30)) for _ in range(2))
            moves = html._moves(p, q)
            length = [[0] * (len(q) + 1) for _ in range(len(p) + 1)]
            for i, x in enumerate(p):
                for j, y in enumerate(q):
                    length[i + 1][j + 1] = length[i][j] + 1 if x == y else max(length[i][j + 1], length[i + 1][j])
            left, right = ([k for k, move in enumerate(moves) if move != other] for other in "><")
            assert len(left) == len(p) and len(right) == len(q)
            both = [k for k, move in enumerate(moves) if move == "="]
            assert [p[left.index(k)] for k in both] == [q[right.index(k)] for k in both]
            assert len(both) == length[-1][-1]


def test_alignment_of_long_irregular_pages():
    draw = random.Random(9)

    def page():
        return "<body>" + "".join(f"<p class=c{draw.randint(0, 300)}>t</p>" for _ in range(7000)) + "</body>"

    streams = [html.parse(page()) for _ in range(2)]
    whole = html.align(*(html.fold(stream) for stream, _ in streams))
    assert set(html.slots(whole)) == {block.path for _, blocks in streams for block in blocks}


def test_html_on_workers_without_the_package(tmp_path):
    code = f"""
import sys
sys.path.insert(0, {str(Path(html.__file__).parents[2])!r})
from cohortmill.llm import html
from cohortmill.session import build_session
spark = build_session("2", 2, **{{"spark.sql.warehouse.dir": {str(tmp_path)!r}}})
pages = spark.createDataFrame([(1, "http://a.org/", "<body><article><p>the text</p></article></body>")], "page_id long, url string, html string")
print("got", [r.text for r in html.extract(pages).collect()])
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=240)
    assert "got ['the text']" in done.stdout, done.stderr[-2000:]


def test_decontamination_keeps_items_apart_and_splits_wide_blocks(spark, monkeypatch):
    draw = random.Random(12)
    wide = [(10 + i, " ".join(f"v{i}n{k}" for k in range(350))) for i in range(200)]  # 70,000 words
    other = ITEM.replace("fox", "wolf").replace("wizards", "witches").replace("rivers", "lakes")
    items = spark.createDataFrame([(1, ITEM), (1, other[::-1]), (None, ITEM), *wide], "item_id long, text string")
    prose = [(i, " ".join(f"w{draw.randint(0, 400)}" for _ in range(120))) for i in range(40)]
    planted = [(100, f"{prose[0][1]} {ITEM}"), (101, f"{other[::-1]} {prose[1][1]}"), (102, f"{prose[2][1]} {wide[7][1]}"),
               (103, wide[199][1]), (102, f"{prose[2][1]} {wide[7][1]}")]
    table = brute.docs(spark, prose + planted)
    want = [(100, 1), (100, None), (101, 1), (102, 17), (103, 209)]
    found = sorted(((r.doc_id, r.item_id) for r in decontam.leaks(table, items).collect()), key=str)
    assert found == sorted(want, key=str)
    both = spark.createDataFrame([(1, f"{ITEM} {other[::-1]}"), (100, None)], "doc_id long, text string")
    assert [(r.doc_id, r.item_id) for r in decontam.leaks(both, items.where("item_id = 1")).collect()] == [(1, 1)] * 2
    # One item with more words than 16 bits tell apart.
    monkeypatch.setattr(decontam, "TERMS", 100)
    assert len(list(decontam._blocks([(i, 0, [w.encode() for w in t.split()]) for i, t in wide[:5]]))) == 5
    assert sorted(((r.doc_id, r.item_id) for r in decontam.leaks(
        table, items.where("item_id in (1, 17)")).collect()), key=str) == [(100, 1), (101, 1), (102, 17)]
