"""HTML extraction by union-free regular-expression inference.

Every page becomes a stream of block tags and text slots, implied end tags filled in and repeats
folded into ``+`` groups. The streams of a host are aligned one after another: what agrees, inside
the same elements, stays; what only one of them has becomes an optional group. The result is the host's wrapper, an
expression of tags, slots, ``+`` and ``?`` that matches all its pages, without any alternative.

The slots of the wrapper that a page fills are then judged by where they stand: article or main
text, or, in a page that marks neither, the container with most text on the host that is no link and
differs between pages (most text in the page, where the host does not tell: it has copies of one page
only, or the url names no host). So templates of a host do not compete. Slots in menus, headers,
footers, sidebars, notices, adverts, forms and comments are never content. A page's text is the text
in its content slots.

Streams of a host are first folded together over salted parts, then over the parts' wrappers, so a
host with a third of all pages is no single task; equal streams count once.

Defined results: null or empty html has no text; pages without a host in their url share a wrapper,
but each is judged by its own text;
a tag cut off at the end of a page is no text; repeated rows are extracted each. A page is whatever
comes in a row: neither length nor number of blocks is bounded. Other columns are not read.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator
from functools import lru_cache
from html import unescape

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import record_groups, scratch_table

SALTS = 16
CELLS = 1 << 30  # of a table of two token streams, a bit each, that is held at once
PERIOD = 24  # tags in the longest unit that is recognised as repeated

# What the elements of HTML are for.
_RAW = {"script", "style", "noscript", "template", "textarea", "svg", "iframe", "math", "object", "canvas"}
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
_INLINE = {
    "a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins",
    "kbd", "label", "mark", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup",
    "time", "tt", "u", "var"}
_CLOSED_BY = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
    "th": {"td", "th"}, "option": {"option"}}
_LIMITS = {"ul", "ol", "dl", "table", "select", "article", "main", "section", "div", "body", "html"}
_NEVER = {"head", "title", "nav", "footer", "aside", "form", "menu", "dialog", "button", "select", "fieldset"}
_MAIN = {"article", "main"}
_HINTS = re.compile(
    r"(?:^|[-_\s])(?:ads?|advert\w*|sponsor\w*|promo\w*|banner\w*|cookies?|consent|notices?|alert|popup|modal|"
    r"sidebar\w*|side|menus?|nav\w*|breadcrumbs?|header|masthead|footer\w*|comments?|replies|reply|respond|"
    r"disqus|share|sharing|social|related|recommend\w*|newsletter|subscribe|signup|login|search|widget\w*|"
    r"pagination|pager|toc)(?:$|[-_\s])", re.I)
_MAIN_HINTS = re.compile(r"(?:^|[-_\s])(?:article|post|entry|story)(?:[-_]?(?:body|content|text))?(?:$|[-_\s])", re.I)

_TAG = re.compile(r"""<(?:!--|[!?]|(/?)([a-zA-Z][^\s/>]*))""")
_ATTRIBUTES = re.compile(r"""(?:[^>"']++|"[^"]*+"|'[^']*+')*+>""")
_NAMED = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_BLANK = re.compile(r"\s+")


class Block:
    """A stretch of text between two block tags: its path and whether it lies in a link."""

    __slots__ = ("path", "text", "linked")

    def __init__(self, path: str, text: str, linked: int):
        self.path, self.text, self.linked = path, text, linked


def _name(tag: str, attributes: str) -> str:
    """An element in a path: its tag and, as far as they tell anything, its names."""
    words = " ".join(
        (m[2] or m[3] or m[4] or "") for m in _NAMED.finditer(attributes))
    words = re.sub(r"[^a-z\s_-]+", "", words.lower()).strip()
    return f"{tag}.{'_'.join(words.split())}" if words else tag


def parse(html: str | None) -> tuple[list[str], list[Block]]:
    """The stream of a page and its blocks. Slots of the stream are ``#`` and stand for blocks."""
    stream: list[str] = []
    blocks: list[Block] = []
    stack: list[tuple[str, str]] = []
    text: list[str] = []
    linked, in_link = 0, 0
    source = html or ""

    def flush() -> None:
        nonlocal linked
        if text:
            joined = _BLANK.sub(" ", "".join(text)).strip()
            if joined:
                blocks.append(Block(">".join(name for _, name in stack), joined, min(linked, len(joined))))
                stream.append("#")
            text.clear()
        linked = 0

    def close(upto: int) -> None:
        while len(stack) > upto:
            stream.append(f"</{stack.pop()[1]}>")

    at = 0
    while at < len(source):
        tag = _TAG.search(source, at)
        plain = source[at:tag.start() if tag else len(source)]
        if plain:
            text.append(unescape(plain))
            linked += len(plain) if in_link else 0
        if not tag:
            break
        if tag[0] == "<!--":
            end = source.find("-->", tag.end())
            at = end + 3 if end >= 0 else len(source)
            continue
        attributes = _ATTRIBUTES.match(source, tag.end())
        end = attributes.end() if attributes else source.find(">", tag.end()) + 1
        if not end:  # cut off
            break
        at = end
        if tag[2] is None:
            continue
        kind, closing = tag[2].lower(), bool(tag[1])
        if kind in _RAW:
            if not closing:
                flush()
                shut = re.compile(rf"</{kind}\b[^>]*>?", re.I).search(source, at)
                at = shut.end() if shut else len(source)
            continue
        if kind == "br":
            text.append(" ")
        elif kind in _INLINE:
            if kind == "a":
                in_link = 0 if closing else 1
        elif closing:
            flush()
            place = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == kind), None)
            if place is not None:
                close(place)
                in_link = 0
        else:
            flush()
            in_link = 0
            ends = _CLOSED_BY.get(kind, set()) | {"p"}
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] in ends:
                    close(i)
                    if kind not in ("tr", "td", "th"):
                        break
                elif stack[i][0] in _LIMITS:
                    break
            if kind in _VOID:
                continue
            name = _name(kind, source[tag.end():end])
            stack.append((kind, name))
            stream.append(f"<{name}>")
    flush()
    close(0)
    return stream, blocks


# ---- wrappers: lists of tokens, ["+", wrapper] and ["?", wrapper] ---------------------------------




def fold(stream: list) -> list:
    """Adjacent repeats of a unit as one ``+`` group, short units first, until nothing repeats."""
    out = list(stream)
    period = 1
    while period <= min(PERIOD, len(out) // 2):
        made, i, changed = [], 0, False
        while i < len(out):
            unit = out[i:i + period]
            n = 1
            while len(unit) == period and out[i + n * period:i + (n + 1) * period] == unit:
                n += 1
            if n > 1 and _balanced(unit):
                made.append(unit[0] if period == 1 and isinstance(unit[0], list) and unit[0][0] == "+" else ["+", unit])
                i += n * period
                changed = True
            else:
                made.append(out[i])
                i += 1
        out = made
        period = 1 if changed else period + 1
    # A unit beside its own group belongs to it.
    tidy: list = []
    for node in out:
        group = tidy[-1] if tidy and isinstance(tidy[-1], list) and tidy[-1][0] == "+" else None
        tidy.append(node)
        if group:
            width = len(group[1])
            if tidy[-width:] == group[1] and isinstance(tidy[-width - 1], list) and tidy[-width - 1] == group:
                del tidy[-width:]
    return tidy


def _balanced(unit: list) -> bool:
    depth = 0
    for node in unit:
        if isinstance(node, str) and node != "#":
            depth += -1 if node.startswith("</") else 1
            if depth < 0:
                return False
    return depth == 0


def _places(marks: list[tuple[object, bool]], numbers: dict[tuple[int, object], int]) -> list[int]:
    """What two nodes must share to be aligned, as a number: themselves and the elements they stand in."""
    out, names, inside = [], [], [0]
    for node, _ in marks:
        if node[0] == "<" and node[1] != "/":
            out.append(numbers.setdefault((inside[-1], node), len(numbers) + 1))
            names.append(node[1:-1])
            inside.append(out[-1])
            continue
        if node[0] == "<" and node[2:-1] in names:
            upto = len(names) - 1 - names[::-1].index(node[2:-1])
            del names[upto:], inside[upto + 1:]
        out.append(numbers.setdefault((inside[-1], node), len(numbers) + 1))
    return out


def _gains(p: list[int], q: list[int]) -> Iterator[int]:
    """After each of ``p``: the places of ``q`` that make its longest common subsequence longer, as zero bits."""
    masks: dict[int, int] = {}
    for j, place in enumerate(q):
        masks[place] = masks.get(place, 0) | 1 << j
    row = full = (1 << len(q)) - 1
    for place in p:
        if hit := row & masks.get(place, 0):
            row = ((row + hit) | (row - hit)) & full
        yield row


def _lengths(p: list[int], q: list[int]) -> np.ndarray:
    """Length of the longest common subsequence of ``p`` and each beginning of ``q``."""
    row = (1 << len(q)) - 1
    for row in _gains(p, q):
        pass
    bits = np.unpackbits(np.frombuffer(row.to_bytes(-(-len(q) // 8), "little"), np.uint8), bitorder="little")
    return np.concatenate([[0], np.cumsum(1 - bits[:len(q)].astype(np.int64))])


def _moves(p: list[int], q: list[int]) -> str:
    """A longest common subsequence as a walk through both: ``=`` in common, ``<`` left alone, ``>`` right alone.

    A cell of the table is one bit. Of larger tables than ``CELLS`` the halves of the left side are walked one by one,
    from where the right side is best cut, so memory is bounded for pages of any length.
    """
    if not p or not q:
        return "<" * len(p) + ">" * len(q)
    if len(p) * len(q) > CELLS and len(p) > 1:
        half = len(p) // 2
        cut = int(np.argmax(_lengths(p[:half], q) + _lengths(p[half:][::-1], q[::-1])[::-1]))
        return _moves(p[:half], q[:cut]) + _moves(p[half:], q[cut:])
    rows = [(1 << len(q)) - 1, *_gains(p[::-1], q[::-1])]

    def common(i: int, j: int) -> int:
        """Of what is left from ``i`` and ``j`` on."""
        rest = len(q) - j
        return rest - (rows[len(p) - i] & ((1 << rest) - 1)).bit_count()

    out = []
    i = j = 0
    while i < len(p) or j < len(q):
        if i < len(p) and j < len(q) and p[i] == q[j]:
            out.append("=")
        elif j == len(q) or (i < len(p) and common(i + 1, j) >= common(i, j + 1)):
            out.append("<")
        else:
            out.append(">")
        i, j = i + (out[-1] != ">"), j + (out[-1] != "<")
    return "".join(out)


def align(left: list, right: list) -> list:
    """A wrapper that matches whatever either side matches.

    The longest common subsequence of nodes stays; stretches between that one side alone has become
    optional. An optional group of one side is aligned as what it holds. Nodes agree only inside the
    same elements, so every slot of the result stands where it stood in one of the sides.
    """
    if left == right:
        return left
    a, b = _opened(left), _opened(right)
    numbers: dict[tuple[int, object], int] = {}
    p, q = _places(a, numbers), _places(b, numbers)
    n, m = len(a), len(b)
    begin = 0
    while begin < min(n, m) and p[begin] == q[begin]:
        begin += 1
    end = 0
    while end < min(n, m) - begin and p[n - 1 - end] == q[m - 1 - end]:
        end += 1
    x, y = a[begin:n - end], b[begin:m - end]
    p, q = p[begin:n - end], q[begin:m - end]
    merged = [(node, one or other) for (node, one), (_, other) in zip(a[:begin], b[:begin], strict=True)]
    i = j = 0
    for move in _moves(p, q):
        if move == "=":
            merged.append((x[i][0], x[i][1] or y[j][1]))
        else:
            merged.append((x[i][0] if move == "<" else y[j][0], True))
        i, j = i + (move != ">"), j + (move != "<")
    if end:
        merged += [(node, one or other) for (node, one), (_, other) in zip(a[n - end:], b[m - end:], strict=True)]
    return _closed(merged)


def _opened(wrapper: list) -> list[tuple[object, bool]]:
    """Nodes with whether they are optional, optional groups and repeats spelled out as marks."""
    out: list[tuple[object, bool]] = []
    for node in wrapper:
        if isinstance(node, list) and node[0] == "?":
            out.extend((inner, True) for inner, _ in _opened(node[1]))
        elif isinstance(node, list):
            out.extend([("(+", False), *_opened(node[1]), ("+)", False)])
        else:
            out.append((node, False))
    return out


def _closed(marks: list[tuple[object, bool]]) -> list:
    """The inverse of ``_opened``: neighbouring optional nodes share a group."""
    levels: list[list] = [[]]
    options: list[bool] = []

    def put(node: object, optional: bool) -> None:
        level = levels[-1]
        if not optional:
            level.append(node)
        elif level and isinstance(level[-1], list) and level[-1][0] == "?":
            level[-1][1].append(node)
        else:
            level.append(["?", [node]])

    for node, optional in marks:
        if node == "(+":
            levels.append([])
            options.append(optional)
        elif node == "+)":
            if len(levels) > 1:
                inner = levels.pop()
                was = options.pop()
                if inner:
                    put(["+", inner], was or optional)
        else:
            put(node, optional)
    while len(levels) > 1:
        inner = levels.pop()
        put(["+", inner], options.pop())
    return levels[0]


def slots(wrapper: list) -> list[str]:
    """Paths of all slots of a wrapper, in order, once each."""
    found: dict[str, None] = {}
    stack: list[str] = []

    def walk(nodes: list) -> None:
        for node in nodes:
            if isinstance(node, list):
                walk(node[1])
            elif node == "#":
                found[">".join(stack)] = None
            elif node.startswith("</"):
                if node[2:-1] in stack:
                    del stack[len(stack) - 1 - stack[::-1].index(node[2:-1]):]
            else:
                stack.append(node[1:-1])

    walk(wrapper)
    return list(found)


def _excluded(path: str) -> bool:
    inside = False
    for name in path.split(">"):
        tag, _, names = name.partition(".")
        if tag in _NEVER or (tag == "header" and not inside):
            return True
        if tag not in ("html", "body") and tag not in _MAIN and _HINTS.search(names.replace("_", " ")):
            return True
        inside = inside or tag in _MAIN
    return False


def _marked(path: str) -> bool:
    for name in path.split(">"):
        tag, _, names = name.partition(".")
        if tag in _MAIN or _MAIN_HINTS.search(names.replace("_", " ")):
            return True
    return False


def content_slots(paths: list[str], volumes: dict[str, int], lengths: dict[str, int],
                  excluded: Callable[[str], bool] = _excluded, is_marked: Callable[[str], bool] = _marked) -> list[str]:
    """Those of a page's slots whose text is the article. ``volumes``: text beside links on the host
    that differs by page; ``lengths``: text beside links in the page, which decides between equals."""
    usable = [path for path in paths if not excluded(path)]
    marked = [path for path in usable if is_marked(path)]
    if marked:
        return marked
    weight: dict[str, tuple[int, int]] = {}
    for path in usable:
        parent = path.rpartition(">")[0] or path
        volume, length = weight.get(parent, (0, 0))
        weight[parent] = volume + volumes.get(path, 0), length + lengths[path]
    if not weight:
        return []
    chosen = max(sorted(weight), key=lambda parent: (*weight[parent], parent.count(">")))
    return [path for path in usable if path == chosen or path.startswith(f"{chosen}>")]


# ---- Spark -----------------------------------------------------------------------------------------


def _hosted(pages: DataFrame) -> DataFrame:
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    return pages.select("page_id", "url", "html", host.alias("host"))


def _observed(pages: DataFrame) -> DataFrame:
    """``host, wrapper, page, slots`` of every page: its folded stream, a hash of its slots and, by
    slot, the length of the text beside links and a hash of the text. Written once, since wrappers and
    volumes both come from it."""
    schema = "host string, wrapper string, page bigint, slots array<struct<path:string,length:bigint,mark:bigint>>"
    kind = pa.list_(pa.struct([("path", pa.string()), ("length", pa.int64()), ("mark", pa.int64())]))

    def observe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made, whole, seen = [], [], []
            for html in batch.column(1).to_pylist():
                stream, blocks = parse(html)
                sums: dict[str, list] = {}
                for block in blocks:
                    one = sums.setdefault(block.path, [0, xxhash.xxh3_64()])
                    one[0] += len(block.text) - block.linked
                    one[1].update(f"{block.text}\n".encode("utf-8", "surrogatepass"))
                made.append(json.dumps(fold(stream)))
                seen.append([{"path": path, "length": length, "mark": mark.intdigest() - (1 << 63)}
                             for path, (length, mark) in sums.items()])
                whole.append(xxhash.xxh3_64_intdigest(json.dumps([(s["path"], s["mark"]) for s in seen[-1]])) - (1 << 63))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(made, pa.string()), pa.array(whole, pa.int64()), pa.array(seen, kind)],
                names=["host", "wrapper", "page", "slots"])

    return scratch_table(_hosted(pages).select("host", "html").mapInArrow(observe, schema), "streams")


def wrappers(pages: DataFrame) -> DataFrame:
    """``host, wrapper, n_pages``: one expression per host, as JSON."""
    return _wrappers(_observed(pages))


def _wrappers(observed: DataFrame) -> DataFrame:
    def join_up(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.RecordBatch]:
        for group in record_groups(batches, keys):
            whole: list | None = None
            for text in group.column("wrapper").to_pylist():
                whole = json.loads(text) if whole is None else align(whole, json.loads(text))
            yield pa.RecordBatch.from_arrays(
                [pa.array([group.column("host")[0].as_py()]), pa.array([json.dumps(whole)]),
                 pa.array([sum(group.column("n_pages").to_pylist())], pa.int64())], names=["host", "wrapper", "n_pages"])

    kind = "host string, wrapper string, n_pages bigint"
    distinct = observed.groupBy("host", "wrapper").agg(F.count(F.lit(1)).alias("n_pages"))
    parts = distinct.withColumn("salt", F.pmod(F.xxhash64("wrapper"), F.lit(SALTS))).repartition(
        "host", "salt").sortWithinPartitions("host", "salt", "wrapper").mapInArrow(
        lambda batches: join_up(batches, ["host", "salt"]), kind)
    return parts.repartition("host").sortWithinPartitions("host", "wrapper").mapInArrow(
        lambda batches: join_up(batches, ["host"]), kind)


def _volumes(observed: DataFrame) -> DataFrame:
    """``host, path, volume``: text of a slot beside links, 0 where different pages all have the same."""
    rows = observed.where("host <> ''").select("host", "page", F.explode("slots").alias("slot")).select(
        "host", "page", "slot.*")
    constant = (F.min("page") != F.max("page")) & (F.min("mark") == F.max("mark"))
    return rows.groupBy("host", "path").agg(
        F.when(constant, F.lit(0)).otherwise(F.sum("length")).cast("bigint").alias("volume"))


def extract(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_blocks`` of every page."""
    observed = _observed(pages)
    hosts = _wrappers(observed)
    volumes = _volumes(observed).groupBy("host").agg(F.collect_list(F.struct("path", "volume")).alias("volumes"))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        excluded = lru_cache(1 << 16)(_excluded)
        for batch in batches:
            rules = []
            for wrapper, volume in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                known = {v["path"]: v["volume"] for v in volume or ()}
                rules.append(json.dumps({path: known.get(path, 0) for path in slots(json.loads(wrapper)) if not excluded(path)}))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rules, pa.string())], names=["host", "rule"])

    rules = scratch_table(hosts.join(volumes, "host", "left").select("host", "wrapper", "volumes").mapInArrow(
        judge, "host string, rule string"), "wrappers")
    schema = T.StructType([
        T.StructField("page_id", pages.schema["page_id"].dataType), T.StructField("url", T.StringType()),
        T.StructField("text", T.StringType()), T.StructField("n_blocks", T.LongType())])

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Caches are made where they are used: one of the module would travel by its name.
        read = lru_cache(64)(lambda rule: json.loads(rule or "{}"))
        excluded, is_marked = lru_cache(1 << 16)(_excluded), lru_cache(1 << 16)(_marked)
        for batch in batches:
            texts, counts = [], []
            for html, rule in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                volume, blocks = read(rule), parse(html)[1]
                lengths: dict[str, int] = {}
                for block in blocks:
                    if block.path in volume:
                        lengths[block.path] = lengths.get(block.path, 0) + len(block.text) - block.linked
                wanted = set(content_slots(list(lengths), volume, lengths, excluded, is_marked))
                kept = [block.text for block in blocks if block.path in wanted]
                texts.append("\n".join(kept))
                counts.append(len(kept))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(counts, pa.int64())],
                names=["page_id", "url", "text", "n_blocks"])

    return _hosted(pages).join(rules, "host", "left").select("page_id", "url", "html", "rule").mapInArrow(apply, schema)
