"""Main text of web pages by wrappers inferred per host.

Every page becomes a tree of structural elements and text slots. The wrapper of a host is a
union-free regular expression over such trees: a sequence of elements and slots in which
each may be optional or repeated. It starts from one page and is aligned with the next,
again and again: neighbours of one label become one repeated element, neighbouring groups
that recur become a repeated group, and what only one side has becomes optional.
The finished wrapper says which kind of main region the host has. A host without any has its
slots' texts compared between its pages: what all of them share is template, the rest content.

Pages of one shape count once: shapes are made distinct before they are aligned, and the
shapes of a large host are aligned in salted parts whose wrappers are then aligned with
each other. Alignment streams over sorted rows and holds one wrapper at a time.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Collection, Iterator
from difflib import SequenceMatcher
from functools import lru_cache
from html import unescape

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegate.functions.compare import quoted
from tidegate.operators.sizing import settle
from tidegate.session import cut_lineage

SALTS = 16
# A text is template if at least so many different pages have its slot, and all the same text in it.
FEW = 3
# Elements nested deeper become siblings of the element at this depth; no text is lost.
DEPTH = 120
_SMALL = 40_000

# Fixed values of the markup language.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title xmp iframe noembed noframes noscript template svg annotation annotation-xml".split())
INLINE = set(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var wbr br img math mi mn mo ms mtext mrow mfrac msup msub msubsup msqrt mroot mover "
    "munder munderover mtable mtr mtd mspace mstyle mpadded menclose semantics".split()
)
CLOSES = {  # what an opening element ends if it is still open
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
    "th": {"td", "th"}, "option": {"option"}, "thead": {"tr", "td", "th"}, "tbody": {"tr", "td", "th", "thead"},
    "tfoot": {"tr", "td", "th", "tbody"}, "body": {"head"},
}
PHRASES = set("p h1 h2 h3 h4 h5 h6".split())

# What is not the article, by element and by the words of class, id and role.
APART = set("nav footer aside form head script style noscript button select dialog menu iframe template svg".split())
APART_WORDS = set(
    "ad ads advert advertisement advertising adverts sponsor sponsored promo promotion banner cookie cookies consent gdpr "
    "notice notices alert popup modal overlay newsletter subscribe subscription signup sidebar aside widget widgets "
    "menu nav navbar navigation breadcrumb breadcrumbs masthead topbar footer comment comments disqus respond reply "
    "replies share sharing social related recommended recommendations pagination pager login search toolbar "
    "copyright paywall".split()
)
# Of these words, those that make even an article element something beside the article.
BESIDE_WORDS = set(
    "ad ads advert advertisement advertising adverts sponsor sponsored promo promotion related recommended "
    "recommendations comment comments disqus respond reply replies teaser".split()
)
# Words that go with those above in one name (related-posts); with any other word the name is the article's own.
COMPANIONS = set(
    "area articles bar block body bottom box button buttons container content count entry footer form group header heading "
    "icons inline inner item items left link links list main meta outer page panel post posts right row section site "
    "slot stories story text thread title top unit wrap wrapper".split()
)
TOP = set("html body article main".split())
ARTICLE_WORDS = set("articlebody".split())

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[(?P<data>.*?)(?:\]\]>|\Z)|<[!?][^>]*+>?"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*+)(?P<rest>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(?P<end2>/?)(?P<name2>[a-zA-Z][^\s/>]*+)(?P<rest2>[^>]*+)(?:>|\Z)",
    re.DOTALL,
)
_ATTRIBUTE = re.compile(r"\b(class|id|role|itemprop)\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s\"'>]++))", re.IGNORECASE)


class Element:
    __slots__ = ("label", "children", "name")

    def __init__(self, name: str, label: str):
        self.name, self.label, self.children = name, label, []


def _label(name: str, attributes: str) -> str:
    """Element name and the names in its class, id, role and itemprop, words joined by "-", numbers apart."""
    names: set[str] = set()
    for _, *values in _ATTRIBUTE.findall(attributes):
        names.update("-".join(re.findall("[a-z]+", n)) for n in "".join(values).lower().split())
    return " ".join([name, *sorted(names - {""})])


def _words(names: list[str]) -> set[str]:
    return {w for n in names for w in n.split("-")}


def parse(html: str) -> Element:
    """The page as a tree: structural elements, and strings for the text between them."""
    root = Element("", "")
    stack, beyond = [root], []

    def text(chunk: str) -> None:
        if chunk:
            held = stack[-1].children
            if held and isinstance(held[-1], str):
                held[-1] += chunk
            else:
                held.append(chunk)

    def close(names: set[str], until: set[str]) -> None:
        for depth in range(len(stack) - 1, 0, -1):
            if stack[depth].name in names:
                del stack[depth:]
                return
            if stack[depth].name in until:
                return

    at, size = 0, len(html)
    while at < size:
        found = _TAG.search(html, at)
        if not found:
            text(unescape(html[at:]))
            break
        text(unescape(html[at : found.start()]))
        at = found.end()
        if found["data"] is not None:
            text(found["data"])
        name = (found["name"] or found["name2"] or "").lower()
        if not name:
            continue
        if found["end"] or found["end2"]:
            if name in beyond:
                while beyond.pop() != name:
                    pass
                stack[-1].children.append(Element("", ""))  # ends the block
            elif name not in INLINE:
                close({name}, set())
            continue
        if name == "br":
            text(" ")
        closed = ((found["rest"] if found["name"] else found["rest2"]) or "").rstrip().endswith("/")
        if name in RAW:
            if closed and name == "svg":  # foreign elements may end at once; others of these cannot
                continue
            ends = re.compile(rf"</{re.escape(name)}\b[^>]*+(?:>|\Z)", re.IGNORECASE).search(html, at)
            at = ends.end() if ends else size
            continue
        if name in INLINE or name in VOID:
            if name == "hr":
                stack[-1].children.append(Element(name, name))
            continue
        if not beyond:
            if name in CLOSES:
                close(CLOSES[name], {"ul", "ol", "dl", "table"} - {name})
            close(PHRASES, TOP | {"table", "td", "th", "li", "div", "section", "blockquote"})
        attributes = found["rest"] if found["name"] else found["rest2"]
        element = Element(name, _label(name, attributes or ""))
        stack[-1].children.append(element)
        if closed:
            continue
        if len(stack) < DEPTH:
            stack.append(element)
        else:
            beyond.append(name)
    return root


# A wrapper item is [label, optional, repeated, items]; "#" is a text slot, "(" a group.
SLOT, GROUP = "#", "("


def _key(item: list) -> str:
    return item[0] if item[0] != GROUP else "(" + "|".join(_key(c) for c in item[3])


def _merged(a: list, b: list) -> list:
    return [a[0], a[1] or b[1], a[2] or b[2], aligned(a[3], b[3])]


def folded(items: list[list]) -> list[list]:
    """Neighbours of one label as one repeated item, and recurring neighbours as a repeated group."""
    out: list[list] = []
    for item in items:
        if out and _key(out[-1]) == _key(item):
            both = _merged(out[-1], item)
            both[1], both[2] = out[-1][1] and item[1], item[0] != SLOT
            out[-1] = both
        else:
            out.append(item)
    for period in (2, 3, 4):
        at = 0
        while at + 2 * period <= len(out):
            one, two = out[at : at + period], out[at + period : at + 2 * period]
            if [_key(i) for i in one] == [_key(i) for i in two]:
                group = [GROUP, False, True, [_merged(x, y) for x, y in zip(one, two, strict=True)]]
                out[at : at + 2 * period] = [group]
                while [_key(i) for i in out[at + 1 : at + 1 + period]] == [_key(i) for i in group[3]]:
                    more = out[at + 1 : at + 1 + period]
                    group[3] = [_merged(x, y) for x, y in zip(group[3], more, strict=True)]
                    del out[at + 1 : at + 1 + period]
            at += 1
    return out


def _matches(a: list[str], b: list[str]) -> Iterator[tuple[int, int]]:
    """A longest common subsequence, or a good one for very long sequences."""
    if len(a) * len(b) > _SMALL:
        for block in SequenceMatcher(None, a, b, autojunk=False).get_matching_blocks():
            yield from ((block.a + i, block.b + i) for i in range(block.size))
        return
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(len(a) - 1, -1, -1):
        for j in range(len(b) - 1, -1, -1):
            best[i][j] = best[i + 1][j + 1] + 1 if a[i] == b[j] else max(best[i + 1][j], best[i][j + 1])
    i = j = 0
    while i < len(a) and j < len(b):
        if a[i] == b[j]:
            yield i, j
            i, j = i + 1, j + 1
        elif best[i + 1][j] >= best[i][j + 1]:
            i += 1
        else:
            j += 1


def aligned(a: list[list], b: list[list]) -> list[list]:
    """The wrapper of both sequences: what one of them lacks is optional."""
    if a == b:
        return a
    out, i, j = [], 0, 0

    def optional(items: list[list]) -> Iterator[list]:
        return ([label, True, repeated, inner] for label, _, repeated, inner in items)

    for x, y in _matches([_key(k) for k in a], [_key(k) for k in b]):
        out.extend(optional(a[i:x]))
        out.extend(optional(b[j:y]))
        out.append(_merged(a[x], b[y]))
        i, j = x + 1, y + 1
    out.extend(optional(a[i:]))
    out.extend(optional(b[j:]))
    return folded(out)


def shape(element: Element) -> list[list]:
    """The page's own wrapper, with what recurs in it folded."""
    items = []
    for child in element.children:
        if isinstance(child, str):
            if child.strip():
                items.append([SLOT, False, False, []])
        else:
            items.append([child.label, False, False, shape(child)])
    return folded(items)


def _apart(label: str, inside: bool) -> bool:
    """Is the element something beside the article? `inside` tells that it lies in the article's region.

    There a name counts only if all its words do: `related-posts` is beside the article, `related-work`
    is a part of it.
    """
    name, *names = label.split(" ")
    if name in TOP:
        return name == "article" and bool(BESIDE_WORDS & _words(names))
    if name in APART:
        return True
    if inside:
        return any(APART_WORDS & set(n.split("-")) and set(n.split("-")) <= APART_WORDS | COMPANIONS for n in names)
    words = _words(names)
    return bool(APART_WORDS & words) or name == "header" or "header" in words


def _regions(items: list[list], inside: bool = False) -> set[str]:
    """Which kinds of main region the wrapper has outside of menus and the like."""
    found: set[str] = set()
    for label, _, _, inner in items:
        name, *names = label.split(" ")
        words = _words(names)
        if label == GROUP:
            found |= _regions(inner, inside)
        elif label != SLOT and not _apart(label, inside):
            if name == "article" or ARTICLE_WORDS & words:
                found.add("article")
            if name == "main" or "main" in words:
                found.add("main")
            found |= _regions(inner, inside or name in ("article", "main"))
    return found


def _is_region(label: str, region: str) -> bool:
    name, *names = label.split(" ")
    words = _words(names)
    if region == "article":
        return name == "article" or bool(ARTICLE_WORDS & words)
    return name == "main" or "main" in words


@lru_cache(maxsize=512)
def _labelled(wrapper: str) -> tuple[list[list], str]:
    items = json.loads(wrapper)
    found = _regions(items)
    return items, "article" if "article" in found else "main" if "main" in found else ""


class _Blocks:
    """Text of the slots that belong to the article, block by block in page order."""

    def __init__(self):
        self.found: list[str] = []

    def add(self, text: str) -> None:
        block = " ".join(text.split())
        if block:
            self.found.append(block)


def _slots(items: list[list]) -> dict[str, list]:
    """The items of a level by label; groups count as their members."""
    out: dict[str, list] = {}
    for item in items:
        if item[0] == GROUP:
            out.update(_slots(item[3]))
        else:
            out.setdefault(item[0], item)
    return out


def _walk(element: Element, items: list[list], region: str, inside: bool, blocks: _Blocks) -> None:
    level = _slots(items)
    for child in element.children:
        if isinstance(child, str):
            if inside or not region:
                blocks.add(child)
        elif not _apart(child.label, inside):
            own = level.get(child.label)  # the wrapper covers every page it was inferred from
            _walk(child, own[3] if own else [], region, inside or bool(region) and _is_region(child.label, region), blocks)


def _digest(*parts: bytes) -> bytes:
    return hashlib.blake2b(b"\0".join(parts), digest_size=16).digest()


def _marked(element: Element, slot: bytes = b"") -> Iterator[tuple[bytes, bytes, str]]:
    """(slot, mark, text) of the blocks that are not apart: the labels from the root down, and those with the text."""
    for child in element.children:
        if not isinstance(child, str):
            if not _apart(child.label, False):
                yield from _marked(child, _digest(slot, child.label.encode("utf-8", "replace")))
        elif text := " ".join(child.split()):
            yield slot, _digest(slot, text.encode("utf-8", "replace")), text


def extract(html: str | None, wrapper: str | None, fixed: Collection[bytes] = ()) -> str:
    """The main text of a page by its host's wrapper.

    `fixed` holds the marks of a host's template texts. A page that has nothing else keeps them.
    """
    if not html:
        return ""
    root, blocks = parse(html), _Blocks()
    items, region = _labelled(wrapper or "[]")
    if region:
        _walk(root, items, region, False, blocks)
    if not blocks.found and fixed:
        for _, mark, text in _marked(root):
            if mark not in fixed:
                blocks.add(text)
    if not blocks.found:  # no article on this page: all that is not apart
        _walk(root, [], "", False, blocks)
    return "\n\n".join(blocks.found)


@lru_cache(maxsize=512)
def _fixed(marks: str | None) -> frozenset[bytes]:
    return frozenset(bytes.fromhex(m) for m in (marks or "").split())


def _host(url: Column) -> Column:
    host = F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*+://(?:[^/@?#]*+@)?([^/:?#]*+)", 1)
    return F.coalesce(F.lower(host), F.lit(""))


def _aligned_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One wrapper per run of rows (host, shape) with the same host."""
    host, wrapper = None, None
    for batch in batches:
        done: list[tuple[str, str]] = []
        for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            items = json.loads(text)
            if key != host and host is not None:
                done.append((host, json.dumps(wrapper)))
            wrapper = aligned(wrapper, items) if key == host else items
            host = key
        yield _wrappers(done)
    if host is not None:
        yield _wrappers([(host, json.dumps(wrapper))])


def _wrappers(pairs: list[tuple[str, str]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([p[0] for p in pairs], pa.string()), pa.array([p[1] for p in pairs], pa.string())], ["host", "shape"]
    )


def wrappers(pages: DataFrame, url_column: str = "url", html_column: str = "html") -> DataFrame:
    """(host, wrapper) inferred from all pages of each host."""

    def shapes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [json.dumps(shape(parse(h or ""))) for h in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["host", "shape"])

    read = pages.select(_host(quoted(url_column)).alias("host"), quoted(html_column).cast("string").alias("html"))
    distinct = read.mapInArrow(shapes, "host string, shape string").distinct()
    salted = distinct.withColumn("salt", F.pmod(F.xxhash64("shape"), F.lit(SALTS)))
    parts = (
        salted.repartition("host", "salt")
        .sortWithinPartitions("host", "salt", "shape")
        .select("host", "shape")
        .mapInArrow(_aligned_runs, "host string, shape string")
    )
    whole = (
        parts.repartition("host").sortWithinPartitions("host", "shape").mapInArrow(_aligned_runs, "host string, shape string")
    )
    return whole.select("host", F.col("shape").alias("wrapper"))


def _without_region(found: DataFrame) -> DataFrame:
    """The hosts whose wrapper marks no article or main region."""

    def plain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [not _labelled(w)[1] for w in batch.column(1).to_pylist()]
            yield batch.select(["host"]).filter(pa.array(own, pa.bool_()))

    return found.select("host", "wrapper").mapInArrow(plain, "host string")


def template_texts(read: DataFrame, hosts: DataFrame) -> DataFrame:
    """(host, fixed): marks of the texts that all pages of the host with that slot share.

    A slot is the path of labels to it. Slots of fewer than FEW different pages are content.
    `read` has host and html, `hosts` the hosts to look at.
    """

    def marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for host, html in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                page = _digest((html or "").encode("utf-8", "replace"))
                own = {(slot, mark) for slot, mark, _ in _marked(parse(html or ""))}
                own |= {(slot, b"") for slot, _ in own}  # the slot itself
                rows.extend((host, slot, mark, page) for slot, mark in own)
            columns = list(zip(*rows, strict=True)) or [()] * 4
            kinds = [pa.string(), pa.binary(), pa.binary(), pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["host", "slot", "mark", "page"]
            )

    chosen = read.select("host", "html").join(hosts.select(F.col("host").alias("__own")), F.col("host") == F.col("__own"))
    each = chosen.select("host", "html").mapInArrow(marks, "host string, slot binary, mark binary, page binary").distinct()
    counted = cut_lineage(each.groupBy("host", "slot", "mark").agg(F.count(F.lit(1)).alias("c")).where(F.col("c") >= FEW))
    slots = counted.where(F.length("mark") == 0).select("host", "slot", "c")
    same = counted.where(F.length("mark") > 0).join(slots, ["host", "slot", "c"])
    return same.groupBy("host").agg(F.collect_list("mark").alias("fixed"))


def main_texts(
    pages: DataFrame, id_column: str = "page_id", url_column: str = "url", html_column: str = "html"
) -> DataFrame:
    """Per row: id, url, the main text and n_chars (its code points).

    NULL and empty pages have empty text; pages without a host share one wrapper; repeated
    rows each give their row. Markup of any length and nesting is read whole. Other columns are
    not read. Where a host's wrapper marks no region, texts that all its pages with that slot
    share are template and left out (see `template_texts`).
    """
    inferred = cut_lineage(wrappers(pages, url_column, html_column))
    plain = settle(_without_region(inferred))
    marked = inferred.withColumn("fixed", F.array().cast("array<binary>"))
    if plain.rows:
        hosted = pages.select(_host(quoted(url_column)).alias("host"), quoted(html_column).cast("string").alias("html"))
        marked = inferred.join(template_texts(hosted, plain.frame), "host", "left")
    # As text, so that its size is measured before a broadcast.
    fixed = F.array_join(F.transform("fixed", F.hex), " ")
    found = settle(marked.select(F.col("host").alias("__host"), "wrapper", fixed.alias("fixed"))).frame
    read = pages.select(
        quoted(id_column).alias("id"), quoted(url_column).alias("url"), quoted(html_column).cast("string").alias("html"),
        _host(quoted(url_column)).alias("host"),
    )
    types = {c: pages.schema[n].dataType.simpleString() for c, n in (("id", id_column), ("url", url_column))}

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = (batch.column(i).to_pylist() for i in (2, 3, 4))
            texts = [extract(h, w, _fixed(f)) for h, w, f in zip(*columns, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                ["id", "url", "text", "n_chars"],
            )

    joined = read.join(found, F.col("host") == F.col("__host"), "left").select("id", "url", "html", "wrapper", "fixed")
    out = joined.mapInArrow(each, f"id {types['id']}, url {types['url']}, text string, n_chars long")
    return out.select(F.col("id").alias(id_column), F.col("url").alias(url_column), "text", "n_chars")
