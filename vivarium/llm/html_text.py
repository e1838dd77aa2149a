"""Main text of web pages by site template removal.

Each page is parsed to blocks of text and to element subtrees over them. A subtree has two hashes, worked out from those of its children as
elements close: one of its tags, classes, ids and text, and one of its shape, without the text. Spark counts on how many pages of a
host each hash occurs, and which share of their text shapes hold; subtrees whose text or shape recurs on many pages of their host are
deleted. A shape is only template outside of articles, where no paragraph or heading is inside, and if it holds little of its
pages' text: menus, footers, adverts and notices differ in words from page to page, but not in form. What is no article by tag, role, class or id
(menus, headers, footers, sidebars, notices, adverts, forms, comments) goes too, for hosts with few pages. If a page has an article or main
element, only text inside is kept, and paragraphs, headings and list items inside are never deleted for recurring, as articles may quote each other, nor for their class or id.

The hashes of recurring subtrees are broadcast only up to BROADCAST_HASHES; beyond it the pages are joined with them by
a shuffle. Pages are parsed twice, so that no text is staged.

Edge cases: a null or empty html gives an empty text; a null url, or one without "://", has the empty host. Repeated rows
give repeated rows (and count as pages of their own). Unclosed and unknown elements are closed with their parents. A very long or deeply
nested page takes time in proportion to its length. An empty table gives an empty table. Other columns are ignored.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common
from .url_filter import host_path

#: A subtree is template if it is on at least so many pages of its host, and on at least this share of them.
MIN_PAGES, MIN_SHARE = 5, 0.2
#: A shape is template if it holds at most this share of its pages' characters, on the mean.
MOST_TEXT = 0.15
BROADCAST_HASHES = 4_000_000

_TOKEN = re.compile(r"""<!--(?:.*?-->|.*)|<[!?][^>]*+>?|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+')?)*+)>|<[/a-zA-Z][^>]*+>?|([^<]++|<)""", re.S)
_ATTRIBUTE = re.compile(r"""(?<![\w-])(class|id|role|style|hidden|aria-hidden)(?:\s*+=\s*+("[^"]*+"|'[^']*+'|[^\s"'>]++))?""", re.I)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr br img".split())
_RAW = frozenset("script style title textarea iframe xmp noembed noframes noscript template svg".split())
_DROP = frozenset("head nav footer aside form button select dialog menu object audio video canvas math fieldset script style noscript template".split())
_TEXT = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd pre blockquote td th figcaption article main body html".split())
#: Elements that articles are made of; and what sets the hashes of shapes apart.
_SOLID = frozenset("p h1 h2 h3 h4 h5 h6 pre blockquote figure table article main".split())
_SHAPE = 0x9E3779B97F4A7C15
_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar".split())
_NAMES = frozenset(
    "nav navbar navigation menu submenu sidebar side footer foot masthead topbar toolbar cookie cookies consent gdpr notice banner alert popup modal overlay ad ads adv advert adverts advertisement "
    "advertising sponsor sponsored promo promotion comment comments commentlist disqus reply replies respond share sharing social related recommended newsletter subscribe subscription signup login "
    "breadcrumb breadcrumbs pagination pager widget form search copyright".split()
)
#: Names that tell what is no article also as a piece of a longer name inside of one, as in comment-list.
_ALWAYS = frozenset("comment comments commentlist disqus ad ads adv advert adverts advertisement advertising sponsor sponsored newsletter subscribe share sharing social related recommended cookie cookies gdpr breadcrumb breadcrumbs pagination".split())
_CLOSED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}


def _drops(tag: str, attributes: str, inside: bool) -> bool:
    if tag in _DROP or tag == "header" and not inside:
        return True
    for name, value in _ATTRIBUTE.findall(attributes) if attributes else ():
        name, value = name.lower(), value.strip("\"'").lower()
        if name == "hidden" or name == "aria-hidden" and value == "true" or name == "role" and value in _ROLES or name == "style" and re.search(r"display\s*:\s*none", value):
            return True
        if name in ("class", "id") and tag not in ("body", "html", "main") and (tag != "article" or inside):
            pieces = re.split("[^a-z0-9]+", value)
            if not inside:
                if not _NAMES.isdisjoint(pieces):
                    return True
            # Inside an article, its own paragraphs, headings and lists stay whatever they are called, and other elements go by whole names or by what is always beside it.
            elif (tag not in _TEXT or tag == "article") and not (_NAMES.isdisjoint(value.split()) and _ALWAYS.isdisjoint(pieces)):
                return True
    return False


def _joined(mark: str, parts: list[int]) -> int:
    return xxhash.xxh64_intdigest(mark + "".join(f",{x:x}" for x in parts))


class _Element:
    """An open element: what is inside so far. solid: it holds an element that articles are made of."""

    __slots__ = ("tag", "drop", "inside", "first", "mark", "parts", "shapes", "solid")

    def __init__(self, tag: str, drop: bool, inside: bool, first: int, mark: str):
        self.tag, self.drop, self.inside, self.first, self.mark = tag, drop, inside, first, mark
        self.parts: list[int] = []
        self.shapes: list[int] = []
        self.solid = tag in _SOLID


class Page:
    """blocks: text, kept by the rules, inside the article. trees: hash, first block, block after the last, for elements that may be deleted; shapes: the same by shape."""

    def __init__(self, text: str):
        self.blocks: list[tuple[str, bool, bool]] = []
        self.trees: list[tuple[int, int, int]] = []
        self.shapes: list[tuple[int, int, int]] = []
        self.buffer: list[str] = []
        self.open = [_Element("", False, False, 0, "")]
        self.count: dict[str, int] = {}  # open elements by tag
        at, end = 0, len(text)
        while at < end and (m := _TOKEN.match(text, at)):
            at = m.end()
            if m[4] is not None:
                self.buffer.append(m[4])
            elif m[2]:
                tag = m[2].lower()
                if m[1]:
                    self.end(tag)
                elif tag in _RAW:
                    close = re.compile(f"</{re.escape(tag)}[\\s/>]", re.I).search(text, at)
                    at = close.start() if close else end
                    at = text.find(">", at) + 1 or end
                else:
                    self.start(tag, m[3])
        while len(self.open) > 1:
            self.close()
        self.flush()

    def flush(self) -> None:
        if self.buffer:
            words = html.unescape("".join(self.buffer)).split()
            self.buffer.clear()
            if words:
                top, block = self.open[-1], " ".join(words)
                self.blocks.append((block, not top.drop, top.inside))
                top.parts.append(xxhash.xxh64_intdigest(block.encode("utf-8", "surrogatepass")))
                top.shapes.append(1)

    def start(self, tag: str, attributes: str) -> None:
        if tag == "br":
            self.buffer.append(" ")
            return
        if tag in _VOID:
            if tag == "hr":
                self.flush()
            return
        if tag not in _INLINE:
            self.flush()
            if self.count.get("p"):  # a block ends an open paragraph
                self.end("p")
            elif (closed := _CLOSED_BY.get(tag)) and any(self.count.get(t) for t in closed) and (hit := next((x.tag for x in reversed(self.open) if x.tag in closed or x.tag in ("ul", "ol", "dl", "table", "select")), "")) in closed:
                self.end(hit)
        top = self.open[-1]
        drop = _drops(tag, attributes, top.inside) if tag not in _INLINE or attributes else False
        inside = top.inside or tag in ("article", "main")
        if tag in _INLINE and drop and not top.drop:
            self.flush()
        mark = tag + "|" + "|".join(v for n, v in sorted(_ATTRIBUTE.findall(attributes)) if n.lower() in ("class", "id")) if attributes else tag
        self.open.append(_Element(tag, top.drop or drop, inside, len(self.blocks), mark))
        self.count[tag] = self.count.get(tag, 0) + 1
        if attributes.endswith("/") and tag not in _TEXT and tag not in _INLINE and tag != "div":
            self.close()

    def end(self, tag: str) -> None:
        if tag in ("p", "br") or tag not in _INLINE:
            self.flush()
        if self.count.get(tag):
            while self.close() != tag:
                pass

    def close(self) -> str:
        x = self.open[-1]
        if x.tag not in _INLINE or x.drop and not self.open[-2].drop:
            self.flush()
        self.open.pop()
        self.count[x.tag] -= 1
        top = self.open[-1]
        if x.tag in _INLINE:  # its text is its parent's; its tag belongs to the shape
            top.parts += x.parts
            top.shapes += [*x.shapes, _joined(x.tag, [])]
        elif len(self.blocks) > x.first:
            whole, shape = _joined(x.mark, x.parts), _joined(x.mark, x.shapes)
            top.parts.append(whole)
            top.shapes.append(shape)
            if x.tag not in ("html", "body", "article", "main") and not (x.inside and x.tag in _TEXT):
                self.trees.append((whole, x.first, len(self.blocks)))
                if not x.inside and not x.solid:
                    self.shapes.append((shape ^ _SHAPE, x.first, len(self.blocks)))
        else:
            top.shapes.append(_joined(x.mark, []))
        top.solid = top.solid or x.solid
        return x.tag

    def recurring(self):
        """The hash of each subtree that may be template, and for shapes which share of the page's characters all of its kind hold (else 0)."""
        for h in {h for h, _, _ in self.trees}:
            yield h, 0.0
        size = np.concatenate(([0], np.cumsum([len(b[0]) for b in self.blocks], dtype=np.int64)))
        held: dict[int, int] = {}
        for h, first, last in self.shapes:
            held[h] = held.get(h, 0) + int(size[last] - size[first])
        for h, n in held.items():
            yield h, n / int(size[-1])

    def text(self, template) -> str:
        gone = np.zeros(len(self.blocks) + 1, np.int64)
        for h, first, last in (*self.trees, *self.shapes):
            if h in template:
                gone[first] += 1
                gone[last] -= 1
        kept = [b[1] and not g for b, g in zip(self.blocks, np.cumsum(gone).tolist(), strict=False)]
        main = any(b[2] and b[1] for b in self.blocks)
        return "\n\n".join(b[0] for b, k in zip(self.blocks, kept, strict=True) if k and (b[2] or not main))


def _site_hash(host: str, h: int) -> int:
    return int(np.int64(np.uint64(h ^ xxhash.xxh64_intdigest((host or "").encode()))))


def _subtrees(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for t in common.batches(parts):
        hosts, hashes, shares = [], [], []
        for host, text in zip(t.column("host").to_pylist(), t.column("html").to_pylist(), strict=True):
            for h, share in Page(text or "").recurring():
                hosts.append(host)
                hashes.append(_site_hash(host, h))
                shares.append(share)
        yield pa.RecordBatch.from_pydict({"host": pa.array(hosts, pa.string()), "tree": pa.array(hashes, pa.int64()), "share": pa.array(shares, pa.float64())})


def templates(pages: DataFrame, min_pages: int = MIN_PAGES, min_share: float = MIN_SHARE, most_text: float = MOST_TEXT) -> DataFrame:
    """tree: the hashes, with their host mixed in, of the subtrees and shapes that recur on many pages of their host."""
    hosts = pages.groupBy("host").agg(F.count(F.lit(1)).alias("pages"))
    counted = common.mapped(pages.select("host", "html"), _subtrees, "host string, tree long, share double").groupBy("host", "tree").agg(F.count(F.lit(1)).alias("n"), F.avg("share").alias("share"))
    counted = counted.where((F.col("n") >= min_pages) & (F.col("share") <= most_text))
    return counted.join(hosts, "host").where(F.col("n") >= F.col("pages") * min_share).select("tree").distinct()


class _Known:
    """Membership of a subtree in a page's templates."""

    def __init__(self, trees: np.ndarray, host: str):
        self.trees, self.host = trees, host

    def __contains__(self, h: int) -> bool:
        x = _site_hash(self.host, h)
        i = int(np.searchsorted(self.trees, x))
        return i < len(self.trees) and int(self.trees[i]) == x


def page_texts(pages: DataFrame, min_pages: int = MIN_PAGES, min_share: float = MIN_SHARE) -> DataFrame:
    """One row per page: page_id, url, text, n_chars."""
    spark = pages.sparkSession
    rows = pages.select("page_id", "url", "html").withColumn("host", host_path(F.col("url"))[0])
    template = common.staged(templates(rows, min_pages, min_share), "templates")
    schema = f"page_id {pages.schema['page_id'].dataType.simpleString()}, url string, text string, n_chars long"

    def out(t: pa.Table, texts: list[str]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([common.column(t, "page_id"), common.column(t, "url"), pa.array(texts, pa.string()), pa.array([len(x) for x in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    if template.count() <= BROADCAST_HASHES:
        trees = spark.sparkContext.broadcast(np.sort(np.array([r[0] for r in template.toLocalIterator()], np.int64)))

        def near(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for t in common.batches(parts):
                yield out(t, [_clean(Page(x or "").text(_Known(trees.value, h))) for h, x in zip(t.column("host").to_pylist(), t.column("html").to_pylist(), strict=True)])

        return common.mapped(rows, near, schema)

    # Each page's own templates come by a join on the page's content key.
    keyed = rows.withColumn("page_key", F.xxhash64("host", "html"))

    def own(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in common.batches(parts):
            found = [(k, _site_hash(h, x)) for k, h, text in zip(*(t.column(c).to_pylist() for c in ("page_key", "host", "html")), strict=True) for x, _ in Page(text or "").recurring()]
            yield pa.RecordBatch.from_pydict({"page_key": pa.array([k for k, _ in found], pa.int64()), "tree": pa.array([x for _, x in found], pa.int64())})

    mine = common.mapped(keyed.select("page_key", "host", "html"), own, "page_key long, tree long").join(template, "tree").groupBy("page_key").agg(F.collect_set("tree").alias("trees"))

    def far(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in common.batches(parts):
            yield out(t, [_clean(Page(x or "").text(_Known(np.sort(np.array(k or [], np.int64)), h))) for h, x, k in zip(*(t.column(c).to_pylist() for c in ("host", "html", "trees")), strict=True)])

    return common.mapped(keyed.join(mine, "page_key", "left").drop("page_key"), far, schema)


def _clean(text: str) -> str:
    """Lone surrogates from character references can't be stored."""
    return text.encode("utf-8", "replace").decode() if not text.isascii() else text
