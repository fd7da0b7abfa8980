"""Main texts of web pages by a vote of their hosts.

Every page scores its containers by the text they hold outside of links and boilerplate, and votes
for the generalised path (tags and classes, numbers blotted out) of the innermost one that holds
most of it. Votes are summed per host in Spark, as are the pages that have text at a path; each page
is then extracted from the container at its host's winning path if that holds most of its text.
Where it does not, the page's own best container is taken if its path is a layout of the host, that
is, wins on more than half of the pages that have it: so a second layout is read at its own path,
while a list of readers' comments, which many pages have and few are won by, leaves the article at
the host's path. A page without text at the host's path is read at its own best container.

The text is the blocks of that container in page order, joined by line feeds: references decoded,
white space run together, without menus, headers, footers, sidebars, notices, adverts, forms,
comments of readers, scripts, styles and markup. Nothing else is dropped.

Null and empty pages have an empty text. A null or odd address counts as the host ``''``. Broken
markup is read leniently and in linear time; pages of any length are read whole. Ties go to the
path that sorts first. Paths are counted by 64-bit hashes within their host. Repeated rows give repeated results, an empty table an empty one. Only the
named columns are read, so further ones do no harm.
"""

from __future__ import annotations

import re
from collections import Counter
from html import unescape

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.common import map_batches, stored, texts_of

# A tag's attributes end at the next "<" at the latest, so that no scan is repeated.
_TAG = re.compile(
    r"<!--.*?(?:--!?>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/><]*)((?:[^><\"']++|\"[^\"<]*\"|'[^'<]*'|[\"'])*+)(?:>|(?=<)|\Z)", re.S)
_ATTRIBUTE = re.compile(r"(?<![\w-])(class|id|role|hidden|aria-hidden|style)\b"
                        r"(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
_NUMBER = re.compile("[0-9]+")
_NAMES = re.compile("[^a-z]+")
_CAMEL = re.compile("(?<=[a-z])(?=[A-Z])")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)

# Fixed values of the markup language.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe noembed noframes xmp".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu "
    "nav ol optgroup option p pre section summary table tbody td tfoot th thead tr ul".split())
CONTAINERS = frozenset(
    "article blockquote body center div dl figure form html main ol section table tbody td "
    "tr ul header footer aside nav fieldset dialog details menu".split())
ENDS_PARAGRAPH = BLOCKS - {"html", "body", "td", "th", "tr", "tbody", "thead", "tfoot", "option",
                           "optgroup", "legend", "caption", "summary"}
# Tag -> tags that it ends when they are open, up to the tags that shut them in.
CLOSES = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}),
          "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}),
          "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
          "option": ({"option"}, {"select"})}
# Elements and words of classes, ids and roles that mark what is not the article.
SIDE_TAGS = frozenset(
    "nav header footer aside form button select dialog menu template svg object canvas audio "
    "video map datalist label input".split())
SIDE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising adsense banner banners breadcrumb breadcrumbs "
    "comment comments commentlist complementary consent contentinfo cookie cookies disqus footer "
    "footnav form gdpr header login masthead menu menus modal nav navbar navigation newsletter "
    "notice notices notification pager pagination popup promo promoted promotion recommended "
    "related replies reply respond search share sharing sidebar signup social sponsor sponsored "
    "subscribe subscription teaser teasers toolbar topbar widget widgets alert".split())
# The part of a page's text that its main container holds at least.
MOST = 0.6
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())


class Node:
    __slots__ = ("tag", "parent", "label", "side", "end", "link", "at")

    def __init__(self, at: int, tag: str, parent: Node | None, label: str, side: int, link: bool):
        self.at, self.tag, self.parent, self.label = at, tag, parent, label
        self.side = side  # the innermost boilerplate element around, by number; -1: none
        self.link = link
        self.end = at     # number of the last element inside


class Block:
    __slots__ = ("node", "text", "links", "heading")

    def __init__(self, node: Node, text: str, links: int, heading: bool):
        self.node, self.text, self.links, self.heading = node, text, links, heading


def _attributes(text: str) -> tuple[str, str, bool]:
    """Generalised classes, words of class, id and role, and whether the element is hidden."""
    label, words, hidden = "", "", False
    if text:
        for name, *values in _ATTRIBUTE.findall(text):
            name, value = name.lower(), unescape(next(filter(None, values), ""))
            if name == "class":
                label = ".".join(sorted({_NUMBER.sub("N", c.lower()) for c in value.split()}))
            if name in ("class", "id", "role"):
                words += " " + _CAMEL.sub(" ", value)
            hidden = hidden or name == "hidden" or (
                name == "aria-hidden" and value.lower() == "true") or (
                name == "style" and bool(_HIDDEN.search(value)))
    return label, words.lower(), hidden


class Page:
    """The elements and text blocks of a page."""

    def __init__(self, html: str):
        self.nodes: list[Node] = []
        self.blocks: list[Block] = []
        self._open: list[Node] = []
        self._count: Counter[str] = Counter()
        self._text: list[tuple[str, bool]] = []
        self._push("html", "")
        at = 0
        for tag in iter(lambda: _TAG.search(html, at), None):
            if tag.start() > at:
                self._say(html[at:tag.start()])
            at = max(tag.end(), tag.start() + 1)
            name = tag.group(2)
            if name is None:
                continue
            name = name.lower()
            if tag.group(1):
                self._close(name)
                continue
            if name in ("html", "body", "head") and self._count[name]:
                continue
            if name in RAW:
                # Nothing inside is markup, up to the element's own end.
                end = re.compile(f"</{name}(?=[\\s/>]|\\Z)[^>]*>?", re.I).search(html, at)
                at = end.end() if end else len(html)
                continue
            self._start(name, tag.group(3) or "")
        if at < len(html):
            self._say(html[at:])
        self._flush()
        while self._open:
            self._pop()

    def _say(self, text: str) -> None:
        self._text.append((text, self._open[-1].link))

    def _flush(self) -> None:
        if self._text:
            text = " ".join(unescape("".join(t for t, _ in self._text)).split())
            if text:
                links = sum(len(t.strip()) for t, link in self._text if link)
                node = self._open[-1]
                heading = any(n.tag in HEADINGS for n in self._open[-4:])
                self.blocks.append(Block(node, text, links, heading))
            self._text = []

    def _push(self, tag: str, attributes: str) -> None:
        parent = self._open[-1] if self._open else None
        at = len(self.nodes)
        label, words, hidden = _attributes(attributes)
        side = parent.side if parent else -1
        marks = SIDE_WORDS.intersection(_NAMES.split(words))
        if self._count["article"] or self._count["main"]:
            # Search boxes are forms; in an article the word names a part of the text.
            marks -= {"search"}
        if hidden or (tag not in ("html", "body", "article", "main") and (
                tag in SIDE_TAGS or marks)):
            side = at
        elif tag == "article" and not {"comment", "comments"}.isdisjoint(_NAMES.split(words)):
            side = at
        name = f"{tag}.{label}" if label else tag
        self.nodes.append(Node(at, tag, parent, name, side, tag == "a" or bool(
            parent and parent.link)))
        self._open.append(self.nodes[-1])
        self._count[tag] += 1

    def _pop(self) -> None:
        node = self._open.pop()
        node.end = len(self.nodes) - 1
        self._count[node.tag] -= 1

    def _close(self, name: str) -> None:
        if name == "br" or not self._count[name] or name in ("html", "body"):
            return
        if name in BLOCKS:
            self._flush()
        while True:
            last = self._open[-1]
            if last.tag in BLOCKS:
                # An inline end tag does not reach beyond its block.
                if name not in BLOCKS:
                    return
                self._flush()
            self._pop()
            if last.tag == name:
                return

    def _start(self, name: str, attributes: str) -> None:
        if name in VOID:
            if name in ("br", "hr", "img"):
                self._text.append((" ", False))
            if name == "hr":
                self._flush()
            return
        if name in BLOCKS:
            self._flush()
            if name in ENDS_PARAGRAPH and self._count["p"]:
                self._end_open({"p"}, CONTAINERS)
        if name in CLOSES:
            self._end_open(*CLOSES[name])
        self._push(name, attributes)

    def _end_open(self, ended: set[str], shut_in: frozenset[str] | set[str]) -> None:
        """End the outermost open element of some tags that no other tag shuts in."""
        upto = None
        for back, node in enumerate(reversed(self._open), 1):
            if node.tag in shut_in:
                break
            if node.tag in ended:
                upto = back
            if back > 64:
                break
        for _ in range(upto or 0):
            self._pop()

    @staticmethod
    def path(node: Node) -> str:
        labels = []
        while node:
            if node.tag in CONTAINERS:
                labels.append(node.label)
            node = node.parent
        return ">".join(reversed(labels))

    def keys(self) -> list[int]:
        """Per element a hash of its path, 0 to 2^63 - 1; equal for elements of equal paths."""
        out: list[int] = []
        for node in self.nodes:
            key = out[node.parent.at] if node.parent else 0
            if node.tag in CONTAINERS:
                key = xxhash.xxh64_intdigest(node.label.encode("utf-8", "replace"), key) >> 1
            out.append(key)
        return out

    def _points(self, link_weight: int = 2, anywhere: bool = False) -> list[float]:
        """Per element the characters inside it, less those in links by a weight."""
        points = [0.0] * len(self.nodes)
        for block in self.blocks:
            if block.node.side < 0 or anywhere:
                points[block.node.at] += max(0, len(block.text) - link_weight * block.links)
        for node in reversed(self.nodes):
            if node.parent:
                points[node.parent.at] += points[node.at]
        return points

    def with_text(self) -> list[Node]:
        """The containers with text outside of boilerplate."""
        points = self._points()
        return [n for n in self.nodes if n.tag in CONTAINERS and points[n.at] > 0]

    def hold_most(self, containers: list[Node]) -> bool:
        """Whether containers hold most of the text outside of boilerplate."""
        points = self._points()
        return sum(points[c.at] for c in containers) >= MOST * points[0]

    def best(self) -> Node | None:
        """The innermost container with most of the page's text; None on a page without text.

        Text in links counts against a block. Should nothing be left outside of boilerplate, then
        boilerplate counts too; should there be only links, then these do.
        """
        for link_weight, anywhere in ((2, False), (2, True), (0, True)):
            points = self._points(link_weight, anywhere)
            if points[0] > 0:
                # Containers with more than half of the text lie within each other.
                at = max(n.at for n in self.nodes
                         if n.tag in CONTAINERS and points[n.at] >= MOST * points[0])
                return self._whole(self.nodes[at])
        return None

    @staticmethod
    def _whole(node: Node) -> Node:
        """The article around a container, or else the main element."""
        for tag in ("article", "main"):
            above = node
            while above:
                if above.tag == tag:
                    return above
                above = above.parent
        return node

    def text(self, containers: list[Node]) -> str:
        """The blocks within containers, without the boilerplate inside these."""
        out = []
        spans = [(c.at, c.end) for c in containers]
        k = 0
        for block in self.blocks:
            at = block.node.at
            while k < len(spans) and spans[k][1] < at:
                k += 1
            if k == len(spans):
                break
            if spans[k][0] > at:
                continue
            side = block.node.side
            inside = side > spans[k][0]
            if not inside or (block.heading and self.nodes[side].tag == "header"
                              and self._in_article(self.nodes[side])):
                out.append(block.text)
        return "\n".join(out)

    @staticmethod
    def _in_article(node: Node) -> bool:
        """Whether a header belongs to an article or to the main element: its headings are titles
        of the text."""
        while node:
            if node.tag in ("article", "main"):
                return True
            node = node.parent
        return False

    def at_path(self, path: str) -> list[Node]:
        """The containers at a path, none inside another."""
        last = path.rpartition(">")[2]
        out: list[Node] = []
        for node in self.nodes:
            if (node.label == last and (not out or node.at > out[-1].end)
                    and self.path(node) == path):
                out.append(node)
        return out


def vote(html: str) -> tuple[str | None, int | None, set[int]]:
    """The path that a page votes for, its key, and the keys of all paths at which it has text."""
    page = Page(html)
    best, keys = page.best(), page.keys()
    present = {keys[n.at] for n in page.with_text()}
    if not best:
        return None, None, present
    return page.path(best), keys[best.at], present | {keys[best.at]}


def extract(html: str, path: str | None) -> tuple[str, int | None, str | None]:
    """The text at a path, or at the page's own best container.

    If the text at the path is not most of the page's, then also the key of the own best
    container's path, and its text.
    """
    page = Page(html)
    there = page.at_path(path) if path else []
    text = page.text(there)
    if text and page.hold_most(there):
        return text, None, None
    best = page.best()
    if not best:
        return text, None, None
    own = page.text([best])
    return (text, page.keys()[best.at], own) if text else (own, None, None)


def host(url: Column) -> Column:
    """The host of an address in lower case, or the empty text."""
    return F.lower(F.coalesce(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#:]*)", 1),
                              F.lit("")))


def counts(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Per host and path that is voted for: its ``key``, its ``votes`` and the number of pages that
    have text there (``present``)."""
    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        found: dict[tuple[str, int], list] = {}
        for where, html in zip(batch.column("_host").to_pylist(), texts_of(batch, html_col),
                               strict=True):
            path, won, present = vote(html)
            for key in present:
                row = found.setdefault((where, key), [None, 0, 0])
                row[2] += 1
                if key == won:
                    row[0] = path
                    row[1] += 1
        rows = [(*at, *row) for at, row in found.items()]
        return pa.RecordBatch.from_pylist(
            [dict(zip(schema.names, row, strict=True)) for row in rows], schema)
    schema = pa.schema([("host", pa.string()), ("key", pa.int64()), ("path", pa.string()),
                        ("votes", pa.int64()), ("present", pa.int64())])
    parts = map_batches(
        pages.select(host(F.col(url_col)).alias("_host"), html_col), ["_host", html_col],
        "host string, key bigint, path string, votes bigint, present bigint", work)
    sums = parts.groupBy("host", "key").agg(
        F.min("path").alias("path"), F.sum("votes").alias("votes"),
        F.sum("present").alias("present"))
    return sums.where("votes > 0")


def winners(found: DataFrame) -> DataFrame:
    """Per host its winning path and the number of pages that voted for it, from ``counts``."""
    # The most votes; of equal paths the first.
    best = F.min(F.struct((-F.col("votes")).alias("n"), "path")).alias("b")
    return found.groupBy("host").agg(best).select(
        "host", F.col("b.path").alias("path"), (-F.col("b.n")).alias("votes"))


def layouts(found: DataFrame) -> DataFrame:
    """The paths, by host and key, that win on more than half of the pages that have them."""
    return found.where("2 * votes > present").select("host", "key")


def main_texts(pages: DataFrame, id_col: str = "page_id", url_col: str = "url",
               html_col: str = "html") -> DataFrame:
    """Per page its id, address and main ``text``."""
    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts, keys, owns = [], [], []
        for row, (html, path) in enumerate(zip(
                texts_of(batch, html_col), batch.column("_path").to_pylist(), strict=True)):
            text, key, own = extract(html, path)
            texts.append(text)
            # A number that is no key, and differs from row to row, joins with nothing.
            keys.append(-1 - row if key is None else key)
            owns.append(own)
        return pa.RecordBatch.from_arrays(
            [batch.column(id_col), batch.column(url_col), batch.column("_host"),
             pa.array(keys, pa.int64()), pa.array(texts, pa.string()),
             pa.array(owns, pa.string())], names)
    # Short rows per host and path. Stored, so that their size is known when joins are planned.
    found = stored(counts(pages, url_col, html_col), "votes")
    paths = stored(winners(found).select(
        F.col("host").alias("_host"), F.col("path").alias("_path")), "paths")
    others = stored(layouts(found), "layouts")
    rows = pages.select(id_col, url_col, html_col, host(F.col(url_col)).alias("_host"))
    kind = pages.schema[id_col].dataType.simpleString()
    names = [id_col, url_col, "_host", "_key", "text", "_own"]
    read = map_batches(rows.join(paths, "_host", "left"),
                       [id_col, url_col, html_col, "_host", "_path"],
                       f"`{id_col}` {kind}, `{url_col}` string, _host string, _key bigint, "
                       "text string, _own string", work)
    same = (F.col("_host") == others["host"]) & (F.col("_key") == others["key"])
    return read.join(others, same, "left").select(
        id_col, url_col,
        F.when(others["key"].isNotNull(), F.col("_own")).otherwise(F.col("text")).alias("text"))


def report(texts: DataFrame) -> DataFrame:
    return texts.select("page_id", "url", "text",
                        F.length("text").cast("bigint").alias("n_chars"))
