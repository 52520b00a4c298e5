"""Main text of web pages with a site style tree.

The DOM trees of a host's pages are merged: elements that stand at the same path of tags, classes and ids are one node
of the tree. A node's presentation is important if its pages lay out its children in different ways, its content if the
pages have different texts there; both are entropies over the pages that have the node. A page then drops the branches
in which every node's combined importance is low, beside elements that are menus, footers and the like by their tag, role
or class name.
"""

from __future__ import annotations

import html
import re
from array import array
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fundlake.llm.common import read, rows_of, stage

#: Branches without a node of this importance go; nodes of fewer pages than ``PAGES`` prove nothing. ``FADE`` weighs a branch's own
#: layout against what it holds, as in the published measure.
LEAST, PAGES, FADE = 0.2, 8, 0.9

# Kinds of HTML elements.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
INLINE = set(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small "
    "span strike strong sub sup time tt u var wbr".split()
)
HIDDEN = set(
    "script style noscript template head title iframe object svg math canvas audio video select option textarea button "
    "form input nav footer aside menu dialog fieldset map".split()
)
RAW = set("script style textarea title xmp iframe noembed noframes".split())
CLOSES = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
    "option": {"option"}, "thead": {"tr", "td", "th"}, "tbody": {"tr", "td", "th", "thead"}, "p": {"p"},
}
ENDS_P = set(
    "address article aside blockquote details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav "
    "ol p pre section table ul".split()
)
ROLES = set("navigation banner contentinfo complementary search dialog alert menu menubar toolbar".split())
NAMES = re.compile(
    r"(?:^|[-_\s])(?:ads?|adverts?|advertisement|advertising|sponsor(?:ed)?|promo(?:tion)?s?|banner|menu|menubar|nav|navbar|navigation|"
    r"breadcrumbs?|sidebar|side|footer|masthead|site-header|page-header|topbar|cookies?|consent|gdpr|notice|popup|modal|"
    r"overlay|newsletter|subscribe|subscription|signup|login|share|sharing|social|related|recommended|comments?|"
    r"commentlist|disqus|replies|reply|respond|pagination|pager|toolbar|widget|skip-link)(?:$|[-_\s\d])",
    re.IGNORECASE,
)

#: Names of a wrapper that say what it has or how it stands, not what it is.
STATES = re.compile(
    r"^(?:has|have|no|not|non|with|without)[-_]|[-_](?:open|opened|closed|layout|enabled|disabled|on|off)$", re.IGNORECASE
)

_TOKEN = re.compile(r"<!--.*?(?:-->|$)|<[!?][^>]*(?:>|$)|</?[a-zA-Z](?:[^>\"']|\"[^\"]*(?:\"|$)|'[^']*(?:'|$))*(?:>|$)|[^<]+|<", re.DOTALL)
_NAME = re.compile(r"</?([a-zA-Z][^\s/>]*)")
_ATTRIBUTE = re.compile(r"\b(class|id|role|hidden|aria-hidden)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+)))?", re.IGNORECASE)


@dataclass
class Node:
    """An element: its place among the host's pages, what it holds in page order (texts and elements), and whether its
    tag or name says that it is no content; ``unsure`` if that is no proof where it holds what the page is about."""

    tag: str
    path: int
    dropped: bool = False
    unsure: bool = False
    held: list = field(default_factory=list)

    def children(self) -> list[Node]:
        return [x for x in self.held if isinstance(x, Node)]


def _attributes(tag: str) -> dict[str, str]:
    return {m[1].lower(): html.unescape(m[2] or m[3] or m[4] or "") for m in _ATTRIBUTE.finditer(tag, len(_NAME.match(tag)[0]))}


def parse(page: str) -> Node:
    """The block elements of a page. Inline elements are part of the text around them, unless they are no content."""
    root = Node("", xxhash.xxh3_64_intdigest(b""))
    stack, at, inside, unsure = [root], 0, 0, False
    while found := _TOKEN.match(page, at):
        token, at = found[0], found.end()
        if token[0] != "<" or len(token) == 1:
            stack[-1].held.append(token)
            continue
        if not (name := _NAME.match(token)):
            continue
        tag = name[1].lower()
        if token[1] == "/":
            if tag in INLINE and all(node.tag != tag for node in stack):
                continue
            depth = next((k for k in range(len(stack) - 1, 0, -1) if stack[k].tag == tag), 0)
            if depth:
                inside -= sum(node.tag in ("article", "main") for node in stack[depth:])
                del stack[depth:]
            elif tag == "p":
                stack[-1].held.append(_node(stack[-1], "p", {}, inside))
            continue
        attributes = _attributes(token) if len(token) > len(tag) + 2 else {}
        if tag in ENDS_P:
            while len(stack) > 1 and stack[-1].tag == "p":
                stack.pop()
        if tag in CLOSES:
            while len(stack) > 1 and stack[-1].tag in CLOSES[tag]:
                stack.pop()
        if tag == "br" or tag == "wbr":
            stack[-1].held.append(" " if tag == "br" else "")
            continue
        node = _node(stack[-1], tag, attributes, inside)
        unsure = unsure or node.unsure
        if tag in INLINE and not node.dropped:
            continue
        stack[-1].held.append(node)
        if tag in RAW:
            end = re.compile(rf"</{tag}\b[^>]*(?:>|$)", re.IGNORECASE).search(page, at)
            at = end.end() if end else len(page)
        elif tag not in VOID and not token.endswith("/>"):
            stack.append(node)
            inside += tag in ("article", "main")
    if unsure:
        _keep_bodies(root)
    return root


def _node(parent: Node, tag: str, attributes: dict[str, str], inside: int) -> Node:
    named = f"{tag}.{attributes.get('class', '')}#{attributes.get('id', '')}"
    path = xxhash.xxh3_64_intdigest(f"{parent.path} {re.sub('[0-9]+', '0', named)}")
    never = tag in HIDDEN and tag != "form" or tag == "header" and not inside
    dropped = (
        never or tag == "form" or "hidden" in attributes or attributes.get("aria-hidden") == "true"
        or attributes.get("role", "").lower() in ROLES
        or tag not in ("html", "body", "main", "article") and any(_named(attributes.get(name, "")) for name in ("class", "id"))
    )
    return Node(tag, path, dropped, dropped and not never)


def _named(value: str) -> bool:
    """Whether one of the names in a class or id is that of a menu, an advertisement and the like."""
    return bool(NAMES.search(value)) and any(NAMES.search(name) and not STATES.search(name) for name in value.split())


def _keep_bodies(root: Node) -> None:
    """Elements that are dropped by name, state or as a form stay if they hold ``main``, more than half of the text in
    articles, or more than half of the page's text. What is dropped for certain counts for nothing."""
    order, todo = [], [(root, False)]
    while todo:
        node, article = todo.pop()
        article = article or node.tag == "article"
        order.append((node, article))
        todo += [(c, article) for c in node.children() if c.unsure or not c.dropped]
    found: dict[int, tuple[int, int, bool]] = {}
    for node, article in reversed(order):
        size = sum(len(x) - x.count(" ") for x in node.held if isinstance(x, str) and not x.isspace())
        below = [found[id(c)] for c in node.children() if id(c) in found]
        sizes = size + sum(x[0] for x in below), size * article + sum(x[1] for x in below)
        found[id(node)] = *sizes, node.tag == "main" or any(x[2] for x in below)
    every, articles, _ = found[id(root)]
    for node, _ in order:
        own, own_articles, main = found[id(node)]
        if node.unsure and (main or 2 * own_articles > articles or 2 * own > every):
            node.dropped = False


def _own_text(node: Node) -> str:
    return " ".join(html.unescape("".join(x for x in node.held if isinstance(x, str))).split())


def _signed(value: int) -> int:
    return value - (1 << 63)


def tree_rows(root: Node) -> Iterator[tuple[int, int, int]]:
    """Path, kind and value of what a page adds to its host's tree: kind 0 the layout of a node's children (runs of equal
    ones as one), kind 1 a text that stands in it."""
    todo = [root]
    while todo:
        node = todo.pop()
        if node.dropped:
            continue
        children = node.children()
        todo += children
        layout = [c.path for k, c in enumerate(children) if not k or c.path != children[k - 1].path]
        yield _signed(node.path), 0, _signed(xxhash.xxh3_64_intdigest(repr(layout)))
        if text := _own_text(node):
            yield _signed(node.path), 1, _signed(xxhash.xxh3_64_intdigest(text))


def importance(node: Node, layouts: dict[int, float], contents: dict[int, float]) -> dict[int, float]:
    """Combined importance of every element below ``node``, by its identity: that of its texts, and its layout against
    the mean of its children. Nodes that the tables do not know are important."""
    found: dict[int, float] = {}
    todo = [(node, False)]
    while todo:
        at, ready = todo.pop()
        children = [c for c in at.children() if not c.dropped]
        if not ready:
            todo += [(at, True), *((c, False) for c in children)]
            continue
        parts = [found[id(c)] for c in children]
        if any(isinstance(x, str) and not x.isspace() for x in at.held):
            parts.append(contents.get(_signed(at.path), 1.0))
        held = sum(parts) / len(parts) if parts else 1.0
        found[id(at)] = (1 - FADE) * layouts.get(_signed(at.path), 1.0) + FADE * held if children else held
    return found


def greatest(node: Node, weight: dict[int, float]) -> dict[int, float]:
    """Greatest importance in the branch of every element below ``node``, by its identity. What holds no text has none."""
    order, todo = [], [node]
    while todo:
        order.append(at := todo.pop())
        todo += [c for c in at.children() if not c.dropped]
    found: dict[int, float] = {}
    for at in reversed(order):
        below = [found[id(c)] for c in at.children() if not c.dropped]
        texts = any(isinstance(x, str) and not x.isspace() for x in at.held)
        found[id(at)] = max([*below, weight[id(at)] if texts or any(below) else 0.0])
    return found


def main_text(root: Node, layouts: dict[int, float], contents: dict[int, float], least: float = LEAST) -> str:
    """Texts of the blocks that stay, in page order, one a line."""
    weight = importance(root, layouts, contents)
    branch = greatest(root, weight)
    lines, run = [], []

    def close() -> None:
        if text := " ".join(html.unescape("".join(run)).split()):
            lines.append(text)
        run.clear()

    todo: list = [root]
    while todo:
        at = todo.pop()
        if at is None:
            close()
        elif isinstance(at, str):
            run.append(at)
        elif at.tag in INLINE:
            if not at.dropped:
                todo += reversed(at.held)
        else:
            close()
            if not at.dropped and branch[id(at)] >= least:
                # Below a low element that holds something important, its own texts count by themselves.
                own = max(weight[id(at)], contents.get(_signed(at.path), 1.0)) >= least
                todo += [None, *(x for x in reversed(at.held) if own or isinstance(x, Node))]
    close()
    return "\n".join(lines)


def host_of(url: str = "url") -> Column:
    return F.lower(F.regexp_extract(F.coalesce(F.col(url), F.lit("")), "^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1))


def style_trees(pages: DataFrame, most: float = 0.9, copies: bool = True) -> DataFrame:
    """A row per host: its nodes that at least ``PAGES`` pages have and whose importance of a kind is under ``most``.
    Without ``copies``, pages of a host with the same html (by 128 bits) count once.

    Rows are counted before they meet, so a host with a third of all pages is no more work than its different texts.
    """

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            known: set[tuple[str, bytes]] = set()
            keys: tuple[list, list, list] = ([], [], [0])
            columns = array("q"), array("i"), array("q")
            for host, text in rows_of(batch, "host", "html"):
                page = (host, xxhash.xxh3_128_digest(text.encode()))
                if not copies and page in known:
                    continue
                known.add(page)
                for row in set(tree_rows(parse(text))):
                    for column, x in zip(columns, row, strict=True):
                        column.append(x)
                for column, x in zip(keys, (*page, len(columns[0])), strict=True):
                    column.append(x)
            flat = [pa.array(np.asarray(c)) for c in columns]
            rows = pa.ListArray.from_arrays(pa.array(keys[2], pa.int32()), pa.StructArray.from_arrays(flat, ["path", "kind", "value"]))
            yield pa.RecordBatch.from_arrays([pa.array(keys[0], pa.string()), pa.array(keys[1], pa.binary()), rows], ["host", "page", "rows"])

    trees = pages.select("host", "html").mapInArrow(add, "host string, page binary, rows array<struct<path long, kind int, value long>>")
    if not copies:
        trees = trees.dropDuplicates(["host", "page"])
    values = trees.select("host", F.inline("rows")).groupBy("host", "path", "kind", "value").agg(F.count("*").alias("n"))
    # Kind 0 has a row for every page and node, so its sum is the number of pages that have the node.
    nodes = values.groupBy("host", "path").agg(
        F.sum(F.when(F.col("kind") == 0, F.col("n"))).alias("pages"),
        F.sum(F.when(F.col("kind") == 0, F.col("n") * F.log("n"))).alias("layout"),
        F.sum(F.when(F.col("kind") == 1, F.log("n"))).alias("content"),
        F.sum(F.when(F.col("kind") == 1, 1)).alias("texts"),
    ).where(F.col("pages") >= PAGES)
    # Entropies to the base of the pages: a layout's share is n / pages; a text is spread evenly over its n pages.
    log_pages = F.log("pages")
    scored = nodes.select(
        "host", "path",
        F.least(F.lit(1.0), 1 - F.col("layout") / F.col("pages") / log_pages).alias("layout"),
        F.when(F.col("texts") > 0, F.greatest(F.lit(0.0), 1 - F.col("content") / F.col("texts") / log_pages)).alias("content"),
    ).where(F.least("layout", "content") < most)
    return scored.groupBy("host").agg(F.collect_list(F.struct("path", "layout", "content")).alias("nodes"))


def extract(pages: DataFrame, least: float = LEAST) -> DataFrame:
    """page_id, url, text and n_chars of every page (page_id, url, html).

    A null html is an empty page; a null or odd url belongs to the host "". Rows repeat as in ``pages``; what a host repeats
    is learned from its different pages, so copies change no text.
    """
    hosted = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"), host_of().alias("host"))
    trees = stage(style_trees(hosted, copies=False), "trees").withColumnRenamed("host", "own_host")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, tuple[dict, dict]] = {}
        for batch in batches:
            texts, nodes = [], batch.column("nodes")
            for k, (host, page) in enumerate(rows_of(batch, "host", "html")):
                if host not in known:
                    if len(known) > 500:
                        known.clear()
                    own = nodes[k].as_py() or []
                    known[host] = tuple({n["path"]: n[kind] for n in own if n[kind] is not None} for kind in ("layout", "content"))
                texts.append(main_text(parse(page), *known[host], least))
            columns = [*(batch.column(name) for name in ("page_id", "url")), pa.array(texts, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["page_id", "url", "text"])

    joined = hosted.join(trees, hosted.host == trees.own_host, "left").select("page_id", "url", "host", "html", "nodes")
    written = joined.mapInArrow(write, "page_id long, url string, text string")
    return written.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op8_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(read(spark, sf_dir, "pages", page_id="long", url="string", html="string"))
