"""Main text of web pages, with the templates of their sites taken out.

Pages are parsed twice. The first pass hashes the subtree of every element from its tag, its
text and its children, and its place from the tags above it; Spark counts, for each host, on how many
different pages a subtree stands. Pages whose whole trees are equal count once, so that a page with
many copies is no template. In the second pass two kinds of templates are deleted, next to
elements that their own tag, class or id marks as something other than the article:

* a subtree that stands at one place outside the articles of MIN_PAGES pages of the host, wherever
  else it stands: a notice of the site that was put into an article too;
* a subtree that stands at one place inside the articles of MIN_PAGES pages and has none of
  the blocks that articles are made of (paragraphs, headings, list items, quotes, cells). A sentence
  that many articles have stays, as it is text of each; so does all that holds such a block or stands in one. In
  pages without an article or a main element, where the body is read, subtrees of several blocks go too.

What is left of the article (or of the main element, or of the body, if there is none) is cut
into blocks at block-level tags. Templates are rows of host and subtree, which meet the subtrees of
each page's own article; only pages that have one get a list, of their own templates.

Null HTML is empty and gives an empty text; a null URL has the empty host. Repeated rows give the
same text. Columns named like the added ones are replaced.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakepnl.llm.text import saved, small_batches
from lakepnl.llm.url_filter import host_path

MIN_PAGES, WRAPPER = 8, 0.8

#: Kinds of elements of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp "
    "small span strike strong sub sup time tt u var wbr".split()
)
CLOSES_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section summary table ul".split()
)
#: A start tag ends an open element of its group, up to the element that holds the group.
SIBLINGS = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"table", "tr"}),
    "th": ({"td", "th"}, {"table", "tr"}),
    "option": ({"option"}, {"select"}),
}
#: The blocks of an article's own text.
TEXT_BLOCKS = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd blockquote q pre td th figcaption".split())
#: Elements and names that are not the article.
NOT_TEXT = frozenset(
    "aside audio button canvas dialog embed fieldset footer form frameset head iframe input map menu nav noframes "
    "noscript object script select style svg template textarea title video".split()
)
MARKS = frozenset(
    "ad ads adv advert advertisement advertising adsense adslot banner breadcrumb breadcrumbs byline comment comments "
    "consent cookie cookies disqus footer gdpr masthead menu modal nav navbar navigation newsletter notice notices "
    "notification pager pagination popup promo promoted promotion related reply respond share sharing sidebar "
    "signup skip social sponsor sponsored subscribe subscription toolbar topbar widget widgets".split()
)
ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search".split())

_TAG = re.compile(
    r"<!--(?:>|->|.*?(?:--!?>|\Z))|<(/?)([a-zA-Z][^\s/>]*)((?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')?+)*+)(?:>|\Z)|<[!?/][^>]*(?:>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(r"\b(class|id|role|hidden)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
_NAME = re.compile(r"[^a-z0-9]+")


@dataclass(slots=True)
class Node:
    tag: str
    marked: bool = False
    items: list = field(default_factory=list)
    key: int = 0
    size: int = 0
    blocks: int = 0
    place: int = 0
    in_block: bool = False
    holds_article: bool = False


def _marked(tag: str, attributes: str) -> bool:
    """A class, an id or a role names something other than the article."""
    if not attributes or "=" not in attributes:
        return False
    for name, *values in _ATTRIBUTE.findall(attributes):
        value = "".join(values).lower()
        if name.lower() == "role":
            if value in ROLES:
                return True
        elif not MARKS.isdisjoint(_NAME.split(value)):
            return True
    return False


def parse(page: str) -> Node:
    """The tree of a page: items of a node are texts (characters decoded) and nodes."""
    root = Node("html")
    stack = [root]
    at = 0
    while True:
        found = _TAG.search(page, at)
        text = page[at : found.start() if found else len(page)]
        if text:
            stack[-1].items.append(entities.unescape(text) if "&" in text else text)
        if not found:
            return root
        at = found.end()
        closing, tag, attributes = found.groups()
        if not tag:
            continue
        tag = tag.lower()
        if closing:
            _close(stack, tag)
            continue
        if tag in ("html", "body"):
            continue
        if tag in CLOSES_P:
            _end(stack, {"p"}, {"article", "section", "div", "td", "th", "li", "blockquote", "table", "button"})
        if tag in SIBLINGS:
            _end(stack, *SIBLINGS[tag])
        node = Node(tag, _marked(tag, attributes))
        stack[-1].items.append(node)
        if tag in ("article", "main"):
            for above in stack:
                above.holds_article = True
        if tag in VOID:
            continue
        if tag in RAW:
            end = re.compile(rf"</{tag}(?=[\s/>])[^>]*(?:>|\Z)", re.I).search(page, at)
            at = end.end() if end else len(page)
            continue
        stack.append(node)


def _end(stack: list[Node], tags: set[str], until: set[str]) -> None:
    for k in range(len(stack) - 1, 0, -1):
        if stack[k].tag in tags:
            del stack[k:]
            return
        if stack[k].tag in until:
            return


def _close(stack: list[Node], tag: str) -> None:
    for k in range(len(stack) - 1, 0, -1):
        if stack[k].tag == tag:
            del stack[k:]
            return
        if tag in INLINE and stack[k].tag not in INLINE and stack[k].tag != "p":
            return


def _signed(text: str) -> int:
    return xxhash.xxh64_intdigest(text) - (1 << 63) or 1


def hash_subtrees(root: Node) -> None:
    """Gives every node a key of its tag, its text and its children's keys, 0 if it has no text; the
    text blocks in it; and a key of the tags above it and its own key."""
    waiting = [(root, False)]
    while waiting:
        node, ready = waiting.pop()
        if not ready:
            waiting.append((node, True))
            waiting += [(x, False) for x in node.items if not isinstance(x, str)]
            continue
        parts = [" ".join(x.split()) if isinstance(x, str) else str(x.key) for x in node.items]
        parts = [x for x in parts if x and x != "0"]
        node.size = sum(len(x) if isinstance(x, str) else x.size for x in node.items)
        node.key = _signed("\x1f".join([node.tag, *parts])) if parts else 0
        within = sum(x.blocks for x in node.items if not isinstance(x, str))
        node.blocks = within + (bool(parts) and node.tag in TEXT_BLOCKS)
    below = [(root, 0)]
    while below:
        node, above = below.pop()
        for x in node.items:
            if not isinstance(x, str):
                x.in_block = node.in_block or node.tag in TEXT_BLOCKS
        path = _signed(f"{above}/{node.tag}")
        node.place = _signed(f"{path}\x1f{node.key}") if node.key else 0
        below += [(x, path) for x in node.items if not isinstance(x, str)]


def nodes(root: Node) -> Iterator[Node]:
    waiting = [root]
    while waiting:
        node = waiting.pop()
        yield node
        waiting += [x for x in reversed(node.items) if not isinstance(x, str)]


def _dropped(node: Node, templates: frozenset, inside: bool, whole: int = 0) -> bool:
    """Whether an element is not part of the main text.

    A name on an element that holds nearly all of the text (`whole` characters) describes the
    page rather than the element. Outside the article, what holds one is looked into.
    """
    if not inside and (node.tag in ("article", "main") or node.holds_article):
        return False
    if node.tag in NOT_TEXT or (node.tag == "header" and not inside):
        return True
    if templates and not node.in_block and (node.key in templates or (_own_place(node, inside) and node.place in templates)):
        return True
    return node.marked and not node.size > WRAPPER * whole > 0


def _own_place(node: Node, inside: bool) -> bool:
    """Whether a subtree may go for its place alone: it has no block of an article, or, in a body, several."""
    return node.blocks == 0 or (not inside and node.blocks > 1)


def _articles(root: Node, tag: str) -> list[Node]:
    """The outermost elements of a kind; those within a marked element only if there are no others."""
    found: list[Node] = []
    marked: list[Node] = []
    waiting = [(root, False)]
    while waiting:
        node, below = waiting.pop()
        if node.tag == tag and not node.marked:
            (marked if below else found).append(node)
        elif not _dropped(node, frozenset(), False):
            below = below or node.marked or node.tag in NOT_TEXT
            waiting += [(x, below) for x in reversed(node.items) if not isinstance(x, str)]
    return found or marked


def _starts(root: Node) -> list[Node]:
    return _articles(root, "article") or _articles(root, "main") or [root]


def main_text(root: Node, templates: frozenset = frozenset()) -> str:
    """Blocks of the article, joined by line ends."""
    starts = _starts(root)
    whole = sum(start.size for start in starts)
    blocks: list[str] = []
    own: list[str] = []

    def flush() -> None:
        line = " ".join("".join(own).split())
        own.clear()
        if line:
            blocks.append(line)

    waiting: list = []
    for start in reversed(starts):
        waiting += [flush, start]
    inside = starts[0] is not root
    while waiting:
        item = waiting.pop()
        if item is flush:
            flush()
        elif isinstance(item, str):
            own.append(item)
        elif any(item is x for x in starts) or not _dropped(item, templates, inside, whole):
            if item.tag in ("br", "wbr"):
                own.append(" " if item.tag == "br" else "")
                continue
            edge = [] if item.tag in INLINE else [flush]
            for do in edge:
                do()
            waiting += edge + item.items[::-1]
    flush()
    return "\n".join(blocks)


def page_keys(root: Node) -> tuple[set[tuple[int, int]], set[int], set[int]]:
    """Keys of a hashed page: places and subtrees outside its article, places inside, all subtrees inside.

    Inside are the elements below the starts of the main text that nothing else drops.
    """
    starts = _starts(root)
    inside = starts[0] is not root
    places, subtrees = set(), set()
    waiting = [x for node in starts for x in node.items if not isinstance(x, str)]
    while waiting:
        node = waiting.pop()
        if not node.key or _dropped(node, frozenset(), inside):
            continue
        if node.in_block:
            continue
        subtrees.add(node.key)
        if _own_place(node, inside) and not node.holds_article:
            places.add(node.place)
        waiting += [x for x in node.items if not isinstance(x, str)]
    outside = set()
    waiting = [root] if inside else []
    while waiting:
        node = waiting.pop()
        if any(node is start for start in starts):
            continue
        if node.key and not node.holds_article and node is not root:
            outside.add((node.place, node.key))
        waiting += [x for x in node.items if not isinstance(x, str)]
    return outside, places, subtrees


_KEYS = "host string, page long, content long, out_places array<long>, out_keys array<long>, places array<long>, subtrees array<long>"


def subtrees(pages: DataFrame) -> DataFrame:
    """host, page (hash of its HTML), content (hash of its tree) and the keys of its elements with text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for page in batch.column(2).to_pylist():
                root = parse(page)
                hash_subtrees(root)
                outside, places, own = page_keys(root)
                rows.append((root.key, [p for p, _ in outside], [k for _, k in outside], list(places), list(own)))
            types = [pa.int64()] + [pa.list_(pa.int64())] * 4
            columns = zip(*rows, strict=True) if rows else [[]] * 5
            made = [pa.array(list(c), t) for c, t in zip(columns, types, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *made], [f.split()[0] for f in _KEYS.split(", ")])

    return pages.select("_host", "_page", "_html").mapInArrow(run, _KEYS)


def page_templates(found: DataFrame, min_pages: int = MIN_PAGES) -> DataFrame:
    """_host, _page and _templates: the templates of the host that stand in the page's own article."""
    found = saved(found, "subtrees")
    # One page for each content: the keys follow it, wherever the tree is the same.
    first = found.dropDuplicates(["host", "content"])
    enough = F.col("n") >= min_pages
    placed = first.select("host", F.explode(F.arrays_zip("out_places", "out_keys")).alias("o"))
    outside = placed.groupBy("host", "o").agg(F.count("*").alias("n")).where(enough).select("host", F.col("o.out_keys").alias("key")).distinct()
    inside = first.select("host", F.explode("places").alias("key")).groupBy("host", "key").agg(F.count("*").alias("n")).where(enough).drop("n")
    often = saved(outside.unionByName(inside), "templates")
    own = found.dropDuplicates(["host", "page"]).select("host", "page", F.explode(F.concat("places", "subtrees")).alias("key"))
    own = own.join(often, ["host", "key"]).groupBy(F.col("host").alias("_host"), F.col("page").alias("_page"))
    return saved(own.agg(F.collect_set("key").alias("_templates")), "page-templates")


def extract(pages: DataFrame, min_pages: int = MIN_PAGES, url: str = "url", html: str = "html") -> DataFrame:
    """Adds text (the main text) and n_chars (its code points); the HTML goes."""
    small_batches(pages.sparkSession)
    whole = F.coalesce(F.col(html).cast("string"), F.lit(""))
    pages = pages.drop("text", "n_chars").withColumns({"_host": host_path(url)[0], "_html": whole, "_page": F.xxhash64(whole)})
    templates = page_templates(subtrees(pages), min_pages)

    @F.pandas_udf(T.StringType())
    def text(page: pd.Series, own: pd.Series) -> pd.Series:
        made = []
        for whole, keys in zip(page, own, strict=True):
            root = parse(whole)
            hash_subtrees(root)
            made.append(main_text(root, frozenset(keys) if keys is not None else frozenset()))
        return pd.Series(made, dtype=object)

    joined = pages.join(templates, ["_host", "_page"], "left")
    own = [c for c in pages.columns if c not in ("_host", "_html", "_page", html)]
    made = joined.select(*own, text("_html", "_templates").alias("text"))
    return made.withColumn("n_chars", F.char_length("text").cast("long"))
