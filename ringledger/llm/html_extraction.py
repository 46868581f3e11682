"""Main text of web pages by boosted trees over DOM nodes and hierarchical decoding.

Every block element is a node with features of its subtree (text, link and tag density), its
name and hashed attribute tokens, its depth and its siblings; loose text between blocks is a node
too. Boosted trees give each node the chance that it holds main text if the part around it does.
Decoding multiplies the chances down the tree and keeps what is over one half, so nothing below a
dropped node is kept. Text of kept nodes is joined block by block.

The trees are trained here, on at most ``TRAIN_PAGES`` pages of at most ``TRAIN_CHARS``
characters (the ones whose ids hash lowest). What is main text on them follows from their element
names and from tokens that say what a part is for. Each page is also used in variants: parts get
other names or names that tell nothing, wrappers and paragraphs get tokens that mislead, paragraphs
go, parts are added. Labels go along with the text, whatever it is renamed to, so on variants
neither names nor tokens settle them and densities, depth and siblings have to. Without pages to
learn from, the rule on names and tokens decides.

Defined results: null and empty pages, and pages without a main part, have an empty text; an empty
table gives none; cut-off pages are read as far as they go; unclosed elements are closed as browsers
do. Rows are taken one by one, so repeated rows give repeated results. A node at a chance of exactly
one half is dropped. Very long pages are read whole. Other columns are ignored, whatever their names.
"""

import html
import random
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ringledger.llm.boosting import Boosted

TRAIN_PAGES = 300
TRAIN_CHARS = 50_000
VARIANTS = 5
# Columns that attribute tokens are hashed to.
TOKEN_BUCKETS = 128
# Pages are judged together up to about this many nodes.
NODES_AT_ONCE = 8192

# Elements of HTML by what they do.
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav "
    "ol p pre section summary table tbody tfoot thead tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea title iframe svg math object select option "
                "button canvas audio video head".split())
RAW_TEXT = frozenset("script style textarea title noscript iframe".split())
# A start tag of the key closes open elements of these names, up to the nearest container.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"}, "option": {"option"}}
SCOPES = {"ul", "ol", "dl", "table", "select", "body", "html", "article", "div", "section", "td"}
# Elements that hold text; loose text in any other is a node of its own.
LEAVES = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd tr pre blockquote figcaption caption".split())
MAIN_NAMES = frozenset(["article", "main"])
# Elements around the whole page: they are no part of it and not judged.
WHOLE = frozenset(["html", "body"])
SIDE_NAMES = frozenset("nav header footer aside form dialog menu fieldset details".split())
MAIN_TOKENS = frozenset("article body content entry main post story text".split())
SIDE_TOKENS = frozenset(
    "ad ads advert advertisement advertising alert author banner bar breadcrumb breadcrumbs comment "
    "comments consent cookie cookies copyright discussion disqus feedback footer form gdpr header "
    "login masthead menu modal nav navbar navigation newsletter notice pager pagination popup promo "
    "promoted promotion recommended related reply replies respond search share sharing side sidebar "
    "signup skip social sponsor sponsored subscribe subscription tags toolbar topbar widget".split()
)
# Names that parts of training pages are given: element and tokens.
SIDE_VARIANTS = tuple(tuple(x.split()) for x in (
    "div sidebar", "div comments", "section related posts", "div cookie notice", "aside", "form search",
    "div share links", "div ad banner", "ul menu", "div footer", "div page header", "section newsletter",
    "div comment list", "div navigation", "form", "nav", "footer", "header", "div ad", "div"))
MAIN_VARIANTS = tuple(tuple(x.split()) for x in (
    "article", "main", "div post content", "div content", "div entry", "section article body", "div"))

TOKEN = re.compile(
    r"<!--(?:.*?-->|.*\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<[!?][^>]*+>|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)(?:>|\Z)", re.S)
ATTRIBUTE = re.compile(r"([^\s=\"'/>]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")
BLANK = re.compile(r"\s+")
WORD_PARTS = re.compile(r"[a-z]+")


@dataclass(slots=True)
class Node:
    name: str
    tokens: tuple[str, ...]
    parent: int
    depth: int


@dataclass
class Page:
    """Block elements in page order, and text blocks as (node, text, linked characters)."""

    nodes: list[Node] = field(default_factory=list)
    blocks: list[tuple[int, str, int]] = field(default_factory=list)


def _tokens(name: str, attributes: str) -> tuple[str, ...]:
    found = []
    for key, *values in ATTRIBUTE.findall(attributes):
        if key.lower() in ("class", "id", "role", "itemprop", "aria-label"):
            spaced = re.sub(r"([a-z])([A-Z])", r"\1 \2", "".join(values)).lower()
            found += WORD_PARTS.findall(spaced)
    return tuple(found)


def parsed(source: str | None) -> Page:
    page = Page()
    page.nodes.append(Node("html", (), -1, 0))
    # Open elements: name, and the node they belong to.
    stack: list[tuple[str, int]] = [("html", 0)]
    parts: list[str] = []
    state = {"links": 0, "linked": 0, "hidden": 0}
    source = source or ""

    def flush() -> None:
        text = BLANK.sub(" ", "".join(parts)).strip()
        if text:
            node = stack[-1][1]
            if page.nodes[node].name not in LEAVES:
                page.nodes.append(Node("#text", (), node, page.nodes[node].depth + 1))
                node = len(page.nodes) - 1
            page.blocks.append((node, text, state["linked"]))
        parts.clear()
        state["linked"] = 0

    def pop() -> None:
        name, _ = stack[-1]
        if name in BLOCKS:
            flush()
        stack.pop()
        state["links"] -= name == "a"
        state["hidden"] -= name in RAW

    def close_within(names: set[str], scopes: set[str]) -> None:
        for at in range(len(stack) - 1, 0, -1):
            if stack[at][0] in names:
                while len(stack) > at:
                    pop()
                return
            if stack[at][0] in scopes:
                return

    def text(raw: str) -> None:
        if raw and not state["hidden"]:
            plain = html.unescape(raw)
            parts.append(plain)
            if state["links"]:
                state["linked"] += len(plain.strip())

    done, position = 0, 0
    while found := TOKEN.search(source, position):
        text(source[done : found.start()])
        done = position = found.end()
        name = (found[2] or found[5] or "").lower()
        if not name:
            continue
        if found[1] or found[4]:
            if any(open_name == name for open_name, _ in stack[1:]):
                while stack[-1][0] != name:
                    pop()
                pop()
            elif name == "p":
                flush()
            continue
        attributes = found[3] or found[6] or ""
        if name == "br":
            parts.append(" ")
        if name in VOID:
            if name == "hr":
                flush()
            continue
        if name in RAW_TEXT:
            end = re.compile(rf"</{name}\b[^>]*>?", re.I).search(source, done)
            done = position = end.end() if end else len(source)
            continue
        if name == "body" and any(open_name == "head" for open_name, _ in stack):
            close_within({"head"}, set())
        if name in BLOCKS:
            if name not in ("html", "body"):
                close_within({"p"}, SCOPES)
            if name in CLOSES:
                close_within(CLOSES[name], SCOPES - {"div", "section", "article"} | {"div"})
            flush()
            # An inline element left open does not go on into the next block.
            while len(stack) > 1 and stack[-1][0] not in BLOCKS and stack[-1][0] not in RAW and (
                stack[-1][0] not in ("td", "th")
            ):
                pop()
            parent = stack[-1][1]
            page.nodes.append(Node(name, _tokens(name, attributes), parent,
                                   page.nodes[parent].depth + 1))
            stack.append((name, len(page.nodes) - 1))
        else:
            if name in ("td", "th"):
                close_within({"td", "th"}, {"tr", "table"})
                parts.append(" ")
            stack.append((name, stack[-1][1]))
            state["links"] += name == "a"
            state["hidden"] += name in RAW
    text(source[done:])
    while len(stack) > 1:
        pop()
    flush()
    return page


def _kind(node: Node) -> int:
    """1 if name or tokens say main text, -1 if they say something else, 0 if neither."""
    if node.name in WHOLE:
        return 0
    if node.name in SIDE_NAMES or any(token in SIDE_TOKENS for token in node.tokens):
        return -1
    if node.name in MAIN_NAMES or any(token in MAIN_TOKENS for token in node.tokens):
        return 1
    return 0


def ruled(page: Page) -> np.ndarray:
    """Nodes that hold main text, by names and tokens alone: the nearest part that says what it
    is decides, and nothing inside a side part is main text, but for an article or main element
    below wrappers whose tokens alone say side. Pages that mark no main part: all else."""
    kinds = [_kind(node) for node in page.nodes]
    marked = 1 in kinds
    state = np.zeros(len(page.nodes), dtype=np.int64)
    # Whether only tokens, and no part within a main one, made it a side part.
    wrapped = np.zeros(len(page.nodes), dtype=bool)
    for k, node in enumerate(page.nodes):
        up = node.parent
        above = state[up] if up >= 0 else 0
        if above == -1:
            freed = wrapped[up] and kinds[k] == 1 and node.name in MAIN_NAMES
            state[k] = 1 if freed else -1
            wrapped[k] = wrapped[up] and not freed and node.name not in SIDE_NAMES
        else:
            state[k] = kinds[k] or above
            wrapped[k] = state[k] == -1 and above == 0 and node.name not in SIDE_NAMES
    kept = (state == 1) if marked else (state == 0)
    held = np.zeros(len(page.nodes), dtype=bool)
    for node, _, _ in page.blocks:
        held[node] = kept[node]
    for k in range(len(page.nodes) - 1, 0, -1):
        held[page.nodes[k].parent] |= held[k]
    return held


NAMES = ("#text", "p", "li", "ul", "div", "section", "table", "h1", "h2", "article", "main", "nav", "aside",
         "header", "footer", "form", "blockquote", "pre")
CODES = {name: code for code, name in enumerate(NAMES)}
MEASURES = ("text", "own text", "share of page", "link density", "text a node", "nodes", "blocks",
            "stop density", "paragraph share", "item share", "depth", "children", "order", "order from end",
            "share of parent", "share of largest sibling", "text before", "text after", "tokens")
N_FEATURES = len(MEASURES) + len(NAMES) + TOKEN_BUCKETS


@cache
def _bucket(token: str) -> int:
    return zlib.crc32(token.encode()) % TOKEN_BUCKETS


def features(pages: list[Page]) -> np.ndarray:
    """A row per node of the pages, one page after the other: ``MEASURES``, names, tokens."""
    nodes = [node for page in pages for node in page.nodes]
    n = len(nodes)
    sizes = np.array([len(page.nodes) for page in pages])
    tops = np.cumsum(sizes) - sizes
    top = np.repeat(tops, sizes)
    parent = np.array([node.parent for node in nodes]) + top
    parent[tops] = tops
    depth = np.array([node.depth for node in nodes])
    name = np.array([CODES.get(node.name, -1) for node in nodes])

    # Text, links, blocks, stops, nodes, paragraphs, items: own ones, then added up the tree.
    told = [(base + node, len(text), linked, 1, text.count(".") + text.count(","))
            for page, base in zip(pages, tops.tolist()) for node, text, linked in page.blocks]
    tree = np.zeros((n, 7))
    if told:
        told = np.array(told)
        np.add.at(tree[:, :4], told[:, 0], told[:, 1:])
    own = tree[:, 0].copy()
    tree[:, 4], tree[:, 5], tree[:, 6] = 1, name == CODES["p"], name == CODES["li"]
    by_depth = np.argsort(depth, kind="stable")
    edges = np.searchsorted(depth[by_depth], np.arange(depth.max() + 2))
    for level in range(int(depth.max()), 0, -1):
        at = by_depth[edges[level] : edges[level + 1]]
        np.add.at(tree, parent[at], tree[at])
    text, linked, blocks, stops, size, paragraphs, items = tree.T

    # Children of one parent lie side by side, in page order.
    inner = np.delete(np.arange(n), tops)
    inner = inner[np.argsort(parent[inner], kind="stable")]
    over = parent[inner]
    children = np.bincount(over, minlength=n)
    order, before, after, largest = np.zeros(n), np.zeros(n), np.zeros(n), np.zeros(n)
    starts = np.searchsorted(over, over)
    order[inner] = np.arange(len(inner)) - starts
    same = np.flatnonzero(over[1:] == over[:-1])
    before[inner[same + 1]] = text[inner[same]]
    after[inner[same]] = text[inner[same + 1]]
    np.maximum.at(largest, over, text[inner])

    chars = np.maximum(text, 1)
    x = np.zeros((n, N_FEATURES), dtype=np.float32)
    for k, column in enumerate((
        np.log1p(text), np.log1p(own), text / chars[top], linked / chars, text / size, np.log1p(size),
        blocks, stops / chars, paragraphs / size, items / size, depth, children, order,
        children[parent] - order, text / chars[parent], text / np.maximum(largest[parent], 1),
        np.log1p(before), np.log1p(after), np.array([len(node.tokens) for node in nodes]),
    )):
        x[:, k] = column
    known = np.flatnonzero(name >= 0)
    x[known, len(MEASURES) + name[known]] = 1
    first = len(MEASURES) + len(NAMES)
    for k, node in enumerate(nodes):
        for token in node.tokens:
            x[k, first + _bucket(token)] = 1
    return x


def decoded(page: Page, margin: np.ndarray) -> np.ndarray:
    """The labels that are right for most characters, of all in which nothing below a dropped node
    is kept.

    ``margin`` are the log odds of a node under a kept one. The chance of a node is thus the product
    along its path. Those over one half are kept; no chance is above its parent's, so no kept node
    lies below a dropped one.
    """
    chance = 1 / (1 + np.exp(-np.clip(margin, -50, 50)))
    for k, node in enumerate(page.nodes):
        if node.name in WHOLE:
            chance[k] = 1
        if node.parent >= 0:
            chance[k] *= chance[node.parent]
    return chance > 0.5


def joined(page: Page, kept: np.ndarray) -> str:
    return "\n".join(text for node, text, _ in page.blocks if kept[node])


def _judged(page: Page, held: np.ndarray) -> np.ndarray:
    """Nodes that decoding asks about: with text, and below a part that holds main text."""
    filled = np.zeros(len(page.nodes), dtype=bool)
    for node, _, _ in page.blocks:
        filled[node] = True
    for k in range(len(page.nodes) - 1, 0, -1):
        filled[page.nodes[k].parent] |= filled[k]
    asked = [node.name not in WHOLE and (held[node.parent] or page.nodes[node.parent].name in WHOLE)
             for node in page.nodes]
    return filled & np.array(asked)


def varied(page: Page, held: np.ndarray, chosen: random.Random) -> tuple[Page, np.ndarray]:
    """The page with parts renamed, moved in, misnamed or left out, and what still holds main text."""
    names = [node.name for node in page.nodes]
    tokens = [node.tokens for node in page.nodes]
    main = list(held)
    below: list[list[int]] = [[] for _ in names]
    texts: list[list[tuple[str, int]]] = [[] for _ in names]
    for k, node in enumerate(page.nodes[1:], 1):
        below[node.parent].append(k)
    for node, text, linked in page.blocks:
        texts[node].append((text, linked))
    words = [word for _, text, _ in page.blocks for word in text.split()]
    side_tokens = sorted(SIDE_TOKENS)

    def misled(at: int) -> None:
        tokens[at] = (*tokens[at], chosen.choice(words).lower(), chosen.choice(side_tokens))

    def added(name: str, marks: tuple[str, ...], holds: bool) -> int:
        for items, item in ((names, name), (tokens, marks), (main, holds), (below, []), (texts, [])):
            items.append(item)
        return len(names) - 1

    def filler(fewest: int, most: int) -> str:
        return " ".join(chosen.choices(words, k=chosen.randint(fewest, most))) + "."

    def aside() -> int:
        """A new part that is not main text."""
        side = chosen.choice(SIDE_VARIANTS[:-1])
        part = added(side[0], side[1:], False)
        inner = part if chosen.random() < 0.3 else added(chosen.choice(("p", "#text", "li")), (), False)
        text = filler(3, 40)
        texts[inner].append((text, len(text) * (chosen.random() < 0.3)))
        if inner != part:
            below[part].append(inner)
        return part

    dropped, fewest = chosen.choice([(0.0, 1), (0.5, 1), (0.9, 2), (1.0, 1), (1.0, 2)])
    renamed = chosen.choice(MAIN_VARIANTS)
    without = chosen.random() < 0.1
    plain = chosen.random() < 0.2  # side parts under names that tell nothing
    for k, node in enumerate(page.nodes):
        if node.name in WHOLE:
            if chosen.random() < 0.3:
                misled(k)
            if node.name == "body" and chosen.random() < 0.5:
                below[k].insert(chosen.randint(0, len(below[k])), aside())
            continue
        up = node.parent
        whole = page.nodes[up].name in WHOLE
        if not held[k]:
            if (held[up] or whole) and chosen.random() < 0.6 and node.name not in LEAVES and below[k]:
                side = ("div",) if plain else chosen.choice(SIDE_VARIANTS)
                names[k], tokens[k] = side[0], side[1:]
        elif node.name in MAIN_NAMES:
            names[k], tokens[k] = renamed[0], renamed[1:]
            if without and whole:
                below[up].remove(k)
                continue
            if chosen.random() < 0.7:
                below[k].insert(chosen.randint(0, len(below[k])), aside())
            if chosen.random() < 0.5:
                wrapper = added(chosen.choice(("div", "section")), (), True)
                below[up][below[up].index(k)] = wrapper
                below[wrapper].append(k)
                if chosen.random() < 0.6:
                    misled(wrapper)
                if chosen.random() < 0.5:
                    below[wrapper].append(aside())
        elif node.name in LEAVES:
            if len(below[up]) > fewest and chosen.random() < dropped:
                below[up].remove(k)
            elif chosen.random() < 0.1:
                misled(k)
        elif chosen.random() < 0.2:
            misled(k)

    new, labels = Page(), []
    stack = [(0, -1, 0)]
    while stack:
        k, up, depth = stack.pop()
        here = len(new.nodes)
        new.nodes.append(Node(names[k], tokens[k], up, depth))
        labels.append(bool(main[k]))
        new.blocks += [(here, text, linked) for text, linked in texts[k]]
        stack += [(child, here, depth + 1) for child in reversed(below[k])]
    return new, np.array(labels)


def trained(sources: list[str]) -> Boosted | None:
    """Trees fitted to the pages and their variants; None without a text to learn from."""
    chosen = random.Random(7)
    rows, labels = [np.zeros((0, N_FEATURES))], [np.zeros(0)]
    for source in sources:
        page = parsed(source)
        if not page.blocks:
            continue
        held = ruled(page)
        for variant, main in [(page, held), *(varied(page, held, chosen) for _ in range(VARIANTS))]:
            judged = _judged(variant, main)
            rows.append(features([variant])[judged])
            labels.append(main[judged].astype(float))
    y = np.concatenate(labels)
    if not len(y) or y.min() == y.max():
        return None
    return Boosted().fit(np.concatenate(rows), y, np.ones(len(y)))


def main_texts(sources: list[str | None], model: Boosted | None) -> list[str]:
    """The main texts of pages, judged together."""
    found: list[str] = []
    waiting: list[Page] = []

    def judge() -> None:
        margin = model.margin(features(waiting))
        at = 0
        for page in waiting:
            size = len(page.nodes)
            found.append(joined(page, decoded(page, margin[at : at + size])))
            at += size
        waiting.clear()

    nodes = 0
    for source in sources:
        page = parsed(source)
        if model is None:
            found.append(joined(page, ruled(page)))
            continue
        waiting.append(page)
        nodes += len(page.nodes)
        if nodes >= NODES_AT_ONCE:
            judge()
            nodes = 0
    if waiting:
        judge()
    return found


def main_text(source: str | None, model: Boosted | None) -> str:
    return main_texts([source], model)[0]


def training_pages(pages: DataFrame, html_column: str = "html") -> list[str]:
    """At most TRAIN_PAGES different pages of at most TRAIN_CHARS characters, chosen by hash.

    Hashes alone are ranked; page texts leave the tasks only for the ones picked.
    """
    source = F.col(f"`{html_column}`")
    usable = pages.where(source.isNotNull() & (F.char_length(source) <= TRAIN_CHARS)).select(
        source.alias("html"), F.xxhash64(source).alias("order")
    )
    lowest = [row[0] for row in
              usable.select("order").distinct().orderBy("order").limit(TRAIN_PAGES).collect()]
    if not lowest:
        return []
    picked = usable.where(F.col("order") <= lowest[-1]).groupBy("order").agg(
        F.min("html").alias("html")
    )
    return [row["html"] for row in sorted(picked.collect(), key=lambda row: row["order"])]


def extracted(pages: DataFrame, id_column: str = "page_id", url_column: str = "url",
              html_column: str = "html") -> DataFrame:
    """``id, url, text`` of every row."""
    model = trained(training_pages(pages, html_column))
    read = pages.select(*[
        F.col(f"`{name}`").alias(alias)
        for name, alias in ((id_column, "id"), (url_column, "url"), (html_column, "html"))
    ])

    def taken(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = main_texts(batch.column("html").to_pylist(), model)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("url"), pa.array(texts, pa.string())],
                names=["id", "url", "text"],
            )

    kind = read.schema["id"].dataType.simpleString()
    return read.mapInArrow(taken, f"id {kind}, url string, text string")
