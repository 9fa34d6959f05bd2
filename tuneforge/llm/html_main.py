"""Main text of web pages by site style trees.

All pages of a host are merged into one tree of element nodes, each named by its path of presentations
(tag, id and classes from the root). Over the pages that have a node:

* an inner node's own importance is the entropy of its presentation styles (the sequences of its
  children), scaled by the logarithm of the page count;
* a leaf's is its content importance: 1 minus the mean over its texts of log(pages with the text) /
  log(pages), so text repeated on every page counts nothing and text of one page counts fully;
* a branch's importance mixes both: (1 - GAMMA^styles) x own + GAMMA^styles x mean of its children.

The tree decides first which part of a page is its article: the branch whose presentation entropy, times its
share of the host's text, is largest. An article's sequence of headings and paragraphs differs from page to
page, while a menu, an advert or a foot keeps its form even where its words are drawn anew. Marks (an article
element, a main role) only break ties: they widen the branch to the marked article around it, narrow a branch
that mostly consists of marked articles, and decide where no branch reaches ``LEAST_SCORE`` or the branch
scores less than the marked article could.

Branches of low importance are removed from each page, as are branches whose presentation itself says that
they are no article text (navigation, adverts, forms, reader comments, ...). Nodes on fewer than
``LEAST_PAGES`` pages of a host tell nothing and count as important. Inside the article only container branches
can be of low importance, never running text: an article's repeated paragraph stays. Where an article or a page
would keep no running text at all (headings aside), its text is taken without importance, and through forms and
branches that only their name speaks against. A form that holds at least half of a page's text, a so named
branch that does where no article is marked, and either around a marked article wrap the page and count as plain
containers.

Blocks: character references are decoded, white space inside a block becomes one space, blocks are joined
by an empty line. Defined cases: null or empty html gives an empty text; a null or odd url belongs to the
host ""; pages of a host with the same branches and texts count once in its tree; an empty table gives an empty result; broken html is
read as far as its tags go, in one pass whatever its length (unclosed elements end with their parent, an unclosed comment or script runs to
the end)."""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written

GAMMA = 0.9
LEAST_PAGES = 8
LOW = 0.3  # a branch below this is removed where the page marks no article
LOW_INSIDE = 0.1  # a container branch inside the article
LEAST_SCORE = 0.2  # of the branch that the tree takes for the article

VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title noscript iframe template xmp noembed noframes svg math".split())
BLOCK = set("""address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer
form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre section summary table tbody tfoot thead tr ul caption
""".split())
SCOPE = set("article aside body button details dialog div fieldset figure footer form header html li main nav section table td th".split())
HEADINGS = set("h1 h2 h3 h4 h5 h6".split())
NOISE_TAGS = set("""nav footer aside form script style noscript iframe template button select option input textarea dialog menu
head title svg math object embed canvas audio video datalist label""".split())
NOISE_WORDS = set("""ad ads advert adverts advertisement advertising adsbygoogle adbox banner sponsor sponsored promo promotion nav
navbar navigation menu breadcrumb breadcrumbs sidebar footer header masthead topbar toolbar cookie cookies consent gdpr notice
notices alert popup modal overlay newsletter subscribe subscription signup login share sharing social related recommended
comment comments commentlist disqus reply replies respond discussion pagination pager copyright widget search skip hidden
""".split())
KEEP_WORDS = set("article content main post entry story body title text".split())
CONTAINERS = set("div section ul ol dl table aside figure details center".split())

_tag = re.compile(r"<!--|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>|<[!?][^>]*>")
_bare_tag = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)([^>]*)>")  # where a quote is never closed
_attr = re.compile(r"([^\s=\"'/>]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?")
_space = re.compile(r"\s+")
_word = re.compile(r"[a-z]+")
_camel = re.compile(r"(?<=[a-z])(?=[A-Z])")


class _Tags:
    """Tags of a source from left to right. No part is read again and again: past the last ``>`` there is no tag,
    and once a quote has no partner, tags end at the next ``>``."""

    def __init__(self, source: str):
        self.source, self.last, self.bare = source, source.rfind(">"), False

    def next(self, at: int):
        while True:
            at = self.source.find("<", at)
            if at < 0 or at > self.last:
                comment = self.source.find("<!--", at) if at >= 0 else -1
                return _tag.match(self.source, comment) if comment >= 0 else None
            m = (_bare_tag if self.bare and not self.source.startswith("<!", at) else _tag).match(self.source, at)
            if m is None and self.source[at + 1:at + 3].strip("/")[:1].isalpha():
                self.bare = True
                m = _bare_tag.match(self.source, at)
            if m is not None:
                return m
            at += 1


class Node:
    __slots__ = ("tag", "name", "kids", "noise", "named")

    def __init__(self, tag: str, name: str, noise: bool):
        self.tag, self.name, self.noise = tag, name, noise
        self.named = noise and tag not in NOISE_TAGS  # by its class, id or role alone
        self.kids: list = []  # nodes, and texts as str


def _says_noise(value: str) -> bool:
    """Whether a class or id names no article text. "has-sidebar" or "entry-header" do not."""
    tokens = [set(_word.findall(_camel.sub("-", t).lower())) for t in value.split()]
    if any(t <= KEEP_WORDS for t in tokens if t):
        return False
    return any(t & NOISE_WORDS and not t & {"has", "no", "with", "without"}
               and not ("header" in t and t & KEEP_WORDS) for t in tokens)


def _presentation(tag: str, raw: str) -> tuple[str, bool]:
    """(name in the style tree, whether it says that this is no article text)."""
    noise, name = tag in NOISE_TAGS, tag
    if raw.strip(" /"):
        for key, value in _attr.findall(raw):
            key, value = key.lower(), value.strip("\"'")
            if key in ("class", "id"):
                value = entities.unescape(value)
                if key == "class":
                    name += "." + ".".join(sorted(value.lower().split()))
                if tag not in ("html", "body"):
                    noise = noise or _says_noise(value)
            elif key == "role":
                noise = noise or value.lower() in ("navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "menu", "alert")
                name += f"[{value.lower()}]"
            elif key == "hidden" or key == "aria-hidden" and value.lower() == "true" \
                    or key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
                noise = True
            elif key == "itemprop" and value.lower() == "articlebody":
                name += "[articlebody]"
    return name, noise


def parse(source: str, known: dict | None = None) -> Node:
    """A tree of elements and texts. ``known`` caches presentations by their raw tags."""
    known = {} if known is None else known
    root = Node("html", "html", False)
    stack, at, n = [root], 0, len(source)
    wrapping: list[Node] = []
    tags, open_ = _Tags(source), Counter()

    def cut(k: int) -> None:
        open_.subtract(x.tag for x in stack[k:])
        del stack[k:]

    while at < n:
        m = tags.next(at)
        if m is None:
            stack[-1].kids.append(source[at:])
            break
        if m.start() > at:
            stack[-1].kids.append(source[at:m.start()])
        at = m.end()
        if m.group(0) == "<!--":
            if source.startswith(">", at):  # <!--> is a whole comment
                at += 1
                continue
            end = source.find("-->", at)
            at = n if end < 0 else end + 3
            continue
        tag = m.group(2)
        if tag is None:
            continue
        tag = tag.lower()
        if m.group(1):  # an end tag: up to its element, formatting only inside its block
            for k in range(len(stack) - 1 if open_[tag] > 0 else 0, 0, -1):
                if stack[k].tag == tag:
                    cut(k)
                    break
                if tag not in BLOCK and tag not in SCOPE and stack[k].tag in BLOCK:
                    break
            continue
        raw = m.group(3)
        key = (tag, raw)
        if key not in known:
            if len(known) > 20_000:
                known.clear()
            known[key] = _presentation(tag, raw)
        if tag in ("html", "body"):
            continue
        if tag in BLOCK:  # closes an open paragraph; li, dt, dd, tr close their like
            closes = {"p", tag} if tag in ("li", "tr") else {"p", "dt", "dd"} if tag in ("dt", "dd") else {"p"}
            for k in range(len(stack) - 1 if any(open_[x] > 0 for x in closes) else 0, 0, -1):
                own = stack[k].tag
                if own in closes:
                    cut(k)
                    break
                if own in SCOPE or own in ("ul", "ol", "dl", "tbody", "thead"):
                    break
        elif tag in ("td", "th"):
            for k in range(len(stack) - 1 if open_["td"] > 0 or open_["th"] > 0 else 0, 0, -1):
                if stack[k].tag in ("td", "th"):
                    cut(k)
                    break
                if stack[k].tag in ("tr", "table"):
                    break
        node = Node(tag, *known[key])
        stack[-1].kids.append(node)
        if tag in RAW:
            end = re.compile(f"</{tag}(?=[\\s/>])", re.I).search(source, at)
            close = source.find(">", end.start()) if end else -1
            at = close + 1 if close >= 0 else n
        elif tag not in VOID and (tag in BLOCK or not raw.endswith("/")):  # a slash on a block element means nothing in HTML
            stack.append(node)
            open_[tag] += 1
        if tag == "form" or node.named:
            wrapping.append(node)
    if wrapping:
        size, marked = _sizes(root)
        for node in wrapping:
            half = 2 * size.get(id(node), 0) >= size[id(root)] > 0 and (node.tag == "form" or not marked)
            if half or id(node) in marked:
                node.noise = node.named = False
    return root


def _sizes(root: Node) -> tuple[dict[int, int], set[int]]:
    """Characters below each branch that may hold article text, forms and branches that only a name speaks against
    included, and the branches with a marked article below them."""
    order, todo = [], [root]
    while todo:
        x = todo.pop()
        order.append(x)
        todo += [k for k in x.kids if isinstance(k, Node) and (not k.noise or k.named or k.tag == "form")]
    size: dict[int, int] = {}
    marked: set[int] = set()
    for x in reversed(order):
        size[id(x)] = sum(len(k.strip()) if isinstance(k, str) else size.get(id(k), 0) for k in x.kids)
        if x.tag == "article" or any(id(k) in marked for k in x.kids if isinstance(k, Node)):
            marked.add(id(x))
    return size, marked


def clean(text: str) -> str:
    return _space.sub(" ", entities.unescape(text)).strip()


def _hash(*parts) -> int:
    import xxhash

    return xxhash.xxh64_intdigest("\x00".join(map(str, parts))) - (1 << 63)


def style_nodes(root: Node) -> dict[int, tuple[bool, set[int], int]]:
    """path -> (is a leaf, hashes of its styles or of its texts, characters below it) of one page; no-article
    branches are skipped."""
    out: dict[int, tuple[bool, set[int], int]] = {}
    order, todo = [], [(root, _hash("html"))]
    while todo:
        node, path = todo.pop()
        kids = [k for k in node.kids if isinstance(k, Node) and not k.noise]
        text = clean("".join(k for k in node.kids if isinstance(k, str)))
        if text or not kids:
            leaf = _hash(path, "#text")
            out.setdefault(leaf, (True, set(), 0))[1].add(_hash(text))
        if kids:
            out.setdefault(path, (False, set(), 0))[1].add(_hash(*(k.name for k in kids)))
            todo += [(k, _hash(path, k.name)) for k in kids]
        order.append((node, path, kids, len(text)))
    size: dict[int, int] = {}
    for node, path, kids, n in reversed(order):
        size[id(node)] = n + sum(size[id(k)] for k in kids)
        if kids:
            leaf, values, chars = out[path]
            out[path] = (leaf, values, chars + size[id(node)])
    return out


def main_blocks(root: Node, importance: dict[int, tuple[float, int, int]]) -> list[str]:
    """The text blocks that stay. importance: path -> (own importance, number of styles, characters)."""
    memo: dict[int, float] = {}

    def branch(node: Node, path: int) -> float:
        """Composite importance of a branch, from its leaves up."""
        order, todo = [], [(node, path)]
        while todo:
            x, p = todo.pop()
            kids = [(k, _hash(p, k.name)) for k in x.kids if isinstance(k, Node) and not k.noise]
            order.append((x, p, kids))
            todo += kids
        for x, p, kids in reversed(order):
            below = [memo[id(k)] for k, _ in kids]
            if any(isinstance(k, str) and not k.isspace() for k in x.kids) or not kids:
                below.append(importance.get(_hash(p, "#text"), (1.0, 1, 0))[0])
            own, styles, _ = importance.get(p, (1.0, 1, 0))
            mean = sum(below) / len(below)
            memo[id(x)] = (1 - GAMMA ** styles) * own + GAMMA ** styles * mean if kids else mean
        return memo[id(node)]

    def roots(node: Node, path: int) -> list[tuple[Node, int]]:
        """The outermost elements marked as the article, or as the page's main part."""
        for test in (lambda x: x.tag == "article" or "[articlebody]" in x.name, lambda x: x.tag == "main" or "[main]" in x.name):
            found, todo = [], [(node, path)]
            while todo:
                x, p = todo.pop()
                if test(x):
                    found.append((x, p))
                else:
                    todo += [(k, _hash(p, k.name)) for k in reversed(x.kids)
                             if isinstance(k, Node) and (not k.noise or k.tag == "form")]  # a form may wrap the page
            if found:
                return found
        return []

    def article(marked: list[tuple[Node, int]]) -> list[tuple[Node, int]]:
        """The branches that the tree takes for the article, or the marked ones where it cannot tell."""
        total = importance.get(top, (0.0, 1, 0))[2]
        if not total:
            return marked
        score, found, at, up, todo = LEAST_SCORE, [], None, {}, [(root, top)]
        while todo:
            x, p = todo.pop()
            if p != top and p in importance:
                own, _, chars = importance[p]
                if p == at:
                    found.append((x, p))
                elif own * chars / total > score:
                    score, found, at = own * chars / total, [(x, p)], p
            kids = [(k, _hash(p, k.name)) for k in reversed(x.kids) if isinstance(k, Node) and not k.noise]
            up.update((id(k), (x, p)) for k, _ in kids)
            todo += kids
        if not found:
            return marked

        def around(x: Node) -> Iterator[int]:
            while x is not root:
                yield id(x)
                x = up[id(x)][0]

        if marked:
            ids, chosen = {id(x) for x, _ in marked}, {id(x) for x, _ in found}
            if any(i in ids for x, _ in found for i in around(x)):
                return marked
            # Characters that the marked branches hold; a path that the tree does not know may hold all.
            held = sum(importance[p][2] if p in importance else total for p in {p for _, p in marked})
            if all(id(x) in up and any(i in chosen for i in around(x)) for x, _ in marked):
                return marked if 2 * held >= importance[at][2] else found
            return found if score > held / total else marked
        out = {}
        for x, p in found:  # a heading beside the branch belongs to it
            while x is not root and up[id(x)][0] is not root and any(
                    isinstance(k, Node) and k.tag in HEADINGS for k in up[id(x)][0].kids):
                x, p = up[id(x)]
            out[id(x)] = (x, p)
        return list(out.values())

    blocks: list[str] = []
    parts: list[str] = []
    heading = running = False  # the open block is a heading; a block of running text was taken

    def flush():
        nonlocal heading, running
        text = _space.sub(" ", "".join(parts)).strip()
        parts.clear()
        if text:
            blocks.append(text)
            running = running or not heading
        heading = False

    def take(node: Node, path: int, inside: bool, by_importance: bool):
        """Whether running text was taken. Without importance, forms and branches with an odd name are taken too."""
        nonlocal heading, running
        running = False
        todo: list = [(node, path)]
        while todo:
            x = todo.pop()
            if x is None:
                flush()
                continue
            if isinstance(x, str):
                parts.append(entities.unescape(x))
                continue
            x, p = x
            if x is not node:
                if x.noise and (by_importance or x.tag != "form" and not x.named):
                    if x.tag in BLOCK:
                        flush()
                    continue
                if x.tag == "header":
                    if not inside:
                        flush()
                        continue
                if by_importance and (not inside or x.tag in CONTAINERS):
                    score = memo[id(x)] if id(x) in memo else branch(x, p)
                    if score < (LOW_INSIDE if inside else LOW):
                        flush()
                        continue
            if x.tag in ("br", "td", "th", "hr"):
                parts.append(" ")
            if x.tag in BLOCK:
                flush()
                heading = x.tag in HEADINGS
                todo.append(None)
            elif x.tag in ("td", "th"):
                todo.append(" ")
            kids = x.kids
            if x.tag == "header":  # of an article: its headings only
                kids = [k for k in kids if isinstance(k, Node) and k.tag in HEADINGS | {"hgroup"}]
            todo += [k if isinstance(k, str) else (k, _hash(p, k.name)) for k in reversed(kids)]
        flush()
        return running

    top = _hash("html")
    main = article(roots(root, top))
    for x, p in main or [(root, top)]:
        before = len(blocks)
        if not take(x, p, bool(main), True):
            del blocks[before:]
            take(x, p, bool(main), False)
    return blocks


def host_of(url) -> F.Column:
    return F.coalesce(F.lower(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1)), F.lit(""))


def site_style_trees(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per host: paths, own importance, number of styles and characters of the nodes on at least
    ``LEAST_PAGES`` pages. Only distinct pages of a host count: rows are made distinct by the digest of their
    page's nodes, then counts are combined per (node, style or text) before nodes are, so neither a hot host
    nor a hot node nor a page with many copies meets in one task."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict = {}
        for batch in batches:
            seen: set = set()
            out: list = []
            for host, source in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                nodes = style_nodes(parse(source or "", known))
                page = _hash(*(x for path, (_, values, chars) in sorted(nodes.items()) for x in (path, chars, *sorted(values))))
                if (host, page) in seen:
                    continue
                seen.add((host, page))
                for path, (leaf, values, chars) in nodes.items():
                    out.append((host, page, path, 2, chars))
                    out += [(host, page, path, int(leaf), v) for v in values]
            cols = list(zip(*out, strict=True)) or [[], [], [], [], []]
            kinds = (pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)],
                                             names=["host", "page", "path", "kind", "value"])

    rows = pages.select(host_of(F.col(url_col)).alias("host"), F.col(html_col).alias("html"))
    counted = (rows.mapInArrow(count, "host string, page long, path long, kind int, value long").distinct()
               .groupBy("host", "path", "kind", "value").agg(F.count(F.lit(1)).alias("n")))
    n, log = F.col("n"), F.log(F.col("n").cast("double"))
    kind = F.col("kind")
    nodes = counted.groupBy("host", "path").agg(
        F.sum(F.when(kind == 2, n)).alias("pages"), F.sum(F.when(kind == 2, n * F.col("value"))).alias("chars"), F.max(F.when(kind < 2, kind)).alias("leaf"),
        F.sum(F.when(kind == 0, n)).alias("uses"), F.sum(F.when(kind == 0, n * log)).alias("style_sum"),
        F.sum(F.when(kind == 0, 1)).alias("styles"),
        F.sum(F.when(kind == 1, n)).alias("texts"), F.sum(F.when(kind == 1, n * log)).alias("text_sum"))
    spread = F.log(F.col("pages").cast("double"))
    shape = (F.log(F.col("uses").cast("double")) - F.col("style_sum") / F.col("uses")) / spread
    content = 1 - F.col("text_sum") / F.col("texts") / spread
    own = F.when(F.col("leaf") == 1, content).otherwise(shape)
    nodes = nodes.filter(F.col("pages") >= LEAST_PAGES).select(
        "host", F.struct("path", own.cast("float").alias("own"), F.coalesce("styles", F.lit(1)).cast("int").alias("styles"),
                         "chars").alias("node"))
    return nodes.groupBy("host").agg(F.collect_list("node").alias("nodes"))


def extract(pages: DataFrame, url_col: str = "url", html_col: str = "html", out: str = "text") -> DataFrame:
    """``pages`` with ``out``, the main text."""
    trees = written(site_style_trees(pages, url_col, html_col), "style-trees")
    # A host's tree has a row per recurring template node. It joins without a hint: Spark broadcasts the trees
    # where their files are small, and otherwise shuffles both sides and splits a hot host.
    joined = pages.withColumn("_tf_host", host_of(F.col(url_col))).join(
        trees.select(F.col("host").alias("_tf_host"), F.col("nodes").alias("_tf_nodes")), "_tf_host", "left")

    @F.arrow_udf("string")
    def text_of(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        known: dict = {}
        tables: dict = {}
        for html, hosts, nodes in batches:
            out = []
            for page, host, tree in zip(html, hosts.to_pylist(), nodes, strict=True):
                if host not in tables:
                    if len(tables) >= 100:
                        tables.clear()
                    t = tree.values if tree.is_valid else None
                    tables[host] = {} if t is None else dict(zip(t.field("path").to_pylist(), zip(
                        t.field("own").to_pylist(), t.field("styles").to_pylist(), t.field("chars").to_pylist(), strict=True), strict=True))
                out.append("\n\n".join(main_blocks(parse(page.as_py() or "", known), tables[host])))
            yield pa.array(out, pa.string())

    return joined.withColumn(out, text_of(F.col(html_col), F.col("_tf_host"), F.col("_tf_nodes"))).drop("_tf_host", "_tf_nodes")
