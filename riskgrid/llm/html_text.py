"""Main text of web pages by composite text density."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskgrid.llm.common import slices

#: Elements whose content is never article text.
DROPPED = frozenset(
    "script style noscript template svg math canvas object embed applet iframe audio video head title nav aside footer"
    " form button select option textarea input label fieldset menu dialog map".split()
)
EMPTY = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details div dl dt fieldset figcaption figure footer form h1 h2 h3"
    " h4 h5 h6 header hr html li main nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
#: A start tag on the left closes an open element on the right, if no barrier is between.
CLOSES = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
    "th": {"td", "th"}, "option": {"option"},
} | {tag: {"p"} for tag in BLOCK - {"li", "dt", "dd", "tr", "td", "th", "body", "html"}}
BARRIER = frozenset("body html table ul ol dl div article section main aside nav footer header form td th blockquote figure".split())
LANDMARK = frozenset(("article", "main"))
#: A subtree around landmarks stands for them if they hold so much of its text outside links.
LANDMARK_SHARE = 0.9
#: Landmarks beside the one of the best subtree count from this share of the smallest density on the path: teasers have less.
BESIDE = 0.5
#: Words of class and id names, and roles, of parts that aren't the article.
BOILERPLATE = frozenset(
    "ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion sidebar menu nav navbar"
    " navigation breadcrumb breadcrumbs cookie cookies consent gdpr comment comments disqus reply replies respond share"
    " sharing social related recommended newsletter subscribe popup modal overlay footer pager pagination toolbar"
    " masthead login signup paywall notice alert widget complementary contentinfo search dialog".split()
)
#: These words of class and id names mark boilerplate only if no article word stands beside them.
HEADERS = frozenset(("header", "topbar", "top", "bottom"))
ARTICLE = frozenset("article content entry post main body story text title headline".split())
#: Beside one of these words a boilerplate word says what a part has, lacks or offers, not what it is.
MODIFIERS = frozenset("has have had no not non without with open opened closed ready enabled disabled allowed".split())
#: An article beside an element dropped for its names has at least this share of the page's text; teasers have less.
RIVAL_SHARE = 0.1
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


class Node:
    __slots__ = ("tag", "parent", "items", "dropped", "gone", "article", "chars", "link_chars", "tags", "link_tags", "density", "total")

    def __init__(self, tag: str, parent: Node | None, dropped: bool, gone: bool):
        # Dropped: not to be read, perhaps for its names alone. Gone: in an element dropped for its kind, without texts.
        self.tag, self.parent, self.dropped, self.gone = tag, parent, dropped, gone
        self.article = tag in LANDMARK
        self.items: list[Node | str] = []
        self.chars = self.link_chars = self.tags = self.link_tags = 0
        self.density = self.total = 0.0


def is_hidden(tag: str, attributes: list[tuple[str, str | None]], in_landmark: bool) -> bool:
    """Never article text: by the element's kind, or as it isn't shown."""
    if tag in DROPPED or (tag == "header" and not in_landmark):
        return True
    if tag in ("html", "body", "article", "main") and not any(k == "class" or k == "id" for k, _ in attributes):
        return False
    for key, value in attributes:
        if key == "hidden" or key == "aria-hidden" and value == "true":
            return True
        if key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value or ""):
            return True
    return False


def judged(tag: str, attributes: list[tuple[str, str | None]], in_landmark: bool) -> tuple[bool, bool]:
    """Whether class, id or role names a part that isn't the article, and one that is. Names don't drop an article or main."""
    if tag in ("html", "body") or tag in LANDMARK:
        return False, tag in LANDMARK
    names: set[str] = set()
    found = False
    for key, value in attributes:
        if key in ("class", "id", "role"):
            for name in (value or "").split():
                words = {w.lower() for w in _WORDS.findall(name)}
                names |= words
                found = found or bool(words & BOILERPLATE) and not words & MODIFIERS
    article = bool(names & ARTICLE)
    return found or bool(names & HEADERS) and not article and not in_landmark, article


class TreeBuilder(HTMLParser):
    """A forgiving DOM: implied end tags, stray end tags ignored, character references decoded."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("html", None, False, False)
        self.landmarks = 0

    def handle_starttag(self, tag, attrs):
        if tag == "html":
            return
        closes = CLOSES.get(tag)
        if closes:
            node = self.at
            while node is not self.root and node.tag not in closes and node.tag not in BARRIER:
                node = node.parent
            if node.tag in closes:
                self._close(node)
        gone = self.at.gone or is_hidden(tag, attrs, self.landmarks > 0)
        node = Node(tag, self.at, gone, gone)
        if attrs and not gone:
            node.dropped, node.article = judged(tag, attrs, self.landmarks > 0)
        self.at.items.append(node)
        if tag not in EMPTY:
            self.at = node
            self.landmarks += tag in LANDMARK

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if self.at.tag == tag and tag not in EMPTY and tag not in BLOCK:
            self._close(self.at)

    def handle_endtag(self, tag):
        node = self.at
        inline = tag not in BLOCK
        while node is not self.root and node.tag != tag:
            if inline and node.tag in BLOCK and node.tag != "p":
                return
            node = node.parent
        if node is not self.root:
            self._close(node)

    def _close(self, node: Node) -> None:
        walk = self.at
        while True:
            self.landmarks -= walk.tag in LANDMARK
            if walk is node:
                break
            walk = walk.parent
        self.at = node.parent

    def handle_data(self, data):
        if not self.at.gone:
            self.at.items.append(data)


def keep_most(root: Node) -> None:
    """Elements dropped for their names stay if they hold most of the page's text outside links and no article is beside.

    So names never drop the page's own frame, but a long comment list beside an article does go. If no text is left, no
    element is dropped for its names.
    """
    nodes, stack = [], [root]
    while stack:
        node = stack.pop()
        nodes.append(node)
        stack.extend(x for x in reversed(node.items) if type(x) is Node and not x.gone)
    named = [n for n in nodes if n.dropped]
    if not named:
        return
    plain: dict[int, int] = {}
    for node in reversed(nodes):
        n = sum(len("".join(x.split())) if type(x) is str else plain.get(id(x), 0) for x in node.items)
        plain[id(node)] = 0 if node.tag == "a" else n
    whole = plain[id(root)]
    live = alive(root)
    rivals = [n for n in live if n.article and plain[id(n)] >= RIVAL_SHARE * whole]
    for node in named:
        if 2 * plain[id(node)] > whole:
            around, up = set(), node.parent
            while up is not None:
                around.add(id(up))
                up = up.parent
            if all(id(n) in around for n in rivals):
                node.dropped = False
                more = alive(node)
                live += more
                rivals += [n for n in more if n.article and plain[id(n)] >= RIVAL_SHARE * whole]
    if not any(type(x) is str and not x.isspace() for n in live for x in n.items):
        for node in named:
            node.dropped = False


def alive(top: Node) -> list[Node]:
    """``top`` and the nodes below it that aren't dropped."""
    found, stack = [], [top]
    while stack:
        node = stack.pop()
        found.append(node)
        stack.extend(x for x in node.items if type(x) is Node and not x.dropped)
    return found


def measured(root: Node) -> list[Node]:
    """All nodes in page order, with counts and densities filled in."""
    nodes, stack = [], [root]
    while stack:
        node = stack.pop()
        nodes.append(node)
        stack.extend(x for x in reversed(node.items) if type(x) is Node and not x.dropped)
    for node in reversed(nodes):
        link = node.tag == "a"
        for x in node.items:
            if type(x) is str:
                node.chars += len(x) - x.count(" ")
            elif not x.dropped:
                node.chars += x.chars
                node.link_chars += x.link_chars
                node.tags += 1 + x.tags
                node.link_tags += x.link_tags + (x.tag == "a")
        if link:
            node.link_chars = node.chars
    body = next((n for n in nodes if n.tag == "body"), root)
    share = body.link_chars / max(body.chars, 1)
    for node in reversed(nodes):
        c, lc, t, lt = node.chars, node.link_chars, max(node.tags, 1), max(node.link_tags, 1)
        if c:
            base = math.log(c * lc / max(c - lc, 1) + share * c + math.e)
            node.density = max(0.0, c / t * math.log(max(c / max(lc, 1) * t / lt, 1e-9)) / max(math.log(base), 1.0))
        if node.parent is not None:
            node.parent.total += node.density
    return nodes


def main_parts(root: Node) -> list[Node]:
    """The subtree with the largest density sum, with dense neighbours of its path; whole landmarks if it is within one.

    Neighbours of the path to the body count as content if their density reaches the smallest density on the path. Within
    an article or main the outermost one is taken instead, and, if that is an article, with it the other outermost ones
    whose density reaches half of that. A landmark that the best subtree isn't part of decides nothing. A best subtree nearly
    all of whose text is in landmarks stands for them.
    """
    nodes = measured(root)
    if not nodes or not root.chars:
        return []
    best = max(nodes, key=lambda n: n.total)
    if not best.total:
        best = max(nodes, key=lambda n: n.density)
    path = [best]
    while path[-1].parent is not None:
        path.append(path[-1].parent)
    inner = [n for n in path if n.tag not in ("html",)] or path
    threshold = min(n.density for n in inner)
    on_path = [n for n in path if n.tag in LANDMARK]
    outermost, below = outer_landmarks(root), outer_landmarks(best)
    if on_path and on_path[-1].tag == "main":
        return [on_path[-1]]
    if on_path:
        return [n for n in outermost if n is on_path[-1] or n.density >= BESIDE * threshold]
    if sum(map(plain_chars, below)) >= LANDMARK_SHARE * max(plain_chars(best), 1):
        return [n for n in outermost if n in below or n.density >= BESIDE * threshold]
    parts = {id(best)}
    for n in path[1:]:
        parts.update(id(x) for x in n.items if type(x) is Node and not x.dropped and x.chars and x.density >= threshold and x not in path)
    return [n for n in nodes if id(n) in parts]


def plain_chars(node: Node) -> int:
    return node.chars - node.link_chars


def outer_landmarks(top: Node) -> list[Node]:
    """The landmarks with text below ``top`` that are in no other one, in page order."""
    found, stack = [], [top]
    while stack:
        node = stack.pop()
        if node.tag in LANDMARK and node.chars:
            found.append(node)
        else:
            stack.extend(x for x in reversed(node.items) if type(x) is Node and not x.dropped)
    return found


def blocks_of(part: Node) -> list[str]:
    """Texts of the blocks below ``part`` in page order, white space joined, empty ones left out."""
    blocks, run = [], []

    def flush() -> None:
        text = " ".join("".join(run).split())
        if text:
            blocks.append(text)
        run.clear()

    stack: list = [part]
    while stack:
        x = stack.pop()
        if type(x) is str:
            run.append(x)
        elif x is None:
            flush()
        elif not x.dropped:
            if x.tag in BLOCK:
                flush()
                stack.append(None)
            elif x.tag == "br":
                run.append(" ")
            stack.extend(reversed(x.items))
    flush()
    return blocks


def main_text(html: str) -> str:
    builder = TreeBuilder()
    builder.feed(html)
    builder.close()
    keep_most(builder.root)
    return " ".join(b for part in main_parts(builder.root) for b in blocks_of(part))


def extract(pages: DataFrame) -> DataFrame:
    """One row per page with the main text.

    A null or empty page, or one without text outside the dropped parts, gives an empty text. Rows are handled alone:
    repeated rows get equal rows, an empty table gives none, columns beside page_id, url and html are ignored. Of
    subtrees with equal density sums the first in page order wins.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "html"):
            found = [main_text(x) if x else "" for x in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_pydict(
                {
                    "page_id": batch.column("page_id"),
                    "url": batch.column("url"),
                    "text": pa.array(found, pa.string()),
                    "n_chars": pa.array([len(x) for x in found], pa.int64()),
                }
            )

    plain = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string"))
    return plain.mapInArrow(run, "page_id long, url string, text string, n_chars long")
