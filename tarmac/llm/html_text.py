"""Main text of HTML pages: flat blocks classified by a small decision tree.

A page is cut into flat text blocks wherever a block-level tag stands; inline
tags do not cut. Each block is described by its own word count and link density,
those of the block before and the one behind, and where it stands (inside an
article, a heading, or an element that by tag, role or a whole class or id is a menu,
a footer, an advert, comments, ...; headings, articles and the main part are never
such by class or id, nor is anything inside an article by its id). A decision tree, trained when the operator is
planned, on the small labelled table below, decides which blocks are main text.

Character references are decoded, white space inside a block becomes one space,
and kept blocks are joined by one space in page order.

Defined results: a NULL or empty page has the empty text; broken markup (unclosed
or crossed tags, a stray "<", an unfinished tag at the end) is read as browsers
do, as far as blocks go; NULL ids and repeated rows are read like any other row;
an empty table gives no rows; further columns are not read.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.llm.common import whole

# How HTML elements take part in the text.
INLINE = set(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small "
    "span strike strong sub sup time tt u var wbr".split()
)
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style noscript template iframe object svg math textarea title head select".split())
HEADINGS = {f"h{n}" for n in range(1, 7)}
MAIN = {"article", "main"}
CHROME = {"nav", "header", "footer", "aside", "form", "menu", "dialog", "button", "fieldset"}
# A "p" ends at any of these, and a list item, row or cell at the next one of its kind.
CLOSES_P = set(
    "address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre "
    "section table ul".split()
)
CHROME_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "menu", "dialog", "alert", "form"}
# A class or id is chrome if each of its parts is one of these or says only where or how it stands.
CHROME_WORDS = set(
    "nav navbar navigation menu breadcrumb breadcrumbs footer foot siteheader masthead topbar side sidebar notice notices "
    "cookie cookies consent gdpr banner alert popup modal overlay ad ads adv advert adverts advertisement sponsor sponsored "
    "promo promotion newsletter subscribe subscription signup login search form comment comments replies reply disqus "
    "respond share sharing social related recommend recommended recommendation recommendations pagination pager widget "
    "toolbar copyright legal disclaimer tags skip".split()
)
PLAIN_WORDS = set(
    "site page main primary secondary global top bottom left right upper lower inner outer wrap wrapper container box bar "
    "block area panel list item items link links button buttons btn icon icons post posts entry entries articles thread".split()
)
# Those that are also subjects: within the main text, an id with one of them names a section.
SUBJECTS = set(
    "navigation menu foot side notice notices cookie cookies consent gdpr alert popup modal overlay adv advertisement "
    "promotion newsletter subscription login search form reply share sharing social related recommendation "
    "recommendations widget toolbar copyright legal disclaimer tags skip".split()
)
MAIN_NAMES = re.compile(r"(?:^|[\s_-])(?:article|post|entry|story|content|main|body-?text|text)(?:$|[\s_-])", re.I)

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    # Quotes count behind "=" only, as in browsers; one that is never closed is a sign like any other,
    # and nothing is tried twice.
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?:=\s*+\"[^\"]*+\"|=\s*+'[^']*+'|[^>])*+)(?:>|\Z)|(?P<text>[^<]+|<)",
    re.S,
)
ATTRIBUTE = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
WHITE = re.compile(r"\s+")

PARTS = re.compile(r"[_-]+")
NUMBER = re.compile(r"\d+(?:x\d+)?")
ITEMS = {"li", "tr", "td", "th", "dt", "dd", "option"}

FEATURES = ["words", "links", "before_words", "before_links", "behind_words", "behind_links", "main", "chrome", "heading", "item"]


@dataclass
class Block:
    text: str
    words: int
    links: float
    main: int
    chrome: int
    heading: int
    item: int


@dataclass(frozen=True)
class Place:
    """Where text stands: the innermost element that is main or chrome decides between the two."""

    tag: str = ""
    main: int = 0
    chrome: int = 0
    heading: int = 0
    item: int = 0
    hidden: int = 0
    link: int = 0
    article: int = 0

    def inside(self, tag: str, attrs: str) -> Place:
        main, chrome, hidden, article = _standing(tag, attrs, self.main, self.article)
        return Place(
            tag,
            int(main or self.main),
            1 if chrome else 0 if main else self.chrome,
            int(self.heading or tag in HEADINGS),
            int(self.item or tag in ITEMS),
            int(self.hidden or hidden),
            int(self.link or tag == "a"),
            int(self.article or article),
        )


def _parts(name: str, in_main: int) -> tuple[list[str], bool]:
    """The parts of a class or id, and whether one of them is a chrome word; an article's own header is none."""
    parts = [p for p in PARTS.split(name.lower()) if p and not NUMBER.fullmatch(p)]
    if in_main and "site" not in parts:
        return parts, not CHROME_WORDS.isdisjoint(parts)
    return [p for p in parts if p != "header"], "header" in parts or not CHROME_WORDS.isdisjoint(parts)


@lru_cache(10_000)
def _standing(tag: str, attrs: str, in_main: int, in_article: int) -> tuple[int, int, int, int]:
    """(main, chrome, hidden, article) of an element by its tag and attributes; an article's own header is main."""
    main, hidden, article = int(tag in MAIN), 0, int(tag == "article")
    chrome = int(tag in CHROME and not (tag == "header" and in_main))
    names = []
    for name, value in ATTRIBUTE.findall(attrs) if attrs else ():
        name, value = name.lower(), value.strip("\"'")
        if name == "role":
            chrome |= value.lower() in CHROME_ROLES
            main |= value.lower() in ("main", "article")
            article |= value.lower() == "article"
        elif name in ("class", "id") and tag not in ("html", "body"):
            names.append((name == "id", value))
        elif name == "hidden" or (name == "style" and re.search(r"display\s*:\s*none", value, re.I)):
            hidden = 1
    # Names do not make chrome of a heading, an article or the main part, nor do ids inside an article.
    may = tag not in HEADINGS and not main
    for is_id, value in names:
        for name in value.split():
            parts, worded = _parts(name, in_main)
            if not worded:
                main |= int(MAIN_NAMES.search(name) is not None)
            elif may and all(p in CHROME_WORDS or p in PLAIN_WORDS for p in parts):
                # "related-posts" is chrome, "related-work" is not.
                if not (is_id and (in_article or (in_main and not SUBJECTS.isdisjoint(parts)))):
                    chrome = 1
    return main, chrome, hidden, article


def blocks(page: str) -> list[Block]:
    """The flat text blocks of a page, in order; blocks without text are left out."""
    out: list[Block] = []
    stack: list[Place] = [Place()]
    # How many elements of a tag are open, and where in the stack those are that are not inline.
    opened: Counter[str] = Counter()
    solid: list[int] = [0]
    # Tags whose text runs to an end tag that the rest of the page does not have.
    endless: set[str] = set()
    pieces: list[str] = []
    linked: list[str] = []
    at = 0

    def flush() -> None:
        text = WHITE.sub(" ", html.unescape("".join(pieces))).strip() if pieces else ""
        if text:
            place = stack[-1]
            n, inside = text.count(" ") + 1, len(html.unescape("".join(linked)).split()) if linked else 0
            links = min(1.0, inside / n)
            out.append(Block(text, n, links, place.main, place.chrome, place.heading, place.item))
        pieces.clear()
        linked.clear()

    def enter(place: Place) -> None:
        if place.tag not in INLINE:
            solid.append(len(stack))
        opened[place.tag] += 1
        stack.append(place)

    def cut(depth: int) -> None:
        """Close all elements from a place in the stack on."""
        while len(stack) > depth:
            opened[stack.pop().tag] -= 1
        while solid[-1] >= depth:
            solid.pop()

    def leave(tag: str) -> None:
        if opened[tag] > 0:
            depth = len(stack) - 1
            while stack[depth].tag != tag:
                depth -= 1
            cut(depth)

    while at < len(page):
        m = TOKEN.match(page, at)
        if not m:
            # An unfinished tag: what is left holds no text.
            break
        at = m.end()
        end, tag, attrs, text = m.groups()
        if text is not None:
            if not stack[-1].hidden:
                pieces.append(text)
                if stack[-1].link:
                    linked.append(text + " ")
            continue
        if not tag:
            continue
        tag = tag.lower()
        if tag not in INLINE:
            flush()
        if end:
            leave(tag)
        elif tag in RAW:
            if tag != "head":
                close = None if tag in endless else re.compile(rf"</{re.escape(tag)}\b[^>]*>", re.I).search(page, at)
                if not close:
                    endless.add(tag)
                at = close.end() if close else (at if tag in ("svg", "math", "object") else len(page))
        else:
            if tag in CLOSES_P:
                # A new block ends an open paragraph, unless an element between them holds it.
                if stack[solid[-1]].tag == "p":
                    cut(solid[-1])
            elif tag in ITEMS and stack[-1].tag == tag:
                cut(len(stack) - 1)
            if tag not in VOID and not attrs.endswith("/"):
                enter(stack[-1].inside(tag, attrs))
    flush()
    return out


def described(found: list[Block]) -> list[tuple]:
    """The features of each block, neighbours' included; outside the page stands an empty block."""
    none = Block("", 0, 0.0, 0, 0, 0, 0)
    out = []
    for i, b in enumerate(found):
        before, behind = found[i - 1] if i else none, found[i + 1] if i + 1 < len(found) else none
        out.append(
            (b.words, b.links, before.words, before.links, behind.words, behind.links, b.main, b.chrome, b.heading, b.item)
        )
    return out


# The labelled table: small invented pages, each block marked "+" (main text) or "-" by a
# leading sign in its text. W stands for a word; "W*30" for 30 words.
LABELLED = [
    "<nav><ul><li><a>-W</a></li><li><a>-W*2</a></li><li><a>-W</a></li></ul></nav><div class=ad>-W*9</div>"
    "<article><h1>+W*8</h1><p>+W*40</p><p>+W</p><p>+W*3</p><p>+W*90</p></article><footer>-W*11</footer>",
    "<header><h1><a>-W*3</a></h1><p>-W*12</p></header><main><h2>+W*6</h2><p>+W*25</p><p>+W*12 <a>W*4</a></p>"
    "<ul><li>+W*7</li><li>+W*2</li></ul><p>+W*60</p></main><aside><h3>-W*2</h3><p>-W*30</p></aside><footer><p>-W*40</p></footer>",
    "<div id=menu><a>-W</a></div><div class=content><h1>+W*5</h1><p>+W*2</p><p>+W*70</p><blockquote>+W*15</blockquote></div>"
    "<div class=comments><h3>-W*2</h3><p>-W*45</p><p>-W*8</p></div><div class=cookie-notice>-W*25</div>",
    "<div><a>-W*2</a></div><div><a>-W</a></div><p>+W*50</p><p>+W*35</p><h2>+W*6</h2><p>+W*80</p><p>+W*14</p><p>+W*44</p>"
    "<div><a>-W*8</a></div><div>-W*3</div>",
    "<ul><li><a>-W*2</a></li><li><a>-W*3</a></li><li><a>-W</a></li></ul><div>+W*120</div><div>+W*30</div><div>-W*4 <a>W*3</a></div>",
    "<article><p>+W*4</p><p>+W</p><p>+W*2</p><aside>-W*30</aside><form>-W*6</form><p>+W*12</p><p>+W*30 <a>W*9</a></p>"
    "<p><a>+W*4</a></p><div class=ad>-W*20</div><p>+W*3</p><section class=comments><p>-W*60</p></section></article>",
    "<article><h1>+W</h1><p>+W*200</p></article><form><p>-W*5</p><p>-W*30</p></form><div class=sidebar><p>-W*50</p><a>-W*2</a></div>",
    "<div class=banner>-W*15</div><article><p>+W*18</p><table><tr><td>+W</td><td>+W*2</td></tr></table><p>+W*22</p></article>"
    "<nav><a>-W*4</a></nav><p>-W*4</p>",
    "<h1>+W*7</h1><p>+W*33</p><p>+W*28</p><p><a>-W*6</a></p><p><a>-W*7</a></p><p>-W*2</p>",
    "<p>+W*20</p>",
    "<p>+W*3</p>",
    "<article><p>+W*50</p><p>+W*9</p><p>+W*4</p></article>",
    "<main><p>+W</p><p>+W*60</p><p>+W*2</p><p>+W*40</p><p>+W*6 <a>W*6</a></p></main>",
    "<article><h1>+W*4</h1><p><a>+W*5</a></p><p><a>+W*3</a></p><p>+W*2 <a>W*9</a></p><p>+W*8</p></article>",
    "<nav><a>-W*2</a></nav><article><h1>+W*2</h1><p>+W*100</p><p>+W*2</p><p><a>+W</a></p></article>",
    "<article><ul><li><a>+W*3</a></li><li><a>+W*4</a> W*2</li><li>+W</li></ul><p>+W*45</p><p>+W*5</p></article>",
    "<article><p>+W*30</p><p><a>+W*12</a></p><p>+W*80</p></article>",
    "<div><a>-W*2</a> <a>W*2</a> <a>W</a></div><p>+W*25</p><p>+W*10</p><p>+W*40</p><div>-W*2 <a>W*2</a></div><p>-W*3</p>",
    "<div>-W*5</div><nav>-W*5</nav><article><p>+W*6</p><p>+W*6</p></article><div>-W*6</div>",
    "<header>-W*20</header><aside>-W*20</aside><article><h2>+W*3</h2><p>+W*20</p></article><footer>-W*20 <a>W*2</a></footer>",
]


def labelled_table() -> list[tuple]:
    """Rows of (features..., label)."""
    out = []
    for page in LABELLED:
        page = re.sub(r"W\*(\d+)", lambda m: " ".join("W" * int(m[1])), page)
        found = blocks(page)
        out += [(*row, int(b.text[0] == "+")) for row, b in zip(described(found), found)]
    return out


@dataclass(frozen=True)
class Node:
    """``row[feature] <= threshold`` goes left; a leaf has only a verdict."""

    verdict: int = 0
    feature: int = -1
    threshold: float = 0.0
    left: Node | None = None
    right: Node | None = None

    def decide(self, row: tuple) -> int:
        node = self
        while node.feature >= 0:
            node = node.left if row[node.feature] <= node.threshold else node.right
        return node.verdict


def _impurity(rows: list[tuple]) -> float:
    share = sum(r[-1] for r in rows) / len(rows)
    return share * (1 - share) * len(rows)


def train(rows: list[tuple], depth: int = 6, least: int = 2) -> Node:
    """Classification tree by Gini impurity; ties go to the earlier feature and lower threshold."""
    ones = sum(r[-1] for r in rows)
    leaf = Node(int(2 * ones >= len(rows)))
    if depth == 0 or ones in (0, len(rows)):
        return leaf
    best = None
    # Where a block stands says more than its size, and is tried first.
    for k in [7, 6, 1, 0, 8, 9, 2, 3, 4, 5]:
        values = sorted({r[k] for r in rows})
        for low, high in zip(values, values[1:]):
            edge = (low + high) / 2
            left, right = [r for r in rows if r[k] <= edge], [r for r in rows if r[k] > edge]
            if min(len(left), len(right)) < least:
                continue
            score = _impurity(left) + _impurity(right)
            if best is None or score < best[0] - 1e-9:
                best = (score, k, edge, left, right)
    if best is None or best[0] >= _impurity(rows) - 1e-9:
        return leaf
    _, k, edge, left, right = best
    return Node(leaf.verdict, k, edge, train(left, depth - 1, least), train(right, depth - 1, least))


def main_text(page: str, tree: Node) -> str:
    found = blocks(page)
    return " ".join(b.text for b, row in zip(found, described(found)) if tree.decide(row))


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) per row of ``pages``."""
    tree = train(labelled_table())

    @F.arrow_udf("string")
    def text_of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([main_text(p, tree) for p in batch.to_pylist()], pa.string())

    read = pages.select("page_id", "url", text_of(whole(F.col("html"))).alias("text"))
    return read.withColumn("n_chars", F.length("text").cast("long"))
