"""Main text of web pages from container paths that a host's pages agree on."""

from __future__ import annotations

import html
import re
from collections import defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from steploom.session import materialize

from .url_filter import host_of

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']|\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))*)(?:>|\Z)",
    re.S,
)
#: One attribute after the other, so that no name is found inside a value.
_ATTRIBUTE = re.compile(r"""([^\s/=>]+)(?:\s*=\s*(?:"([^"]*)"?|'([^']*)'?|([^\s>]+)))?""")
_READ = frozenset("class id role hidden style aria-hidden".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style textarea title noscript template iframe noembed noframes svg math xmp".split())
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup "
    "time tt u var wbr".split()
)
_CONTAINER = frozenset("html body div article section main aside nav header footer form table td center fieldset dialog".split())
_CLOSES_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main "
    "menu nav ol p pre section table ul".split()
)
_CLOSED_BY = {
    "li": (frozenset(["li"]), frozenset(["ul", "ol", "menu"])),
    "dt": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "dd": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "tr": (frozenset(["tr", "td", "th"]), frozenset(["table"])),
    "td": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
    "th": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
    "option": (frozenset(["option"]), frozenset(["select"])),
}
#: Elements that are never main text.
_DROPPED_TAGS = frozenset(
    "head script style noscript template nav header footer aside form button select option iframe svg math textarea title dialog menu object canvas "
    "audio video noembed noframes".split()
)
#: Words in a class or id that mark what is not main text, unless the element holds most of the page or an article.
_DROPPED_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising adbox adslot banner banners breadcrumb breadcrumbs comment comments commentlist disqus cookie "
    "cookies consent gdpr footer header masthead menu menus nav navbar navigation newsletter notice notices notification alert modal overlay popup "
    "pager pagination promo promotion related recommended recommendations reply replies responses share sharing sidebar signup social sponsor "
    "sponsored subscribe subscription tags toolbar topbar widget widgets login search".split()
)
#: Those of them that also stand in the names of plain content, such as ``market-share`` or ``search-methods``.
_AMBIGUOUS_WORDS = frozenset(
    "header masthead footer menu menus navigation modal overlay pager promotion related recommended recommendations replies reply responses search "
    "share sharing social tags consent".split()
)
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_DROPPED_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert menu menubar".split())
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


@dataclass
class Block:
    """Text of one block: the container it lies in (a number of its page's), and how much of it is links."""

    node: int
    text: str
    link_chars: int


@dataclass
class Page:
    """A page's containers as a tree and its blocks of text in page order.

    Container 0 is the page.  Elements with equal paths are one container, and a container's number is
    larger than its parent's, so sums over the tree are one walk along the numbers.
    """

    parents: list[int] = field(default_factory=lambda: [-1])
    steps: list[str] = field(default_factory=lambda: [""])
    tags: list[str] = field(default_factory=lambda: [""])
    numbers: dict[tuple[int, str], int] = field(default_factory=dict)
    blocks: list[Block] = field(default_factory=list)

    def inside(self, parent: int, tag: str, step: str) -> int:
        """The container of this step in ``parent``."""
        number = self.numbers.setdefault((parent, step), len(self.parents))
        if number == len(self.parents):
            self.parents.append(parent)
            self.steps.append(step)
            self.tags.append(tag)
        return number

    def path(self, node: int) -> str:
        steps = []
        while node > 0:
            steps.append(self.steps[node])
            node = self.parents[node]
        return "/".join(reversed(steps))

    def find(self, path: str) -> int | None:
        """The container with a path, if the page has it."""
        node = 0
        for step in path.split("/") if path else ():
            if (node := self.numbers.get((node, step), -1)) < 0:
                return None
        return node

    def within(self, node: int) -> list[bool]:
        """Whether each container is ``node`` or lies in it."""
        found: list[bool] = []
        for n, parent in enumerate(self.parents):
            found.append(n == node or (parent >= 0 and found[parent]))
        return found


@dataclass
class _Element:
    tag: str
    dropped: bool
    node: int
    link: bool
    #: The innermost marked element it is or lies in; 0 for none.
    mark: int
    #: Whether it is or lies in an article or main element.
    article: bool


@dataclass
class _Mark:
    """An element with a word of what is not main text, and what it holds."""

    outer: int
    #: Whether it lies in an article and its words also stand in names of content.
    ambiguous: bool = False
    unlinked: int = 0
    linked: int = 0
    article: bool = False


def _attributes(text: str) -> dict[str, str]:
    """The attributes that are read here; of repeated ones the first counts."""
    found: dict[str, str] = {}
    for m in _ATTRIBUTE.finditer(text):
        if (name := m[1].lower()) in _READ:
            found.setdefault(name, html.unescape(m[2] or m[3] or m[4] or ""))
    return found


def _is_dropped(tag: str, attributes: dict[str, str]) -> bool:
    if tag in _DROPPED_TAGS:
        return True
    if not attributes or tag in ("html", "body", "article", "main"):
        return False
    if "hidden" in attributes or attributes.get("aria-hidden", "").lower() == "true":
        return True
    if "display:none" in attributes.get("style", "").replace(" ", "").lower() or attributes.get("role", "").lower() in _DROPPED_ROLES:
        return True
    return False


def _is_marked(attributes: dict[str, str]) -> bool:
    return any(w.lower() in _DROPPED_WORDS for w in _WORD.findall(_named(attributes)))


def _named(attributes: dict[str, str]) -> str:
    return f"{attributes.get('class', '')} {attributes.get('id', '')}"


def _is_ambiguous(attributes: dict[str, str]) -> bool:
    """Whether each of its listed words is an ambiguous one within a longer name."""
    for name in _named(attributes).split():
        own = [w.lower() for w in _WORD.findall(name)]
        listed = [w for w in own if w in _DROPPED_WORDS]
        if listed and (len(listed) == len(own) or not _AMBIGUOUS_WORDS.issuperset(listed)):
            return False
    return True


def _step(tag: str, attributes: dict[str, str]) -> str:
    """A container in a path: its tag, classes and id, without digits, so that pages of a template agree."""
    general = lambda c: re.sub(r"[\d_/-]+", "", c).lower()
    classes = sorted({general(c) for c in attributes.get("class", "").split()} - {""})
    name = general(attributes.get("id", ""))
    return ".".join([tag, *classes]) + (f"#{name}" if name else "")


@dataclass
class _Parser:
    page: Page = field(default_factory=Page)
    #: Container, and texts with their marks and whether they are links.
    found: list[tuple[int, list[tuple[str, int, bool]]]] = field(default_factory=list)
    stack: list[_Element] = field(default_factory=list)
    #: Where in the stack the open elements of each tag stand, and where the containers do.
    places: dict[str, list[int]] = field(default_factory=lambda: defaultdict(list))
    containers: list[int] = field(default_factory=list)
    words: list[tuple[str, int, bool]] = field(default_factory=list)
    marks: list[_Mark] = field(default_factory=lambda: [_Mark(0)])

    def top(self) -> _Element:
        return self.stack[-1] if self.stack else _Element("", False, 0, False, 0, False)

    def nearest(self, tags: Iterable[str]) -> int:
        """Place of the innermost open element of these tags, -1 without one."""
        return max((self.places[t][-1] for t in tags if self.places.get(t)), default=-1)

    def flush(self) -> None:
        if self.words:
            self.found.append((self.top().node, self.words))
            self.words = []

    def text(self, raw: str) -> None:
        top = self.top()
        if raw and not top.dropped:
            self.words.append((html.unescape(raw) if "&" in raw else raw, top.mark, top.link))

    def dropped_marks(self) -> list[bool]:
        """Whether each mark's element is dropped: not if it holds most of the page's unlinked text,
        an article or main element without such a word, or, with an ambiguous name in an article, more plain text
        than links; and none if no unlinked text would be left.
        """
        for _, words in self.found if len(self.marks) > 1 else ():
            for text, mark, link in words:
                if link:
                    self.marks[mark].linked += len(text.strip())
                else:
                    self.marks[mark].unlinked += len(text.strip())
        alone = [m.unlinked for m in self.marks]
        for m in reversed(self.marks[1:]):
            self.marks[m.outer].unlinked += m.unlinked
            self.marks[m.outer].linked += m.linked
            self.marks[m.outer].article |= m.article
        total, dropped = self.marks[0].unlinked, [False]
        for m in self.marks[1:]:
            prose = m.ambiguous and m.unlinked > m.linked
            dropped.append(dropped[m.outer] or not (m.article or prose or 2 * m.unlinked > total))
        left = sum(n for n, d in zip(alone, dropped, strict=True) if not d)
        return dropped if left or not total else [False] * len(dropped)

    def finished(self) -> Page:
        dropped = self.dropped_marks()
        for node, words in self.found:
            kept = [(text, link) for text, mark, link in words if not dropped[mark]]
            if text := " ".join("".join(t for t, _ in kept).split()):
                self.page.blocks.append(Block(node, text, sum(len(t.strip()) for t, link in kept if link)))
        return self.page

    def pop_to(self, index: int) -> None:
        if any(e.tag not in _INLINE for e in self.stack[index:]):
            self.flush()
        for e in self.stack[index:]:
            self.places[e.tag].pop()
        while self.containers and self.containers[-1] >= index:
            self.containers.pop()
        del self.stack[index:]

    def leave(self, tags: set[str]) -> None:
        outermost = min((self.places[t][0] for t in tags if self.places.get(t)), default=-1)
        if outermost >= 0:
            self.pop_to(outermost)

    def open(self, tag: str, rest: str) -> None:
        if tag == "br":
            self.text(" ")
            return
        if tag not in _INLINE:
            self.flush()
        if tag in _VOID:
            return
        if tag in _CLOSES_P and self.nearest(["p"]) > (self.containers[-1] if self.containers else -1):
            self.pop_to(self.nearest(["p"]))
        if tag in _CLOSED_BY:
            closed, limits = _CLOSED_BY[tag]
            if (i := self.nearest(closed)) > self.nearest(limits):
                self.pop_to(i)
        attributes, top = _attributes(rest), self.top()
        node = self.page.inside(top.node, tag, _step(tag, attributes)) if tag in _CONTAINER else top.node
        dropped, mark, exempt = top.dropped or _is_dropped(tag, attributes), top.mark, tag in ("html", "body", "article", "main")
        if attributes and not dropped and _is_marked(attributes):
            if not exempt and not (top.article and tag in _HEADINGS and _is_ambiguous(attributes)):
                self.marks.append(_Mark(mark, top.article and _is_ambiguous(attributes)))
                mark = len(self.marks) - 1
        elif tag in ("article", "main") and not dropped:
            self.marks[mark].article = True
        self.places[tag].append(len(self.stack))
        if tag in _CONTAINER:
            self.containers.append(len(self.stack))
        article = top.article or tag in ("article", "main")
        self.stack.append(_Element(tag, dropped, node, top.link or tag == "a", mark, article))

    def close(self, tag: str) -> None:
        at = self.nearest([tag])
        if at < 0:
            if tag not in _INLINE:
                self.flush()
        # An inline end tag never closes a block around it.
        elif tag not in _INLINE or at > (self.containers[-1] if self.containers else -1):
            self.pop_to(at)


def page_blocks(page: str | None) -> Page:
    """Containers and blocks of text in page order, without what is never main text."""
    parser, at, page = _Parser(), 0, page or ""
    endless: set[str] = set()
    while True:
        m = _TAG.search(page, at)
        if m is None:
            parser.text(page[at:])
            break
        parser.text(page[at : m.start()])
        at = m.end()
        if m[2] is None:
            continue
        tag = m[2].lower()
        if m[1]:
            parser.close(tag)
        elif tag in ("svg", "math") and m[3].endswith("/"):
            continue
        elif tag in _RAW and tag not in endless:
            ended = re.compile(rf"</{re.escape(tag)}(?=[\s/>]|\Z)[^>]*(?:>|\Z)", re.I).search(page, at)
            if ended:
                at = ended.end()
            elif tag in ("svg", "math"):
                # Without an end tag it ends with the element around it or at the next block.
                endless.add(tag)
                parser.open(tag, m[3])
            else:
                at = len(page)
        else:
            if endless and tag in _CLOSES_P:
                parser.leave(endless)
            parser.open(tag, m[3])
    parser.flush()
    return parser.finished()


def best_path(page: Page, share: float = 0.7, part: float = 0.1) -> tuple[int, int]:
    """The container that holds a page's main text, and its worth.

    A block is worth its characters less twice those of links; in an article or main element it
    scores half as much again.  The container holds ``share`` of the page's score: of those that do, the outermost
    article or else main element, or else the deepest container.  If articles outside the chosen one hold ``part``
    of the page's worth each, it is the lowest container of all of these instead.

    Worth is added up the tree, so the time grows with the page's containers and blocks, not with their depth.
    """
    size = len(page.parents)
    worth, named, depth = [0] * size, [False] * size, [0] * size
    for n in range(1, size):
        named[n] = named[page.parents[n]] or page.tags[n] in ("article", "main")
        depth[n] = depth[page.parents[n]] + 1
    for b in page.blocks:
        worth[b.node] += max(0, len(b.text) - 2 * b.link_chars)
    score = [(3 if inner else 2) * w for w, inner in zip(worth, named, strict=True)]
    for n in range(size - 1, 0, -1):
        worth[page.parents[n]] += worth[n]
        score[page.parents[n]] += score[n]
    total = worth[0]
    if not total:
        return 0, 0
    # Containers with so much of the score lie within each other.
    holders = sorted((n for n in range(size) if score[n] >= share * score[0]), key=depth.__getitem__)
    of_tag = lambda *tags: next((n for n in holders if page.tags[n] in tags), None)
    chosen = next((n for n in (of_tag("article"), of_tag("main")) if n is not None), holders[-1])
    under = page.within(chosen)
    others = [n for n in range(size) if page.tags[n] == "article" and worth[n] >= part * total and not under[n]]
    if others:
        # The lowest container with all of them in it.
        held = [0] * size
        for n in (chosen, *others):
            held[n] += 1
        for n in range(size - 1, 0, -1):
            held[page.parents[n]] += held[n]
        chosen = max((n for n in range(size) if held[n] == len(others) + 1), key=depth.__getitem__)
    return chosen, worth[chosen]


def text_under(page: Page, node: int | None) -> str:
    """The text of a container; none without one."""
    if node is None:
        return ""
    under = page.within(node)
    return " ".join(b.text for b in page.blocks if under[b.node])


def _vote(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        paths, worths = [], []
        for page in map(page_blocks, batch["html"].tolist()):
            node, worth = best_path(page)
            paths.append(page.path(node))
            worths.append(worth)
        yield pd.DataFrame({"host": batch["host"], "path": paths, "worth": worths})


def host_paths(pages: DataFrame) -> DataFrame:
    """``host`` and its winning ``path``: the one that most pages chose (ties: more text, then the smaller path).

    Votes are summed before they are shuffled, and each task sends its best path of a host only, so a large host
    is no hot spot, however many paths it has.
    """
    votes = pages.select("host", "html").mapInPandas(_vote, "host string, path string, worth long")
    counted = votes.where("worth > 0").groupBy("host", "path").agg(F.count(F.lit(1)).alias("n"), F.sum("worth").alias("worth"))
    order = F.struct((-F.col("n")).alias("n"), (-F.col("worth")).alias("worth"), "path")
    return counted.groupBy("host").agg(F.min(order).alias("best")).select("host", "best.path")


def _extract(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        texts = []
        for page, path in zip(batch["html"].tolist(), batch["path"].tolist(), strict=True):
            parsed = page_blocks(page)
            found = text_under(parsed, parsed.find(path)) if isinstance(path, str) else ""
            texts.append(found or text_under(parsed, best_path(parsed)[0]))
        yield batch.drop(columns=["html", "path"]).assign(text=texts)


def extract_pages(pages: DataFrame, url: str = "url", page_html: str = "html", key: str = "page_id") -> DataFrame:
    """``page_id, url, text`` of every row.

    Pages vote for the container path with their main text; each host's winner is used for all
    its pages, and a page that lacks it uses its own best container, as do pages whose URL is NULL or
    names no host: they share no template and do not vote.  NULL or empty pages give an empty text; repeated rows
    are extracted each; broken markup is read as far as it goes; other columns are left out.
    """
    page = pages.select(
        F.col(key).alias("page_id"), F.col(url).alias("url"), F.coalesce(host_of(F.col(url)), F.lit("")).alias("host"), F.col(page_html).alias("html")
    )
    # Stored, so that the planner knows how large the table is: where it is small, the pages are not shuffled.
    joined = page.join(materialize(host_paths(page.where("host != ''")), "paths"), "host", "left").select("page_id", "url", "html", "path")
    kind = page.schema["page_id"].dataType.simpleString()
    return joined.mapInPandas(_extract, f"page_id {kind}, url string, text string").select(
        F.col("page_id").alias(key), F.col("url").alias(url), "text"
    )
