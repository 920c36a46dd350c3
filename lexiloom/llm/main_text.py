"""Main text of web pages by minimum-cut labelling.

A page becomes a row of text blocks. Two costs per block say how much it looks
like content and like boilerplate; they are the capacities of its edges to
source and sink. Blocks next to each other, and blocks with the same parent or
section, are joined by smoothness edges. The minimum cut labels all blocks of a
page at once.

An element speaks by its kind and by the names in its class and id. Names of an
``article`` or ``main`` do not make it boilerplate (but for those of remarks and
adverts), nor do those of what holds the first one. A short block says little of
itself: the cut gives it the label of the blocks it stands among.

Work is row-local, and linear in the page but for the cut. Cases: null and empty
html give empty text; unclosed and stray tags and quotes are accepted, a ``<``
that opens no tag is text; a page without text has empty text; repeated rows
each get their result; a table without rows gives none; other columns are not
touched. A ``br`` ends a block, as a line does. A block as likely content as
boilerplate (a tie of the cut) is boilerplate. Nothing else is dropped.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter, deque
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

# Elements whose content is no text, and elements that end a block.
SILENT = "script style noscript template svg math iframe object head title select textarea button canvas audio video".split()
#: Those that take the rest of a page if they are not closed, and those that one tag may close.
RAW, FOREIGN = frozenset("script style textarea title iframe".split()), frozenset(("svg", "math"))
BLOCKS = frozenset(
    "html body main article section div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead tbody tfoot tr td th caption"
    " blockquote pre figure figcaption address details summary fieldset legend hr br nav header footer aside form".split()
)
VOID = frozenset("br hr img input meta link area base col embed source track wbr".split())
#: Elements that close an open element of the same kind.
REPEATED = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
#: Blocks that end an open paragraph.
END_PARAGRAPH = frozenset("main article section div h1 h2 h3 h4 h5 h6 ul ol dl table blockquote pre figure address fieldset hr nav header footer aside form p".split())
SECTIONS = frozenset("body main article section div nav header footer aside form ul ol table blockquote".split())

# What ancestors say: content above 0, boilerplate below.
BY_ELEMENT = {"article": 3.0, "main": 2.0, "nav": -9.0, "footer": -9.0, "aside": -9.0, "form": -9.0, "header": -7.0, "dialog": -9.0, "menu": -7.0}
#: Class words that name a region wherever they begin or end a name.
STRONG = re.compile(
    r"(?:ads?|advert\w*|adsense|sponsor\w*|banner|promo\w*|nav|navbar|navigation|menu|sidebar|widgets?|foot|footer|masthead|topbar"
    r"|cookies?|consent|gdpr|notice|popup|modal|overlay|toolbar|breadcrumbs?|pagination|pager|subscribe|newsletter|signup|login"
    r"|related|recommend\w*|trending|comments?|disqus|respond|responses|replies|reader|skip|copyright|tracking)\d*"
)
#: Class words that name a region only as the last word of a name without a content word beside it.
WEAK = re.compile(r"(?:head|header|share|sharing|social|follow|search|popular|alert|notification|legal|tags?|meta)\d*")
CONTENT = frozenset("article content entry post story main text body prose".split())
#: First or last words of names that tell a state, not a region.
STATE_FIRST = frozenset("has with without no not is type tag category format status".split())
STATE_LAST = frozenset("enabled disabled active ready supported open closed on off left right fixed sticky visible".split())
#: Whole names that make an ``article`` element a remark of a reader, a teaser or an advert.
NO_ARTICLE = frozenset("comment reply ad advert sponsored promo teaser".split())
ROLES = {"navigation": -9.0, "banner": -7.0, "contentinfo": -9.0, "complementary": -9.0, "search": -9.0, "dialog": -9.0, "alert": -9.0, "form": -9.0, "main": 2.0, "article": 3.0}

#: Smoothness: next block, same parent, same section.
NEXT, SIBLING, SECTION = 0.5, 0.8, 0.7
#: Neighbours in one section that get an edge beyond the next block.
REACH = 2
#: Open elements that are told apart; deeper ones belong to the deepest.
DEPTH = 512

_NAME = re.compile(r"</?([a-zA-Z][^\s/>]*)")
_STOP = re.compile("[>\"']")
_ATTRIBUTE = re.compile(r"(?<![\w-])(class|id|role|hidden|aria-hidden|style)(?![\w-])(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?", re.I)
_HIDDEN = re.compile(r"display\s*:\s*none", re.I)
_SPACE = re.compile(r"\s+")
_WORD = re.compile(r"\w+")
_RIGHTS = re.compile(r"©|(?:copyright|\(c\))\s*(?:©|\(c\))?\s*(?:19|20)\d\d", re.I)


@dataclass(slots=True)
class Block:
    """A run of text between block tags, and where it stands."""

    text: str
    parent: int
    section: int
    prior: float
    linked: int
    heading: bool


@dataclass(slots=True)
class Element:
    """An open element: its own evidence, its nearest block and section, whether it lies in a link."""

    name: str
    number: int
    block: int
    heading: bool
    section: int
    link: bool


def by_names(value: str) -> float:
    """What the names in a class or id say about a region."""
    content = strong = weak = False
    for name in value.lower().replace("side-bar", "sidebar").replace("top-bar", "topbar").split():
        words = [w for w in re.split(r"[-_]+", name) if w]
        if not words or len(words) > 1 and (words[0] in STATE_FIRST or words[-1] in STATE_LAST):
            continue
        if STRONG.fullmatch(words[0]) or STRONG.fullmatch(words[-1]):
            strong = True
        elif words[-1] in CONTENT:
            content = True
        elif WEAK.fullmatch(words[-1]):
            weak = True
    if strong or weak:
        return 0.0 if content else -7.0
    return 1.0 if content else 0.0


def evidence(name: str, attributes: str, inside: bool) -> tuple[float, float]:
    """What an open element says about the text in it: by its kind, and by its names."""
    kind, names = BY_ELEMENT.get(name, 0.0), 0.0
    if name == "header" and inside:
        kind = 0.0  # the header of an article is its title
    if not attributes.strip():
        return kind, names
    for m in _ATTRIBUTE.finditer(attributes):
        key, value = m[1].lower(), (m[2] or "").strip("\"'")
        if key == "role":
            kind += ROLES.get(value.lower(), 0.0)
        elif key == "hidden" or (key == "aria-hidden" and value == "true") or (key == "style" and _HIDDEN.search(value)):
            kind -= 9.0
        elif key in ("class", "id"):
            if name in ("article", "main"):
                names -= 10.0 * (not NO_ARTICLE.isdisjoint(value.lower().split()))
            elif name not in ("html", "body"):
                names += by_names(value)
    return kind, names


class _Scanner:
    """Tags of a page in one pass; searches that failed are not repeated."""

    def __init__(self, page: str) -> None:
        self.page = page
        self.last = {c: page.rfind(c) for c in "<>\"'"}
        self.quotes = True
        self.unclosed: set[str] = set()

    def tag_end(self, at: int) -> int:
        """Place of the ``>`` that ends a tag, outside quotes where they are closed; -1 without one."""
        if at > self.last[">"]:
            return -1
        place = at
        while self.quotes:
            m = _STOP.search(self.page, place)
            if not m:
                self.quotes = False  # quotes of the rest of the page do not pair
            elif m[0] == ">":
                return m.start()
            else:
                place = m.end()
                if place <= self.last[m[0]]:
                    place = self.page.index(m[0], place) + 1
        return self.page.find(">", at)

    def markup(self, at: int) -> tuple[int, int, str, bool, str]:
        """Next piece of markup: start, end, name (empty if it is no tag), closing, attributes."""
        page = self.page
        while 0 <= at <= self.last["<"]:
            start = page.find("<", at)
            if page.startswith("<!--", start):
                end = page.find("-->", start + 4)
                return start, end + 3 if end >= 0 else len(page), "", False, ""
            if m := _NAME.match(page, start):
                end = self.tag_end(m.end())
                if end >= 0:
                    return start, end + 1, m[1].lower(), page[start + 1] == "/", page[m.end() : end]
            elif page[start + 1 : start + 2] in ("!", "?") and start < self.last[">"]:
                return start, page.index(">", start) + 1, "", False, ""
            at = start + 1
        return len(page), len(page), "", False, ""

    def after(self, name: str, at: int) -> int:
        """End of an element without text; where its end is missing, of the page (raw text) or of its tag."""
        if name in self.unclosed:
            return at
        m = re.compile(r"</head\s*>|(?=<body[\s>])" if name == "head" else rf"</{name}\s*>", re.I).search(self.page, at)
        if m:
            return m.end()
        if name in RAW:
            return len(self.page)
        self.unclosed.add(name)
        return at


def blocks(page: str) -> list[Block]:
    """Text blocks of a page in order."""
    scanner = _Scanner(page)
    found: list[tuple[str, int, int, int, int, bool]] = []
    stack = [Element("", 0, 0, False, 0, False)]
    #: By number of an element: its parent, and its evidence by kind and names.
    parents, kinds, names = [0], [0.0], [0.0]
    opened: Counter[str] = Counter()
    skipped: Counter[str] = Counter()
    texts, linked, article = [], 0, False

    def flush() -> None:
        nonlocal texts, linked
        text = _SPACE.sub(" ", "".join(texts)).strip()
        if text:
            top = stack[-1]
            found.append((text, top.block, top.section, top.number, linked, top.heading))
        texts, linked = [], 0

    def cut(depth: int) -> None:
        if any(e.name in BLOCKS for e in stack[depth:]):
            flush()
        opened.subtract(e.name for e in stack[depth:])
        del stack[depth:]

    at = 0
    while at < len(page):
        start, end, name, closing, attributes = scanner.markup(at)
        if start > at:
            raw = page[at:start]
            text = entities.unescape(raw) if "&" in raw else raw
            texts.append(text)
            linked += len(text.strip()) if stack[-1].link else 0
        at = end
        if not name:
            continue
        if name in BLOCKS:
            flush()
        if closing:
            if skipped[name]:
                skipped[name] -= 1
            elif opened[name]:
                cut(next(k for k in range(len(stack) - 1, 0, -1) if stack[k].name == name))
            continue
        if name in SILENT and not (name in FOREIGN and attributes.endswith("/")):
            at = scanner.after(name, at)
            continue
        closes = REPEATED.get(name, frozenset()) | ({"p"} if name in END_PARAGRAPH else frozenset())
        if any(opened[c] for c in closes):
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].name in closes:
                    cut(k)
                    break
                if stack[k].name in SECTIONS:
                    break
        if name in VOID or attributes.endswith("/"):
            continue
        if len(stack) > DEPTH:
            skipped[name] += 1
            continue
        top, number = stack[-1], len(parents)
        kind, by_name = evidence(name, attributes, bool(opened["article"] or opened["main"]))
        if name in ("article", "main") and not article and by_name >= 0 and not any(opened[x] for x in ("nav", "aside", "footer")):
            # What holds the first article is no boilerplate, whatever its names.
            article = name == "article"
            for e in stack[1:]:
                names[e.number] = max(names[e.number], 0.0)
        parents.append(top.number)
        kinds.append(kind)
        names.append(by_name)
        is_block = name in BLOCKS
        stack.append(
            Element(
                name,
                number,
                number if is_block else top.block,
                name in ("h1", "h2", "h3") if is_block else top.heading,
                number if name in SECTIONS else top.section,
                top.link or name == "a",
            )
        )
        opened[name] += 1
    flush()
    priors = [0.0]
    for number in range(1, len(parents)):
        priors.append(priors[parents[number]] + kinds[number] + names[number])
    return [Block(text, block, section, priors[number], n, head) for text, block, section, number, n, head in found]


def costs(block: Block) -> float:
    """How much more likely a block is content than boilerplate, in log-odds."""
    words = len(_WORD.findall(block.text))
    score = block.prior - 0.8
    score += min(words, 40) / 20
    if block.text.endswith((".", "!", "?", ":", ";", '"', "”")) or block.heading:
        score += 0.7
    score -= 4.0 * min(1.0, block.linked / max(1, len(block.text)))
    if _RIGHTS.match(block.text):
        score -= 4.0
    return max(-12.0, min(12.0, score))


def minimum_cut(content: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """Which nodes stay with the source, for node log-odds and undirected edges.

    Dinic's algorithm: shortest augmenting paths by levels.
    """
    n = len(content)
    source, sink = n, n + 1
    graph: list[list[int]] = [[] for _ in range(n + 2)]
    to: list[int] = []
    room: list[float] = []

    def edge(a: int, b: int, there: float, back: float) -> None:
        graph[a].append(len(to))
        graph[b].append(len(to) + 1)
        to.extend((b, a))
        room.extend((there, back))

    for i, score in enumerate(content):
        if score > 0:
            edge(source, i, score, 0.0)
        elif score < 0:
            edge(i, sink, -score, 0.0)
    for a, b, weight in edges:
        edge(a, b, weight, weight)
    while True:
        level = [-1] * (n + 2)
        level[source], queue = 0, deque([source])
        while queue:
            node = queue.popleft()
            for e in graph[node]:
                if room[e] > 1e-9 and level[to[e]] < 0:
                    level[to[e]] = level[node] + 1
                    queue.append(to[e])
        if level[sink] < 0:
            return [level[i] >= 0 for i in range(n)]
        tried, path, node = [0] * (n + 2), [], source
        while True:
            if node == sink:
                flow = min(room[e] for e in path)
                for e in path:
                    room[e] -= flow
                    room[e ^ 1] += flow
                path, node = [], source
                continue
            while tried[node] < len(graph[node]):
                e = graph[node][tried[node]]
                if room[e] > 1e-9 and level[to[e]] == level[node] + 1:
                    break
                tried[node] += 1
            if tried[node] < len(graph[node]):
                path.append(graph[node][tried[node]])
                node = to[path[-1]]
            elif path:
                node = to[path.pop() ^ 1]
                tried[node] += 1
            else:
                break


def smoothness(found: list[Block]) -> list[tuple[int, int, float]]:
    """Edges between blocks that belong together: neighbours that share a parent or a section."""
    out = []
    for i, block in enumerate(found):
        for j in range(i + 1, min(len(found), i + 1 + REACH)):
            other = found[j]
            weight = NEXT if j == i + 1 and abs(block.prior - other.prior) < 5 else 0.0
            weight += SIBLING * (block.parent == other.parent) + SECTION * (block.section == other.section)
            if weight:
                out.append((i, j, weight))
    return out


def extract(page: str | None) -> str:
    """Content blocks of a page, joined by line ends."""
    found = blocks(page or "")
    kept = minimum_cut([costs(b) for b in found], smoothness(found))
    return "\n".join(b.text for b, keep in zip(found, kept) if keep)


def main_text(html: Column) -> Column:
    """Main text of each page."""

    @F.arrow_udf("string")
    def run(pages: pa.Array) -> pa.Array:
        return pa.array([extract(page.as_py()) for page in pages], pa.string())

    return run.asNondeterministic()(html)
