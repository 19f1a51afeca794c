"""Main text of web pages by minimum-cut labelling.

A page is cut into blocks of text. A linear classifier gives each block a cost for being called
content and one for being called boilerplate; these are the capacities to the two terminals of a
graph. Blocks that follow each other, and blocks close to each other in the DOM, are tied by edges
that cost something if their labels differ. The minimum cut is the cheapest labelling.
"""

from __future__ import annotations

import re
from collections import deque
from dataclasses import dataclass, field
from html import unescape

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from viewlog.llm.tables import text_of

# Names from the HTML standard: fixed values.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
NEVER_TEXT = frozenset("script style noscript template iframe object svg canvas annotation title textarea select "
                       "button datalist audio video map".split())  # a head holds only such and void elements
RAW_TEXT = frozenset("script style textarea title iframe noscript".split())
BLOCKS = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset "
                   "figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol "
                   "p pre section summary table tbody td tfoot th thead tr ul search".split())
CLOSES_ITSELF = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"),
}
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
TRACKED = BLOCKS | {"a", "span"}

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)(?:>|\Z)"
    r"|<(?P<odd_end>/?)(?P<odd>[a-zA-Z][^\s/>]*)[^>]*+(?:>|\Z)"
    r"|<[!?/][^>]*+(?:>|\Z)|<\Z", re.S)  # what is cut off is still markup
ATTRIBUTE = re.compile(r"""([a-zA-Z][-\w:]*)\s*=\s*("[^"]*"|'[^']*'|[^\s>"']+)""")
NAME_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|[0-9]+")

# The classifier: what an element, a word of its class, id or role, and the text of a block weigh.
# Positive is content. The weights are log odds and can be replaced by learned ones.
BY_TAG = {
    "article": 4.0, "main": 3.0, "nav": -7.0, "footer": -6.0, "aside": -6.0, "header": -4.0, "form": -6.0,
    "dialog": -7.0, "menu": -5.0, "search": -6.0, "fieldset": -4.0,
}
BAD_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner cookie "
    "cookies consent gdpr notice alert popup modal overlay newsletter subscribe subscription signup login signin "
    "register search share sharing social follow comment comments respond reply replies disqus discussion sidebar "
    "widget widgets menu menus navbar navigation nav breadcrumb breadcrumbs pagination pager footer copyright legal "
    "related recommended recommendations trending popular toolbar masthead topbar skip contentinfo complementary "
    "dialog form feedback paywall toc tags outbrain taboola".split())
GOOD_WORDS = frozenset("article articlebody content post entry story maincontent prose".split())
MODIFIER = re.compile(r"(?:has|have|with|without|no|is|not)[-_]", re.I)  # says what a wrapper holds, not what it is
# Words that say nothing about what an element holds. An id of an article's section is made from its heading, so it
# is boilerplate only as a whole: "related-posts", not "related-work"; nor is one word that is often a heading.
LAYOUT_WORDS = frozenset("area article articles block bottom box container content inner left link links list news "
                         "panel post posts right section stories thread top wrap wrapper".split())
HEADINGS_TOO = frozenset("alert banner cookie cookies copyright dialog discussion feedback follow form legal menu menus "
                         "modal navigation notice overlay pager pagination popular popup register reply search skip "
                         "social tags toolbar widget widgets".split())
HEADING_WORDS = frozenset("header heading headline title byline".split())
BAD_WORD, GOOD_WORD = -6.0, 2.0
STRONG = 4.0  # an element at or beyond this decides for what is inside, unless something stronger does
HIDDEN = -8.0
LINKED, LONG, SENTENCE, HEADING, LEGAL = -4.0, 2.5, 0.5, 0.8, -3.0
OUTSIDE = -3.0  # for a block outside the article of a page that marks one
LONG_WORDS = 30
ENDS = ".!?…\"'”»"  # of a sentence
ADJACENT = (1.0, 0.5, 0.2)  # edge to the block before: same parent, same grandparent, else
NEAR = 0.4  # edge to the last earlier block of the same parent with others between


@dataclass
class Element:
    name: str
    verdict: float  # what its ancestors and itself say about the text inside
    inside_main: bool
    fixed: bool  # below navigation and the like, which nothing inside can undo
    number: int = 0
    named_bad: bool = False  # judged boilerplate by its class, id or role alone, or as a form
    place: int = 0  # in the stack of open elements
    outer: Element | None = None  # the nearest one around it that is judged by its name


@dataclass
class Block:
    """Text between two block boundaries."""

    parts: list[str] = field(default_factory=list)
    linked: int = 0
    parent: int = 0
    grandparent: int = 0
    tag: str = ""
    verdict: float = 0.0
    inside_main: bool = False
    held_by: Element | None = None  # the nearest element around it that is judged by its name

    @property
    def text(self) -> str:
        return " ".join(unescape("".join(self.parts)).split())


def _words(names: str) -> set[str]:
    return {word.lower() for part in names.split() if not MODIFIER.match(part) for word in NAME_PART.findall(part)}


def _is_anchor(name: str, words: set[str], classes: set[str]) -> bool:
    """Whether an id inside an article may be made from a heading."""
    if name != "section" and name not in HEADINGS and not (name == "div" and "section" in classes):
        return False
    named = {word for word in words if not word.isdigit()}
    return not named <= BAD_WORDS | LAYOUT_WORDS or len(named) == 1 and named <= HEADINGS_TOO


def _element(name: str, attrs: str, above: Element, excused: bool) -> Element:
    named_bad = name == "form"
    weight = BY_TAG.get(name, 0.0)
    if name == "form" and excused:
        weight = 0.0
    hard = weight <= -STRONG and name != "header"
    if name == "header" and above.inside_main:
        weight = 0.0  # the head of the article itself
    if attrs and "=" in attrs and name not in ("html", "body"):
        named = {key.lower(): value.strip("\"'") for key, value in ATTRIBUTE.findall(attrs)}
        words = _words(" ".join(named.get(key, "") for key in ("class", "role", "itemprop", "aria-label")))
        by_id = _words(named.get("id", ""))
        if not (above.inside_main and _is_anchor(name, by_id, words)):
            words |= by_id
        style = named.get("style", "").replace(" ", "").lower()
        if "display:none" in style or "visibility:hidden" in style or named.get("aria-hidden", "").lower() == "true":
            weight, hard = HIDDEN, True
        elif words & BAD_WORDS and not (above.inside_main and words & HEADING_WORDS):
            named_bad = named_bad or name not in BY_TAG
            if not (named_bad and excused):
                weight = min(weight, 0.0) + BAD_WORD
            elif words & GOOD_WORDS:
                weight += GOOD_WORD
        elif words & GOOD_WORDS:
            weight += GOOD_WORD
    verdict = above.verdict
    if above.fixed or (weight > 0 and above.verdict <= -STRONG and name not in ("article", "main")):
        verdict = min(above.verdict, above.verdict + min(weight, 0.0))
    elif abs(weight) >= STRONG or name == "main":
        verdict = weight
    else:
        verdict = above.verdict + weight
    main = (above.inside_main or name in ("article", "main")) and verdict > -STRONG
    return Element(name, verdict, main, above.fixed or hard, named_bad=named_bad)


def blocks_of(html: str, excused: frozenset[int] = frozenset()) -> list[Block]:
    """The blocks of a page in order. Scripts, styles, controls and comments leave no text.

    What an element without text holds ends with it or with the block around it, whichever comes first;
    one that ends nowhere in the rest of the page holds nothing. The names of elements whose numbers are
    ``excused`` do not make them boilerplate.
    """
    root = Element("", 0.0, False, False)
    stack, found, current = [root], [], Block()
    boxes = [root]  # the open elements that are not inline
    opened: dict[str, list[Element]] = {}  # by name
    counter, at, skipping = 0, 0, ""
    inside: dict[str, int] = {}  # blocks open within what is skipped
    last_end: dict[str, int] = {}
    lowered = html.lower() if html.isascii() else re.sub("[A-Z]+", lambda found: found[0].lower(), html)

    def text(piece: str) -> None:
        if not skipping and piece:
            current.parts.append(piece)
            if opened.get("a"):
                current.linked += len(piece.strip())

    def close() -> None:
        nonlocal current
        if any(part and not part.isspace() for part in current.parts):
            own = stack[-1]
            current.parent, current.tag = boxes[-1].number, boxes[-1].name
            current.grandparent = boxes[-2].number if len(boxes) > 1 else 0
            current.verdict, current.inside_main = min(own.verdict, boxes[-1].verdict), own.inside_main
            current.held_by = own if own.named_bad else own.outer
            found.append(current)
        current = Block()

    def shut_from(place: int) -> None:
        """Close the element at a place of the stack and all inside it."""
        while len(stack) > place:
            element = stack.pop()
            opened[element.name].pop()
            if element is boxes[-1]:
                boxes.pop()

    length = len(html)
    while at < length:
        match = TOKEN.search(html, at)
        if not match:
            text(html[at:])
            break
        text(html[at:match.start()])
        at = match.end()
        name = (match["name"] or match["odd"] or "").lower()
        if not name:
            continue
        ending = bool(match["end"] or match["odd_end"])
        if skipping:
            if ending and name == skipping:
                skipping = ""
                continue
            if name not in BLOCKS:
                continue
            if not ending or inside.get(name, 0):
                inside[name] = max(0, inside.get(name, 0) + (-1 if ending else 1))
                continue
            if not opened.get(name):
                continue
            skipping = ""
        if name in NEVER_TEXT:
            if not ending:
                if name in RAW_TEXT:  # nothing inside is markup
                    stop = re.compile(rf"</{name}\b[^>]*+(?:>|\Z)", re.I).search(html, at)
                    at = stop.end() if stop else length
                elif not (match["attrs"] or "").endswith("/"):
                    if name not in last_end:
                        last_end[name] = lowered.rfind(f"</{name}")
                    if last_end[name] >= at:
                        skipping, inside = name, {}
            continue
        if name == "br" or name in VOID:
            text(" ")
            if name == "hr":
                close()
            continue
        if name not in TRACKED:
            continue
        if name in BLOCKS:
            close()
        if ending:
            inner = opened.get(name)
            if inner and (name in BLOCKS or inner[-1].place > boxes[-1].place):  # an inline end closes no block
                shut_from(inner[-1].place)
        else:
            if name in BLOCKS:
                while boxes[-1].name == "p" or boxes[-1].name in CLOSES_ITSELF.get(name, ()):
                    shut_from(boxes[-1].place)
            counter += 1
            above = stack[-1]
            element = _element(name, match["attrs"] or "", above, counter in excused)
            element.number, element.place = counter, len(stack)
            element.outer = above if above.named_bad else above.outer
            stack.append(element)
            opened.setdefault(name, []).append(element)
            if name in BLOCKS:
                boxes.append(element)
    close()
    return found


def log_odds(block: Block, text: str, marked: bool) -> float:
    """How much the classifier is for content. ``marked``: the page has an article with text."""
    words = text.count(" ") + 1
    linked = min(1.0, block.linked / max(1, len(text)))
    odds = block.verdict + LINKED * linked
    if linked < 0.5:
        odds += LONG * min(1.0, words / LONG_WORDS)
        odds += SENTENCE if text[-1:] in ENDS else 0.0
    if block.tag in HEADINGS:
        odds += HEADING
    if not block.inside_main:
        odds += OUTSIDE if marked else 0.0
        if text[:1] == "©" or "all rights reserved" in text.lower():
            odds += LEGAL
    return odds


def edges_of(blocks: list[Block]) -> list[tuple[int, int, float]]:
    """Smoothness edges: to the block before, and to the last earlier one of the same parent."""
    found, last = [], {}
    for number, block in enumerate(blocks):
        if number:
            before = blocks[number - 1]
            near = 0 if before.grandparent == block.grandparent and before.tag == block.tag or before.parent == block.parent \
                else 1 if before.grandparent in (block.grandparent, block.parent) or block.grandparent == before.parent else 2
            found.append((number - 1, number, ADJACENT[near]))
        other = last.get(block.grandparent)
        if other is not None and other < number - 1:
            found.append((other, number, NEAR))
        last[block.grandparent] = number
    return found


def minimum_cut(odds: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """Labels of the cheapest cut: True for content, also where both labels cost the same.

    A node whose own cost outweighs all its edges has the same label in every minimum cut. Such nodes
    are settled first and their edges become costs of the neighbours; the rest is a maximum flow.
    """
    odds, count = list(odds), len(odds)
    ties: list[dict[int, float]] = [{} for _ in odds]
    for one, other, weight in edges:
        ties[one][other] = ties[one].get(other, 0.0) + weight
        ties[other][one] = ties[other].get(one, 0.0) + weight
    label: list[bool | None] = [None] * count
    waiting = deque(range(count))
    while waiting:
        node = waiting.popleft()
        if label[node] is not None or abs(odds[node]) <= sum(ties[node].values()):
            continue
        label[node] = odds[node] > 0
        for other, weight in ties[node].items():
            del ties[other][node]
            odds[other] += weight if label[node] else -weight
            waiting.append(other)
        ties[node] = {}
    free = [node for node in range(count) if label[node] is None]
    if free:
        reached = _source_side(free, odds, ties)
        for node in free:
            label[node] = node in reached
    return [bool(one) for one in label]


def _source_side(nodes: list[int], odds: list[float], ties: list[dict[int, float]]) -> set[int]:
    """Nodes that stay on the side of content: those from which the sink cannot be reached."""
    source, sink, tiny = -1, -2, 1e-9
    rest: dict[int, dict[int, float]] = {node: dict(ties[node]) for node in nodes}
    rest[source], rest[sink] = {}, {}
    for node in nodes:
        if odds[node] > 0:
            rest[source][node], rest[node][source] = odds[node], 0.0
        elif odds[node] < 0:
            rest[node][sink], rest[sink][node] = -odds[node], 0.0
    while True:  # shortest augmenting paths
        came = {source: source}
        queue = deque([source])
        while queue and sink not in came:
            node = queue.popleft()
            for other, capacity in rest[node].items():
                if capacity > tiny and other not in came:
                    came[other] = node
                    queue.append(other)
        if sink not in came:
            break
        path, node = [], sink
        while node != source:
            path.append((came[node], node))
            node = came[node]
        flow = min(rest[a][b] for a, b in path)
        for a, b in path:
            rest[a][b] -= flow
            rest[b][a] = rest[b].get(a, 0.0) + flow
    # Backwards from the sink: whoever can still send something there is boilerplate.
    lost, queue = {sink}, deque([sink])
    while queue:
        node = queue.popleft()
        for other in rest[node]:
            if other not in lost and rest[other].get(node, 0.0) > tiny:
                lost.add(other)
                queue.append(other)
    return set(nodes) - lost


def _wrappers(blocks: list[tuple[Block, str]], marked: bool) -> frozenset[int]:
    """Elements that are boilerplate by their names, but hold most of the page's sentence text.

    On a page that marks its article these are forms only.
    """
    held: dict[int, int] = {}
    known: dict[int, Element] = {}
    total = 0
    for block, text in blocks:
        if text[-1:] in ENDS and 2 * block.linked < len(text):
            total += len(text)
            element = block.held_by
            if element:
                held[element.number] = held.get(element.number, 0) + len(text)
            while element and element.number not in known:
                known[element.number], element = element, element.outer
    for number in sorted(known, reverse=True):  # what is inside has the larger number
        if outer := known[number].outer:
            held[outer.number] = held.get(outer.number, 0) + held[number]
    return frozenset(number for number, size in held.items()
                     if 2 * size > total and (not marked or known[number].name == "form"))


def main_text(html: str) -> str:
    """The blocks labelled content, joined by one space.

    A form around most of a page's sentences is no boilerplate, nor, on a page that marks no article, a
    wrapper around them, whatever its class says; the page is then read again without that verdict.
    """
    def read(excused: frozenset[int]) -> tuple[list[tuple[Block, str]], bool]:
        blocks = [(block, text) for block in blocks_of(html, excused) if (text := block.text)]
        return blocks, any(block.inside_main for block, _ in blocks)

    blocks, marked = read(frozenset())
    if excused := _wrappers(blocks, marked):
        blocks, marked = read(excused)
    odds = [log_odds(block, text, marked) for block, text in blocks]
    labels = minimum_cut(odds, edges_of([block for block, _ in blocks]))
    return " ".join(text for (_, text), content in zip(blocks, labels) if content)


EXTRACTED = T.StructType([T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])


@F.pandas_udf(EXTRACTED)
def extracted(pages: pd.Series) -> pd.DataFrame:
    texts = [main_text(page) for page in pages]
    return pd.DataFrame({"text": texts, "n_chars": [len(text) for text in texts]})


def extract_pages(pages: DataFrame) -> DataFrame:
    """One row per page: page_id, url, text, n_chars (code points).

    The whole page is read. References are decoded, white space inside a block becomes one space, and
    blocks stand in page order. A NULL or empty page, and one without content, has an empty text.
    Markup may be broken or cut off anywhere. Pages are independent, so repeated rows get equal
    texts; other columns are ignored and no rows give no rows.
    """
    return pages.select(
        pages["page_id"], pages["url"], extracted(text_of(pages, "html")).alias("_main"),
    ).select("page_id", "url", "_main.*")
