"""Text blocks of a web page, with what surrounds them."""

from __future__ import annotations

import html
import re
from dataclasses import dataclass, field

#: Comments, elements closed where they open, elements whose content is not text, declarations, and tags.
MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<(?:noscript|template|iframe|svg|select|object|canvas)\b(?:[^>\"']|\"[^\"]*\"|'[^']*')*/>"
    r"|<(script|style|noscript|template|textarea|title|iframe|svg|select|object|canvas)\b[^>]*>"
    r".*?(?:</\1\s*>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>",
    re.DOTALL | re.IGNORECASE,
)
NAMED = re.compile(r"\b(?:class|id|role|aria-label)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.IGNORECASE)
LETTERS = re.compile(r"[a-z]+")

#: Elements that begin and end a block.
BLOCKS = frozenset(
    "address article aside blockquote body button caption center dd details dialog div dl dt fieldset figcaption"
    " figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre section"
    " summary table tbody td tfoot th thead tr ul".split()
)
#: An opening tag of these closes an open one of the same group, if no element of the last set is between.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}}
CLOSES["th"] = CLOSES["td"]
HOLDERS = frozenset("ul ol dl table tbody thead tfoot".split())
VOID = frozenset(["hr"])

#: Elements and words in names that speak against the article, wherever they are.
AROUND = frozenset("nav footer aside dialog menu button".split())
AROUND_WORDS = frozenset(
    "ad ads advert advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies"
    " disqus footer masthead menu menubar modal nav navbar navigation newsletter notice pager pagination popup promo"
    " promotion recommended related reply replies respond share sharing sidebar social sponsor sponsored subscribe"
    " toolbar widget complementary contentinfo alert".split()
)
#: A name with one of these tells the state of an element: ``comments-open``, ``with-sidebar``.
STATE_WORDS = frozenset("with without has no is open opened closed enabled disabled on off allowed".split())
#: Those that speak for the article, and those that speak against it unless they are inside of one.
ARTICLE = frozenset(["article", "main"])
ARTICLE_WORDS = frozenset("article articlebody content entry post story".split())
WEAK = frozenset(["header"])
WEAK_WORDS = frozenset(["form", "header", "search", "login", "signup"])
ROOTS = frozenset(["html", "body"])
#: How much a name says, next to a tag or a name that is one of the words or begins or ends with one.
CERTAIN, LIKELY, HINT = 1.0, 0.5, 0.25


def against(name: str) -> float:
    """How much a class or another name speaks against the article."""
    words = LETTERS.findall(name)
    if not AROUND_WORDS.intersection(words):
        return 0.0
    if STATE_WORDS.intersection(words):
        return HINT
    return CERTAIN if words[0] in AROUND_WORDS or words[-1] in AROUND_WORDS else LIKELY


@dataclass
class Element:
    tag: str
    number: int
    depth: int
    #: What the names of the element and those around it say for and against the article, from 0 to 1.
    inside: float
    outside: float
    #: In a form, and no article between.
    form: bool


@dataclass
class Block:
    text: str
    element: Element
    parent: int
    #: Share of the characters that are in links.
    linked: float
    #: Depth of the deepest element around both this block and the one before.
    shared: int


@dataclass
class _Page:
    stack: list[Element] = field(default_factory=list)
    blocks: list[Block] = field(default_factory=list)
    parts: list[str] = field(default_factory=list)
    link_chars: int = 0
    in_link: bool = False
    lowest: int = 0
    count: int = 0

    def flush(self) -> None:
        if self.parts:
            text = " ".join("".join(self.parts).split())
            if text:
                element = self.stack[-1]
                parent = self.stack[-2].number if len(self.stack) > 1 else -1
                linked = min(1.0, self.link_chars / len(text))
                self.blocks.append(Block(text, element, parent, linked, self.lowest))
                self.lowest = element.depth
        self.parts, self.link_chars, self.in_link = [], 0, False

    def open(self, tag: str, attributes: str) -> None:
        around = self.stack[-1]
        inside, outside, form = around.inside, around.outside, around.form or tag == "form"
        if tag not in ROOTS:
            names = []
            if "=" in attributes:
                names = " ".join(next(filter(None, x), "") for x in NAMED.findall(attributes)).lower().split()
            words = {word for name in names for word in LETTERS.findall(name)}
            if tag in AROUND:
                outside = CERTAIN
            elif tag not in ("main", "p"):
                outside = max([outside, *map(against, names)])
            if outside < CERTAIN and (tag in ARTICLE or words & ARTICLE_WORDS):
                inside, form = CERTAIN, form and tag not in ARTICLE
            elif not inside and (tag in WEAK or words & WEAK_WORDS):
                outside = max(outside, LIKELY)
        self.count += 1
        self.stack.append(Element(tag, self.count, len(self.stack), inside, outside, form))

    def close(self, tags: set[str], stop: frozenset[str] = frozenset()) -> None:
        for place in range(len(self.stack) - 1, 0, -1):
            if self.stack[place].tag in tags:
                del self.stack[place:]
                self.lowest = min(self.lowest, place - 1)
                return
            if self.stack[place].tag in stop:
                return


def blocks_of(page: str) -> list[Block]:
    """Blocks with visible text, in page order."""
    now = _Page()
    now.stack.append(Element("", 0, 0, 0.0, 0.0, False))
    at = 0
    for match in MARKUP.finditer(page):
        if match.start() > at:
            _text(now, page[at : match.start()])
        at = match.end()
        tag = (match[3] or "").lower()
        if not tag:
            continue
        if tag == "br":
            now.parts.append(" ")
        elif tag == "a":
            now.in_link = not match[2]
        elif tag in ("img", "input"):
            now.parts.append(" ")
        elif tag in BLOCKS:
            now.flush()
            if match[2]:
                now.close({tag})
            else:
                now.close({"p"}, BLOCKS - {"p"})
                if tag in CLOSES:
                    now.close(CLOSES[tag], HOLDERS)
                if tag not in VOID:
                    now.open(tag, match[4])
    if at < len(page):
        _text(now, page[at:])
    now.flush()
    return now.blocks


def _text(now: _Page, raw: str) -> None:
    text = html.unescape(raw) if "&" in raw else raw
    now.parts.append(text)
    if now.in_link:
        now.link_chars += len(text.strip())
