"""Lenient reading of HTML into containers and text blocks, for extraction of the main text.

Covers what pages in the wild need: unclosed and misnested tags, raw-text elements, comments, character
references. Boilerplate elements, by tag, role or class words, are left out while reading.
"""

from __future__ import annotations

import html as entities
import re
from dataclasses import dataclass, field

# --- fixed values: what HTML defines, and words pages use to name their parts ---
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp noembed noframes".split())
BLOCK = frozenset(
    "html body main article section div header footer nav aside p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead tbody tfoot tr td th caption"
    " blockquote pre figure figcaption address form fieldset details summary hr br center hgroup".split()
)
CONTAINERS = frozenset("html body main article section div td center blockquote".split())
CLOSES_PARAGRAPH = BLOCK - {"br", "td", "th", "tr", "tbody", "thead", "tfoot", "caption", "html", "body"}
SAME_CLOSES = {"li": {"ul", "ol"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"tr", "table"}, "th": {"tr", "table"}, "option": {"select"}}
DROPPED = frozenset(
    "head script style noscript template nav footer aside form iframe object svg canvas audio video button select textarea dialog menu title xmp noembed noframes".split()
)
DROPPED_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar".split())
DROPPED_WORDS = frozenset(
    "nav navbar navigation menu submenu breadcrumb breadcrumbs footer masthead sidebar aside rail ad ads adv advert adverts advertising advertisement"
    " adsense banner sponsor sponsored promo promos promotion promoted cookie cookies consent gdpr notice notices notification alert popup modal overlay"
    " comment comments commentlist disqus respond reply replies share sharing social related recommended recommendations newsletter subscribe"
    " subscription signup login search searchbox pagination pager widget widgets toolbar copyright disclaimer hidden".split()
)
MAIN_WORDS = frozenset("article content post entry main story body text".split())
#: What is read outside boilerplate is little if an element left out for its name holds more than this multiple of it.
LITTLE = 10
NOT_WORDS = frozenset("with has no without".split())

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>", re.S
)
_ATTRIBUTE = re.compile(r"\b(class|id|role|hidden|aria-hidden|style)\s*(?:=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?", re.I)
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")
_SPACE = re.compile(r"\s+")


@dataclass
class Node:
    """A container element: its generalised path and the blocks it spans."""

    path: str
    depth: int
    start: int
    end: int = -1
    semantic: bool = False


@dataclass
class Page:
    blocks: list[str] = field(default_factory=list)
    #: Characters of each block outside links.
    plain: list[int] = field(default_factory=list)
    nodes: list[Node] = field(default_factory=list)

    def text(self, start: int, end: int) -> str:
        return " ".join(self.blocks[start:end])

    def chars(self, start: int, end: int) -> int:
        return sum(self.plain[start:end])


def attributes(raw: str) -> dict[str, str]:
    return {k.lower(): (v or "").strip("\"'") for k, v in _ATTRIBUTE.findall(raw)} if raw else {}


def name_words(attrs: dict[str, str]) -> list[list[str]]:
    """The words of each class name and of the id."""
    names = attrs.get("class", "").split() + attrs.get("id", "").split()
    return [[w.lower() for w in _WORDS.findall(n)] for n in names]


def is_boilerplate(tag: str, attrs: dict[str, str], inside_main: bool) -> bool:
    return is_unseen(tag, attrs) or is_named_boilerplate(tag, attrs, inside_main)


def is_unseen(tag: str, attrs: dict[str, str]) -> bool:
    """Whether the element's tag, role or style says that it is no part of the text, whatever it holds."""
    if tag in DROPPED - {"form"}:
        return True
    if tag in ("html", "body", "main", "article"):
        return False
    if attrs.get("role", "").lower() in DROPPED_ROLES or "hidden" in attrs or attrs.get("aria-hidden", "").lower() == "true":
        return True
    return "display:none" in attrs.get("style", "").replace(" ", "").lower()


def is_named_boilerplate(tag: str, attrs: dict[str, str], inside_main: bool) -> bool:
    """Whether the element is a form or header or named like boilerplate; wrappers of whole pages are, too."""
    if tag in ("html", "body", "main", "article"):
        return False
    if tag == "form":
        return True
    header = tag == "header"
    for words in name_words(attrs):
        for k, word in enumerate(words):
            if word in DROPPED_WORDS and not NOT_WORDS.intersection(words[:k]):
                return True
        header = header or ("header" in words and not MAIN_WORDS.intersection(words))
    return header and not inside_main


def generalised(tag: str, attrs: dict[str, str]) -> str:
    """A tag with its first class name, numbers made equal, so that pages of one template agree."""
    names = attrs.get("class", "").split()
    return f"{tag}.{re.sub(r'[0-9]+', '0', names[0].lower())}" if names else tag


@dataclass
class Doubtful:
    """An element left out for its name: where it begins, the one around it, and what it holds besides further ones."""

    at: int
    around: Doubtful | None
    chars: int = 0
    headed: bool = False


def read_page(source: str) -> Page:
    """Blocks and containers of the page outside its boilerplate.

    The page is read again without the rules on names for elements that turn out to wrap its main text.
    """
    lifted: frozenset[int] = frozenset()
    while True:
        page, doubtful = _read(source, lifted)
        more = _wrappers(page, doubtful)
        if not more:
            return page
        lifted |= more


def _wrappers(page: Page, doubtful: list[Doubtful]) -> frozenset[int]:
    """Where elements begin that were left out for their names but hold the main text.

    They hold at least as much text as was read, and an article, a main element or a first heading; where
    none does and what was read is little, the smallest with most of the text left out.
    """
    chars, headed = [x.chars for x in doubtful], [x.headed for x in doubtful]
    place = {id(x): k for k, x in enumerate(doubtful)}
    for k in range(len(doubtful) - 1, -1, -1):  # inner elements follow outer ones
        if (around := doubtful[k].around) is not None:
            chars[place[id(around)]] += chars[k]
            headed[place[id(around)]] |= headed[k]
    read = page.chars(0, len(page.blocks))
    chosen = [k for k in range(len(doubtful)) if headed[k] and chars[k] and chars[k] >= read]
    if not chosen:
        total = sum(x.chars for x in doubtful)
        most = [k for k in range(len(doubtful)) if 2 * chars[k] > total and chars[k] > LITTLE * read]
        chosen = most[-1:]
    found: set[int] = set()
    for k in chosen:
        x: Doubtful | None = doubtful[k]
        while x is not None:
            found.add(x.at)
            x = x.around
    return frozenset(found)


def _read(source: str, lifted: frozenset[int]) -> tuple[Page, list[Doubtful]]:
    page = Page()
    doubtful: list[Doubtful] = []
    # open elements left out for their names, innermost last
    doubts: list[Doubtful] = []
    # open elements: tag, container (or None), whether boilerplate starts here, and whether for its name only
    stack: list[tuple[str, Node | None, bool, bool]] = []
    path: list[str] = []
    pieces: list[str] = []
    state = {"dropped": 0, "links": 0, "main": 0, "linked": 0}

    def flush() -> None:
        text = _SPACE.sub(" ", entities.unescape("".join(pieces))).strip()
        pieces.clear()
        if text:
            page.blocks.append(text)
            page.plain.append(max(0, len(text) - state["linked"]))
        state["linked"] = 0

    def pop() -> None:
        tag, node, dropped, named = stack.pop()
        if tag in BLOCK:
            flush()
        if node is not None:
            node.end = len(page.blocks)
            path.pop()
        state["dropped"] -= dropped
        if named:
            doubts.pop()
        state["links"] -= tag == "a"
        state["main"] -= tag in ("main", "article")

    def close_through(tag: str, stop: frozenset[str] | set[str]) -> None:
        for k in range(len(stack) - 1, -1, -1):
            if stack[k][0] == tag:
                while len(stack) > k:
                    pop()
                return
            if stack[k][0] in stop:
                return

    def add(text: str) -> None:
        if text and not state["dropped"]:
            pieces.append(text)
            if state["links"]:
                state["linked"] += len(text)
        elif doubts and not state["links"] and state["dropped"] == len(doubts):
            doubts[-1].chars += len(text.strip())

    at, n = 0, len(source)
    while at < n:
        found = _TAG.search(source, at)
        if found is None:
            add(source[at:])
            break
        add(source[at : found.start()])
        at = found.end()
        tag = (found[2] or found[5] or "").lower()
        if not tag:
            continue
        if found[1] or found[4]:
            if any(x[0] == tag for x in stack):
                close_through(tag, frozenset())
            elif tag in BLOCK and not state["dropped"]:
                flush()
            continue
        raw = found[3] or found[6] or ""
        if tag in BLOCK:  # content ends a head that was never closed
            close_through("head", frozenset())
        if tag in CLOSES_PARAGRAPH:
            close_through("p", CONTAINERS | {"table"})
        if tag in SAME_CLOSES:
            close_through(tag, SAME_CLOSES[tag])
            if tag in ("dt", "dd", "td", "th"):
                close_through({"dt": "dd", "dd": "dt", "td": "th", "th": "td"}[tag], SAME_CLOSES[tag])
        if tag in VOID:
            if tag in BLOCK and not state["dropped"]:
                if tag == "br":
                    pieces.append(" ")
                else:
                    flush()
            continue
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}\b[^>]*>", re.I).search(source, at)
            at = end.end() if end else n
            continue
        attrs = attributes(raw)
        unseen = is_unseen(tag, attrs)
        named = not unseen and found.start() not in lifted and is_named_boilerplate(tag, attrs, state["main"] > 0)
        dropped = unseen or named
        if doubts and tag in ("article", "main", "h1") and state["dropped"] == len(doubts):
            doubts[-1].headed |= not any(DROPPED_WORDS.intersection(words) for words in name_words(attrs))
        if tag in BLOCK:
            if not state["dropped"]:
                flush()
        node = None
        if tag in CONTAINERS and not dropped and not state["dropped"]:
            path.append(generalised(tag, attrs))
            node = Node("/".join(path), len(path), len(page.blocks), semantic=tag in ("article", "main") or attrs.get("role") == "main")
            page.nodes.append(node)
        stack.append((tag, node, dropped, named))
        if named:
            doubts.append(Doubtful(found.start(), doubts[-1] if doubts else None))
            doubtful.append(doubts[-1])
        state["dropped"] += dropped
        state["links"] += tag == "a"
        state["main"] += tag in ("main", "article")
    while stack:
        pop()
    flush()
    return page, doubtful


#: A block of this many characters outside links is article text; a shorter one if it ends as a sentence.
LONG_BLOCK, SENTENCE = 80, 25
_SENTENCE_END = re.compile(r"[.!?\u2026\u3002\uff01\uff1f\u0964\u061f][)\]\"'\u201d\u2019\u00bb]*$")


def article_blocks(page: Page) -> list[int]:
    """The numbers of the blocks that read as article text; where none does, of all with text outside links."""
    found = [
        k for k, (text, plain) in enumerate(zip(page.blocks, page.plain, strict=True))
        if 2 * plain >= len(text) and (plain >= LONG_BLOCK or plain >= SENTENCE and _SENTENCE_END.search(text))
    ]
    return found or [k for k, plain in enumerate(page.plain) if plain]


def best_container(page: Page) -> Node | None:
    """The deepest container that holds all article text of the page; article and main elements that do are preferred."""
    wanted = article_blocks(page)
    holding = [x for x in page.nodes if wanted and x.start <= wanted[0] and wanted[-1] < x.end]
    if not holding:
        return None
    return max([x for x in holding if x.semantic] or holding, key=lambda x: (x.depth, -x.start))


def outermost(page: Page, path: str) -> list[Node]:
    """The containers with this path, in page order."""
    out: list[Node] = []
    for node in page.nodes:
        if node.path == path and not (out and node.start < out[-1].end):
            out.append(node)
    return out
