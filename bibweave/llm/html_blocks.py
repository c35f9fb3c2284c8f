"""HTML to leaf blocks of text with the features that tell an article from its surroundings."""

from __future__ import annotations

import html
import re
from collections import Counter
from dataclasses import dataclass

#: What may stand behind a quoted value that itself holds a tag's end: the tag's end or another attribute.
_AFTER = r"""(?=\s*+/?>|\s++[^\s<>"'=/]++(?:\s*+=|\s*+/?>))"""
#: One attribute: a quote opens a value right after the equals sign only, and only if it is closed like one; else it is a character like any other.
_ATTRIBUTE = rf"""[\s/]*+(?P<key>[^\s/>][^\s/>=]*+)(?:\s*+=\s*+(?:"(?P<v1>[^">]*+)"|'(?P<v2>[^'>]*+)'|"(?P<v3>[^"]*+)"{_AFTER}|'(?P<v4>[^']*+)'{_AFTER}|(?P<v5>[^\s>]*+)))?+"""
_TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<attrs>(?>{re.sub(r'[?]P<[a-z0-9]+>', '?:', _ATTRIBUTE)})*+)[\s/]*+(?:>|\Z)|[^<]+|<",
    re.S,
)
_ATTR = re.compile(_ATTRIBUTE, re.S)
_TOLD = re.compile(r"class|id|role|hidden|style", re.I)
_NO_DISPLAY = re.compile(r"display\s*:\s*none", re.I)
_PIECES = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")
#: Elements whose text is never shown, or belongs to a form; raw ones end only at their own end tag.
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
SKIPPED = frozenset("head noscript template select button option canvas audio video desc metadata defs symbol".split())
#: Parts of a drawing that are not drawn; they may be closed by a slash, and end with the drawing.
UNDRAWN = frozenset("desc metadata defs symbol".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "math mi mn mo ms mtext mrow msup msub msubsup mfrac msqrt mroot mover munder munderover mstyle mpadded mphantom menclose mspace mtable mtr mtd merror semantics "
    "svg g path rect circle ellipse line polyline polygon use tspan textpath image map "
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split()
)
#: Source of a formula, beside what is shown of it.
ANNOTATION = frozenset(("annotation", "annotation-xml"))
#: Tags that an open head can hold; any other one, or text, ends it.
IN_HEAD = frozenset("html head title base link meta script style noscript template".split())
#: Tags that end an open one of the same kind (or group) in the same container.
SIBLINGS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
CONTAINERS = frozenset("ul ol dl table tbody thead tfoot article section nav aside main header footer body div form".split())
_CLOSES_P = frozenset(
    "address article aside blockquote div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split()
)
#: Words of class, id and role attributes, and what they hint at.
HINTS = {
    "nav": "nav navbar navigation menu breadcrumb breadcrumbs topbar toolbar tabs pagination pager toc",
    "header": "header masthead banner brand logo tagline",
    "footer": "footer colophon copyright legal bottom imprint",
    "side": "sidebar aside side rail widget related recommended trending popular tags archive",
    "ad": "ad ads advert adverts advertisement sponsor sponsored promo promotion adsense adslot",
    "notice": "notice cookie cookies consent gdpr popup modal overlay alert newsletter subscribe signup paywall disclaimer",
    "social": "social share sharing follow twitter facebook",
    "comment": "comment comments reply replies disqus discussion respond",
    "form": "form search login input contact",
    "main": "article main content post entry story body text maincontent page",
}
_HINT_OF = {w: kind for kind, words in HINTS.items() for w in words.split()}
_SPACE = re.compile(r"\s+")


#: First pieces of class words that tell a state of the page, not what an element is (``has-sidebar``, ``no-comments``).
STATES = frozenset("has have had no not with without is are hide hides hidden show shows supports enable enabled disable disabled".split())
#: Last pieces of such words (``comments-open``, ``menu-off``).
STATES_BEHIND = frozenset("open opened closed enabled disabled on off none".split())


@dataclass
class Block:
    text: str
    own: str  # the innermost element, of block level
    tags: frozenset  # those of ``TAGS`` that it lies in
    hints: frozenset  # of attributes of elements outside of the article element, if there is one
    inner: frozenset  # of attributes of elements within it
    core: bool | None  # whether it lies in the innermost element that wraps the page; None if there is none
    linked: int  # characters within links
    depth: int


def _attributes(attrs: str) -> list[tuple[str, str]]:
    return [(m["key"].lower(), m["v1"] or m["v2"] or m["v3"] or m["v4"] or m["v5"] or "") for m in _ATTR.finditer(attrs)]


def _hints(pairs: list[tuple[str, str]]) -> frozenset:
    """Hints of the words of class, id and role; words that tell a state give none."""
    found = set()
    for name, value in pairs:
        if name in ("class", "id", "role"):
            for word in value.split():
                pieces = [x.lower() for x in _PIECES.findall(word)]
                if len(pieces) > 1 and (pieces[0] in STATES or pieces[-1] in STATES_BEHIND):
                    continue
                found.update(_HINT_OF[x] for x in pieces if x in _HINT_OF)
    return frozenset(found)


def _hidden(pairs: list[tuple[str, str]]) -> bool:
    """Whether an element has the attribute ``hidden``, is hidden by its style or is marked so for readers."""
    return any(name == "hidden" or (name == "aria-hidden" and value.strip().lower() == "true") or (name == "style" and _NO_DISPLAY.search(value)) for name, value in pairs)


#: Ancestor tags that are features.
TAGS = "nav header footer aside form article main section ul ol dl table figure figcaption blockquote pre address dialog fieldset details menu".split()
_TAG_SET = frozenset(TAGS)
_NONE: frozenset = frozenset()
#: Share of a page's text from which an element is a wrapper of the page, with a heading of the first level and on a page without one.
WRAPS, WRAPS_ALONE = 0.5, 0.8


@dataclass
class _Element:
    name: str
    parent: int
    skip: bool
    hints: frozenset
    text: int = 0  # characters before it, then within it
    headings: int = 0  # the same of headings of the first level


def _surroundings(elements: list[_Element], length: int, headings: int) -> list[tuple[frozenset, frozenset, frozenset, bool | None]]:
    """Tags, outer hints and inner hints of every element, its ancestors' included, and whether it lies in the core; sets are shared, so this is linear.

    Hints of html, body and the outermost article or main say nothing of what an element holds. Nor do those of an element
    that wraps the page: it holds half of all text, and the heading. The innermost of those but html and body is the core.
    """
    out: list[tuple[frozenset, frozenset, frozenset, bool | None]] = []
    wrappers = [i for i, e in enumerate(elements) if e.name not in ("html", "body") and e.text >= WRAPS * length and (e.headings or not headings)]
    core, nowhere = (wrappers[-1], False) if wrappers else (-1, None)
    for i, e in enumerate(elements):
        tags, hints, inner, within = out[e.parent] if e.parent >= 0 else (_NONE, _NONE, _NONE, nowhere)
        inside = "article" in tags or "main" in tags
        found = e.hints
        if found and not inside:
            wraps = e.text >= WRAPS * length and e.headings if headings else e.text >= WRAPS_ALONE * length
            if e.name in ("html", "body", "article", "main") or wraps:
                found = found & {"main"}
        if e.name in _TAG_SET and e.name not in tags:
            tags = tags | {e.name}
        if found and inside:
            inner = inner if found <= inner else inner | found
        elif found:
            hints = hints if found <= hints else hints | found
        out.append((tags, hints, inner, within or i == core if wrappers else None))
    return out


def blocks(page: str) -> list[Block]:
    """Leaf blocks in page order: runs of text that no block-level tag interrupts.

    Character references are decoded once, white space is one space, ``br`` is white space.
    Unclosed and stray tags, cut-off pages and text outside any element are fine.
    """
    made: list[tuple[str, int, int, int]] = []  # text, element, linked characters, depth
    elements: list[_Element] = []
    stack: list[int] = []
    parts: list[str] = []
    state = [0, 0, 0]  # open links, linked characters, skipped elements
    total = [0, 0]  # characters and headings of the first level so far
    open_tags: Counter = Counter()
    annotated = dict.fromkeys(ANNOTATION, True)  # whether an end tag can still follow

    def flush() -> None:
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            parts.clear()
            if text:
                made.append((text, stack[-1] if stack else -1, state[1], len(stack)))
                total[0] += len(text)
        state[1] = 0

    def top() -> str | None:
        return elements[stack[-1]].name if stack else None

    def pop() -> None:
        e = elements[stack.pop()]
        e.text, e.headings = total[0] - e.text, total[1] - e.headings
        open_tags[e.name] -= 1
        if e.skip:
            state[2] -= 1

    def pop_to(names) -> bool:
        """Close elements up to the innermost open one of some names, if there is one."""
        if not any(open_tags[x] for x in names):
            return False
        while True:
            last = top() in names
            pop()
            if last:
                return True

    at, end = 0, len(page)
    while at < end:
        m = _TOKEN.match(page, at)
        at = m.end()
        name = m["name"]
        if name is None:
            s = m[0]
            if top() == "head" and s.strip() and not (s[0] == "<" and len(s) > 1):
                pop()
            if not state[2] and not (s[0] == "<" and len(s) > 1):
                parts.append(s)
                if state[0]:
                    state[1] += len(s.strip())
            continue
        name = name.lower()
        closing = m["end"] == "/"
        if not closing and top() == "head" and name not in IN_HEAD:
            pop()
        if name in ANNOTATION:
            if not closing and annotated[name]:
                close = re.compile(rf"</{name}\b[^>]*(?:>|\Z)", re.I).search(page, at)
                annotated[name] = close is not None
                at = close.end() if close else at
            continue
        if name in UNDRAWN and not closing and m[0].rstrip(">").rstrip().endswith("/"):
            continue
        if name in INLINE:
            while closing and name == "svg" and top() in UNDRAWN:
                pop()
            if name == "a":
                state[0] = 0 if closing else 1
            continue
        if name == "br":
            parts.append(" ")
            continue
        flush()
        state[0] = 0
        if closing:
            pop_to((name,))
            continue
        if name in RAW:
            close = re.compile(rf"</{re.escape(name)}\b[^>]*(?:>|\Z)", re.I).search(page, at)
            at = close.end() if close else end
            continue
        if name in VOID:
            continue
        if name in ("body", "html"):
            while stack and top() != "html":
                pop()
        if name in _CLOSES_P and top() == "p":
            pop()
        if name in SIBLINGS and any(open_tags[x] for x in SIBLINGS[name]):
            for i in range(len(stack) - 1, -1, -1):
                if elements[stack[i]].name in SIBLINGS[name]:
                    pop_to(SIBLINGS[name])
                    break
                if elements[stack[i]].name in CONTAINERS:
                    break
        attrs = m["attrs"] or ""
        pairs = _attributes(attrs) if attrs and _TOLD.search(attrs) else []
        skip = name in SKIPPED or _hidden(pairs)
        if skip:
            state[2] += 1
        total[1] += name == "h1" and not state[2]
        elements.append(_Element(name, stack[-1] if stack else -1, skip, _hints(pairs) if pairs else _NONE, total[0], total[1] - (name == "h1" and not state[2])))
        stack.append(len(elements) - 1)
        open_tags[name] += 1
    flush()
    while stack:
        pop()
    around = _surroundings(elements, *total)
    nowhere = (_NONE, _NONE, _NONE, False if any(a[3] is not None for a in around[:1]) else None)
    return [Block(text, elements[e].name if e >= 0 else "body", *(around[e] if e >= 0 else nowhere), linked, depth) for text, e, linked, depth in made]


OWN = "p h1 h2 h3 h4 h5 h6 li dt dd td th div section article body pre blockquote figcaption caption summary legend span".split()
_SIZES = (2, 5, 10, 20, 40, 80)


def _names() -> list[str]:
    names = ["bias", "cut_header", "cut_footer", "only_body", "stop_end", "letterless", "rights", "all_link", "half_link", "some_link", "has_comma", "first", "last", "lone_upper", "near_stop", "near_long", "in_core", "off_core"]
    names += [f"in_{t}" for t in TAGS] + [f"own_{t}" for t in OWN] + ["own_other"] + [f"hint_{h}" for h in HINTS] + [f"inner_{h}" for h in HINTS]
    return names + [f"size_{i}" for i in range(len(_SIZES) + 1)]


NAMES = _names()
_AT = {n: i for i, n in enumerate(NAMES)}
_OWN_SET = frozenset(OWN)


def features(found: list[Block]) -> list[list[int]]:
    """Numbers of the features that each block has."""
    out = []
    sizes = [b.text.count(" ") + 1 for b in found]
    for k, b in enumerate(found):
        f = [0]
        tags = b.tags
        f += [_AT["in_" + t] for t in tags]
        f += [_AT["hint_" + h] for h in b.hints]
        f += [_AT["inner_" + h] for h in b.inner]
        if b.core is not None:
            f.append(_AT["in_core" if b.core else "off_core"])
        f.append(_AT["own_" + b.own] if b.own in _OWN_SET else _AT["own_other"])
        inside = "article" in tags or "main" in tags
        if inside:
            if "header" in tags:
                f.append(_AT["cut_header"])
            if "footer" in tags:
                f.append(_AT["cut_footer"])
        elif not tags and not b.hints:
            f.append(_AT["only_body"])
        f.append(_AT[f"size_{sum(sizes[k] > s for s in _SIZES)}"])
        text = b.text
        if text[-1] in ".!?\"'”’":
            f.append(_AT["stop_end"])
        if "," in text:
            f.append(_AT["has_comma"])
        low = text.lower()
        if "©" in text or "copyright" in low or "all rights reserved" in low:
            f.append(_AT["rights"])
        link = b.linked / len(text)
        if link > 0.1:
            f.append(_AT["all_link" if link > 0.8 else "half_link" if link > 0.4 else "some_link"])
        if not any(c.isalpha() for c in text):
            f.append(_AT["letterless"])
        if sizes[k] < 6 and text.isupper():
            f.append(_AT["lone_upper"])
        if k == 0:
            f.append(_AT["first"])
        if k == len(found) - 1:
            f.append(_AT["last"])
        if any(0 <= j < len(found) and found[j].text[-1] in ".!?" for j in (k - 1, k + 1)):
            f.append(_AT["near_stop"])
        if any(0 <= j < len(found) and sizes[j] > 20 for j in (k - 1, k + 1)):
            f.append(_AT["near_long"])
        out.append(f)
    return out
