"""A tolerant HTML reader that keeps what extraction needs: a tree of block elements with runs of inline text.

Markup is scanned forward once, character class by character class, and open elements are counted by name, so that the
time is in proportion to the page however broken it is. What can't be read as a tag ends where a browser would end it.
"""

from __future__ import annotations

import html as entities
import re
from functools import lru_cache

#: Elements whose content is never shown as text of the page.
DROPPED = frozenset("script style head title template noscript iframe canvas audio video select option textarea map noembed noframes".split())
#: Of these, elements whose content is raw text up to their end tag.
RAW = frozenset("script style title textarea noscript iframe noembed noframes template".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements of formulas and drawings, whose text runs on in its line.
FORMULA = frozenset("annotation annotation-xml maction math menclose merror mfenced mfrac mi mmultiscripts mn mo mover mpadded mphantom mprescripts mroot mrow ms mspace msqrt mstyle msub msubsup msup mtable mtd mtext mtr munder munderover none semantics svg text tspan g".split())
INLINE = frozenset("a abbr acronym b bdi bdo big button cite code data del dfn em font i ins kbd label mark nobr object q rp rt ruby s samp small span strike strong sub sup time tt u var".split()) | FORMULA
#: Elements whose start ends an open paragraph.
ENDS_P = frozenset("address article aside blockquote center details dialog dir div dl dt dd fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr li main menu nav ol p pre section summary table ul".split())
#: Start tag -> open elements that it ends, and the elements beyond which it does not look.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"table", "tr"}),
    "th": ({"td", "th"}, {"table", "tr"}),
    "thead": ({"tr", "td", "th", "thead", "tbody"}, {"table"}),
    "tbody": ({"tr", "td", "th", "thead", "tbody"}, {"table"}),
    "tfoot": ({"tr", "td", "th", "thead", "tbody"}, {"table"}),
}
WALLS = frozenset({"table", "td", "th", "caption", "html", "button", "object"})
#: Elements deeper than this are read as if they stood beside their parent; marginals need a level for each depth.
DEEPEST = 256

#: Words in class, id or role, and the kind of node that they hint at.
HINTS = {
    "menu": "nav navigation navbar menu breadcrumb breadcrumbs pagination pager tabs toc topbar skip",
    "header": "header masthead banner branding logo sitename heading",
    "footer": "footer foot copyright colophon legal bottom",
    "side": "sidebar side aside widget related recommended popular trending rail complementary more",
    "notice": "notice cookie cookies consent gdpr alert popup modal overlay subscribe newsletter paywall disclaimer warning message",
    "advert": "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion promoted banner-ad adsense dfp commercial",
    "form": "form login signin signup search register contact",
    "comment": "comment comments commentlist disqus discussion replies reply respond reviews review responses",
    "share": "share sharing social follow like tweet tags meta byline author",
    "main": "article content main post story entry body text prose page articlebody maincontent",
}
KINDS = ["none", *HINTS]
_KIND = {w: i + 1 for i, ws in enumerate(HINTS.values()) for w in ws.split()}

_OPEN = re.compile(r"<(?:[A-Za-z]|/[A-Za-z]|[!?/])")
_NAME = re.compile(r"[^\s/>\x00]+")
#: One attribute after another: a name, and a value that is quoted, bare or missing. A quote that never ends takes no value.
_ATTRIBUTE = re.compile(r"[\s/]*([^\s/>=][^\s/>=]*)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"'][^\s>]*))?)?")
_USED = frozenset({"class", "id", "role", "data-main"})
_CAMEL, _LETTERS = re.compile(r"([a-z])([A-Z])"), re.compile(r"[^a-z]+")


@lru_cache(20_000)
def hint_of(value: str) -> tuple[int, ...]:
    """Kinds that the words of an attribute's value hint at, in order."""
    return tuple(k for w in _LETTERS.split(_CAMEL.sub(r"\1-\2", value).lower()) if (k := _KIND.get(w, 0)))


class _Quotes:
    """Whether a quote that opens at a place is ever closed; the last place of each kind of quote is looked up once."""

    def __init__(self, source: str):
        self.last = {q: source.rfind(q) for q in "\"'"}


def read_tag(source: str, at: int, quotes: _Quotes) -> tuple[int, int, str | None]:
    """(end, hint, label in data-main) of the attributes from a place after the tag's name on.

    end is behind the tag's ">", or the page's end where there is none. In a value whose quote is never closed the quote
    is an ordinary character, and the tag ends at the next ">". Of several hints the first that is not main wins.
    """
    hint, label, end = 0, None, len(source)
    while at < end:
        c = source[at]
        if c == ">":
            return at + 1, hint, label
        if c.isspace() or c == "/":
            at += 1
            continue
        stop = at + 1  # a name may start with "="
        while stop < end and not (source[stop].isspace() or source[stop] in "/>="):
            stop += 1
        name, at = source[at:stop], stop
        gap = at
        while gap < end and source[gap].isspace():
            gap += 1
        value = None
        if gap < end and source[gap] == "=":
            at = gap + 1
            while at < end and source[at].isspace():
                at += 1
            if at < end and source[at] in "\"'" and quotes.last[source[at]] > at:
                close = source.index(source[at], at + 1)
                value, at = source[at + 1 : close], close + 1
            else:
                stop = at
                while stop < end and not source[stop].isspace() and source[stop] != ">":
                    stop += 1
                value, at = source[at:stop], stop
        if value and len(name) <= 9 and (name := name.lower()) in _USED:
            value = entities.unescape(value) if "&" in value else value
            if name == "data-main":
                label = value
            else:
                for k in hint_of(value[:1000]):
                    if not hint or KINDS[hint] == "main":
                        hint = k
    return end, hint, label


class Page:
    """Nodes in page order. tag: element name, or '#' for a run of text; runs carry text, link characters and a block."""

    __slots__ = ("tag", "parent", "depth", "hint", "label", "text", "linked", "block")

    def __init__(self) -> None:
        self.tag, self.parent, self.depth, self.hint = ["#root"], [-1], [0], [0]
        self.label: list[str | None] = [None]
        self.text: list[str | None] = [None]
        self.linked, self.block = [0], [0]

    def add(self, tag: str, parent: int, hint: int = 0, label: str | None = None, text: str | None = None, linked: int = 0, block: int = 0) -> int:
        self.tag.append(tag)
        self.parent.append(parent)
        self.depth.append(self.depth[parent] + 1)
        self.hint.append(hint)
        self.label.append(self.label[parent] if label is None else label)
        self.text.append(text)
        self.linked.append(linked)
        self.block.append(block)
        return len(self.tag) - 1


class _Reader:
    """Open elements and the run of text that is being read."""

    def __init__(self) -> None:
        self.page = Page()
        self.names, self.nodes = ["#root"], [0]  # open elements; inline ones have their parent's node
        self.open: dict[str, int] = {}  # how many elements of a name are open
        self.run: list[str] = []
        self.linked = self.block = self.links = self.hidden = 0

    def flush(self) -> None:
        page = self.page
        if self.run:
            text = "".join(self.run)
            if not text.isspace():
                page.add("#", self.nodes[-1], text=text, linked=self.linked, block=self.block)
            elif page.tag[-1] == "#" and page.block[-1] == self.block:
                page.text[-1] += " "
            self.run.clear()
        self.linked = 0

    def new_block(self) -> None:
        self.flush()
        self.block += 1

    def say(self, raw: str) -> None:
        if raw and not self.hidden:
            text = entities.unescape(raw) if "&" in raw else raw
            self.run.append(text)
            if self.links:
                self.linked += len(text)

    def push(self, tag: str, node: int) -> None:
        self.names.append(tag)
        self.nodes.append(node)
        self.open[tag] = self.open.get(tag, 0) + 1
        self.links += tag == "a"
        self.hidden += tag in DROPPED

    def pop_to(self, k: int) -> None:
        while len(self.names) > k:
            tag = self.names[-1]
            if self.nodes[-1] != self.nodes[-2] or tag in DROPPED:
                self.flush()
            if tag not in INLINE:
                self.new_block()
            self.links -= tag == "a"
            self.hidden -= tag in DROPPED
            self.open[tag] -= 1
            self.names.pop()
            self.nodes.pop()

    def end(self, which: set[str] | frozenset[str], walls: set[str] | frozenset[str]) -> None:
        """Close the innermost open element of which, unless a wall stands before it. The search passes over elements
        only if one of which is open, and stops at walls, so it is short wherever pages nest as they should."""
        if not any(self.open.get(t) for t in which):
            return
        for k in range(len(self.names) - 1, max(0, len(self.names) - 1 - DEEPEST), -1):
            if self.names[k] in which:
                self.pop_to(k)
                return
            if self.names[k] in walls:
                return

    def start(self, tag: str, hint: int, label: str | None) -> None:
        if tag == "body":
            self.end({"head"}, frozenset())
        if tag in ENDS_P:
            self.end({"p"}, WALLS)
        if tag in ENDS:
            self.end(*ENDS[tag])
        node = self.nodes[-1]
        deep = self.page.depth[node] >= DEEPEST
        if tag in INLINE:
            if (hint and KINDS[hint] != "main" or label is not None) and not deep:
                self.flush()
                node = self.page.add(tag, node, hint, label)
        else:
            self.new_block()
            if tag not in DROPPED and not deep:
                node = self.page.add(tag, node, hint, label)
        self.push(tag, node)

    def close(self, tag: str) -> None:
        if not self.open.get(tag):
            return
        for k in range(len(self.names) - 1, max(0, len(self.names) - 1 - DEEPEST), -1):
            if self.names[k] == tag:
                self.pop_to(k)
                return
            if tag in INLINE and self.names[k] not in INLINE or self.names[k] in {"td", "th", "table"} and tag in {"p", "div", "span", "li"}:
                return


@lru_cache(32)
def _end_of(tag: str) -> re.Pattern:
    return re.compile(rf"</{tag}(?=[\s/>])", re.I)


def read(source: str) -> Page:
    r = _Reader()
    quotes = _Quotes(source)
    unclosed: set[str] = set()  # raw elements and comments without an end from here on
    at, end = 0, len(source)
    while at < end:
        found = _OPEN.search(source, at)
        if not found:
            r.say(source[at:])
            break
        r.say(source[at : found.start()])
        at, kind = found.end(), source[found.start() + 1]
        if kind.isalpha():
            name = _NAME.match(source, found.start() + 1)
            tag = name[0].lower()
            at, hint, label = read_tag(source, name.end(), quotes)
            if tag in VOID:
                if tag == "hr":
                    r.new_block()
                elif not r.hidden:
                    r.run.append(" " if tag == "br" else "")
            elif tag in RAW:
                close = None if tag in unclosed else _end_of(tag).search(source, at)
                if close is None:
                    unclosed.add(tag)
                at = read_tag(source, close.end(), quotes)[0] if close else end
            else:
                r.start(tag, hint, label)
        elif kind == "/" and source[at - 1].isalpha():
            name = _NAME.match(source, at - 1)
            at = _behind(source, ">", name.end())
            r.close(name[0].lower())
        elif source.startswith("<!--", found.start()):
            at = _comment_end(source, found.start() + 4)
        else:  # a declaration, an instruction, or an end tag without a name
            at = _behind(source, ">", at)
    r.flush()
    return r.page


def _behind(source: str, what: str, at: int) -> int:
    found = source.find(what, at)
    return len(source) if found < 0 else found + len(what)


def _comment_end(source: str, at: int) -> int:
    """Behind the comment that starts before at: "-->" or "--!>", or at once "<!-->" and "<!--->"."""
    for short in (">", "->"):
        if source.startswith(short, at):
            return at + len(short)
    ends = [x + n for x, n in ((source.find("-->", at), 3), (source.find("--!>", at), 4)) if x >= 0]
    return min(ends, default=len(source))
