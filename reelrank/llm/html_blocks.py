"""Leaf text blocks of an HTML page, with the features a labeller reads.

A block is a run of text between two block-level borders; inline markup does
not end it. Element ends that authors leave out are implied (a paragraph ends
where the next block begins). Raw-text elements give no block.
"""

from __future__ import annotations

import html
import re
from collections.abc import Container, Iterable, Iterator
from dataclasses import dataclass

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small "
                   "span strike strong sub sup time tt u var br wbr img".split())
#: These run to their end tag or, as browsers read them, to the end of the page.
RAW = frozenset("script style iframe title textarea noframes".split())
#: These are skipped up to their end tag; without one they are elements like others.
SKIPPED = frozenset("template svg select object".split())
#: Elements whose start ends an open element of the set, up to the given fence.
_CLOSES = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
           "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}),
           "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"})}
#: A tag without a "<" in it, as most are: an attempt ends at the next "<".
_SIMPLE = re.compile(r"""<(/?)([a-zA-Z][^\s/>"'<]*+)(?=[\s/>])((?:[^>"'<]|"[^"<]*"|'[^'<]*')*+)>""")
_NAME = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)")
_RAW_START = re.compile(rf"<({'|'.join(sorted(RAW))})(?=[\s/]|\Z)", re.I)
_QUOTE_OR_END = re.compile("[>\"']")
_END_TAG = {tag: re.compile(rf"</{tag}\s*>", re.I) for tag in RAW | SKIPPED}
#: A decimal reference of more digits than any character has.
_LONG_REFERENCE = re.compile(r"&#0*([0-9]{8})[0-9]*|&#0{7,}([0-9]{0,7})(?![0-9])")
_NAMES = re.compile(r"""(?:^|\s)(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
_PART = re.compile(r"[a-z]+")


class _Scanner:
    """Markup of a page from left to right, in time linear in its length.

    The scanner moves forward only. A search that found nothing, or something
    far ahead, is not made again before that place; quotes from which no tag
    comes to an end are remembered, so each is followed once.
    """

    def __init__(self, page: str):
        self.page = page
        self._ahead: dict[str, tuple[int, int]] = {}
        self._dead: set[int] = set()

    def _next(self, what: str, pattern: re.Pattern | None, at: int) -> tuple[int, int]:
        """Begin and end of the first ``what`` from ``at`` on (never less than
        before); the page's length twice where there is none."""
        found = self._ahead.get(what)
        if found is None or found[0] < at:
            n = len(self.page)
            if pattern is None:
                begin = self.page.find(what, at)
                found = (n, n) if begin < 0 else (begin, begin + len(what))
            else:
                m = pattern.search(self.page, at)
                found = m.span() if m else (n, n)
            self._ahead[what] = found
        return found

    def _tag_end(self, at: int) -> int:
        """Place of the first ">" outside quotes from ``at`` on, -1 if there is none."""
        page, followed = self.page, []
        place = self._next("quote or end", _QUOTE_OR_END, at)[0]
        while place < len(page) and page[place] != ">" and place not in self._dead:
            followed.append(place)
            close = page.find(page[place], place + 1)
            m = _QUOTE_OR_END.search(page, close + 1) if close >= 0 else None
            place = m.start() if m else len(page)
        if place < len(page) and page[place] == ">":
            return place
        self._dead.update(followed)
        return -1

    def _markup(self, at: int) -> tuple[int, bool, str, str]:
        """End of the markup that begins with the "<" at ``at`` (-1: it is text),
        whether it is an end tag, its name (none: no element) and attributes."""
        page, n = self.page, len(self.page)
        m = _SIMPLE.match(page, at)
        if m:
            ending, name, attributes, end = m[1] == "/", m[2].lower(), m[3], m.end()
            after_name = m.end(2)
        elif page.startswith("<!--", at):
            close = page.find("-->", at + 4)
            return (n if close < 0 else close + 3), False, "", ""
        else:
            first_end = self._next(">", None, at)[1]
            if self._next(">", None, at)[0] == n:  # no tag ends from here on
                return (n if _RAW_START.match(page, at) else -1), False, "", ""
            if page[at + 1] in "!?":
                return first_end, False, "", ""
            m = _NAME.match(page, at)
            if not m:
                return -1, False, "", ""
            ending, name, after_name = m[1] == "/", m[2].lower(), m.end()
            if not ending and name in RAW:
                attributes, end = "", -1
            else:
                close = self._tag_end(after_name)
                attributes, end = (page[after_name:close], close + 1) if close >= 0 else ("", -1)
        if not ending and name in RAW:
            return self._next(name, _END_TAG[name], after_name)[1], False, "", ""
        if not ending and name in SKIPPED:
            if name == "svg" and attributes.endswith("/"):
                return end, False, "", ""
            begin, close = self._next(name, _END_TAG[name], after_name)
            if begin < n:
                return close, False, "", ""
        if end < 0:  # its quotes never close: markup up to the first ">"
            return first_end, False, "", ""
        return end, ending, name, attributes

    def __iter__(self) -> Iterator[tuple[int, int, bool, str, str]]:
        at = 0
        while (at := self.page.find("<", at)) >= 0:
            end, *element = self._markup(at)
            if end < 0:
                at += 1
            else:
                yield at, end, *element
                at = end


@dataclass
class Block:
    """Text with references decoded and white space collapsed, and its features."""

    text: str
    features: list[str]
    ancestors: tuple[str, ...]


def _references(text: str) -> str:
    """Character references decoded; numbers of any length are allowed."""
    if "&#" in text:
        text = _LONG_REFERENCE.sub(lambda m: "&#" + (m[1] or m[2] or "0"), text)
    return html.unescape(text)


def _element_features(tag: str, attributes: str, known: Container[str] | None) -> tuple[str, ...]:
    names = [] if tag in ("html", "body") else [f"in:{tag}"]  # all pages have these or imply them
    if attributes:
        for match in _NAMES.finditer(attributes):
            names += [f"name:{p}" for p in _PART.findall((match[1] or match[2] or match[3] or "").lower())]
    return tuple(names if known is None else [f for f in names if f in known])


def _bucket(n: float, cuts: tuple[float, ...]) -> int:
    return sum(n >= c for c in cuts)


def _text_features(text: str, linked: int, tag: str) -> list[str]:
    words = text.count(" ") + 1
    digits = sum(map(str.isdigit, text)) if len(text) < 400 else 0
    return ["bias", f"words:{_bucket(words, (2, 4, 8, 15, 30, 60))}",
            f"linked:{_bucket(linked / len(text), (0.01, 0.3, 0.7))}", f"ends:{text[-1] if text[-1] in '.!?:…' else '-'}",
            f"digits:{_bucket(digits / len(text), (0.05, 0.3))}", f"tag:{tag}",
            "mark:copyright" if "©" in text else "mark:none"]


def blocks(page: str | None, known: Container[str] | None = None) -> list[Block]:
    """The leaf blocks of a page in order (none for a null or empty page).

    With ``known``, only those features of ancestors are told. Time and memory
    are linear in the page's length then, however deep its elements lie.
    """
    out: list[Block] = []
    stack: list[tuple[str, tuple[str, ...]]] = []
    places: dict[str, list[int]] = {}  # where the open elements of a name lie
    solid: list[int] = []              # where those that are not inline lie
    held: dict[str, int] = {}          # how many open elements have a feature, outermost first
    parts: list[str] = []
    linked = 0

    def nearest(tags: Iterable[str]) -> int:
        return max((places[t][-1] for t in tags if places.get(t)), default=-1)

    def flush() -> None:
        nonlocal linked
        if parts:
            text = " ".join(_references("".join(parts)).split())
            parts.clear()
            if text:
                own = stack[solid[-1]][0] if solid else "none"
                out.append(Block(text, _text_features(text, min(linked, len(text)), own) + list(held), tuple(held)))
        linked = 0

    def say(text: str) -> None:
        nonlocal linked
        if text:
            parts.append(text)
            if places.get("a"):
                linked += len(text)

    def drop(at: int) -> None:
        while len(stack) > at:
            tag, names = stack.pop()
            places[tag].pop()
            if tag not in INLINE:
                solid.pop()
            for f in names:
                held[f] -= 1
                if not held[f]:
                    del held[f]

    if not page:
        return out
    last = 0
    for begin, end, ending, tag, attributes in _Scanner(page):
        say(page[last:begin])
        last = end
        if not tag:
            continue
        if ending:  # an end tag closes the nearest element of its name, if one is open
            at = nearest((tag,))
            if at >= 0:
                if solid and solid[-1] >= at:
                    flush()
                drop(at)
            elif tag not in INLINE:
                flush()
            continue
        if tag in ("br", "wbr", "img"):
            if tag == "br":
                say(" ")
            continue
        if tag not in INLINE:
            flush()
            at = nearest(("p",))
            if at >= 0 and solid[-1] == at:
                drop(at)
            if tag in _CLOSES:
                ends, fence = _CLOSES[tag]
                at = nearest(ends)
                if at > nearest(fence):
                    drop(at)
        if tag not in VOID:
            names = _element_features(tag, attributes, known)
            places.setdefault(tag, []).append(len(stack))
            if tag not in INLINE:
                solid.append(len(stack))
            stack.append((tag, names))
            for f in names:
                held[f] = held.get(f, 0) + 1
    say(page[last:])
    flush()
    return out
