"""A small reader for stored HTML, built on the standard library's tokenizer."""

from __future__ import annotations

import re
from collections import Counter
from html import unescape
from html.parser import HTMLParser

# Elements that never have content, and those whose text is not shown.
VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
HIDDEN = frozenset(("script", "style", "template"))


_SPECIAL = re.compile(r"[<>\"']")
_TAG_START = re.compile(r"<[A-Za-z]")


def finished(html: str) -> str:
    """The markup with every tag that another one cuts short closed before that.

    The tokenizer would search the rest of the page from each such tag. A sign of a quoted
    value does not count; each sign is looked at once.
    """
    parts, done, at = [], 0, 0
    absent = set()  # quotes that do not occur any more
    while True:
        start = _TAG_START.search(html, at)
        if start is None:
            break
        at = start.end()
        while True:
            sign = _SPECIAL.search(html, at)
            if sign is None:
                at = len(html)
                break
            what, at = sign[0], sign.end()
            if what == ">":
                break
            if what == "<":
                at -= 1
                parts += [html[done:at], ">"]
                done = at
                break
            if html[sign.start() - 1] == "=" and what not in absent:
                end = html.find(what, at)
                if end < 0:
                    absent.add(what)
                else:
                    at = end + 1
    return "".join([*parts, html[done:]]) if parts else html


# A tag as most pages write it, with the text before it.
_PLAIN = re.compile(r'([^<]*+)<(?:/([a-z][a-z0-9]*)|([a-z][a-z0-9]*)((?: [a-z][a-z0-9-]*="[^"<>&]*")*))>')
_DOCTYPE = "<!DOCTYPE html>"
_ATTRIBUTE = re.compile(r'([a-z][a-z0-9-]*)="([^"]*)"')
# A number too long for int(), which refuses more than 4,300 digits.
_LONG_NUMBER = re.compile("&#([0-9]{4000,})")
# Elements whose content a tokenizer may read in a way of its own.
SPECIAL = frozenset("script style title textarea iframe noembed noframes noscript plaintext xmp".split())
_SIMPLE_SPECIAL = frozenset("script style title textarea".split())


class Element:
    """An element with the span it covers.

    Elements are numbered in document order and texts likewise. An element covers the
    elements after it up to ``last`` and the texts ``[first_text, last_text)``, so looking
    below an element is a scan over a range of two flat lists.
    """

    __slots__ = ("name", "attrs", "tokens", "parent", "at", "last", "first_text", "last_text")

    def __init__(self, name, attrs, parent, at, first_text):
        self.name, self.parent, self.at, self.last = name, parent, at, None
        self.first_text, self.last_text = first_text, None
        self.attrs = {}
        for key, value in attrs:
            self.attrs.setdefault(key, "" if value is None else value)
        self.tokens = self.attrs.get("class", "").split()


def _short_number(reference: re.Match) -> str:
    """The same reference in few digits; a number beyond all signs stays one."""
    digits = reference[1].lstrip("0")
    return f"&#{digits or 0}" if len(digits) < 8 else f"&#{0x110000}"


class Page(HTMLParser):
    """The elements and shown texts of one page.

    What the tokenizer refuses stops it. A ``lenient`` page is read to its end as a browser
    does: a marked section of an unknown kind is a comment up to the next ``>``.
    """

    def __init__(self, html: str | None, lenient: bool = False):
        super().__init__(convert_charrefs=True)
        self._lenient = lenient
        self.elements: list[Element] = []
        self.texts: list[str] = []
        self._open: list[Element] = []
        self._names: Counter[str] = Counter()  # how many of each name are open
        html = html or ""
        if lenient:
            html = _LONG_NUMBER.sub(_short_number, html)
        rest = html[self._plain(html):]
        if rest:
            self.feed(finished(rest))
            self.close()
        while self._open:
            self._shut(self._open.pop())

    def _plain(self, html: str) -> int:
        """Read plain tags and texts up to the first other sign. Returns where that is.

        What is left begins with a text or a tag, so the tokenizer can go on from there.
        """
        at = len(_DOCTYPE) if html.startswith(_DOCTYPE) else 0
        while (match := _PLAIN.match(html, at)) is not None:
            text, ended, started, attributes = match.groups()
            if started in SPECIAL:
                # Without any sign inside, its content is one text for every tokenizer.
                inner = html.find("<", match.end())
                if started not in _SIMPLE_SPECIAL or not html.startswith(f"</{started}>", inner):
                    break
            if text:
                self.handle_data(unescape(text) if "&" in text else text)
            if ended:
                self.handle_endtag(ended)
            else:
                self.handle_starttag(started, _ATTRIBUTE.findall(attributes) if attributes else ())
            at = match.end()
        return at

    def _shut(self, element):
        element.last, element.last_text = len(self.elements), len(self.texts)

    def parse_marked_section(self, i, report=1):
        try:
            return super().parse_marked_section(i, report)
        except AssertionError:
            if not self._lenient:
                raise
            return self.parse_bogus_comment(i, report)

    def updatepos(self, i, j):
        """Line numbers are not needed."""
        return j

    def handle_starttag(self, tag, attrs):
        parent = self._open[-1] if self._open else None
        element = Element(tag, attrs, parent, len(self.elements), len(self.texts))
        self.elements.append(element)
        if tag in VOID:
            self._shut(element)
        else:
            self._open.append(element)
            self._names[tag] += 1

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self._names[tag] -= 1
            self._shut(self._open.pop())

    def handle_endtag(self, tag):
        if not self._names[tag]:
            return
        while True:
            element = self._open.pop()
            self._names[element.name] -= 1
            self._shut(element)
            if element.name == tag:
                return

    def handle_data(self, data):
        if not (self._open and self._open[-1].name in HIDDEN):
            self.texts.append(data)

    def below(self, scope: Element | None, name: str, token=None, part=None, exact=None, **attrs):
        """Elements of a name below a scope, by class token, part of one, or whole class."""
        first, last = (0, len(self.elements)) if scope is None else (scope.at + 1, scope.last)
        for element in self.elements[first:last]:
            if element.name != name:
                continue
            if token is not None and token not in element.tokens:
                continue
            if part is not None and not any(part in t for t in element.tokens):
                continue
            if exact is not None and " ".join(element.tokens) != exact:
                continue
            if all(element.attrs.get(key) == value for key, value in attrs.items()):
                yield element

    def first(self, scope, name, **wanted) -> Element | None:
        return next(self.below(scope, name, **wanted), None)

    def enclosing(self, element: Element, name: str, part: str) -> Element | None:
        node = element.parent
        while node is not None:
            if node.name == name and any(part in t for t in node.tokens):
                return node
            node = node.parent
        return None

    def raw_text(self, element: Element | None) -> str | None:
        if element is None:
            return None
        return "".join(self.texts[element.first_text:element.last_text])

    def text(self, element: Element | None) -> str | None:
        """All texts below an element, each without surrounding whitespace, joined."""
        if element is None:
            return None
        return "".join(t.strip() for t in self.texts[element.first_text:element.last_text])
