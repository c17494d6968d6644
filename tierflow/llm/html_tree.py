"""A forgiving reader of HTML that keeps what the content model looks at: the block elements."""

from __future__ import annotations

import re
from html import unescape

# Kinds of elements of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var nobr br wbr img".split())
UNSHOWN = frozenset("script style template head noscript svg math iframe object canvas audio video".split())
RAW = ("script", "style", "textarea", "title", "noscript", "iframe")
LEAF_BLOCKS = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd td th pre blockquote figcaption caption address summary".split())
# A start of one of these ends an open paragraph; an element of the left kind ends an open one of the right kinds.
ENDS_PARAGRAPH = frozenset(
    "address article aside blockquote details dialog div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hr main menu nav ol p pre section table ul".split())
ENDS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
        "th": ("td", "th"), "option": ("option",), "tbody": ("thead", "tbody", "tr", "td", "th")}
BORDERS = frozenset("html body table ul ol dl div section article main aside nav header footer form td th blockquote".split())

_TAG = re.compile(
    # A tag that another one cuts short ends there, so no search goes on behind it.
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([A-Za-z][^\s/><]*)((?:[^<>\"']|\"[^\"]*\"|'[^']*')*)(?:>|(?=<)|\Z)", re.S)
_MARK = re.compile(r"""\b(?:class|id|role|itemprop|aria-label)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)


class Block:
    """A block element: its tag and marks, its parent's number, and its own texts.

    ``texts`` holds (serial of the run, text, is it a link?); texts of one run stand in one
    visual block.
    """

    __slots__ = ("tag", "marks", "parent", "texts")

    def __init__(self, tag: str, marks: str, parent: int):
        self.tag, self.marks, self.parent, self.texts = tag, marks, parent, []


def read_blocks(html: str) -> list[Block]:
    """The block elements in document order; number 0 is the page itself.

    Missing end tags are implied, unknown ones are ignored, and whatever is cut off at the
    end counts as far as it goes. Scripts, styles, comments and the head are not read.
    """
    blocks = [Block("html", "", -1)]
    stack: list[tuple[str, int]] = [("html", 0)]  # open elements with their block
    at = run = links = 0
    hidden = 0  # open elements that are not shown
    size = len(html)
    depths: dict[str, list[int]] = {"html": [0]}  # where the elements of a name are on the stack
    block_depths = [0]  # and where those are that are not inline

    def push(tag, block):
        depths.setdefault(tag, []).append(len(stack))
        if tag not in INLINE:
            block_depths.append(len(stack))
        stack.append((tag, block))

    def last(tags):
        """The depth of the innermost element with one of the names, the page apart."""
        return max((depths[t][-1] for t in tags if depths.get(t)), default=0)

    def put(text):
        if not hidden and text:
            blocks[stack[-1][1]].texts.append((run, text, links > 0))

    def close(count):
        nonlocal run, links, hidden
        for _ in range(count):
            tag, _ = stack.pop()
            depths[tag].pop()
            if tag not in INLINE:
                block_depths.pop()
            hidden -= tag in UNSHOWN
            links -= tag == "a"
            run += tag not in INLINE

    while at < size:
        found = _TAG.search(html, at)
        if not found:
            cut = html.rfind("<", at)
            # A tag that is cut off is no text.
            put(html[at:cut] if cut >= 0 and re.match(r"<[/!A-Za-z]", html[cut:cut + 2]) else html[at:])
            break
        put(html[at:found.start()])
        at = found.end()
        if not found[2]:
            continue
        tag = found[2].lower()
        if found[1]:
            depth = last((tag,))
            # The end of an inline element does not reach out of a block.
            if depth and not (tag in INLINE and block_depths[-1] > depth):
                close(len(stack) - depth)
            continue
        if tag == "br":
            put(" ")
            continue
        if tag in VOID:
            run += tag not in INLINE
            continue
        ended = ("p",) if tag in ENDS_PARAGRAPH else ENDS.get(tag, ())
        if ended:
            border = last(BORDERS.difference(ended))
            while (depth := last(ended)) > border:
                close(len(stack) - depth)
                if tag in ENDS_PARAGRAPH:
                    break
        if tag == "body":
            while stack[-1][0] == "head":
                close(1)
        if tag in RAW:
            end = re.compile(rf"</{tag}\b", re.I).search(html, at)
            inside, at = html[at:end.start() if end else size], end.start() if end else size
            if tag == "textarea":
                put(inside)
        if tag in INLINE:
            push(tag, stack[-1][1])
            links += tag == "a"
            continue
        run += 1
        hidden += tag in UNSHOWN
        if hidden:
            push(tag, stack[-1][1])
            continue
        marks = " ".join(a or b or c for a, b, c in _MARK.findall(found[3]))
        blocks.append(Block(tag, marks, stack[-1][1]))
        push(tag, len(blocks) - 1)
    return blocks


def shown(texts: list[str]) -> str:
    """The texts as one line: references decoded in each by itself, white space folded."""
    return " ".join("".join(map(unescape, texts)).split())
