"""Cutting text where the public pre-tokenisation pattern cuts it anyway, and remembering chunks.

The pattern never joins what follows a blank with what precedes it: in a run of white
space all but the last character are one match, and the last one opens the next match if
it is a plain blank and stands alone otherwise. So every word with its blank can be
encoded by itself, and a common word is encoded once per worker instead of once per use.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from itertools import chain

import regex

# The characters with the Unicode property White_Space, without the plain blank.
SPACES = "\t-\r\x85\xa0  -     　"
_STOPS = frozenset(",.;:!?")
_RUNS = re.compile(f"([ {SPACES}]{{2,}}|[{SPACES}])")


def pieces(text: str) -> list[tuple[list[str], list[str]]]:
    """``text`` as pairs of chunks that stand as they are and words that each follow a plain blank."""
    out: list[tuple[list[str], list[str]]] = []
    head: list[str] = []
    blank = False
    parts = _RUNS.split(text)
    last = len(parts) - 1
    for i, part in enumerate(parts):
        if i % 2:
            if i == last - 1 and not parts[last]:
                head.append(part)
            elif part[-1] == " ":
                head.append(part[:-1])
                blank = True
            else:
                if len(part) > 1:
                    head.append(part[:-1])
                head.append(part[-1])
        elif part:
            words = part.split(" ")
            if not blank:
                first, *words = words
                if first:
                    head.append(first)
            out.append((head, words))
            head, blank = [], False
    return [*out, (head, [])] if head else out


def chunks(text: str) -> list[str]:
    """Consecutive parts of ``text`` that the pattern splits independently of each other."""
    return [chunk for head, words in pieces(text) for chunk in (*head, *(" " + word for word in words))]


class _Codes(dict):
    """Codes of chunks without their ``lead``; they are made when they are first asked for."""

    def __init__(self, lead: str, older: dict[str, bytes], encoder: ChunkEncoder):
        super().__init__()
        self.lead, self.older, self.make, self.longest, self.long = lead, older, encoder._code, encoder.longest, encoder.long

    def __missing__(self, key: str) -> bytes:
        code = self.older.get(key)
        if code is None:
            code = self.make(self.lead + key)
        self[key] = code
        if len(key) >= self.longest:
            self.long.append((self, key))
        return code


class ChunkEncoder:
    """Encodes texts by chunks and remembers the codes of short ones.

    ``encode`` gives the code of one match of the pattern. What follows a blank is looked up
    without it, so no text is made for it. Tables of up to ``most`` chunks, younger and older
    ones: when the younger are full they replace the older, so frequent chunks stay and
    memory is bounded.
    """

    def __init__(self, encode: Callable[[str], bytes], pattern: str, most: int = 150_000, longest: int = 100):
        self.encode, self.split = encode, regex.compile(pattern).findall
        self.most, self.longest = most, longest
        self.long: list[tuple[_Codes, str]] = []
        self.whole, self.spaced = _Codes("", {}, self), _Codes(" ", {}, self)

    def _code(self, chunk: str) -> bytes:
        bare = chunk[1:] if chunk[0] == " " else chunk
        if bare.isalpha():
            return self.encode(chunk)  # letters with their blank are one match
        if bare[-1:] in _STOPS and bare[:-1].isalpha():
            return self._known(chunk[:-1]) + self._known(chunk[-1])  # so is a stop behind them
        matches = self.split(chunk)
        return b"".join(map(self._known, matches)) if len(matches) > 1 else self.encode(chunk)

    def _known(self, match: str) -> bytes:
        table, key = (self.spaced, match[1:]) if match[0] == " " else (self.whole, match)
        code = table.get(key) or table.older.get(key)
        if code is None:
            code = self.encode(match)
            if len(match) <= self.longest:
                table[key] = code
        return code

    def __call__(self, texts: list[str]) -> list[bytes]:
        if len(self.whole) + len(self.spaced) > self.most:
            for table in (self.whole, self.spaced):
                table.older = {}
            self.whole, self.spaced = (_Codes(t.lead, dict(t), self) for t in (self.whole, self.spaced))
        whole, spaced, codes = self.whole.__getitem__, self.spaced.__getitem__, []
        for text in texts:
            own: list[bytes] = []
            for head, words in pieces(text):
                own += map(whole, head)
                own += map(spaced, words)
            codes.append(b"".join(own))
        for known, key in self.long:
            known.pop(key, None)
        self.long.clear()
        return codes
