"""Word shingles of texts as 64-bit hashes, computed side by side for many texts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

from tierflow.llm.common import mix64

#: Bytes that are hashed at once; texts beyond are cut between words.
AT_ONCE = 1 << 22
_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True
_BYTE = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_BASE, _UNBASE, _STEP = 0x2545F4914F6CDD1D, pow(0x2545F4914F6CDD1D, -1, 1 << 64), 0xD6E8FEB86659FD93
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power_tables(size: int) -> list[np.ndarray]:
    """Powers of the base and of its inverse; multiplication wraps at 64 bits."""
    if len(_powers[0]) < size:
        for i, base in enumerate((_BASE, _UNBASE)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[i] = np.multiply.accumulate(steps)
    return _powers


def _word_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every word, where it starts) of lower-cased bytes."""
    blank = np.concatenate([[True], _BLANK[data], [True]])
    edges = np.flatnonzero(blank[1:] != blank[:-1])
    starts, ends = edges[::2], edges[1::2]
    up, down = _power_tables(len(data) + 1)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_BYTE[data] * up[:len(data)])])
    return mix64((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64)), starts


def _pieces(text: bytes) -> Iterator[bytes]:
    """A long text in parts that end between words."""
    start = 0
    while len(text) - start > AT_ONCE:
        cut = start + AT_ONCE
        while cut < len(text) and not _BLANK[text[cut]]:
            cut += 1
        yield text[start:cut]
        start = cut
    yield text[start:]


def _words(texts: list[bytes]) -> list[np.ndarray]:
    """The word hashes of every text."""
    out: list[np.ndarray] = []
    held: list[bytes] = []

    def flush():
        if held:
            hashes, starts = _word_hashes(np.frombuffer(b" ".join(held), np.uint8))
            borders = np.cumsum([len(t) + 1 for t in held])
            out.extend(np.split(hashes, np.searchsorted(starts, borders[:-1])))
            held.clear()

    size = 0
    for text in texts:
        lower = text.lower()
        if len(lower) > AT_ONCE:
            flush()
            out.append(np.concatenate([_word_hashes(np.frombuffer(p, np.uint8))[0] for p in _pieces(lower)]))
            size = 0
            continue
        if size + len(lower) > AT_ONCE:
            flush()
            size = 0
        held.append(lower)
        size += len(lower) + 1
    flush()
    return out


def shingle_sets(texts: list[bytes], width: int = 5) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of every text, A-Z taken as a-z.

    A text of fewer words has its whole sequence as the only shingle, one without words none.
    """
    factors = [np.uint64(pow(_STEP, i, 1 << 64)) for i in range(width)]
    out = []
    for words in _words(texts):
        n = max(1, len(words) - width + 1) if len(words) else 0
        total = np.zeros(n, np.uint64)
        for i in range(min(width, len(words))):
            total += words[i:i + n] * factors[i]
        out.append(np.unique(mix64(total + np.uint64(min(width, len(words))))))
    return out


def set_hash(shingles: np.ndarray) -> int:
    """A signed 64-bit hash of a set."""
    mixed = mix64(np.array([mix64(shingles).sum() + np.uint64(len(shingles))], np.uint64))
    return int(mixed.view(np.int64)[0])
