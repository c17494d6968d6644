"""Simple-8b: varying counts of integers packed into 64-bit words.

The upper four bits of a word select how many values of how many bits the lower sixty
hold. Selector 0 is the escape: the next word is one raw value. Values are cut into blocks
that are packed independently of each other, and the offset of each block's first word is
kept, so that all blocks are packed and unpacked side by side with array operations.
"""

from __future__ import annotations

import numpy as np

# Selector -> number of values and bits of each.
COUNTS = np.array([1, 120, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1])
BITS = np.array([64, 0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60])
ESCAPE = 0
BLOCK = 512


def block_ends(sizes: np.ndarray, block: int = BLOCK) -> np.ndarray:
    """Ends of the blocks of streams of the given sizes; no block holds values of two streams."""
    sizes = np.asarray(sizes, dtype=np.int64)
    counts = -(-sizes // block)
    starts = np.repeat(np.cumsum(sizes) - sizes, counts)
    nth = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    return np.minimum(starts + (nth + 1) * block, np.repeat(np.cumsum(sizes), counts))


def _selectors(widths: np.ndarray) -> np.ndarray:
    """The first selector whose word would hold the values from each place on.

    ``widths`` has a row per block with enough zeros behind its values, so that a word may
    stay part empty at the end of a block and nowhere else.
    """
    largest = np.concatenate([widths.ravel(), np.zeros(COUNTS.max(), np.uint8)])
    selector, n, reach = np.zeros(widths.size, np.uint8), widths.size, 1
    for s in range(15, 0, -1):
        # ``largest`` holds the largest width among the ``reach`` values from each place on.
        while reach < COUNTS[s]:
            step = min(reach, COUNTS[s] - reach)
            largest = np.maximum(largest[:len(largest) - step], largest[step:])
            reach += step
        np.putmask(selector, largest[:n] <= BITS[s], s)
    return selector


_NARROW = np.frexp(np.arange(1 << 16))[1].astype(np.uint8)


def _widths(values: np.ndarray) -> np.ndarray:
    """Bits of each value: the exponents of its two halves, which floats hold exactly."""
    if not len(values) or values.max() < len(_NARROW):
        return _NARROW[values.astype(np.int64)]
    low = np.frexp((values & np.uint64(0xFFFFFFFF)).astype(np.float64))[1].astype(np.uint8)
    if len(values) and values.max() >> np.uint64(32):
        high = np.frexp((values >> np.uint64(32)).astype(np.float64))[1].astype(np.uint8)
        return np.where(high, high + np.uint8(32), low)
    return low


def pack(values: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(words, offset of each block's first word) of unsigned integers in blocks up to ``ends``."""
    values = np.asarray(values, dtype=np.uint64)
    starts = np.concatenate([[0], ends[:-1]]).astype(np.int64) if len(ends) else np.zeros(0, np.int64)
    if not len(values):
        return np.zeros(0, np.uint64), np.zeros(len(ends), np.uint32)
    row = int((ends - starts).max()) + int(COUNTS.max())
    rows = np.arange(len(ends), dtype=np.int64) * row
    shift = rows - starts  # from the place of a value to its place in the rows
    widths = np.zeros((len(ends), row), np.uint8)
    widths.ravel()[np.arange(len(values)) + np.repeat(shift, ends - starts)] = _widths(values)
    selector = _selectors(widths)
    begins = np.zeros(widths.size, bool)
    at, stop = rows[starts < ends], (ends + shift)[starts < ends]
    while len(at):
        begins[at] = True
        at = at + COUNTS[selector[at]]
        going = at < stop
        at, stop = at[going], stop[going]
    at = np.flatnonzero(begins)
    chosen, block = selector[at], at // row
    at -= shift[block]
    taken = np.minimum(COUNTS[chosen], ends[block] - at)
    width = np.where(chosen == ESCAPE, 2, 1)
    place = np.cumsum(width) - width
    words = np.zeros(int(width.sum()), np.uint64)
    padded = np.concatenate([values, np.zeros(120, np.uint64)])
    for s in np.unique(chosen):
        mine = chosen == s
        if s == ESCAPE:
            words[place[mine] + 1] = values[at[mine]]
            continue
        first, held = at[mine], taken[mine]
        short = np.flatnonzero(held < COUNTS[s])  # words that end a block
        own = np.full(len(first), np.uint64(s) << np.uint64(60), np.uint64)
        for lane in range(COUNTS[s]):
            lot = padded[first + lane]
            lot[short[held[short] <= lane]] = 0
            own |= lot << np.uint64(lane * BITS[s])
        words[place[mine]] = own
    return words, place[np.searchsorted(at, starts)].astype(np.uint32)


def unpack(words: np.ndarray, offsets: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The values of all blocks, in order."""
    n = int(ends[-1]) if len(ends) else 0
    out = np.zeros(n, np.uint64)
    if not n:
        return out
    selector = (words >> np.uint64(60)).astype(np.int64)
    stops = np.concatenate([offsets[1:], [len(words)]]).astype(np.int64)
    header = np.ones(len(words), bool)
    # Behind an escape stands a raw word; only blocks with a possible escape are walked.
    suspects = np.flatnonzero(selector == ESCAPE)
    for b in np.unique(np.searchsorted(offsets, suspects, side="right") - 1):
        at = int(offsets[b])
        while at < stops[b]:
            if selector[at] == ESCAPE:
                header[at + 1] = False
                at += 1
            at += 1
    count = np.where(header, COUNTS[selector], 0)
    starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
    block_of = np.repeat(np.arange(len(ends)), stops - offsets.astype(np.int64))
    before = np.cumsum(count) - count
    first = starts[block_of] + before - before[offsets.astype(np.int64)][block_of]
    limit = ends[block_of]
    for s in np.unique(selector[header]):
        mine = np.flatnonzero(header & (selector == s))
        if s == ESCAPE:
            out[first[mine]] = words[mine + 1]
            continue
        lanes = np.arange(COUNTS[s])
        shifts, mask = (lanes * BITS[s]).astype(np.uint64), np.uint64((1 << int(BITS[s])) - 1)
        held = (words[mine, None] >> shifts) & mask
        place = first[mine, None] + lanes
        inside = place < limit[mine, None]
        out[place[inside]] = held[inside]
    return out
