"""Repeated passages by a depth-limited radix sort of suffixes.

Only suffixes that begin a window, i.e. have ``length`` bytes left in their document, matter,
and only their first ``length`` bytes. The first digit of the sort is chosen by content: of
the grams inside a window the one with the least hash (the leftmost of equal ones) is its
anchor. Equal windows have equal anchors at the same offset, and neighbouring windows mostly
share one, so the first pass deals out one narrow row per anchor of a block instead of one
per suffix. Anchors that a single document holds drop out. For the others the bytes of
their windows follow, and each bucket is sorted by most-significant-digit passes of eight
bytes, in which suffixes alone with their digits drop out, down to the threshold and no
further: what is then still together are exactly the windows that repeat.

Buckets do not grow without bound: a block sends equal passages once, whatever the number
of documents that hold them, and anchors that are very common with different surroundings
are dealt out once more by the whole window, whose first document is a plain minimum.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from tierflow.llm.common import arrow_batch, attach, bytes_of, mix64, slices
from tierflow.llm.shelf import Shelf

LENGTH, GRAM = 50, 16
BLOCK_BYTES = 1 << 22
STEP = 1 << 20  # windows whose anchors are searched at once
COMMON = 1 << 16  # occurrences from which an anchor's windows are dealt out one by one
ROWS_AT_ONCE = 1 << 14

_TEXTS = pa.schema([("block", pa.int64()), ("at", pa.int32()), ("doc", pa.int64()), ("digest", pa.binary()),
                    ("docs", pa.binary()), ("sizes", pa.binary()), ("data", pa.binary())])
_TEXTS_KIND = "block long, at int, doc long, digest binary, docs binary, sizes binary, data binary"
_ANCHORS = pa.schema([("key", pa.int64()), ("block", pa.int64()), ("at", pa.int32()), ("doc", pa.int64()),
                      ("several", pa.bool_()), ("n", pa.int32())])
_ANCHORS_KIND = "key long, block long, at int, doc long, several boolean, n int"
_CONTEXTS = pa.schema([("block", pa.int64()), ("at", pa.int32()), ("key", pa.int64()), ("lead", pa.int32()),
                       ("doc", pa.int64()), ("bytes", pa.binary()), ("runs", pa.binary())])
_CONTEXTS_KIND = "block long, at int, key long, lead int, doc long, bytes binary, runs binary"
_MASKS = pa.schema([("block", pa.int64()), ("at", pa.int32()), ("mask", pa.int64())])
_MASKS_KIND = "block long, at int, mask long"
_RESULT = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()),
                     ("kept_sha256", pa.string())])
_RESULT_KIND = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
#: One anchor of a block: where its first window starts, how many it has, its document, its passage.
_RUN = np.dtype([("start", "<i8"), ("windows", "<i4"), ("doc", "<i4"), ("passage", "<i4")])
_DOC = np.dtype([("id", "<i8"), ("known", "?")])


def _read_texts(batches, block_bytes):
    """Blocks of documents, and one row per document with the digest of its text."""
    block, held = TaskContext.get().partitionId() << 32, []

    def rows():
        docs = np.array([(0 if i is None else i, i is not None) for i, _ in held], _DOC)
        none = pa.nulls(len(held), pa.binary())
        yield arrow_batch(_TEXTS, pa.array(np.full(len(held), block)), pa.array(np.arange(len(held), dtype=np.int32)),
                          [i for i, _ in held], [hashlib.sha256(t).digest() for _, t in held], none, none, none)
        yield arrow_batch(_TEXTS, [block], [None], [None], [None], [docs.tobytes()],
                          [np.array([len(t) for _, t in held], "<i8").tobytes()], [b"".join(t for _, t in held)])

    size = 0
    for batch in slices(batches):
        for number, text in zip(batch.column(0).to_pylist(), bytes_of(batch.column(1))):
            held.append((number, text))
            size += len(text)
            if size >= block_bytes:
                yield from rows()
                block, held, size = block + 1, [], 0
    if held:
        yield from rows()


class _Block:
    """The texts of a block side by side, with a margin behind them."""

    def __init__(self, docs: bytes, sizes: bytes, data: bytes):
        self.docs, self.sizes = np.frombuffer(docs, _DOC), np.frombuffer(sizes, "<i8")
        self.ends = np.cumsum(self.sizes)
        self.size = len(data)
        self.data = data + bytes(256)

    def words(self) -> np.ndarray:
        """The eight bytes from every place on as a number."""
        return np.ndarray((self.size + 248,), "<u8", self.data, 0, (1,))

    def anchors(self, length: int, gram: int) -> Iterator[tuple[np.ndarray, ...]]:
        """(gram hash, start of the first window, number of windows, offset of the gram, document)."""
        words, span = self.words(), length - gram + 1
        # Windows may not reach beyond their text; documents without an id have none.
        limit = np.where(self.docs["known"], self.ends, 0)
        owner = np.repeat(np.arange(len(self.sizes), dtype=np.int32), self.sizes)
        offsets = [*range(0, gram - 7, 8), *([gram - 8] if gram % 8 else [])]
        for start in range(0, self.size, STEP):
            count = min(STEP, self.size - start)
            size = count + span - 1
            hashes = np.zeros(size, np.uint64)
            for offset in offsets:
                hashes = mix64(hashes + words[start + offset:start + offset + size])
            least, nth, seen = (hashes >> np.uint64(32)).astype(np.uint32), np.zeros(size, np.int16), 1
            while seen < span:
                step = min(seen, span - seen)
                later = least[step:] < least[:-step]
                nth[:-step] = np.where(later, nth[step:] + np.int16(step), nth[:-step])
                least[:-step] = np.where(later, least[step:], least[:-step])
                seen += step
            own = owner[start:start + count]
            at = np.flatnonzero(limit[own] - np.arange(start, start + count) >= length)
            if not len(at):
                continue
            gram_at = at + nth[at]
            first = np.flatnonzero(np.concatenate([[True], (np.diff(gram_at) != 0) | (np.diff(at) != 1)]))
            yield (hashes[gram_at[first]], start + at[first], np.diff(first, append=len(at)),
                   (gram_at - at)[first], own[at[first]])

    def all_anchors(self, length: int, gram: int) -> list[np.ndarray]:
        found = list(self.anchors(length, gram))
        return [np.concatenate(p) for p in zip(*found)] if found else [np.zeros(0, np.int64)] * 5


def _anchor_rows(batches, length, gram):
    """Per block one row for each of its anchors."""
    for batch in batches:
        for block, docs, sizes, data in zip(*(c.to_pylist() for c in batch.columns)):
            texts = _Block(docs, sizes, data)
            keys, _, _, _, doc = texts.all_anchors(length, gram)
            if not len(keys):
                continue
            order = np.argsort(keys, kind="stable")
            first = np.flatnonzero(np.concatenate([[True], keys[order][1:] != keys[order][:-1]]))
            ids = texts.docs["id"][doc[order]]
            least, most = np.minimum.reduceat(ids, first), np.maximum.reduceat(ids, first)
            own, counts = keys[order][first].view(np.int64), np.diff(first, append=len(keys)).astype(np.int32)
            for start in range(0, len(first), ROWS_AT_ONCE):
                part = slice(start, start + ROWS_AT_ONCE)
                size = len(own[part])
                yield arrow_batch(_ANCHORS, pa.array(own[part]), pa.array(np.full(size, block)),
                                  pa.array(np.arange(start, start + size, dtype=np.int32)), pa.array(least[part]),
                                  pa.array(least[part] < most[part]), pa.array(counts[part]))


def _digits(words: np.ndarray, starts: np.ndarray, sizes: np.ndarray, most: int) -> Iterator[np.ndarray]:
    """The bytes of spans as numbers of eight bytes; the last one ends with the span."""
    for offset in range(0, most, 8):
        yield words[starts + np.minimum(offset, sizes - 8)]


def distinct_spans(words: np.ndarray, group: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, is it the first of its kind) so that equal spans of a group lie together.

    Spans are arranged by a hash and compared byte by byte. Spans that collide may part equal
    ones; those then count as different, which costs time and changes no result.
    """
    if not len(starts):
        return np.zeros(0, np.int64), np.zeros(0, bool)
    hashes = mix64(group.astype(np.uint64) + (sizes.astype(np.uint64) << np.uint64(48)))
    most = int(sizes.max())
    for digit in _digits(words, starts, sizes, most):
        hashes = mix64(hashes + digit)
    order = np.argsort(hashes, kind="stable")
    one, two = order[:-1], order[1:]
    same = (group[one] == group[two]) & (sizes[one] == sizes[two])
    for a, b in zip(_digits(words, starts[one], sizes[one], most), _digits(words, starts[two], sizes[two], most)):
        same &= a == b
    return order, np.concatenate([[True], ~same])


def _passages(texts: _Block, block: int, kept: np.ndarray, common: np.ndarray, copies: np.ndarray, length: int, gram: int):
    """Rows of the passages around a block's remaining anchors, and the block's anchor runs."""
    keys, start, windows, lead, doc = texts.all_anchors(length, gram)
    place = np.unique(keys, return_inverse=True)[1]
    state = np.zeros(int(place.max(initial=-1)) + 1, np.int8)
    state[kept] = np.where(common, 2, 1)
    whole = np.zeros(len(texts.sizes), bool)
    whole[copies] = True
    used = np.flatnonzero((state[place] > 0) & ~whole[doc])
    keys, start, windows, lead, doc, common = (a[used] for a in (keys, start, windows, lead, doc, state[place] == 2))
    # Windows of very common anchors stand for themselves.
    times = np.where(common, windows, 1)
    row = np.repeat(np.arange(len(used)), times)
    nth = np.arange(len(row)) - np.repeat(np.cumsum(times) - times, times)
    keys, start, lead, doc, common = keys[row], start[row] + nth, lead[row] - nth, doc[row], common[row]
    windows = np.where(common, 1, windows[row])
    order, first = distinct_spans(texts.words(), mix64(keys + lead.astype(np.uint64)).view(np.int64), start, windows + length - 1)
    runs = np.zeros(len(order), _RUN)
    passage = np.empty(len(order), np.int64)
    passage[order] = np.cumsum(first) - 1
    runs["start"], runs["windows"], runs["doc"], runs["passage"] = start, windows, doc, passage
    heads = order[first]
    least = np.minimum.reduceat(texts.docs["id"][doc[order]], np.flatnonzero(first)) if len(order) else np.zeros(0, np.int64)
    for begin in range(0, len(heads), ROWS_AT_ONCE):
        part = slice(begin, begin + ROWS_AT_ONCE)
        own = heads[part]
        size = len(own)
        yield arrow_batch(
            _CONTEXTS, pa.array(np.full(size, block)), pa.array(np.arange(begin, begin + size, dtype=np.int32)),
            pa.array(keys[own].view(np.int64)), pa.array(np.where(common[own], -1, lead[own]).astype(np.int32)), pa.array(least[part]),
            [texts.data[a:b] for a, b in zip(start[own].tolist(), (start[own] + windows[own] + length - 1).tolist())],
            pa.nulls(size, pa.binary()))
    head = np.array([len(least), len(copies)], "<i8").tobytes()
    yield arrow_batch(_CONTEXTS, [block], [None], [None], [None], [None], [None],
                      [head + least.astype("<i8").tobytes() + copies.astype("<i8").tobytes() + runs.tobytes()])


def _passage_rows(batches, length, gram):
    """Rows come by block: its remaining anchors, its whole copies, then its texts."""
    places, kinds, commons = [], [], []
    for batch in batches:
        kind = batch.column(1).to_numpy(zero_copy_only=False)
        at = batch.column(2).fill_null(0).to_numpy(zero_copy_only=False)
        common = batch.column(3).fill_null(False).to_numpy(zero_copy_only=False)
        start = 0
        for i in np.flatnonzero(kind == 2):
            own, what, often = (np.concatenate([*held, column[start:i]]) for held, column in (
                (places, at), (kinds, kind), (commons, common)))
            texts = _Block(*(batch.column(c)[int(i)].as_py() for c in (4, 5, 6)))
            yield from _passages(texts, batch.column(0)[int(i)].as_py(), own[what == 0], often[what == 0], own[what == 1], length, gram)
            places, kinds, commons, start = [], [], [], i + 1
        places.append(at[start:])
        kinds.append(kind[start:])
        commons.append(common[start:])


def first_documents(words: np.ndarray, group: np.ndarray, starts: np.ndarray, docs: np.ndarray, length: int) -> np.ndarray:
    """For each suffix the smallest document among those of its group with the same first ``length`` bytes.

    A most-significant-digit sort: every pass orders the suffixes that still share all bytes
    with another by their next eight bytes and goes on inside the parts.
    """
    least = docs.copy()
    left = np.arange(len(starts))
    bucket = group
    for offset in (None, *range(0, length - 7, 8), *([length - 8] if length % 8 else [])):
        digit = np.zeros(len(left), np.uint64) if offset is None else words[starts[left] + offset].astype(np.uint64)
        order = np.lexsort((digit, bucket))
        left, bucket, digit = left[order], bucket[order], digit[order]
        new = np.concatenate([[True], (bucket[1:] != bucket[:-1]) | (digit[1:] != digit[:-1])]) if len(left) else np.zeros(0, bool)
        alone = new & np.concatenate([new[1:], [True]]) if len(left) else new
        bucket = np.cumsum(new)[~alone]
        left = left[~alone]
        if not len(left):
            return least
    first = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
    least[left] = np.repeat(np.minimum.reduceat(docs[left], first), np.diff(first, append=len(left)))
    return least


def _judged(parts: list[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """For whole buckets: which windows of each passage start in an earlier document."""
    rows = pa.Table.from_batches(parts).combine_chunks()
    column = rows.column("bytes").chunk(0)
    lengths = pc.binary_length(column).to_numpy(zero_copy_only=False).astype(np.int64)
    data = b"".join(column.to_pylist()) + bytes(256)
    words = np.ndarray((len(data) - 8,), ">u8", data, 0, (1,))
    starts = np.cumsum(lengths) - lengths
    key, lead, doc, block, at = (rows.column(n).to_numpy() for n in ("key", "lead", "doc", "block", "at"))
    bucket = np.cumsum(np.concatenate([[True], key[1:] != key[:-1]]))
    # Equal passages count once, with their first document.
    order, first = distinct_spans(words, bucket * 64 + lead, starts, lengths)
    heads, kind = np.flatnonzero(first), np.empty(len(order), np.int64)
    kind[order] = np.cumsum(first) - 1
    least, head = np.minimum.reduceat(doc[order], heads), order[heads]
    windows = lengths - length + 1
    size = windows[head]
    own = np.repeat(np.arange(len(head)), size)
    nth = np.arange(len(own)) - np.repeat(np.cumsum(size) - size, size)
    source = head[own]
    earliest = first_documents(words, bucket[source] * 64 + lead[source] - nth, starts[source] + nth, least[own], length)
    # A bit for each window of a passage, against the passage's own row.
    base = np.cumsum(size) - size
    from_row = np.repeat(np.arange(len(key)), windows)
    place = np.arange(len(from_row)) - np.repeat(np.cumsum(windows) - windows, windows)
    hit = earliest[base[kind[from_row]] + place] < doc[from_row]
    bits = np.where(hit, np.uint64(1) << place.astype(np.uint64), np.uint64(0))
    mask = np.bitwise_or.reduceat(bits, np.cumsum(windows) - windows)
    some = np.flatnonzero(mask)
    yield arrow_batch(_MASKS, pa.array(block[some]), pa.array(at[some]), pa.array(mask[some].view(np.int64)))


def _judge(batches, length):
    """Rows come sorted by key; whole buckets are judged together."""
    held, size = [], 0
    for batch in batches:
        key = batch.column(0).to_numpy(zero_copy_only=False)
        if not len(key):
            continue
        if size >= ROWS_AT_ONCE:
            border = int(np.searchsorted(key != held[-1].column(0)[-1].as_py(), True)) if len(key) else 0
            if border < len(key):
                if border:
                    held.append(batch.slice(0, border))
                yield from _judged(held, length)
                held, size, batch = [], 0, batch.slice(border)
        held.append(batch)
        size += batch.num_rows
    if held:
        yield from _judged(held, length)


def _results(texts: _Block, runs: bytes, at: np.ndarray, masks: np.ndarray, length: int) -> pa.RecordBatch:
    n, n_copies = np.frombuffer(runs[:16], "<i8")
    least = np.frombuffer(runs[16:16 + 8 * n], "<i8")
    copies = np.frombuffer(runs[16 + 8 * n:16 + 8 * (n + n_copies)], "<i8")
    runs = np.frombuffer(runs[16 + 8 * (n + n_copies):], _RUN)
    mask = np.zeros(n, np.uint64)
    mask[at] = masks.view(np.uint64)
    own = mask[runs["passage"]]
    # A later document of the block with the same passage has all its windows from the first.
    own = np.where(texts.docs["id"][runs["doc"]] > least[runs["passage"]], ~np.uint64(0), own)
    found = [np.zeros(0, np.int64)]
    for nth in range(int(runs["windows"].max(initial=0))):
        found.append(runs["start"][(runs["windows"] > nth) & ((own >> np.uint64(nth)) & np.uint64(1) == 1)] + nth)
    begin = np.concatenate(found)
    edges = np.bincount(begin, minlength=texts.size + 1) - np.bincount(begin + length, minlength=texts.size + 1)
    starts = texts.ends - texts.sizes
    covered = np.cumsum(edges[:-1]) > 0
    for doc in copies:
        if texts.sizes[doc] >= length:
            covered[starts[doc]:texts.ends[doc]] = True
    before = np.concatenate([[0], np.cumsum(covered)])
    removed = before[texts.ends] - before[starts]
    opens = covered.copy()
    opens[1:] &= ~covered[:-1]
    inner = starts[texts.sizes > 0]
    opens[inner] = covered[inner]
    opened = np.concatenate([[0], np.cumsum(opens)])
    kept = np.frombuffer(texts.data, np.uint8, texts.size)[~covered].tobytes()
    ends = texts.ends - before[texts.ends]
    begins = ends - (texts.sizes - removed)
    return arrow_batch(
        _RESULT, pa.array(texts.docs["id"], mask=~texts.docs["known"]), pa.array(texts.sizes), pa.array(removed),
        pa.array(opened[texts.ends] - opened[starts]),
        [hashlib.sha256(kept[b:e]).hexdigest() for b, e in zip(begins.tolist(), ends.tolist())])


def _result_rows(batches, length):
    """Rows come by block: its masks, its anchor runs, then its texts."""
    at, masks, runs = [], [], None
    for batch in batches:
        kind = batch.column(1).to_numpy(zero_copy_only=False)
        place, mask = (batch.column(i).fill_null(0).to_numpy(zero_copy_only=False) for i in (2, 3))
        start = 0
        for i in np.flatnonzero(kind > 0):
            at.append(place[start:i])
            masks.append(mask[start:i])
            start = i + 1
            if kind[i] == 1:
                runs = batch.column(4)[int(i)].as_py()
                continue
            texts = _Block(*(batch.column(c)[int(i)].as_py() for c in (5, 6, 7)))
            yield _results(texts, runs, np.concatenate(at), np.concatenate(masks), length)
            at, masks, runs = [], [], None
        at.append(place[start:])
        masks.append(mask[start:])


def _rows(df: DataFrame, kind: int, columns: dict[str, str]) -> DataFrame:
    """The rows of ``df`` with all the columns, absent ones null, and the kind behind the block."""
    return df.select("block", F.lit(kind).alias("kind"), *[
        (F.col(name) if name in df.columns else F.lit(None)).cast(cast).alias(name) for name, cast in columns.items()])


def remove_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, key: str = "doc_id", text: str = "text",
                   block_bytes: int = BLOCK_BYTES, common: int = COMMON) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256: one row per row of ``docs``.

    Of every text, as UTF-8 bytes, those bytes go that lie in a string of ``length`` bytes
    which also starts in a document with a smaller key. Strings are judged on the whole
    input, overlaps count, and none crosses a document. ``n_spans`` counts the maximal
    removed runs; the digest is that of the remaining bytes, one after the other.

    A null text is empty; texts shorter than ``length`` stay as they are. Rows with a null
    key remove nothing and lose nothing, and rows that share a key do not affect each other.
    An empty table gives no rows. Other columns are not read. A block holds up to
    ``block_bytes`` of text and one text more; anchors that occur more than ``common`` times
    are dealt out by whole windows.
    """
    if not 8 <= gram <= length or length - gram > 62:
        raise ValueError("gram must have 8 bytes or more, and length at most 62 more than that")
    shelf = Shelf(docs.sparkSession, "repeats")
    texts = shelf.put("texts", docs.select(docs[key].cast("long"), F.coalesce(docs[text], F.lit(""))).mapInArrow(
        lambda batches: _read_texts(batches, block_bytes), _TEXTS_KIND))
    blocks = texts.filter("data IS NOT NULL").select("block", "docs", "sizes", "data")

    # Documents whose whole text an earlier one has need no search of their own.
    known = texts.filter("doc IS NOT NULL").select("block", "at", "doc", "digest")
    first = known.groupBy("digest").agg(F.min("doc").alias("least"), F.count(F.lit(1)).alias("size"), F.max("doc").alias("most"))
    first = shelf.put("first", first.filter("least < most").drop("most"))
    copies = shelf.put("copies", attach(known, first, "digest", "size", known.count()).filter("doc > least").select("block", "at"))

    by_key = Window.partitionBy("key")
    anchors = blocks.mapInArrow(lambda batches: _anchor_rows(batches, length, gram), _ANCHORS_KIND).withColumns({
        "least": F.min("doc").over(by_key), "most": F.max("doc").over(by_key), "any": F.max("several").over(by_key),
        "total": F.sum("n").over(by_key)})
    kept = shelf.put("anchors", anchors.filter("any OR least < most").select(
        "block", "at", (F.col("total") > common).alias("common")))

    columns = {"at": "int", "common": "boolean", "docs": "binary", "sizes": "binary", "data": "binary"}
    met = _rows(kept, 0, columns).unionByName(_rows(copies, 1, columns)).unionByName(_rows(blocks, 2, columns))
    met = met.repartition("block").sortWithinPartitions("block", "kind")
    found = shelf.put("passages", met.mapInArrow(lambda batches: _passage_rows(batches, length, gram), _CONTEXTS_KIND))
    shelf.drop("anchors", "first", "copies")

    bounded = found.filter("runs IS NULL AND lead >= 0").select("key", "lead", "doc", "bytes", "block", "at")
    masks = bounded.repartition("key").sortWithinPartitions("key").mapInArrow(lambda batches: _judge(batches, length), _MASKS_KIND)
    single = found.filter("runs IS NULL AND lead < 0").select("bytes", "doc", "block", "at")
    earliest = single.groupBy("bytes").agg(F.min("doc").alias("least"))
    single = single.join(earliest, "bytes").filter("least < doc").select("block", "at", F.lit(1).cast("long").alias("mask"))
    masks = shelf.put("masks", masks.unionByName(single))

    columns = {"at": "int", "mask": "long", "runs": "binary", "docs": "binary", "sizes": "binary", "data": "binary"}
    met = _rows(masks, 0, columns).unionByName(_rows(found.filter("runs IS NOT NULL").select("block", "runs"), 1, columns))
    met = met.unionByName(_rows(blocks, 2, columns)).repartition("block").sortWithinPartitions("block", "kind")
    return met.mapInArrow(lambda batches: _result_rows(batches, length), _RESULT_KIND)
