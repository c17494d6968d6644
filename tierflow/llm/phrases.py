"""Phrase collocations by direct-address tiling.

Texts are read once into blocks of bounded size. A block is a sequence of numbers, one per
word, and the block's own list of words with their counts. The counts of all blocks are
summed, and the frequent words of each block come back to it, where they are ranked by
frequency. With these ranks a block counts its pairs of neighbours: the square of ranks is
cut into tiles, and a tile with many occurrences is counted in a dense array that the pair
addresses directly, while the occurrences of all sparse tiles are sorted and counted
together. Frequent pairs are ranked in turn, and two overlapping pairs are a pair of ranks
again: a phrase of three words, and so on. A phrase that occurs often enough has only parts
that do, so nothing is missed, and each step handles only what the one before has left.

A key is known everywhere by the first (block, place) that holds it, so neither numbering
nor a join is needed to name it: one window per step sums the counts and finds the name.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from tierflow.llm.common import arrow_batch, bytes_of, slices
from tierflow.llm.shelf import Shelf

BLOCK_BYTES = 1 << 23
TILE = 512  # ranks on either side of a tile
TILES = 8  # tiles on either side that may be counted densely
DENSE = TILE * TILE // 8  # occurrences that make a tile worth an array of its own
ROWS_AT_ONCE = 1 << 15
PLACE = 28  # bits of a key's place in its block; the block's number is above them
BLOCKS = 14  # bits for the blocks of one task

# What a step leaves: the rows of its keys, and one row per block with its sequence.
_WORDS = pa.schema([("at", pa.int64()), ("lang", pa.string()), ("word", pa.string()), ("n", pa.int32()), ("seq", pa.binary()), ("kind", pa.int32())])
_WORDS_KIND = "at long, lang string, word string, n int, seq binary, kind int"
_PAIRS = pa.schema([("at", pa.int64()), ("first", pa.int64()), ("second", pa.int64()), ("n", pa.int32()), ("seq", pa.binary()), ("kind", pa.int32())])
_PAIRS_KIND = "at long, first long, second long, n int, seq binary, kind int"

#: A-Z to a-z, blanks to a space, the ends of pieces to a line break.
_PLAIN = bytes(
    0x0A if b in b".,;:!?\n\x0b\x0c\r" else 0x20 if b in b" \t" else b + 32 if 0x41 <= b <= 0x5A else b for b in range(256)
)
# Other bytes at which bytes.split() would cut do not exist: it knows the six above.
_END = re.compile(rb"[.,;:!?\n\x0b\x0c\r]")


def split_pieces(text: bytes) -> tuple[list[bytes], np.ndarray]:
    """(words in order, number of the piece that each lies in)."""
    plain = text.translate(_PLAIN)
    cells = np.frombuffer(plain, np.uint8)
    inside = (cells != 0x20) & (cells != 0x0A)
    starts = np.flatnonzero(inside & ~np.concatenate([[False], inside[:-1]]))
    return plain.split(), np.cumsum(cells == 0x0A)[starts]


def _at(block: int, place: int, count: int) -> np.ndarray:
    """The names of ``count`` places of a block from one on; place 0 is the block's sequence."""
    return (block << PLACE) + np.arange(place, place + count, dtype=np.int64)


def _kind(kind: int, count: int) -> pa.Array:
    """0 for the rows of keys, 1 for a block's sequence."""
    return pa.array(np.full(count, kind, np.int32))


def _packed(seq: np.ndarray) -> bytes:
    return len(seq).to_bytes(8, "little") + pa.compress(seq.astype("<i4").tobytes(), "zstd", asbytes=True)


def _unpacked(data: bytes) -> np.ndarray:
    size = int.from_bytes(data[:8], "little")
    return np.frombuffer(pa.decompress(data[8:], 4 * size, "zstd", asbytes=True), "<i4")


def _cut(text: bytes, size: int) -> Iterator[bytes]:
    """A long text in parts that end with a piece."""
    while len(text) > size:
        end = _END.search(text, size)
        if end is None:
            break
        yield text[:end.end()]
        text = text[end.end():]
    yield text


class _Block:
    """Sequence and words of the texts of one block."""

    def __init__(self):
        self.places: dict[str, dict[bytes, int]] = {}
        self.words: list[tuple[str, bytes]] = []
        self.parts: list[np.ndarray] = []
        self.size = 0

    def add(self, lang: str, text: bytes) -> None:
        known = self.places.setdefault(lang, {})
        words, pieces = split_pieces(text)
        at = np.empty(len(words), np.int32)
        for i, word in enumerate(words):
            place = known.get(word)
            if place is None:
                self.words.append((lang, word))
                place = known[word] = len(self.words)
            at[i] = place
        # A 0 ends every piece.
        self.parts.append(np.insert(at, np.flatnonzero(np.diff(pieces)) + 1, 0))
        self.parts.append(np.zeros(1, np.int32))
        self.size += len(text) + 1

    def rows(self, block: int) -> Iterator[pa.RecordBatch]:
        seq = np.concatenate(self.parts)
        counts = np.bincount(seq, minlength=len(self.words) + 1)[1:]
        for start in range(0, len(self.words), ROWS_AT_ONCE):
            part = self.words[start:start + ROWS_AT_ONCE]
            size = len(part)
            yield arrow_batch(
                _WORDS, pa.array(_at(block, start + 1, size)), [lang for lang, _ in part],
                pa.array([w for _, w in part], pa.binary()).cast(pa.string()),
                pa.array(counts[start:start + size].astype(np.int32)), pa.nulls(size, pa.binary()), _kind(0, size))
        yield arrow_batch(_WORDS, pa.array(_at(block, 0, 1)), [None], [None], [None], [_packed(seq)], _kind(1, 1))


def _read_words(batches, block_bytes):
    number = TaskContext.get().partitionId() << BLOCKS
    block = _Block()
    for batch in slices(batches):
        for lang, text in zip(batch.column(0).to_pylist(), bytes_of(batch.column(1))):
            for part in _cut(text, block_bytes):
                block.add(lang, part)
                if block.size >= block_bytes:
                    yield from block.rows(number)
                    number, block = number + 1, _Block()
    if block.parts:
        yield from block.rows(number)


def count_pairs(a: np.ndarray, b: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(distinct codes a * width + b, their counts, for each pair the place of its code).

    ``a`` and ``b`` are ranks below ``width``, the most frequent first. Dense tiles are
    counted by direct address, all others as sorted codes.
    """
    found, counts = [], []
    place = np.empty(len(a), np.int64)
    rest = np.ones(len(a), bool)
    near = np.flatnonzero((a < TILE * TILES) & (b < TILE * TILES))
    tile = (a[near] // TILE) * TILES + b[near] // TILE
    done = 0
    for number in np.flatnonzero(np.bincount(tile, minlength=1) >= DENSE):
        own = near[tile == number]
        rest[own] = False
        row, column = divmod(int(number), TILES)
        cell = (a[own] - row * TILE) * TILE + b[own] - column * TILE
        dense = np.bincount(cell, minlength=TILE * TILE)
        used = np.flatnonzero(dense)
        found.append((used // TILE + row * TILE) * width + used % TILE + column * TILE)
        counts.append(dense[used])
        to = np.zeros(TILE * TILE, np.int64)
        to[used] = np.arange(done, done + len(used))
        place[own] = to[cell]
        done += len(used)
    left = np.flatnonzero(rest)
    codes, inverse, sparse = np.unique(a[left] * width + b[left], return_inverse=True, return_counts=True)
    place[left] = inverse + done
    return np.concatenate([*found, codes]), np.concatenate([*counts, sparse]), place


def _pairs_of(block, seq, places, names, counts):
    """The rows of the pairs of one block, whose keys at ``places`` are frequent."""
    seq = _unpacked(seq)
    order = np.lexsort((names, -counts))  # the most frequent key has rank 0
    to = np.full(int(max(seq.max(initial=0), places.max(initial=0))) + 1, -1, np.int64)
    to[places[order]] = np.arange(len(order))
    to[0] = -1
    at = to[seq]
    both = np.flatnonzero((at[:-1] >= 0) & (at[1:] >= 0))
    if not len(both):
        return
    width, known = len(order), names[order]
    codes, counts, place = count_pairs(at[both], at[both + 1], width)
    follow = np.zeros(len(at), np.int32)
    follow[both] = place + 1
    # One 0 is enough to part what does not overlap.
    follow = follow[(follow > 0) | np.concatenate([[False], follow[:-1] > 0])]
    for start in range(0, len(codes), ROWS_AT_ONCE):
        code = codes[start:start + ROWS_AT_ONCE]
        yield arrow_batch(
            _PAIRS, pa.array(_at(block, start + 1, len(code))), pa.array(known[code // width]), pa.array(known[code % width]),
            pa.array(counts[start:start + len(code)].astype(np.int32)), pa.nulls(len(code), pa.binary()), _kind(0, len(code)))
    yield arrow_batch(_PAIRS, pa.array(_at(block, 0, 1)), [None], [None], [None], [_packed(follow)], _kind(1, 1))


def _pair_rows(batches):
    """Rows come by block: first (at, name, f) of its frequent keys, then its sequence."""
    held = []
    for batch in batches:
        at, name, f = (batch.column(i).fill_null(0).to_numpy(zero_copy_only=False) for i in range(3))
        start = 0
        for end in np.flatnonzero(batch.column(3).is_valid().to_numpy(zero_copy_only=False)):
            held.append((at[start:end], name[start:end], f[start:end]))
            places, names, counts = (np.concatenate(p) for p in zip(*held))
            yield from _pairs_of(int(at[end]) >> PLACE, batch.column(3)[int(end)].as_py(),
                                 places & ((1 << PLACE) - 1), names, counts)
            held, start = [], end + 1
        held.append((at[start:], name[start:], f[start:]))


def _frequent(rows: DataFrame, keys: list[str], least: int) -> DataFrame:
    """(at, name, f, *keys) of every row whose key occurs often enough; the keys stand in the
    row that gives the name only."""
    own = Window.partitionBy(*keys)
    rows = rows.select("at", *keys, "n").withColumns({
        "f": F.sum("n").over(own), "name": F.min("at").over(own)}).filter(F.col("f") >= least)
    first = F.col("at") == F.col("name")
    return rows.select("at", "name", "f", *[F.when(first, F.col(k)).alias(k) for k in keys])


def _next_rows(sequences: DataFrame, frequent: DataFrame) -> DataFrame:
    """The pair rows of all blocks. A block's frequent keys and its sequence meet in one shuffle."""
    none = F.lit(None)
    both = frequent.select("at", "name", "f", none.cast("binary").alias("seq")).unionByName(
        sequences.select("at", none.cast("long").alias("name"), none.cast("long").alias("f"), "seq"))
    block = F.shiftright("at", PLACE)
    met = both.repartition(block).sortWithinPartitions(block, F.col("seq").isNotNull())
    return met.mapInArrow(_pair_rows, _PAIRS_KIND)


def _longest(longer: DataFrame, parts: list[str]) -> DataFrame:
    """(part, over): the highest count of a longer phrase around each part."""
    both = longer.select(F.explode(F.array(*parts)).alias("part"), "f")
    return both.groupBy("part").agg(F.max("f").alias("over"))


def mine_phrases(docs: DataFrame, least: int = 30, first: int = 2000, swallow: int = 80, scale: int = 2_000_000,
                 lang: str = "lang", text: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the best phrases of 2 to 4 words of each language.

    Words are taken in pieces that end at ``.,;:!?`` and line breaks, A-Z as a-z. A phrase
    occurs ``a`` times; cut in two, its parts occur ``l`` and ``r`` times, and its score is
    floor(scale * a / (l + r)) for the cut that gives least, then the earliest. Phrases with
    fewer than ``least`` occurrences are left out, and those which a longer one contains in
    ``swallow`` percent of the cases or more. ``n`` counts all words of the language. Equal
    scores go by ``a`` descending, then by the phrase's bytes.

    A null language counts as ``und``, a null text as empty; texts without words and empty
    tables give no rows. Repeated rows count each time. Other columns are not read. Blocks
    hold up to ``block_bytes`` of text and one text more, however long that is.
    """
    shelf = Shelf(docs.sparkSession, "phrases")
    source = docs.select(F.coalesce(F.col(lang), F.lit("und")), F.coalesce(F.col(text), F.lit("")))
    rows, sequences = shelf.put_by("rows1", source.mapInArrow(lambda batches: _read_words(batches, block_bytes), _WORDS_KIND), "kind", 2)
    totals = shelf.put("totals", rows.groupBy("lang").agg(F.sum("n").alias("n")))
    keys, levels = ["lang", "word"], []
    for size in range(1, 5):
        # One share of the keys after the other, so that half of the rows are on the way at most.
        shares = [F.pmod(F.xxhash64(*keys), F.lit(2)) == share for share in (0, 1)]
        frequent = reduce(DataFrame.unionByName, [
            shelf.put(f"frequent{size}/{share}", _frequent(rows.filter(own), keys, least)) for share, own in enumerate(shares)])
        shelf.drop(f"rows{size}/kind=0")
        levels.append(shelf.put(f"keys{size}", frequent.filter(F.col("at") == F.col("name")).select("name", *keys, "f")))
        if size < 4:
            rows, sequences = shelf.put_by(f"rows{size + 1}", _next_rows(sequences, frequent), "kind", 2)
            keys = ["first", "second"]
        shelf.drop(f"rows{size}", f"frequent{size}")

    def parts(ranked, shorter, columns):
        """Both parts of each phrase, with their columns prefixed ``a_`` and ``b_``."""
        for side, prefix in (("first", "a_"), ("second", "b_")):
            ranked = ranked.join(shorter.select(*[F.col(c).alias(prefix + c) for c in ("name", *columns)]),
                                 F.col(side) == F.col(f"{prefix}name"))
        return ranked

    words, pairs, triples, quads = levels
    pairs = shelf.put("pairs", parts(pairs, words, ["lang", "word", "f"]).select(
        "name", "f", F.col("a_lang").alias("lang"), F.concat_ws(" ", "a_word", "b_word").alias("phrase"),
        F.col("b_word").alias("last"), F.col("a_f").alias("f1"), F.col("b_f").alias("f2")))
    triples = shelf.put("triples", parts(triples, pairs, ["lang", "phrase", "last", "f", "f1", "f2"]).select(
        "name", "first", "second", "f", F.col("a_lang").alias("lang"), F.concat_ws(" ", "a_phrase", "b_last").alias("phrase"),
        F.col("b_last").alias("last"), F.col("a_f1").alias("f1"), F.col("a_f").alias("f12"),
        F.col("b_f").alias("f23"), F.col("b_f2").alias("f3")))
    quads = parts(quads, triples, ["lang", "phrase", "last", "f", "f1", "f12", "f23", "f3"]).select(
        "first", "second", "f", F.col("a_lang").alias("lang"), F.concat_ws(" ", "a_phrase", "b_last").alias("phrase"),
        F.array(F.struct(F.col("a_f1").alias("l"), F.col("b_f").alias("r")),
                F.struct(F.col("a_f12").alias("l"), F.col("b_f23").alias("r")),
                F.struct(F.col("a_f").alias("l"), F.col("b_f3").alias("r"))).alias("cuts"))
    quads = shelf.put("quads", quads)

    def cuts(*sides):
        return F.array(*[F.struct(F.col(left).alias("l"), F.col(right).alias("r")) for left, right in sides]).alias("cuts")

    # A longer phrase never occurs more often than a phrase inside it, so of all phrases around
    # one it is enough to look at those with one word more.
    def standing(df, longer):
        over = _longest(longer, ["first", "second"])
        kept = df.join(over, F.col("name") == F.col("part"), "left")
        return kept.filter(F.col("over").isNull() | (F.col("over") * 100 < F.col("f") * swallow))

    candidates = (
        standing(pairs, triples).select("lang", "phrase", F.col("f").alias("a"), cuts(("f1", "f2")))
        .unionByName(standing(triples, quads).select("lang", "phrase", F.col("f").alias("a"), cuts(("f1", "f23"), ("f12", "f3"))))
        .unionByName(quads.select("lang", "phrase", F.col("f").alias("a"), "cuts"))
    )
    # Integral division of decimals is exact, and 28 digits hold every product.
    scored = candidates.withColumn("best", F.expr(f"""array_min(transform(cuts, (c, k) -> struct(
        (cast(a AS decimal(20, 0)) * cast({scale} AS decimal(8, 0))) div (cast(c.l AS decimal(20, 0)) + c.r) AS score, k, c.l AS l, c.r AS r)))"""))
    place = Window.partitionBy("lang").orderBy(F.desc("best.score"), F.desc("a"), F.asc("phrase"))
    top = scored.withColumn("rank", F.row_number().over(place).cast("long")).filter(F.col("rank") <= first)
    return top.join(totals, "lang").select("lang", "rank", "phrase", "a", "best.l", "best.r", "n", "best.score")
