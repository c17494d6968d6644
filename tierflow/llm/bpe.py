"""Byte-level BPE as a finite-state transducer, and streaming decoding.

A sequence of tokens is what the merges make of its bytes exactly when every two
neighbours are what the merges make of *their* bytes. So after each byte either the
current token goes on, or it ends and has to suit the token before it: a non-deterministic
transducer. ``Transducer`` determinises it while it reads. A state is the set of live
hypotheses, i.e. the places where the current token may have begun, given by the tokens
that ended there; a step tells the one token that may end at the new place. Tokens on which
all live hypotheses agree are emitted; hypotheses begin within the length of the longest
token, which bounds the lookahead.
"""

from __future__ import annotations

import base64
import hashlib
from array import array
from collections.abc import Iterable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tierflow.llm.chunks import ChunkEncoder
from tierflow.llm.common import arrow_batch, slices, texts_of


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and ranks of a rank file (base64, rank)."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class Merges:
    """The tokens that merging by rank leaves of a few bytes; the definition itself."""

    def __init__(self, ranks: dict[bytes, int]):
        if any(bytes([b]) not in ranks for b in range(256)):
            raise ValueError("every single byte has to be a token")
        self.ranks = ranks

    def __call__(self, data: bytes, before: int = 1 << 62) -> list[bytes]:
        """All merges of a rank below ``before``, lowest rank first, then leftmost."""
        parts = [data[i:i + 1] for i in range(len(data))]
        while len(parts) > 1:
            rank, at = min((self.ranks.get(parts[i] + parts[i + 1], 1 << 62), i) for i in range(len(parts) - 1))
            if rank >= before:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts


class Transducer:
    """Encodes the bytes of one match of the pattern.

    States are made when they are first needed; the table starts anew at ``most_states``,
    so memory stays bounded.
    """

    def __init__(self, ranks: dict[bytes, int], most_states: int = 200_000):
        self.ranks, self.most_states = ranks, most_states
        merges = Merges(ranks)
        # The two parts that the last merge of a token joins, and the token by its parts.
        self.whole = [False] * (max(ranks.values()) + 1)
        self.size = [0] * len(self.whole)
        self.halves: dict[int, tuple[int, int]] = {}
        for token, rank in ranks.items():
            parts = merges(token, rank)
            self.size[rank] = len(token)
            self.whole[rank] = len(token) == 1 or len(parts) == 2
            if len(parts) == 2:
                self.halves[rank] = ranks[parts[0]], ranks[parts[1]]
        self.joined = {pair: rank for rank, pair in self.halves.items()}
        self._build_trie()
        self._restart()

    def _build_trie(self):
        """The trie of the tokens; for each node the longest proper suffix that is a node too."""
        children: list[dict[int, int]] = [{}]
        self.token_at, self.depth = [-1], [0]
        for token, rank in self.ranks.items():
            node = 0
            for byte in token:
                if byte not in children[node]:
                    children[node][byte] = len(children)
                    children.append({})
                    self.token_at.append(-1)
                    self.depth.append(self.depth[node] + 1)
                node = children[node][byte]
            self.token_at[node] = rank
        self.children = children
        self.suffix = [0] * len(children)
        self.begins: dict[int, tuple[int, ...]] = {}
        level = list(children[0].values())
        while level:
            below = []
            for node in level:
                for byte, child in children[node].items():
                    at = self.suffix[node]
                    while at and byte not in children[at]:
                        at = self.suffix[at]
                    self.suffix[child] = children[at].get(byte, 0)
                    below.append(child)
            level = below

    def _restart(self):
        self.numbers: dict[tuple, int] = {}
        self.states: list[tuple] = []
        self.steps: dict[int, tuple[int, int]] = {}  # state number * 256 + byte -> the same and a token
        self._number((0, (-1,)))

    def _begins(self, node: int) -> tuple[int, ...]:
        """The lengths of a node's suffixes from which a token may still go on, longest first."""
        found = self.begins.get(node)
        if found is None:
            lengths, at = [], node
            while at:
                if self.children[at]:
                    lengths.append(self.depth[at])
                at = self.suffix[at]
            found = self.begins[node] = (*lengths, 0)
        return found

    def suits(self, before: int, token: int) -> bool:
        """Do the merges leave this token alone after that one (-1: at the start)?

        Only a merge across the border could join them. The parts that meet there over
        time are the last part of one token and the first part of the other, each taken
        apart in the reverse order of its merges; a merge of two of them happens if it
        comes before the merges that end either part.
        """
        if not self.whole[token]:
            return False
        if before < 0:
            return True
        halves, joined, limit = self.halves, self.joined, 1 << 62
        while True:
            if joined.get((before, token), limit) < limit:
                return False
            left, right = halves.get(before), halves.get(token)
            if left is None and right is None:
                return True
            if right is None or (left is not None and before > token):
                limit, before = before, left[1]
            else:
                limit, token = token + 1, right[0]

    def _number(self, state) -> int:
        number = self.numbers.get(state)
        if number is None:
            number = self.numbers[state] = len(self.states) << 8
            self.states.append(state)
        return number

    def _step(self, number: int, byte: int) -> tuple[int, int]:
        """The next state, and the token that ends with this byte if the input does."""
        node, befores = self.states[number >> 8]
        children, depth, suffix, token_at = self.children, self.depth, self.suffix, self.token_at
        before = dict(zip(self._begins(node), befores))
        while node and byte not in children[node]:
            node = suffix[node]
        node = children[node][byte]
        at, token = node, -1
        while at:
            token = token_at[at]
            if token >= 0 and self.suits(before[depth[at] - 1], token):
                break
            at = suffix[at]
        assert at, "any bytes have an encoding"
        live = tuple([before[length - 1] if length else token for length in self._begins(node)])
        return self._number((node, live)), token

    def __call__(self, data: bytes) -> list[int]:
        """Token ids of ``data``."""
        whole = self.ranks.get(data)
        if whole is not None or not data:
            return [whole] if data else []
        return [token for tokens in self.stream(data) for token in tokens]

    def stream(self, data: bytes, at_once: int = 4096) -> Iterator[list[int]]:
        """The ids in order; after every ``at_once`` bytes all that are certain by then."""
        if len(self.states) > self.most_states:
            self._restart()
        number, steps, size = 0, self.steps, self.size
        ends: list[int] = []  # the token that ends at each place since the last emission
        for start in range(0, len(data), at_once):
            put = ends.append
            for byte in data[start:start + at_once]:
                move = steps.get(number + byte)
                if move is None:
                    move = steps[number + byte] = self._step(number, byte)
                number, token = move
                put(token)
            places = {len(ends)}
            if start + at_once < len(data):
                places |= {len(ends) - length for length in self._begins(self.states[number >> 8][0])}
                while len(places) > 1:
                    last = max(places)
                    places.remove(last)
                    places.add(last - size[ends[last - 1]])
            agreed = at = places.pop()
            out = []
            while at:
                out.append(ends[at - 1])
                at -= size[ends[at - 1]]
            yield out[::-1]
            ends = ends[agreed:]


# Transitions of the UTF-8 machine: what the next byte may be, by state. State 0 is between
# characters; the others wait for the last bytes of one. A missing entry is an error.
_TAIL = range(0x80, 0xC0)
UTF8 = [{} for _ in range(8)]
for _state, _bytes, _next in (
    (0, range(0x00, 0x80), 0), (0, range(0xC2, 0xE0), 1), (0, (0xE0,), 4), (0, range(0xE1, 0xED), 2),
    (0, (0xED,), 5), (0, range(0xEE, 0xF0), 2), (0, (0xF0,), 6), (0, range(0xF1, 0xF4), 3), (0, (0xF4,), 7),
    (1, _TAIL, 0), (2, _TAIL, 1), (3, _TAIL, 2), (4, range(0xA0, 0xC0), 1), (5, range(0x80, 0xA0), 1),
    (6, range(0x90, 0xC0), 2), (7, range(0x80, 0x90), 2),
):
    UTF8[_state].update((b, _next) for b in _bytes)


class Utf8Machine:
    """Text from bytes that arrive in any pieces.

    Only the unfinished character at the end of a piece goes through the machine and is
    kept; what precedes it is complete. Each ill-formed part becomes U+FFFD.
    """

    def __init__(self):
        self.held = b""

    def feed(self, data: bytes) -> str:
        data = self.held + data
        cut = len(data)
        for start in range(len(data) - 1, max(-1, len(data) - 4), -1):
            if data[start] & 0xC0 != 0x80:
                state = 0
                for byte in data[start:]:
                    state = UTF8[state].get(byte, -1)
                    if state < 0:
                        break
                if state > 0:
                    cut = start
                break
        self.held = data[cut:]
        return data[:cut].decode("utf-8", "replace")

    def close(self) -> str:
        rest, self.held = self.held.decode("utf-8", "replace"), b""
        return rest


def decode_stream(ids: Iterable[int], tokens: list[bytes], at_once: int = 4096) -> Iterator[str]:
    """The text of ``ids``, in pieces."""
    machine, ids = Utf8Machine(), list(ids)
    for start in range(0, len(ids), at_once):
        yield machine.feed(b"".join(map(tokens.__getitem__, ids[start:start + at_once])))
    yield machine.close()


class Codec:
    """Encoding and decoding with one rank file."""

    def __init__(self, path: str, pattern: str):
        ranks = read_ranks(path)
        self.transduce = Transducer(ranks)
        self.tokens = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.tokens[rank] = token
        self.encode_texts = ChunkEncoder(lambda match: array("I", self.transduce(match.encode())).tobytes(), pattern)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return [np.frombuffer(codes, np.uint32) for codes in self.encode_texts(texts)]

    def decode(self, ids: np.ndarray) -> str:
        return "".join(decode_stream(ids.tolist(), self.tokens))


@cache
def codec(path: str, pattern: str) -> Codec:
    """One codec per worker process."""
    return Codec(path, pattern)


def encode_documents(docs: DataFrame, path: str, pattern: str, key: str = "doc_id", text: str = "text",
                     with_ids: bool = True) -> DataFrame:
    """doc_id, n_tokens, ids (unless not wanted), ids_sha256 and decoded_sha256 of every row, without a shuffle.

    The ids (array of int) hold no special tokens; ids_sha256 is the digest of the ids as
    little-endian unsigned 32-bit integers, decoded_sha256 that of the bytes which the
    streaming decoder makes of them. Null and empty texts have no ids. Rows may repeat;
    other columns are not read. ``path`` has to exist on the executors.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()),
                        ("decoded_sha256", pa.string()), *([("ids", pa.list_(pa.int32()))] if with_ids else [])])

    def run(batches):
        own = codec(path, pattern)
        for part in slices(batches):
            encoded = own.encode(texts_of(part.column(1)))
            digests, decoded = [], []
            for ids in encoded:
                digests.append(hashlib.sha256(ids.astype("<u4").tobytes()).hexdigest())
                whole = hashlib.sha256()
                for piece in decode_stream(ids.tolist(), own.tokens):
                    whole.update(piece.encode())
                decoded.append(whole.hexdigest())
            sizes = [len(ids) for ids in encoded]
            columns = [part.column(0), sizes, digests, decoded]
            if with_ids:
                ends = np.cumsum([0, *sizes]).astype(np.int32)
                columns.append(pa.ListArray.from_arrays(ends, np.concatenate(encoded).astype(np.int32)))
            yield arrow_batch(schema, *columns)

    return docs.select(docs[key].cast("long").alias("doc_id"), docs[text].alias("text")).mapInArrow(
        run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids)
