"""Secret scan with structural confirmation.

Three plain patterns give the base findings. Every other candidate is only reported once
its encoding has been taken apart: base64 or hexadecimal text is decoded, and the bytes
have to be a key, i.e. nested DER lengths that add up, the length-prefixed fields of an
SSH key, or a token whose header is JSON naming an algorithm. An encoded run may use either
base64 alphabet or hexadecimal and go on over line breaks, written out or escaped; the key's
own lengths tell where it ends. Armour and signed tokens are also found inside one such
encoding, as cluster manifests hold them. A run is read and decoded once, however many
places in it could begin a key.
"""

from __future__ import annotations

import base64
import binascii
import hashlib
import json
import re
from bisect import bisect_left

import pyarrow as pa
from pyspark.sql import DataFrame

from tierflow.llm.common import arrow_batch, slices, texts_of

# The base patterns and the least lengths of what they find.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
LEAST = {"assign": 6, "access": 20, "hex": 24}
KINDS = ("assign", "access", "hex", "pem", "der", "ssh", "jwt")

WORDS = ("passw", "secret", "token", "api")
# A run of at least that many lower-case hex digits is equal to a long enough match of HEX.
LONG_HEX = re.compile(r"[0-9a-f]{24,}")
# The body ends at the next dashes, whatever stands in it; what it holds is checked afterwards.
PEM = re.compile(r"-----BEGIN ([A-Z0-9 ]*(?:PRIVATE|PUBLIC) KEY)-----((?:[^-]|-(?!----))+)-----END \1-----")
PEM_HEADER = re.compile(r"[A-Za-z][A-Za-z0-9-]*:[^\n]*(?:\n[\x20\t][^\n]*)*\n")
DEK = re.compile(r"DEK-Info:\s*([A-Za-z0-9-]+),\s*([0-9A-Fa-f]+)")
ESCAPED = re.compile(r"\\+[nrt]")
# Base64 of a DER sequence longer than 127 bytes starts with MI and two more; shorter ones with MC, MD, ME, MF.
DER = re.compile(r"(?<![A-Za-z0-9+/])M[C-I][A-Za-z0-9+/]{40,}={0,2}")
DER_HEX = re.compile(r"(?<![0-9A-Fa-f])30(?:8[12])?[0-9A-Fa-f]{48,}")
SSH = re.compile(r"(?<![A-Za-z0-9+/])AAAA[A-Za-z0-9+/]{30,}={0,2}")
# Where an encoded key may begin, after an escaped line break too, and what may stand inside a run.
ENDS_BREAK = r"(?<=\\n)|(?<=\\r)|(?<=\\t)"
# Keys begin so, and so do armour and the headers of tokens when they are encoded once more.
START = re.compile(rf"(?:(?<![A-Za-z0-9+/_-])|{ENDS_BREAK})(?=M[B-I]|AAAA|b3Bl|LS0tLS1C|ZX(?:l[BJK]|d[or]|cw))")
START_HEX = re.compile(rf"(?:(?<![0-9A-Fa-f])|{ENDS_BREAK})(?=30|000000|6[Ff]70656[Ee]|(?:2[Dd]){{5}}42|657[79])")
PIECE = re.compile(r"([A-Za-z0-9+/_-]+)(={0,2})")
PIECE_HEX = re.compile(r"([0-9A-Fa-f]+)()")
BREAK = re.compile(r"\\+(?=/)|[\x20\t]*(?:\\+r)?(?:\\+n|\r?\n|\r)[\x20\t]*")
OPENSSH = b"openssh-key-v1\0"
KEY_TYPE = re.compile(rb"(ssh|ecdsa|sk)-[a-z0-9@.-]+")
# A header is a JSON object, with or without white space behind its first brace.
JWT = re.compile(r"(?<![A-Za-z0-9_-])e[wy][A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]*")
JWT_BYTES = re.compile(rb"e[wy][A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]*")


def _decoded(text: str) -> bytes:
    """Base64, standard or for URLs, with or without padding; nothing if it is none."""
    text = re.sub(r"\s", "", text).rstrip("=").replace("-", "+").replace("_", "/")
    try:
        return base64.b64decode(text + "=" * (-len(text) % 4), validate=True)
    except (binascii.Error, ValueError):
        return b""


def der_items(data: bytes, start: int, end: int) -> list[tuple[int, int, int]] | None:
    """(tag, start, end) of the values that fill data[start:end] exactly, or None."""
    items = []
    while start < end:
        if end - start < 2:
            return None
        tag, size, at = data[start], data[start + 1], start + 2
        if size >= 0x80:
            n = size & 0x7F
            if not 1 <= n <= 4 or at + n > end:
                return None
            size, at = int.from_bytes(data[at:at + n], "big"), at + n
            if size < 0x80:
                return None
        if at + size > end:
            return None
        items.append((tag, at, at + size))
        start = at + size
    return items


def is_der_key(data: bytes) -> bool:
    """One SEQUENCE over all bytes whose nested lengths fit and that holds key material.

    Key material: an INTEGER or BIT/OCTET STRING of 16 bytes or more at some depth.
    """
    top = der_items(data, 0, len(data))
    if not top or len(top) != 1 or top[0][0] != 0x30:
        return False
    material, open_items = False, [(0, *top[0])]
    while open_items:
        depth, tag, start, end = open_items.pop()
        if tag & 0x20:
            inside = der_items(data, start, end) if depth < 12 else None
            if not inside:
                return False
            open_items += [(depth + 1, *item) for item in inside]
        elif tag in (0x02, 0x03, 0x04) and end - start >= 16:
            material = True
    return material


def is_ssh_key(data: bytes) -> bool:
    """Length-prefixed fields that fill the bytes, of which the first names a key type."""
    if data.startswith(b"openssh-key-v1\0"):
        data = data[15:]
        at, fields = 0, 0
        while fields < 3:  # cipher, key derivation, its options
            if at + 4 > len(data):
                return False
            at, fields = at + 4 + int.from_bytes(data[at:at + 4], "big"), fields + 1
        return at + 4 <= len(data)
    at, fields = 0, []
    while at < len(data):
        size = int.from_bytes(data[at:at + 4], "big")
        if at + 4 + size > len(data):
            return False
        fields.append(data[at + 4:at + 4 + size])
        at += 4 + size
    return len(fields) >= 2 and re.fullmatch(rb"(ssh|ecdsa|sk)-[a-z0-9@.-]+", fields[0]) is not None


def is_token(text: str) -> bool:
    """A signed token: the header and the claims are JSON objects and the header names an algorithm."""
    header, claims, signature = text.split(".")
    try:
        head, body = json.loads(_decoded(header)), json.loads(_decoded(claims))
    except (ValueError, RecursionError):
        return False
    named = isinstance(head, dict) and isinstance(head.get("alg"), str) and isinstance(body, dict)
    return named and (bool(_decoded(signature)) or head["alg"].lower() == "none")


class Encoded:
    """A maximal encoded run of a text, joined over line breaks, decoded at most once per alignment."""

    def __init__(self, text: str, start: int, coded_hex: bool):
        self.hex, self.unit = coded_hex, 2 if coded_hex else 4
        self.places: dict[int, int] = {}  # start of a line in the text -> characters before it
        self.ends: dict[int, int] = {}  # characters up to the end of a line -> its place in the text
        parts, count, at = [], 0, start
        while piece := (PIECE_HEX if coded_hex else PIECE).match(text, at):
            self.places[at] = count
            parts.append(piece[1])
            count += len(piece[1])
            self.ends[count] = piece.end()
            gap = None if piece[2] else BREAK.match(text, piece.end())
            if not gap:
                break
            at = gap.end()
        self.chars, self.counts = "".join(parts), list(self.ends)
        self.decoded: dict[int, bytes] = {}
        self.unended: dict[int, bool] = {}

    def bytes_from(self, shift: int) -> bytes:
        if shift not in self.decoded:
            chars = self.chars[shift:]
            whole = len(chars) // self.unit * self.unit
            # The last one to three characters count as the end of the run.
            rest = "" if self.hex or len(chars) % 4 == 1 else chars[whole:]
            self.decoded[shift] = bytes.fromhex(chars[:whole]) if self.hex else _decoded(chars[:whole] + rest)
        return self.decoded[shift]


class Run:
    """What an encoded run holds from one of its places on."""

    def __init__(self, source: Encoded, start: int):
        self.source, self.offset = source, source.places[start]
        self.shift = self.offset % source.unit
        self.whole = source.bytes_from(self.shift)
        self.begin = (self.offset - self.shift) // source.unit * (1 if source.hex else 3)
        self.data = memoryview(self.whole)[self.begin:]

    def has(self, size: int) -> bool:
        """Are there so many bytes?"""
        return size <= len(self.data)

    def _characters(self, size: int) -> int:
        return self.offset + (2 * size if self.source.hex else -(-4 * size // 3))

    def end(self, size: int) -> int | None:
        """The place in the text where these bytes end together with a line, or None."""
        return self.source.ends.get(self._characters(size))

    def line_end(self, size: int) -> int:
        """The end in the text of the line that holds the last of these bytes."""
        counts = self.source.counts
        return self.source.ends[counts[min(bisect_left(counts, self._characters(size)), len(counts) - 1)]]

    def number(self, at: int, size: int = 4) -> int | None:
        return int.from_bytes(self.data[at:at + size], "big") if self.has(at + size) else None

    def starts(self, data: bytes) -> bool:
        return self.whole.startswith(data, self.begin)

    def armour(self) -> int | None:
        """The number of bytes of the armoured key that the run begins with, or None."""
        if self.source.unended.get(self.shift):
            return None
        end = self.whole.find(b"-----END ", self.begin)
        if end < 0:
            self.source.unended[self.shift] = True
            return None
        close = self.whole.find(b"-----", end + 9)
        found = PEM.match(self.whole[self.begin:close + 5].decode("latin-1")) if close > 0 else None
        return found.end() if found and _pem_key(found[2]) else None

    def token(self) -> int | None:
        """The number of bytes of the signed token that the run begins with, or None."""
        found = JWT_BYTES.match(self.whole, self.begin)
        return found.end() - found.start() if found and is_token(found[0].decode()) else None


def _field(run: Run, at: int) -> int | None:
    """The end of the length-prefixed field at that byte, if the run has it."""
    size = run.number(at)
    return at + 4 + size if size is not None and run.has(at + 4 + size) else None


def key_at(run: Run) -> tuple[str, int] | None:
    """The kind of the key that the run begins with and its end in the text, by the key's own lengths."""
    if run.number(0, 2) is None:
        return None
    if run.starts(b"-----BEGIN "):
        size = run.armour()
        return ("pem", run.line_end(size)) if size else None
    if run.starts(b"ey") or run.starts(b"ew"):
        size = run.token()
        return ("jwt", run.line_end(size)) if size else None
    if run.data[0] == 0x30:
        n = run.data[1] & 0x7F if run.data[1] >= 0x80 else 0
        if n > 4 or run.data[1] == 0x80:
            return None
        size = run.number(2, n) if n else run.data[1]
        if size is None or not run.has(2 + n + size):
            return None
        end = run.end(2 + n + size)
        return ("der", end) if end and is_der_key(run.data[:2 + n + size]) else None
    if run.starts(OPENSSH):
        at = len(OPENSSH)
        for _ in range(3):  # cipher, key derivation, its options
            at = _field(run, at) if at is not None else None
        keys = run.number(at) if at is not None else None
        if not keys:
            return None
        at += 4
        while at is not None and keys >= 0:  # the public keys, then the private ones
            at, keys = _field(run, at), keys - 1
        end = run.end(at) if at else None
        return ("ssh", end) if end else None
    at, found = _field(run, 0), None
    if at is None or not KEY_TYPE.fullmatch(run.whole, run.begin + 4, run.begin + at):
        return None
    while at is not None:
        at = _field(run, at)
        if at and run.end(at):
            found = "ssh", run.end(at)
    return found


def _bare_keys(text: str):
    """(kind, start, end) of the keys without armour, from either alphabet or hexadecimal, over any line breaks."""
    for starts, coded_hex in ((START, False), (START_HEX, True)):
        source = None
        for m in starts.finditer(text):
            if source is None or m.start() not in source.places:
                source = Encoded(text, m.start(), coded_hex)
            key = key_at(Run(source, m.start())) if source.chars else None
            if key:
                yield key[0], m.start(), key[1]


def _pem_key(body: str) -> bool:
    """A key in armour: line ends may be escaped, lines quoted, and header lines may come first."""
    body = ESCAPED.sub("\n", body).replace("\r", "\n").replace("\\", "").lstrip()
    headers = ""
    while m := PEM_HEADER.match(body):
        headers, body = headers + m[0], body[m.end():]
    data = _decoded("".join(line.strip("\x20\t\"',") for line in body.split("\n")))
    if "ENCRYPTED" in headers and (cipher := DEK.search(headers)):
        block = 8 if "DES" in cipher[1].upper() else 16
        return len(data) >= 2 * block and len(data) % block == 0
    return is_der_key(data) or is_ssh_key(data)


def find_secrets(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of all findings by start, then kind; code points, end exclusive."""
    found = []
    lower = text.lower()
    if any(word in lower for word in WORDS):
        found += [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST["assign"]]
    if "AKIA" in text:
        found += [("access", *m.span()) for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST["access"]]
    found += [("hex", *m.span()) for m in LONG_HEX.finditer(text)]
    if "-----BEGIN " in text:
        found += [("pem", *m.span()) for m in PEM.finditer(text) if _pem_key(m[2])]
    if "AAAA" in text:
        found += [("ssh", *m.span()) for m in SSH.finditer(text) if is_ssh_key(_decoded(m[0]))]
    if "ey" in text or "ew" in text:
        found += [("jwt", *m.span()) for m in JWT.finditer(text) if is_token(m[0])]
    inside = [(s, e) for kind, s, e in found if kind == "pem"]
    for m in DER.finditer(text) if "M" in text else ():
        if is_der_key(_decoded(m[0])) and not any(s <= m.start() < e for s, e in inside):
            found.append(("der", *m.span()))
    for m in DER_HEX.finditer(text) if "30" in text else ():
        if len(m[0]) % 2 == 0 and is_der_key(bytes.fromhex(m[0])):
            found.append(("der", *m.span()))
    told = {(kind, start) for kind, start, _ in found}
    found += [k for k in _bare_keys(text) if k[:2] not in told and not any(s <= k[1] < e for s, e in inside)]
    return sorted(found, key=lambda f: (f[1], KINDS.index(f[0]), f[2]))


def written(spans) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


SCHEMA = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_confirmed long"
_OUT = pa.schema([("doc_id", pa.int64()), ("n_assign", pa.int64()), ("n_access", pa.int64()), ("n_hex", pa.int64()),
                  ("base_sha256", pa.string()), ("spans", pa.string()), ("n_confirmed", pa.int64())])


def _scan(batches):
    for part in slices(batches):
        rows = []
        for key, text in zip(part.column(0).to_pylist(), texts_of(part.column(1))):
            spans = find_secrets(text)
            base = [s for s in spans if s[0] in LEAST]
            kinds = [s[0] for s in base]
            rows.append((key, kinds.count("assign"), kinds.count("access"), kinds.count("hex"),
                         hashlib.sha256(written(base).encode()).hexdigest(), written(spans), len(spans) - len(base)))
        yield arrow_batch(_OUT, *zip(*rows))


def scan_secrets(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The findings of every row of ``docs`` in one pass without a shuffle.

    Null and empty texts have none (empty ``spans``); repeated rows are scanned like
    others; other columns are not read; no rows give no rows.
    """
    return docs.select(docs[key].cast("long").alias("doc_id"), docs[text].alias("text")).mapInArrow(_scan, SCHEMA)
