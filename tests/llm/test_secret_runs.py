"""Keys in wrapped, escaped and URL-safe runs, with and without armour."""

import base64
import json
import random

import pytest

from tierflow.llm.secrets import find_secrets

rng = random.Random(8)


def der(tag, data):
    size = len(data)
    head = bytes([size]) if size < 128 else bytes([0x80 | (size.bit_length() + 7) // 8]) + size.to_bytes((size.bit_length() + 7) // 8, "big")
    return bytes([tag]) + head + data


def field(data):
    return len(data).to_bytes(4, "big") + data


KEY = der(0x30, der(2, b"\0") + b"".join(der(2, b"\0" + rng.randbytes(128)) for _ in range(5)))
PUBLIC = field(b"ssh-rsa") + field(b"\1\0\1") + field(b"\0" + rng.randbytes(256))
OPENSSH = b"openssh-key-v1\0" + field(b"none") + field(b"none") + field(b"") + b"\0\0\0\1" + field(PUBLIC) + field(rng.randbytes(400))
CIPHER = rng.randbytes(640)


def lines(data, width=64, end="\n", coder=base64.b64encode):
    coded = coder(data).decode()
    return end.join(coded[i:i + width] for i in range(0, len(coded), width))


def armour(body, end="\n", name="RSA PRIVATE KEY"):
    return f"-----BEGIN {name}-----{end}{body}{end}-----END {name}-----{end}"


def found(text):
    return [(k, text[s:e]) for k, s, e in find_secrets(text) if k in ("pem", "der", "ssh")]


@pytest.mark.parametrize("body", [
    json.dumps({"private_key": armour(lines(KEY))}),
    json.dumps(json.dumps({"private_key": armour(lines(KEY))})),
    "KEY=" + armour(lines(KEY, end=r"\n"), end=r"\n"),
    armour("Proc-Type: 4,ENCRYPTED\nDEK-Info: AES-128-CBC,00112233445566778899AABBCCDDEEFF\n\n" + lines(CIPHER)),
    armour("Comment: a key\n\n" + lines(KEY)),
    json.dumps(armour(lines(OPENSSH), name="OPENSSH PRIVATE KEY")),
])
def test_armoured_keys(body):
    text = "before " + body + " after"
    (kind, span), = found(text)
    assert kind == "pem" and span.startswith("-----BEGIN ") and span.endswith(" KEY-----")


@pytest.mark.parametrize("kind, data", [("der", KEY), ("ssh", PUBLIC), ("ssh", OPENSSH)])
@pytest.mark.parametrize("coder", [base64.b64encode, base64.urlsafe_b64encode, base64.b16encode, lambda b: b.hex().encode(),
                                   lambda b: base64.urlsafe_b64encode(b).rstrip(b"=")])
@pytest.mark.parametrize("end", ["\n", "\r\n", r"\n", r"\r\n", "\n    ", ""])
def test_keys_without_armour(kind, data, coder, end):
    run = lines(data, 64, end, coder)
    for text in (f"key: {run}\nnext line", f'{{"k": "{run}"}}', rf'"\n{run}\n"', run):
        assert found(text) == [(kind, run)]


def test_near_misses_are_not_reported():
    for data in (KEY, OPENSSH):
        for broken in (lines(data[:-9]), lines(data[:40] + b"\0" + data[40:]), "x" + lines(data), lines(data).rstrip("=") + "xyzw"):
            assert found(f"key: {broken}\n") == []
    assert found(armour(lines(CIPHER))) == []
    assert found(armour("DEK-Info: AES-128-CBC,0011\nProc-Type: 4,ENCRYPTED\n\n" + lines(CIPHER[:-3]))) == []
    assert found("AAAA\n" * 500 + "MIIB\n" * 500 + "30820101\n" * 500) == []


def token(header='{"alg":"HS256","typ":"JWT"}'):
    def part(data):
        return base64.urlsafe_b64encode(data).rstrip(b"=").decode()

    return ".".join((part(header.encode()), part(b'{"sub":"1234567890"}'), part(rng.randbytes(32))))


@pytest.mark.parametrize("coder", [base64.b64encode, base64.urlsafe_b64encode, lambda b: b.hex().encode()])
@pytest.mark.parametrize("end", ["\n", r"\n", ""])
@pytest.mark.parametrize("kind, inner", [
    ("pem", armour(lines(KEY))), ("pem", armour(lines(OPENSSH), name="OPENSSH PRIVATE KEY")), ("jwt", token()), ("jwt", token('{ "alg": "HS256" }')),
])
def test_armour_and_tokens_inside_an_encoding(kind, inner, coder, end):
    run = lines(inner.encode(), 76, end, coder)
    for text in (f"tls.key: {run}\nnext", f'{{"k": "{run}"}}'):
        got = [(k, text[s:e]) for k, s, e in find_secrets(text) if k in ("pem", "der", "ssh", "jwt")]
        assert got == [(kind, run)]


@pytest.mark.parametrize("header", ['{"alg":"none"}', '{ "alg": "HS256"}', '{\n  "alg": "HS256"\n}', '{\r\n"alg":"HS256"}', '{\t"alg":"HS256"}'])
def test_token_headers_of_any_spacing(header):
    text = token(header)
    assert [(k, s, e) for k, s, e in find_secrets("x " + text) if k == "jwt"] == [("jwt", 2, 2 + len(text))]


def test_encoded_text_that_is_no_secret():
    for inner in ("-----BEGIN NOTE-----\n" + "abc " * 20 + "\n-----END NOTE-----", "eyJ hello", "{}" * 40, armour(lines(KEY[:-5]))):
        run = base64.b64encode(inner.encode()).decode()
        assert [k for k in find_secrets(f"v: {run}\n") if k[0] in ("pem", "der", "ssh", "jwt")] == []


@pytest.mark.parametrize("line", ["MIMA" + "A" * 60, "MIIB" + "Q" * 60, "AAAAB" + "A" * 59, "LS0tLS1CRUdJTi" + "A" * 50, "ZXlK" * 16, "308200ff" * 8])
def test_a_megabyte_of_lines_that_could_begin_keys(line):
    import time

    start = time.perf_counter()
    find_secrets((line + "\n") * (1_000_000 // (len(line) + 1)))
    assert time.perf_counter() - start < 30
