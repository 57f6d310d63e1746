import base64
import hashlib
import json
import re

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from hexwatch.llm import secrets
from hexwatch.llm.queries import QUERIES


def der(tag, body):
    size = len(body)
    head = bytes([size]) if size < 128 else bytes([0x80 | (n := (size.bit_length() + 7) // 8)]) + size.to_bytes(n)
    return bytes([tag]) + head + body


NUMBER = der(2, b"\x01" + bytes(range(1, 65)))
RSA = der(0x30, der(2, b"\x00") + NUMBER * 8)
PUBLIC = der(0x30, der(0x30, der(6, secrets.KEY_OIDS[0]) + der(5, b"")) + der(3, b"\x00" + der(0x30, NUMBER * 2)))
FIELD = lambda b: len(b).to_bytes(4) + b
SSH = FIELD(b"ssh-ed25519") + FIELD(bytes(32))
b64 = lambda b: base64.b64encode(b).decode()
url64 = lambda b: base64.urlsafe_b64encode(b).decode().rstrip("=")
TOKEN = ".".join(url64(x) for x in (json.dumps({"alg": "HS256", "typ": "JWT"}).encode(), b'{"sub":"1"}', bytes(range(32))))
PEM = "-----BEGIN RSA PRIVATE KEY-----\n" + "\n".join(re.findall(".{1,64}", b64(RSA))) + "\n-----END RSA PRIVATE KEY-----"


OCTETS = bytes(range(64, 112))
PKCS8 = der(0x30, der(2, b"\x00") + der(0x30, der(6, secrets.KEY_OIDS[0]) + der(5, b"")) + der(4, RSA))
ED25519 = der(0x30, der(2, b"\x01") + der(0x30, der(6, bytes.fromhex("2b6570"))) + der(4, der(4, OCTETS[:32])) + der(0x81, b"\x00" + OCTETS[:32]))
EC = der(0x30, der(2, b"\x01") + der(4, OCTETS[:32]) + der(0xA0, der(6, bytes.fromhex("2a8648ce3d030107"))) + der(0xA1, der(3, b"\x00" + OCTETS)))
DSA = der(0x30, der(2, b"\x00") + NUMBER * 5)
SEALED = der(0x30, der(0x30, der(6, secrets.PBES2) + der(0x30, der(0x30, b"") * 2)) + der(4, OCTETS))
CERTIFICATE = der(0x30, der(0x30, der(0xA0, der(2, b"\x02")) + NUMBER + der(0x30, der(6, secrets.KEY_OIDS[0])) + PUBLIC) + der(0x30, der(6, secrets.KEY_OIDS[0])) + der(3, b"\x00" + OCTETS))
armour = lambda label, raw, head="": f"-----BEGIN {label}-----\n{head}" + "\n".join(re.findall(".{1,64}", b64(raw))) + f"\n-----END {label}-----"
HEADERS = "Proc-Type: 4,ENCRYPTED\nDEK-Info: AES-128-CBC,00112233445566778899AABBCCDDEEFF\n\n"


@pytest.mark.parametrize("text, kind", [
    (TOKEN, "jwt"), (PEM, "pem"), (b64(RSA), "der"), (RSA.hex(), "der"), (url64(PKCS8), "der"), (b64(ED25519), "der"), (b64(EC), "der"), (b64(DSA), "der"), (b64(SEALED), "der"),
    (armour("PRIVATE KEY", PKCS8), "pem"), (armour("EC PRIVATE KEY", EC), "pem"), (armour("ENCRYPTED PRIVATE KEY", SEALED), "pem"), (armour("RSA PRIVATE KEY", OCTETS, HEADERS), "pem"),
])
def test_structures_are_confirmed(text, kind):
    spans = secrets.confirmed(f"é before {text} after")
    assert (kind, 9, 9 + len(text)) in spans


LINES = re.findall(".{1,64}", b64(RSA))
CONTAINER = secrets.SSH_KEY + FIELD(b"none") + FIELD(b"none") + FIELD(b"") + (1).to_bytes(4) + FIELD(SSH) + FIELD(b"abcdabcd" + bytes(range(128)))
LOCKED = secrets.SSH_KEY + FIELD(b"aes256-gcm@openssh.com") + FIELD(b"bcrypt") + FIELD(bytes(24)) + (1).to_bytes(4) + FIELD(SSH) + FIELD(bytes(range(128))) + bytes(16)
SHORT = ".".join((url64(b'{"alg":"HS256"}'), "e30", "abcdefghij"))


@pytest.mark.parametrize("text, kind", [
    (PEM.replace("\n", "\\n"), "pem"), (PEM.replace("\n", "\\\\n"), "pem"), (PEM.replace("\n", "\n> "), "pem"), (PEM.replace("\n", '\\n" +\n  "'), "pem"), (PEM.replace("\n", "\\r\\n"), "pem"),
    ("\n".join(LINES), "der"), ("\\n".join(LINES), "der"), ("\r\n> ".join(LINES), "der"), ('\\n" +\n"'.join(LINES), "der"),
    ("\n".join(re.findall(".{1,70}", b64(CONTAINER))), "ssh"), ("\\n".join(re.findall(".{1,64}", b64(PKCS8))), "der"), ("\n".join(re.findall(".{1,70}", b64(LOCKED))), "ssh"),
])
def test_wrapped_and_escaped_keys_are_confirmed(text, kind):
    for before, after in (("é before ", " after"), ("é before\n", "\nNext line of words"), ('{"key": "\\n', '\\n", "x": 1}')):
        spans = secrets.confirmed(before + text + after)
        assert spans == {(kind, len(before), len(before) + len(text))}
        assert secrets.scan(pa.array([before + text + after]))[0]


def test_short_token_is_found_alone():
    assert 33 <= len(SHORT) < 40
    assert secrets.scan(pa.array([f"a {SHORT} b", "a.b.c and words.with.dots"])) == [[("jwt", 2, 2 + len(SHORT))], []]


def test_wrapped_lookalikes_are_not():
    for lines in (LINES[:-1], LINES[1:], [*LINES[:-1], "AAAA"]):
        assert not secrets.confirmed("words\n" + "\n".join(lines) + "\nmore words")


@pytest.mark.parametrize("raw", [
    PUBLIC, CERTIFICATE, der(0x30, NUMBER * 2), SSH, FIELD(b"ssh-rsa") + FIELD(b"\x01\x00\x01") + FIELD(bytes(range(200))),
    RSA.replace(b"\x02\x01\x00", b"\x02\x01\x07", 1), der(0x30, der(2, b"\x00") + NUMBER * 7), der(0x30, der(2, b"\x02") + der(4, OCTETS)), SEALED.replace(secrets.PBES2, secrets.KEY_OIDS[0]),
    CONTAINER[:-1], CONTAINER + b"x", CONTAINER.replace(b"abcdabcd", b"abcdabce"), secrets.SSH_KEY + bytes(range(90)), LOCKED[:-9], OCTETS * 3,
], ids=range(15))
def test_what_is_public_or_broken_is_not_a_secret(raw):
    wrapped = "\n".join(re.findall(".{1,64}", b64(raw)))
    for text in (b64(raw), raw.hex(), wrapped, f"ssh-rsa {b64(raw)} user@host", armour("PUBLIC KEY", raw), armour("CERTIFICATE", raw), armour("ENCRYPTED PRIVATE KEY", raw), armour("OPENSSH PRIVATE KEY", raw)):
        assert not [s for s in secrets.confirmed(text) if s[0] != "hex"]


def test_time_is_linear():
    import time

    lines = re.findall(".{1,64}", b64(PKCS8))
    for unit in (lines[0] + "\n", "\n".join(lines) + "\nword\n", armour("PRIVATE KEY", PKCS8) + "\n", "-----BEGIN PRIVATE KEY-----\n" + lines[1] + "\n"):
        took = []
        for n in (1 << 17, 1 << 20):
            text = unit * (n // len(unit))
            began = time.perf_counter()
            secrets.confirmed(text)
            took.append(time.perf_counter() - began)
        assert took[1] < 40 * max(took[0], 0.05)


def test_lookalikes_are_not():
    for raw in (bytes(range(100)), RSA[:-1], RSA + b"x", der(0x30, der(0x0C, b"just a text of some length, not a key")), b"plain text " * 9):
        assert not secrets.confirmed(f"x {b64(raw)} y {raw.hex()} z")
    assert not secrets.confirmed(url64(b'{"typ":"JWT"}') + ".e30.abcdefghij")
    assert not secrets.confirmed(url64(b'{"alg":"HS256"}') + ".abcdefgh.abcdefghij")
    assert not secrets.confirmed("-----BEGIN RSA PRIVATE KEY-----\nnot a key at all\n-----END RSA PRIVATE KEY-----")


def brute(text):
    spans = []
    for kind, pattern, ok in (
        ("assign", r"((?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY]))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", lambda m: len(m[2]) >= 6),
        ("access", r"AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 20),
        ("hex", r"[0-9a-f]+", lambda m: len(m[0]) >= 24),
    ):
        spans += [(kind, m.start(), m.end()) for m in re.finditer(pattern, text or "") if ok(m)]
    return secrets.ordered(spans)


def check(docs, got):
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    n = 0
    for r in got.collect():
        base = brute(texts[r["doc_id"]])
        shown = ",".join(f"{k}:{a}:{b}" for k, a, b in base)
        assert [r["n_assign"], r["n_access"], r["n_hex"]] == [sum(k == x for k, *_ in base) for x in ("assign", "access", "hex")]
        assert r["base_sha256"] == hashlib.sha256(shown.encode()).hexdigest()
        assert set(shown.split(",")) - {""} <= set(r["spans"].split(","))
        n += len(base)
    return n


def test_query_against_brute_force(spark, odd, docs_of):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    assert check(docs, QUERIES["op7_secret_scan"](spark, sf)) > 0
    check(odd, secrets.digests(odd))
    texts = [
        "password=token = abcdef", "PASSWORD: 'hunter2xyz'", "api_key=abc apikey = abcdefg", "AKIA" + "B" * 15, "AKIA" + "B" * 16 + "x", "ſecret=abcdefgh", "toKen=abcdefgh",
        "passwd passwd=123456", "f" * 23, "f" * 24 + "F" + "a" * 30, "é😀 secret=abcdef", "secret  =  x", 'secret":"abcdef', "akia" + "a" * 30, TOKEN, PEM,
    ]
    rows = docs_of(list(enumerate(texts)))
    check(rows, secrets.digests(rows))


def test_redaction(docs_of, odd, empty):
    text = f"keep é {TOKEN} and password=hunter22 end"
    docs = docs_of([(1, text, "en", "s"), (2, "clean", None, None), (3, None, None, None)]).withColumn("redacted_text", F.lit("own"))
    out = {r["doc_id"]: r for r in secrets.redacted(docs).collect()}
    assert out[1]["text"] == "keep é [jwt] and [assign] end" and out[1]["n_chars"] == len(out[1]["text"])
    assert out[2]["text"] == "clean" and out[3]["text"] is None and out[1]["redacted_text"] == "own"
    assert secrets.redacted(docs).columns == docs.columns
    assert secrets.redacted(odd).count() == odd.count() and secrets.redacted(empty).count() == 0
    assert secrets.redact("abcdef", [("hex", 0, 3), ("der", 1, 5)]) == "[hex]f"


def test_memory_of_a_scan():
    """Runs of letters take a few bytes a position, whatever the block: executors hold several blocks at once."""
    import tracemalloc

    import numpy as np

    from hexwatch.llm import secrets
    from hexwatch.llm.common import spans_in

    data, bounds = np.full(1 << 20, ord(" "), np.uint8), np.array([0, 1 << 20])
    data[5:50] = ord("a")
    tracemalloc.start()
    start, end = spans_in(secrets.RUN_CLASS[data], bounds)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert (start.tolist(), end.tolist()) == ([5], [50]) and peak < 6 * len(data)
