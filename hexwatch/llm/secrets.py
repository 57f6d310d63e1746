"""Secret scans with structural confirmation (operator 7).

Three base patterns report assignments, access keys and long hex strings. Beyond them, runs of base64 or hex letters are
candidates: they are decoded, and reported only if what they hold parses to its end as a secret:

- DER: an RSA or DSA private key with its version and all its integers, an EC private key, a PKCS #8 key with version, key
  algorithm and octets, or an encrypted PKCS #8 key with a password-based algorithm and octets. Public keys and certificates are
  not secrets and are not reported;
- the OpenSSH private key container, all its length-prefixed fields to the end;
- a signed token whose first part is JSON with an algorithm and whose second part is JSON as well;
- between PEM marks, one of these, or the ciphertext of a key that is encrypted as its own headers say.

Keys may be wrapped, with escaped line ends, as in JSON and source strings, or behind quote marks: their lines are joined up
to the length that the structure itself gives. Candidates are found on the bytes of whole batches; only texts with a candidate
or a key word are looked at one by one. A DER key longer than MAX_KEY_BYTES is no key, so that a text full of lines that begin
like keys is read a bounded number of times.

Spans are (kind, start, end) in code points, end exclusive. Defined results: null and empty texts have no spans; very long texts
are scanned whole; of equal spans of one kind one is reported, others in the order of start, kind and end; repeated rows give
equal results; an empty table yields no rows; columns with the name of a result, in any case, are replaced.
"""

from __future__ import annotations

import base64
import binascii
import hashlib
import json
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hexwatch.llm.common import blocks, column, fresh, spans_in, text_bytes, with_columns

#: Kinds in the order in which they are listed.
KINDS = ("assign", "access", "hex", "jwt", "pem", "der", "ssh")
ASSIGN = re.compile(r"(?ai:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
JWT = re.compile(r"(?<![A-Za-z0-9_-])([A-Za-z0-9_-]{8,})\.([A-Za-z0-9_-]{2,})\.([A-Za-z0-9_-]{8,})(?![A-Za-z0-9_-])")
PEM = re.compile(r"-----BEGIN ([A-Z0-9 ]*PRIVATE KEY)-----((?:(?!-----)[A-Za-z0-9+/=\s:,\\\"'>#*|-])*)-----END \1-----")
BASE64_RUN = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{40,}={0,2}")
#: What may stand between two lines of one key: line ends, also escaped, marks of quotes and comments, joined source strings.
LINE_BREAK = re.compile(r"(?:\\+[nr]|\\(?=\r?\n)|[\s\"'>#*|,]|(?<=[\"'\s])\+(?=\s))+")
ESCAPE = re.compile(r"\\+[nrt]")
JOINED_STRINGS = re.compile(r"[\"']\s*[+,]?\s*[\"']")
BASE64_LINE = re.compile(r"[A-Za-z0-9+/_-]+")
HEX_RUN = re.compile(r"(?<![0-9A-Fa-f])[0-9A-Fa-f]{48,}(?![0-9A-Fa-f])")
#: Object identifiers of key algorithms, as DER bytes: RSA, EC, DSA, X25519, X448, Ed25519, Ed448, RSA-PSS.
KEY_OIDS = tuple(bytes.fromhex(x) for x in ("2a864886f70d010101", "2a8648ce3d0201", "2a8648ce380401", "2b656e", "2b656f", "2b6570", "2b6571", "2a864886f70d01010a"))
#: The same of password-based encryption: PBES2, and the beginnings of those of PKCS #5 and PKCS #12.
PBES2, PBES_OLD = bytes.fromhex("2a864886f70d01050d"), (bytes.fromhex("2a864886f70d0105"), bytes.fromhex("2a864886f70d010c01"))
SSH_KEY = b"openssh-key-v1\x00"
MAX_KEY_BYTES = 1 << 16
#: Headers of an encrypted PEM key, and the block sizes of the ciphers they name.
ENCRYPTED_HEADERS = re.compile(r"Proc-Type:\s*4,\s*ENCRYPTED\s+DEK-Info:\s*([A-Z0-9-]+),\s*([0-9A-Fa-f]{16,32})\s")
#: Letters of the shortest token that JWT matches.
LEAST_TOKEN = 20


def _class(letters: str) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(letters.encode())] = True
    return table


ALNUM = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
RUN_CLASS = _class(ALNUM + "+/_-.")
HEX_CLASS = _class("0123456789abcdef")
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def der_items(data: bytes) -> list[tuple[int, bytes]] | None:
    """The (tag, content) items that fill `data` exactly, or None."""
    items, at = [], 0
    while at < len(data):
        if at + 2 > len(data):
            return None
        tag, size = data[at], data[at + 1]
        at += 2
        if size & 0x80:
            n = size & 0x7F
            if not 1 <= n <= 4 or at + n > len(data) or data[at] == 0:
                return None
            size = int.from_bytes(data[at : at + n])
            at += n
            if size < 0x80:
                return None  # DER takes the short form
        if at + size > len(data):
            return None
        items.append((tag, data[at : at + size]))
        at += size
    return items


INTEGER, OCTETS, OID, SEQUENCE = 0x02, 0x04, 0x06, 0x30


def is_algorithm(content: bytes, known) -> bool:
    """An algorithm identifier: an object identifier that is `known`, and at most one item of parameters."""
    items = der_items(content)
    return bool(items) and len(items) <= 2 and items[0][0] == OID and known(items[0][1])


def is_der_key(data: bytes) -> bool:
    """A private key in DER that fills the data."""
    outer = der_items(data) if len(data) <= MAX_KEY_BYTES else None
    if not outer or len(outer) != 1 or outer[0][0] != SEQUENCE:
        return False
    items = der_items(outer[0][1])
    if not items:
        return False
    tags, first = [t for t, _ in items], items[0][1]
    if tags == [INTEGER] * 9:  # RSA: version 0, modulus, exponents, primes, their exponents and coefficient
        return first == b"\x00" and len(items[1][1]) >= 32
    if tags == [INTEGER] * 9 + [SEQUENCE]:  # with further primes
        return first == b"\x01" and len(items[1][1]) >= 32
    if tags == [INTEGER] * 6:  # DSA: version 0, three parameters, public and private number
        return first == b"\x00" and len(items[1][1]) >= 32
    if tags[:2] == [INTEGER, OCTETS] and first == b"\x01":  # EC, with curve and public point as options
        return len(items[1][1]) >= 16 and tags[2:] in ([], [0xA0], [0xA1], [0xA0, 0xA1])
    if tags[:3] == [INTEGER, SEQUENCE, OCTETS] and first in (b"\x00", b"\x01"):  # PKCS #8, with attributes and public key as options
        return len(items[2][1]) >= 16 and tags[3:] in ([], [0xA0], [0xA1], [0x81], [0xA0, 0xA1], [0xA0, 0x81]) and is_algorithm(items[1][1], lambda x: x in KEY_OIDS)
    if tags == [SEQUENCE, OCTETS]:  # encrypted PKCS #8
        sound = is_algorithm(first, lambda x: x == PBES2 or x.startswith(PBES_OLD))
        return sound and len(items[1][1]) >= 16 and len(items[1][1]) % 8 == 0
    return False


def is_ssh_key(data: bytes) -> bool:
    """The OpenSSH private key container: cipher, key derivation and its options, a number of public keys, and the private part."""
    if not data.startswith(SSH_KEY):
        return False
    at = len(SSH_KEY)

    def field() -> bytes | None:
        nonlocal at
        n = int.from_bytes(data[at : at + 4])
        if at + 4 + n > len(data):
            return None
        at += 4 + n
        return data[at - n : at]

    cipher, derivation, options = field(), field(), field()
    if cipher is None or derivation is None or options is None or not re.fullmatch(rb"[a-z0-9@.-]+", cipher) or derivation not in (b"none", b"bcrypt"):
        return False
    count = int.from_bytes(data[at : at + 4])
    at += 4
    if not 1 <= count <= len(data) // 4 or any(not field() for _ in range(count)):
        return False
    private = field()
    if not private or at > len(data) or len(private) % 8:
        return False
    rest = data[at:]  # authenticated ciphers add a tag
    if cipher == b"none":
        return not rest and private[:4] == private[4:8]
    return len(rest) in (0, 16)


def decoded(run: str) -> bytes | None:
    """Bytes of a base64 string in either alphabet, with or without padding."""
    body = run.rstrip("=").replace("-", "+").replace("_", "/")
    if len(body) % 4 == 1:
        return None
    try:
        return base64.b64decode(body + "=" * (-len(body) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def json_object(part: str) -> dict | None:
    raw = decoded(part)
    if not raw or raw[:1] != b"{":
        return None
    try:
        found = json.loads(raw)
    except (ValueError, RecursionError):
        return None
    return found if isinstance(found, dict) else None


def is_token(header: str, claims: str) -> bool:
    """The first parts of a signed token: base64 of a JSON object that names an algorithm, and of another JSON object."""
    head = json_object(header)
    return head is not None and isinstance(head.get("alg"), str) and json_object(claims) is not None


def der_size(data: bytes) -> int | None:
    """Bytes of the DER private key that may begin here: a sequence that begins with a version or with another sequence."""
    if len(data) < 12 or data[0] != SEQUENCE:
        return None
    n = data[1] & 0x7F if data[1] & 0x80 else 0
    if n > 4 or data[1] == 0x80:
        return None
    size = 2 + n + (int.from_bytes(data[2 : 2 + n]) if n else data[1])
    inner = data[2 + n :]
    return size if size <= MAX_KEY_BYTES and (inner[:2] == b"\x02\x01" and inner[2] < 2 or inner[0] == SEQUENCE) else None


def ssh_size(data: bytes) -> int | None:
    """Bytes of the OpenSSH container that begins here without a tag after it, or None if its fields end beyond the data."""
    at = len(SSH_KEY)
    for _ in range(3):
        at += 4 + int.from_bytes(data[at : at + 4])
    count = int.from_bytes(data[at : at + 4])
    at += 4
    for _ in range(count + 1):
        if at + 4 > len(data):
            return None
        at += 4 + int.from_bytes(data[at : at + 4])
    return at


def wrapped_end(text: str, start: int, end: int) -> tuple[str, int] | None:
    """Kind and end of a key that begins with the base64 line text[start:end] and goes on in the lines after it, or None."""
    head = decoded(text[start : start + 40])
    if not head:
        return None
    size = der_size(head)
    ssh = size is None and head.startswith(SSH_KEY)
    if size is None and not ssh:
        return None
    need = None if size is None else -(-size * 8 // 6)
    parts, ends, length = [text[start:end]], [end], end - start
    while length < (need or MAX_KEY_BYTES * 4 // 3):
        gap = LINE_BREAK.match(text, end)
        if not gap or not re.search(r"[\r\n\\]", gap[0]) or not (line := BASE64_LINE.match(text, gap.end())):
            break
        end = line.end()
        parts.append(line[0])
        ends.append(end)
        length += len(line[0])
    body = "".join(parts)
    if ssh:
        size = ssh_size(decoded(body[: len(body) // 4 * 4]) or b"")
        # The last letters may be a part of a group of four.
        size = size or ssh_size((decoded(body) or b""))
        if size is None:
            return None
        need = (-(-size * 8 // 6), -(-(size + 16) * 8 // 6))
    need = need if ssh else (need,)
    at = 0
    for part, stop in zip(parts, ends):
        at += len(part)
        if at in need and (raw := decoded(body[:at])):
            kind = "ssh" if ssh and is_ssh_key(raw) else "der" if not ssh and is_der_key(raw) else None
            return (kind, stop + len(re.match("={0,2}", text[stop : stop + 2])[0])) if kind else None
    return None


def is_pem_key(label: str, body: str) -> bool:
    """What stands between the marks of a private key: a key's structure, or ciphertext with the headers that say so."""
    plain = JOINED_STRINGS.sub("\n", ESCAPE.sub("\n", body))
    lines = [x for x in plain.split("\n") if ":" not in x]  # headers of encrypted keys
    raw = decoded(re.sub(r"[\s\\\"'>#*|]", "", "".join(lines)))
    if not raw:
        return False
    if is_der_key(raw) or is_ssh_key(raw):
        return True
    sealed = ENCRYPTED_HEADERS.search(re.sub(r"[>#*|\"']", " ", plain))
    return bool(sealed) and not label.startswith("ENCRYPTED") and len(raw) >= 48 and len(raw) % (len(sealed[2]) // 2) == 0


def confirmed(text: str) -> set[tuple[str, int, int]]:
    """Spans whose decoded structure is that of a key or token."""
    found = set()
    armoured = []
    for m in PEM.finditer(text):
        if is_pem_key(m[1], m[2]):
            found.add(("pem", m.start(), m.end()))
            armoured.append((m.start(), m.end()))
    for m in JWT.finditer(text):
        if is_token(m[1], m[2]):
            found.add(("jwt", m.start(), m.end()))
    at, taken = 0, 0  # the first armoured key that may reach the run, and the end of the last key found
    for m in BASE64_RUN.finditer(text):
        while at < len(armoured) and armoured[at][1] <= m.start():
            at += 1
        if m.start() < taken or at < len(armoured) and armoured[at][0] <= m.start():
            continue
        start = m.start()
        if text[start - 1 : start] == "\\" and m[0][0] in "nrt":
            start += 1  # the letter of an escape
        if whole := wrapped_end(text, start, start + len(text[start : m.end()].rstrip("="))):
            found.add((whole[0], start, whole[1]))
            taken = whole[1]
            continue
        raw = decoded(m[0]) if len(m[0]) <= 2 * MAX_KEY_BYTES else None
        if raw and is_der_key(raw):
            found.add(("der", m.start(), m.end()))
        elif raw and is_ssh_key(raw):
            found.add(("ssh", m.start(), m.end()))
    for m in HEX_RUN.finditer(text):
        if len(m[0]) % 2 == 0 and len(m[0]) <= 2 * MAX_KEY_BYTES and is_der_key(bytes.fromhex(m[0])):
            found.add(("der", m.start(), m.end()))
    return found


def base_spans(text: str) -> list[tuple[str, int, int]]:
    spans = [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m[1]) >= 6]
    spans += [("access", m.start(), m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= 20]
    return spans + [("hex", m.start(), m.end()) for m in HEX.finditer(text)]


def ordered(spans) -> list[tuple[str, int, int]]:
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def suspects(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Indexes of texts that may hold any span: long runs of base64 or hex letters, or one of the key words."""
    hit = np.zeros(len(bounds) - 1, bool)
    for table, least in ((RUN_CLASS, 40), (HEX_CLASS, 24)):
        start, end = spans_in(table[data], bounds)
        hit[np.searchsorted(bounds, start[end - start >= least], side="right") - 1] = True
    start, end = spans_in(RUN_CLASS[data], bounds)  # a short token has two dots in a run
    dots = np.flatnonzero(data == ord("."))
    token = (end - start >= LEAST_TOKEN) & (np.searchsorted(dots, end) - np.searchsorted(dots, start) >= 2)
    hit[np.searchsorted(bounds, start[token], side="right") - 1] = True
    whole = LOWER[data].tobytes()
    for word in (*(w.encode() for w in WORDS), b"akia", b"private key-----"):
        at = whole.find(word)
        while at >= 0:
            i = int(np.searchsorted(bounds, at, side="right")) - 1
            hit[i] = True
            at = whole.find(word, int(bounds[i + 1]))
    return np.flatnonzero(hit)


def scan(texts: pa.Array) -> list[list[tuple[str, int, int]]]:
    """All spans of every text, in order."""
    out: list[list[tuple[str, int, int]]] = [[] for _ in range(len(texts))]
    data, bounds = text_bytes(texts)
    for i, j in blocks(bounds):
        own = bounds[i : j + 1]
        for k in suspects(data[own[0] : own[-1]], own - own[0]):
            text = texts[i + int(k)].as_py()
            out[i + int(k)] = ordered([*base_spans(text), *confirmed(text)])
    return out


def find_secrets(docs: DataFrame, text: str = "text", into: str = "secrets") -> DataFrame:
    """Every row with an array of its spans: kind, start_at, end_at."""
    kind = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start_at", T.LongType()), T.StructField("end_at", T.LongType())]))
    arrow = pa.list_(pa.struct([("kind", pa.string()), ("start_at", pa.int64()), ("end_at", pa.int64())]))

    def make(texts: pa.Array) -> list[pa.Array]:
        return [pa.array([[{"kind": k, "start_at": a, "end_at": b} for k, a, b in spans] for spans in scan(texts)], arrow)]

    return with_columns(docs, text, {into: kind}, make)


def redact(text: str, spans: list[tuple[str, int, int]]) -> str:
    """The text with every span, overlapping ones together, replaced by a mark of its first kind."""
    out, at = [], 0
    for kind, start, end in spans:
        if start >= at:
            out += [text[at:start], f"[{kind}]"]
            at = end
        else:
            at = max(at, end)
    return "".join(out) + text[at:] if spans else text


def redacted(docs: DataFrame, text: str = "text", n_chars: str | None = "n_chars") -> DataFrame:
    """The input's columns with secrets replaced in the text; a null text stays null, `n_chars` follows a changed text."""
    clean = fresh(docs, "redacted_text")

    def make(texts: pa.Array) -> list[pa.Array]:
        found = scan(texts)
        return [pa.array([redact(texts[i].as_py(), s) if s else None for i, s in enumerate(found)], pa.string())]

    marked = with_columns(docs, text, {clean: T.StringType()}, make)
    changed = column(marked, clean)
    columns = []
    for c in docs.columns:
        if c == text:
            columns.append(F.coalesce(changed, column(marked, c)).alias(c))
        elif c == n_chars:
            columns.append(F.when(changed.isNotNull(), F.char_length(changed).cast(docs.schema[c].dataType)).otherwise(column(marked, c)).alias(c))
        else:
            columns.append(column(marked, c))
    return marked.select(*columns)


def digests(docs: DataFrame) -> DataFrame:
    """Counts of the base kinds and the joined spans, per document."""

    def make(texts: pa.Array) -> list[pa.Array]:
        columns: tuple[list, ...] = ([], [], [], [], [])
        for spans in scan(texts):
            base = [s for s in spans if s[0] in KINDS[:3]]
            joined = [",".join(f"{k}:{a}:{b}" for k, a, b in x) for x in (base, spans)]
            counts = [sum(s[0] == k for s in base) for k in KINDS[:3]]
            for c, v in zip(columns, (*counts, hashlib.sha256(joined[0].encode()).hexdigest(), joined[1])):
                c.append(v)
        return [*(pa.array(c, pa.int64()) for c in columns[:3]), *(pa.array(c, pa.string()) for c in columns[3:])]

    fields = {"n_assign": T.LongType(), "n_access": T.LongType(), "n_hex": T.LongType(), "base_sha256": T.StringType(), "spans": T.StringType()}
    return with_columns(docs.select("doc_id", "text"), "text", fields, make).drop("text")
