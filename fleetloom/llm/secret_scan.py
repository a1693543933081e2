"""Secret scans with structural confirmation.

Three base patterns report by form alone. The rest of what the scan reports has been decoded and parsed first: PEM
blocks and bare base64 or hex runs whose bytes are a private key (DER with nested lengths that add up, or the OpenSSH
container), and signed tokens whose header decodes to a JSON object with an algorithm. What only looks like a key or a
token isn't reported.

Defined results: null text is the empty text and has no spans; a span is (kind, start, end) in code points, end exclusive, of
the whole match; spans are sorted by start, then in the order of KINDS; repeated rows give a row each; an empty table gives
none; other columns are ignored (scan) or kept (redact).
"""

from __future__ import annotations

import base64
import binascii
import hashlib
import json
import re
from bisect import bisect_left
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import forget, ship

#: Base kinds first, in the order that breaks ties; then the confirmed ones.
BASE_KINDS = ("assign", "access", "hex")
KINDS = (*BASE_KINDS, "pem_key", "base64_key", "hex_key", "signed_token")

_ASSIGN = re.compile(r"""((?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
_ASSIGN_WORDS = ("passw", "secret", "token", "apikey", "api_key")
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")  # a run of 24 at least is the whole run: what can't match starts no later inside it
_PEM_BEGIN = re.compile(r"-----BEGIN ([A-Z0-9 ]*PRIVATE KEY)-----")
_PEM_END = re.compile(r"-----END ([A-Z0-9 ]*PRIVATE KEY)(?=-----)")
#: Bytes that an encoded private key has at most when it runs over several lines; the largest in use have a sixth of that.
MAX_KEY = 1 << 16
# A DER sequence starts with 0x30, an OpenSSH key with its magic, an encoded PEM block with dashes.
_BASE64 = re.compile(r"(?<![A-Za-z0-9+/_-])(?:M[A-P][A-Za-z0-9+/_-]{6}|b3BlbnNzaC1rZXktdjE|LS0tLS1CRUdJTi)[A-Za-z0-9+/_-]*={0,2}")
# What may follow on the next line of a wrapped run; line ends may be escaped.
_WRAPPED = re.compile(r"(?:[ \t\r]*\n[ \t]*|(?:\\r)?\\n)([A-Za-z0-9+/_-]+={0,2})")
_HEX_DER = re.compile(r"(?<![0-9A-Fa-f])(?:30[0-9A-Fa-f]{60,}|6f70656e7373682d6b65792d7631[0-9A-Fa-f]{40,})")
_SIGNED = re.compile(r"(?<![A-Za-z0-9_.-])e[wy][A-Za-z0-9_-]{8,}(?:\.[A-Za-z0-9_-]*){2,4}")
_OPENSSH = b"openssh-key-v1\0"


def _decode64(text: str) -> bytes | None:
    body = re.sub(r"\s+", "", text).rstrip("=").replace("-", "+").replace("_", "/")
    try:
        return base64.b64decode(body + "=" * (-len(body) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def der_items(data: bytes) -> list[tuple[int, bytes]] | None:
    """The (tag, content) items of a DER value list whose lengths cover data exactly; None where they don't."""
    items, at = [], 0
    while at < len(data):
        if at + 2 > len(data):
            return None
        tag, size, at = data[at], data[at + 1], at + 2
        if tag & 31 == 31 or size == 0x80:
            return None
        if size > 0x80:
            n = size & 0x7F
            if n > 4 or at + n > len(data) or data[at] == 0:
                return None
            size, at = int.from_bytes(data[at : at + n], "big"), at + n
            if size < 0x80:
                return None
        if at + size > len(data):
            return None
        items.append((tag, data[at : at + size]))
        at += size
    return items


def is_der_private_key(data: bytes) -> bool:
    """PKCS#1, SEC1, DSA or PKCS#8 (plain or encrypted), by structure."""
    outer = der_items(data)
    if not outer or len(outer) != 1 or outer[0][0] != 0x30 or not (inner := der_items(outer[0][1])):
        return False
    tags = [t for t, _ in inner]
    if tags[0] == 0x02 and len(inner[0][1]) == 1:
        version = inner[0][1][0]
        if version <= 1 and len(tags) >= 6 and set(tags[1:]) <= {0x02, 0x30}:
            return all(c for _, c in inner)  # RSA has nine integers, DSA six
        if version == 1 and tags[1] == 0x04 and len(inner[1][1]) >= 20:
            return all(t in (0xA0, 0xA1) and der_items(c) is not None for t, c in inner[2:])
        if version <= 1 and tags[1:3] == [0x30, 0x04]:
            oid = der_items(inner[1][1])
            return bool(oid) and oid[0][0] == 0x06 and len(inner[2][1]) >= 16
    if tags == [0x30, 0x04]:
        oid = der_items(inner[0][1])
        return bool(oid) and oid[0][0] == 0x06 and len(oid) == 2 and len(inner[1][1]) >= 16
    return False


def _openssh_size(data: bytes) -> int | None:
    """How many bytes the OpenSSH private key container takes: strings with 32-bit lengths, a key count, public keys and the private part."""
    if not data.startswith(_OPENSSH):
        return None
    at, fields = len(_OPENSSH), 0

    def field() -> bytes | None:
        nonlocal at
        if at + 4 > len(data):
            return None
        size = int.from_bytes(data[at : at + 4], "big")
        if at + 4 + size > len(data):
            return None
        at += 4 + size
        return data[at - size : at]

    for _ in range(3):  # cipher, key derivation, its options
        if field() is None:
            return None
    if at + 4 > len(data) or not 1 <= (fields := int.from_bytes(data[at : at + 4], "big")) <= 64:
        return None
    at += 4
    return at if all(field() is not None for _ in range(fields)) and field() else None


def is_openssh_key(data: bytes) -> bool:
    return _openssh_size(data) is not None


def pem_blocks(text: str) -> Iterator[tuple[int, int, str]]:
    """Start, end and body of each PEM block of a private key: a begin mark and the next end mark of its kind, without overlaps."""
    ends: dict[str, list[int]] = {}
    for m in _PEM_END.finditer(text):
        ends.setdefault(m[1], []).append(m.start())
    at = 0
    while ends and (m := _PEM_BEGIN.search(text, at)):
        own = ends.get(m[1], [])
        k = bisect_left(own, m.end())
        if k < len(own):
            at = own[k] + len(m[1]) + 14
            yield m.start(), at, text[m.end() : own[k]]
        else:
            # The next begin mark may start in this one's last dashes.
            at = m.end() - 5


def _is_key(data: bytes | None) -> bool:
    if not data:
        return False
    if data.startswith(b"-----BEGIN"):
        block = next(pem_blocks(data.decode("latin-1")), None)
        return block is not None and _pem_holds_key(block[2])
    return is_openssh_key(data) or is_der_private_key(data)


def _pem_holds_key(body: str) -> bool:
    if "\n\n" in body.replace("\r", "") and "Proc-Type" in body:  # old encrypted form: headers, a blank line, then cipher text
        data = _decode64(body.replace("\r", "").split("\n\n", 1)[1])
        return bool(data) and len(data) % 8 == 0
    data = _decode64(body.replace("\\n", ""))
    return bool(data) and (is_openssh_key(data) or is_der_private_key(data))


def _json_object(part: str) -> dict | None:
    try:
        found = json.loads(_decode64(part) or b"")
    except (ValueError, RecursionError):
        return None
    return found if isinstance(found, dict) else None


def _is_signed_token(text: str) -> bool:
    parts = text.split(".")
    head = _json_object(parts[0])
    if not head or not isinstance(head.get("alg"), str):
        return False
    if len(parts) == 5:  # encrypted form
        return isinstance(head.get("enc"), str)
    if len(parts) != 3:
        return False
    if parts[2]:  # a signature may stand for any payload, also for one that is kept elsewhere
        return (head.get("b64") is False or _decode64(parts[1]) is not None) and bool(_decode64(parts[2]))
    return head["alg"] == "none" and _json_object(parts[1]) is not None


def _der_size(data: bytes) -> int:
    """How many bytes the DER value at the start of data takes by its header; 0 where there is no such header."""
    if len(data) < 6 or data[0] != 0x30 or data[1] == 0x80 or data[1] > 0x84:
        return 0
    n = data[1] & 0x7F if data[1] > 0x80 else 0
    return 2 + n + (int.from_bytes(data[2 : 2 + n], "big") if n else data[1])


def _begins_like_a_key(run: str) -> bool:
    """Whether base64 that is 96 long begins with the mark of a private key, with the name of an OpenSSH cipher, or with an integer or a sequence."""
    data = _decode64(run) or b""
    if data.startswith(b"-----"):
        return bool(_PEM_BEGIN.match(data.decode("latin-1")))
    if data.startswith(_OPENSSH):
        at = len(_OPENSSH)
        return 1 <= int.from_bytes(data[at : at + 4], "big") <= 64
    inner = 2 + (data[1] & 0x7F if len(data) > 1 and data[1] > 0x80 else 0)
    return data[:1] == b"\x30" and data[inner : inner + 1] in (b"\x02", b"\x30")


def _wrapped_end(text: str, m: re.Match) -> int | None:
    """The end of the key that starts with the base64 line m and goes on over further lines; None where there is none."""
    parts, at, n = [m[0]], m.end(), len(m[0])
    size, most = 0, -(-MAX_KEY * 4 // 3)
    if m[0][0] == "M":
        # The header says how long the key is, so no line after it is read.
        if not 0 < (size := _der_size(_decode64(m[0][:8]) or b"")) <= MAX_KEY:
            return None
    checked = False
    while not parts[-1].endswith("=") and n < (-(-size * 4 // 3) if size else most) and (more := _WRAPPED.match(text, at)):
        parts.append(more[1])
        at, n = more.end(), n + len(more[1])
        if not checked and n >= 96:
            # The beginning tells most of what is no key, before the lines after it are read.
            if not _begins_like_a_key("".join(parts)[:96]):
                return None
            checked = True
    if len(parts) == 1:
        return None
    if size:
        return at if _is_key(_decode64("".join(parts))) else None
    # Whole groups of four tell how far the container or the inner block goes; the key ends with the line that holds its last byte.
    run = "".join(parts).rstrip("=")
    data = _decode64(run[: len(run) - (len(run) % 4 == 1)]) or b""
    if data.startswith(_OPENSSH):
        size = _openssh_size(data) or 0
    elif block := next(pem_blocks(data.decode("latin-1")), None):
        size = block[1] if _pem_holds_key(block[2]) else 0
    if not size:
        return None
    at, n = m.end(), len(m[0])
    while n < -(-size * 4 // 3) and (more := _WRAPPED.match(text, at)):
        at, n = more.end(), n + len(more[1])
    return at


def _base64_keys(text: str) -> Iterator[tuple[int, int]]:
    """Spans of the private keys that stand as base64 without marks, on one line or wrapped."""
    at = 0
    while m := _BASE64.search(text, at):
        end = m.end() if _is_key(_decode64(m[0])) else _wrapped_end(text, m)
        if end is not None:
            yield m.start(), end
        at = end or m.end()


def find_secrets(text: str) -> list[tuple[str, int, int]]:
    """All spans of a text: base matches and structurally confirmed ones."""
    spans: list[tuple[str, int, int]] = []
    low = text.lower()
    if any(w in low for w in _ASSIGN_WORDS):
        spans += [("assign", *m.span()) for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    if "AKIA" in text:
        spans += [("access", *m.span()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 20]
    spans += [("hex", *m.span()) for m in _HEX.finditer(text)]
    if "-----BEGIN " in text:
        spans += [("pem_key", a, b) for a, b, body in pem_blocks(text) if _pem_holds_key(body)]
    spans += [("base64_key", *span) for span in _base64_keys(text)]
    if "30" in text or "6f70656e" in text:
        spans += [("hex_key", *m.span()) for m in _HEX_DER.finditer(text) if len(m[0]) % 2 == 0 and _is_key(bytes.fromhex(m[0]))]
    if "ey" in text or "ew" in text:
        for m in _SIGNED.finditer(text):
            token = m[0].rstrip(".") if not m[0].endswith("..") else m[0]
            token = token if _is_signed_token(token) else m[0]
            if _is_signed_token(token):
                spans.append(("signed_token", m.start(), m.start() + len(token)))
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def _joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def scan_secrets(docs: DataFrame) -> DataFrame:
    """docs(doc_id, text) -> doc_id, counts of the base kinds, base_sha256, spans, n_confirmed."""
    ship(docs.sparkSession)

    @F.pandas_udf("n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_confirmed long")
    def scan(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            rows = []
            for text in texts:
                spans = find_secrets(text)
                base = [s for s in spans if s[0] in BASE_KINDS]
                n = [sum(k == kind for k, _, _ in base) for kind in BASE_KINDS]
                rows.append((*n, hashlib.sha256(_joined(base).encode()).hexdigest(), _joined(spans), len(spans) - len(base)))
            yield pd.DataFrame(rows, columns=["n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_confirmed"])

    rows = docs.select(F.col("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    return rows.select("doc_id", scan("text").alias("found")).select("doc_id", "found.*")


def redacted(text: str) -> str:
    """The text with each secret replaced by its kind; of an assignment the name stays."""
    marks = []
    for kind, start, end in find_secrets(text):
        if kind == "assign":
            start = _ASSIGN.match(text, start).start(2)
        marks.append((start, end, kind))
    out, at = [], 0
    for start, end, kind in sorted(marks):
        if start >= at:
            out += [text[at:start], f"[{kind}]"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def redact_secrets(docs: DataFrame) -> DataFrame:
    """docs with the secrets in text replaced and n_chars counted anew; all rows and columns stay, null text stays null."""
    ship(docs.sparkSession)

    @F.pandas_udf("string")
    def redact(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        forget()
        for texts in batches:
            yield texts.map(redacted, na_action="ignore")

    kinds = dict(docs.dtypes)
    out = docs.withColumn("text", redact("text"))
    return out.withColumn("n_chars", F.length("text").cast(kinds["n_chars"])) if "n_chars" in kinds else out
