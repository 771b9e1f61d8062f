"""Secret scans with structural confirmation.

Base patterns (assignments, access keys, long hex runs) give candidate spans
in every whole text.  The method looks further at what a candidate encodes:
base64 or hex is decoded and parsed -- DER key encodings by their nested
lengths, length-prefixed key containers, signed-token headers -- and only a
confirmed structure adds a span (``jwt``, ``der``, ``sshkey``).  Base64 may
begin at any place that no base64 character precedes, or after an escaped
line end or tab, and goes on over line ends, real or escaped, and indentation.
Base spans always stay.

Spans are half-open, in code points.  Defined results: null counts as empty
and has no spans; repeated rows give a row each; ids may be null; empty
tables work; further columns are not read.
"""

from __future__ import annotations

import base64
import binascii
import hashlib
import json
import re

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import id_text

KINDS = ("assign", "access", "hex", "jwt", "der", "sshkey")
ASSIGN = re.compile(r"""(?i:(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?)([A-Za-z0-9+/_.=-]+)""", re.A)
ASSIGN_WORDS = ("passw", "secret", "token", "api")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
# the runs of [0-9a-f]+ that have 24 characters or more: a run is maximal either way
HEX = re.compile(r"[0-9a-f]{24,}")
# anchored where a run begins and possessive, so that a long run is read once
TOKEN = re.compile(r"(?<![A-Za-z0-9_-])[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{2,}+\.[A-Za-z0-9_-]*+")
# where base64 of a DER SEQUENCE or of a key container begins, with 24 characters or more in its first line
START64 = re.compile(r"[Mb](?:(?<![A-Za-z0-9+/].)|(?<=\\[nrt].))"
                     r"(?=(?<=M)[A-P][A-Za-z0-9+/]{22}|(?<=b)3BlbnNzaC1rZXktdjEA[A-Za-z0-9+/]{4})")
LINE64 = re.compile(r"[A-Za-z0-9+/]+")
NEXT64 = re.compile(r"(?:(?:\\+r)?\\+n|\\*\r?\n)(?:[\x20\t]|\\+t)*(?=[A-Za-z0-9+/])")
HEX_KEY = re.compile(r"(?:30|6[fF])(?:[0-9a-fA-F]{2}){23,}")
_RUN = bytes(104 if chr(c) in "0123456789abcdefABCDEF" else 98 if chr(c) in "+/-_=" or chr(c).isalnum() and c < 128
             else 32 for c in range(256))
SSH_MAGIC = b"openssh-key-v1\x00"


def decode64(s: str, alphabet: bytes = b"+/") -> bytes | None:
    s = "".join(s.split()).rstrip("=")
    if len(s) % 4 == 1:
        return None
    try:
        return base64.b64decode(s + "=" * (-len(s) % 4), altchars=alphabet, validate=True)
    except (binascii.Error, ValueError):
        return None


def der_item(b: bytes, at: int, end: int) -> tuple[int, int, int] | None:
    """Tag, start and end of the content of the DER item at ``at``."""
    if at + 2 > end:
        return None
    tag, n, at = b[at], b[at + 1], at + 2
    if n & 0x80:
        size = n & 0x7F
        if not 1 <= size <= 4 or at + size > end:
            return None
        n, at = int.from_bytes(b[at:at + size], "big"), at + size
    return (tag, at, at + n) if at + n <= end else None


def der_size(head: bytes) -> int | None:
    """Size of the DER item that ``head`` begins with, header included."""
    if len(head) < 6 or head[0] != 0x30:
        return None
    n = head[1]
    if n < 0x80:
        return 2 + n
    size = n & 0x7F
    return 2 + size + int.from_bytes(head[2:2 + size], "big") if 1 <= size <= 4 else None


def is_der_key(b: bytes) -> bool:
    """One SEQUENCE over the whole value whose children's lengths add up to
    it, and that starts as a key does: a version INTEGER followed by an
    INTEGER, SEQUENCE or OCTET STRING, or an algorithm SEQUENCE with an OID
    followed by a BIT STRING."""
    top = der_item(b, 0, len(b))
    if top is None or top[0] != 0x30 or top[2] != len(b):
        return False
    children, at = [], top[1]
    while at < top[2]:
        item = der_item(b, at, top[2])
        if item is None:
            return False
        children.append(item)
        at = item[2]
    if len(children) < 2:
        return False
    (tag, start, end), nxt = children[0], children[1][0]
    if tag == 0x02:
        return end - start == 1 and b[start] <= 3 and nxt in (0x02, 0x04, 0x30)
    if tag == 0x30 and nxt == 0x03:
        oid = der_item(b, start, end)
        return oid is not None and oid[0] == 0x06
    return False


def may_be_der_key(head: bytes) -> bool:
    """Whether the first bytes of a value can begin a key that ``is_der_key``
    confirms, so that no more is read of what cannot."""
    top = der_item(head, 0, 1 << 40)
    if top is None or top[0] != 0x30 or top[1] + 4 > len(head):
        return False
    at = top[1]
    if head[at] == 0x02:
        return head[at + 1] == 1 and head[at + 2] <= 3 and head[at + 3] in (0x02, 0x04, 0x30)
    inner = der_item(head, at, 1 << 40)
    return inner is not None and inner[0] == 0x30 and (inner[1] >= len(head) or head[inner[1]] == 0x06)


def ssh_parse(b: bytes) -> tuple[int | None, int, bool]:
    """Size of the key container that ``b`` begins with, if it can be told:
    magic, then length-prefixed strings cipher, kdf and options, a key count,
    as many length-prefixed public keys, and the private part with its tag.
    Else how many bytes must be at hand to go on (0: it is no container) and
    whether only the private part is missing."""
    if not b.startswith(SSH_MAGIC):
        return None, 0, False
    at, head, keys = len(SSH_MAGIC), [], None
    while True:
        private = keys == 0
        if at + 4 > len(b):
            return None, at + 4, private
        n = int.from_bytes(b[at:at + 4], "big")
        at += 4
        if keys is None and len(head) == 3:
            if not 1 <= n <= 16:
                return None, 0, False
            keys = n
            continue
        at += n
        if private:
            return at + 16 * (b"gcm" in head[0] or b"poly1305" in head[0]), 0, False
        if at > len(b):
            return None, at, False
        if keys is None:
            head.append(b[at - n:at])
        else:
            keys -= 1


def ssh_size(b: bytes) -> int | None:
    """Size of a key container, all of ``b`` if its private part is not whole."""
    size, _, private = ssh_parse(b)
    return len(b) if private else None if size is None else min(len(b), size)


def ssh_size_at(text: str, at: int) -> int | None:
    """``ssh_size`` of the base64 run at ``at``, of which only as much is
    read as the container's own lengths ask for."""
    need = 96
    while True:
        n = -(-need * 4 // 3)
        run, _ = base64_run(text, at, n)
        b = decode64(run[:len(run) - (len(run) % 4 == 1)]) or b""
        size, more, private = ssh_parse(b)
        if len(run) < n or size is not None and size <= len(b):
            return ssh_size(b)
        if size is None and not private and (not more or more > (len(text) - at) * 3 // 4):
            return None
        need = max(size or more, 2 * need)


def is_ssh_key(b: bytes) -> bool:
    return ssh_size(b) is not None


def is_token(s: str) -> bool:
    """Three base64url parts, the first a JSON object that names an
    algorithm, the second a JSON object."""
    head, body, sign = s.split(".")
    try:
        header, claims = (json.loads(decode64(x, b"-_") or b"") for x in (head, body))
    except (ValueError, UnicodeDecodeError):
        return False
    return isinstance(header, dict) and isinstance(header.get("alg"), str) and isinstance(claims, dict) \
        and (decode64(sign, b"-_") is not None)


def base_spans(text: str) -> list[tuple[str, int, int]]:
    out = []
    low = text.lower() if not text.isascii() else text.casefold()
    if any(w in low for w in ASSIGN_WORDS):
        out += [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        out += [("access", m.start(), m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    out += [("hex", m.start(), m.end()) for m in HEX.finditer(text)]
    return out


def confirmed_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans whose decoded structure confirms a key or signed token."""
    out = []
    if "eyJ" in text or "ey" in text and "." in text:
        out += [("jwt", m.start(), m.end()) for m in TOKEN.finditer(text) if m[0].startswith("ey") and is_token(m[0])]
    done = 0
    for m in START64.finditer(text):
        at = m.start()
        if at < done:
            continue
        if m[0] == "M":  # how 0x30 begins
            kind, size = "der", der_size(decode64(text[at:at + 8]) or b"")
        else:
            kind, size = "sshkey", ssh_size_at(text, at)
        if not size:
            continue
        need = -(-size * 4 // 3)
        if need > len(text) - at or kind == "der" and not may_be_der_key(decode64(base64_run(text, at, 24)[0]) or b""):
            continue
        run, end = base64_run(text, at, need)
        if len(run) == need and (kind == "sshkey" or is_der_key(decode64(run) or b"")):
            done = end + len(text[end:end + 2]) - len(text[end:end + 2].lstrip("="))
            out.append((kind, at, done))
    for m in HEX_KEY.finditer(text):
        raw = bytes.fromhex(m[0])
        size = der_size(raw)
        if size and size <= len(raw) and is_der_key(raw[:size]):
            out.append(("der", m.start(), m.start() + 2 * size))
        elif is_ssh_key(raw):
            out.append(("sshkey", m.start(), m.end()))
    return out


def base64_run(text: str, at: int, n: int) -> tuple[str, int]:
    """The first ``n`` base64 characters, or as many as there are, of the
    lines that begin at ``at``, and where the last of them ends."""
    out = []
    while True:
        end = min(LINE64.match(text, at).end(), at + n)
        out.append(text[at:end])
        n -= end - at
        m = NEXT64.match(text, end) if n else None
        if m is None:
            return "".join(out), end
        at = m.end()


def _has_run(text: str) -> tuple[bool, bool]:
    """Whether 24 hex characters, or 24 base64 characters, stand in a row."""
    runs = text.encode("utf-8", "surrogatepass").translate(_RUN)
    hexes = b"h" * 24 in runs
    return hexes, hexes or b"b" * 24 in runs.replace(b"h", b"b")


def find_spans(text: str | None) -> list[tuple[str, int, int]]:
    """All spans ``(kind, start, end)`` by start, then kind as listed."""
    if not text:
        return []
    _, long_run = _has_run(text)
    spans = base_spans(text)
    if long_run or "ey" in text and "." in text:
        spans += confirmed_spans(text)
    return sorted(set(spans), key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def written(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


SCHEMA = "id long, spans array<struct<kind:string,start:int,end:int>>"


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, spans`` of every document."""
    def run(batches):
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
        for batch in batches:
            spans = [[dict(zip(("kind", "start", "end"), s, strict=True)) for s in find_spans(t.as_py())]
                     for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(spans, kind)], ["id", "spans"])
    return id_text(docs, id_col, text_col).mapInArrow(run, SCHEMA)


def query(docs: DataFrame) -> DataFrame:
    def run(batches):
        for batch in batches:
            cols = [[], [], [], [], [], []]
            for found in batch.column("spans"):
                spans = [(s["kind"], s["start"], s["end"]) for s in found.as_py()]
                base = [s for s in spans if s[0] in KINDS[:3]]
                for c, k in zip(cols, KINDS[:3], strict=False):
                    c.append(sum(s[0] == k for s in base))
                cols[3].append(hashlib.sha256(written(base).encode()).hexdigest())
                cols[4].append(written(spans))
                cols[5].append(len(spans) - len(base))
            arrays = [pa.array(c, t) for c, t in zip(cols, [pa.int64()] * 3 + [pa.string()] * 2 + [pa.int64()], strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("id"), *arrays], ["doc_id", "n_assign", "n_access", "n_hex",
                                                                             "base_sha256", "spans", "n_confirmed"])
    return scan_secrets(docs).mapInArrow(
        run, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_confirmed long")
