"""SentencePiece BPE encoding with source offsets, and decoding.

The model file is parsed here (its bytes are read once on the driver and
broadcast; a vocabulary is a bounded parameter).  Normalisation walks the
compiled character map for the longest prefix at each place and records, for
every normalised byte, the source byte it came from; BPE merges then run
within the stretches between spaces, and every piece is projected back to a
span of original UTF-8 bytes.  Merges cannot cross from a word into the next
space when no piece of the vocabulary does, which is checked on load; a
model with such pieces is merged over whole texts.

Defined results: null counts as empty; an empty text has no pieces and
decodes to the empty text; repeated rows give a row each; ids may be null;
empty tables work; further columns are not read.
"""

from __future__ import annotations

import array
import hashlib
import heapq
import math
import re
import struct
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import id_text

SPACE = "▁"
NORMAL, UNKNOWN, CONTROL, USER, BYTE, UNUSED = 1, 2, 3, 4, 6, 5
CACHE_SIZE = 200_000


# ---- model file ----------------------------------------------------------

def _fields(b: bytes):
    """(number, value) of every field of a protocol-buffer message."""
    at = 0

    def varint():
        nonlocal at
        out = shift = 0
        while True:
            c = b[at]
            at += 1
            out |= (c & 0x7F) << shift
            shift += 7
            if c < 0x80:
                return out

    while at < len(b):
        key = varint()
        kind = key & 7
        if kind == 0:
            yield key >> 3, varint()
        elif kind == 2:
            n = varint()
            at += n
            yield key >> 3, b[at - n:at]
        else:
            n = 4 if kind == 5 else 8
            at += n
            yield key >> 3, b[at - n:at]


class Charsmap:
    """Longest-prefix replacement by a compiled character map: the size of a
    double-array trie, its units, then the replacements, each ended by NUL."""

    def __init__(self, blob: bytes):
        size = struct.unpack_from("<I", blob)[0]
        self.units = np.frombuffer(blob, "<u4", size // 4, 4).tolist()
        self.texts = blob[4 + size:]

    def longest(self, b: bytes, at: int) -> tuple[int, bytes] | None:
        """Length of the longest mapped prefix of ``b[at:]`` and its text."""
        units, best = self.units, None
        unit = units[0]
        node = (unit >> 10) << ((unit & 512) >> 6)
        for k in range(at, len(b)):
            node ^= b[k]
            if node >= len(units):
                break
            unit = units[node]
            if unit & 0x800000FF != b[k]:
                break
            node ^= (unit >> 10) << ((unit & 512) >> 6)
            if unit >> 8 & 1:
                best = k + 1 - at, units[node] & 0x7FFFFFFF
        if best is None:
            return None
        return best[0], self.texts[best[1]:self.texts.index(b"\0", best[1])]


class Model:
    """A SentencePiece BPE model: normalise, encode with spans, decode."""

    def __init__(self, blob: bytes):
        pieces, norm, trainer = [], b"", b""
        for k, v in _fields(blob):
            if k == 1:
                f = dict(_fields(v))
                pieces.append((f[1].decode(), struct.unpack("<f", f[2])[0] if 2 in f else 0.0, f.get(3, NORMAL)))
            elif k == 2:
                trainer = v
            elif k == 3:
                norm = v
        t, n = dict(_fields(trainer)), dict(_fields(norm))
        if t.get(3, 1) != 2:
            raise ValueError("not a BPE model")
        self.dummy_prefix, self.squeeze, self.escape = (bool(n.get(k, 1)) for k in (3, 4, 5))
        self.suffix, self.byte_fallback = bool(t.get(24, 0)), bool(t.get(35, 0))
        self.unk_surface = t.get(44, b" \xe2\x81\x87 ").decode()
        self.map = Charsmap(n[2]) if n.get(2) else None
        self.pieces = pieces
        self.scores = {p: s for p, s, kind in pieces if kind in (NORMAL, USER, UNUSED)}
        self.ids = {p: i for i, (p, _, kind) in enumerate(pieces) if kind in (NORMAL, USER, UNUSED)}
        self.unk = next(i for i, p in enumerate(pieces) if p[2] == UNKNOWN)
        self.unused = {p for p, _, kind in pieces if kind == UNUSED}
        self.byte_id = {int(p[3:5], 16): i for i, (p, _, kind) in enumerate(pieces) if kind == BYTE}
        self.id_byte = {i: b for b, i in self.byte_id.items()}
        users = sorted((p for p, _, kind in pieces if kind == USER), key=len, reverse=True)
        self.user = re.compile("|".join(map(re.escape, users))) if users else None
        crossing = any(SPACE in p.lstrip(SPACE) for p in self.scores)
        self.stretch = re.compile(r".+", re.S) if crossing or users or self.suffix else re.compile(
            f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+")
        self.plain = self.map is None and self.dummy_prefix and not self.squeeze and self.escape and not self.suffix \
            and self.stretch.pattern != ".+"
        # what a piece decodes to wherever it stands; None: it depends, or the model squeezes spaces
        self.surface = [None if self.squeeze or self.suffix or kind in (CONTROL, UNKNOWN) or self.id_byte.get(i, 0) > 127
                        else chr(self.id_byte[i]) if kind == BYTE else p.replace(SPACE, " ")
                        for i, (p, _, kind) in enumerate(pieces)]
        self.known = {p: (i, len(p.encode()), len(p.encode()) - 2 * p.count(SPACE)) for p, i in self.ids.items()}
        self.young: dict[str, bytes] = {}
        self.elder: dict[str, bytes] = {}

    # -- normalisation

    def normalise(self, text: str) -> tuple[str, np.ndarray | None]:
        """Normalised text and, for each of its UTF-8 bytes and its end, the
        source byte it came from; None where that is the plain case of a
        dummy prefix and every space turned into the (3-byte) space mark."""
        if not text:
            return "", np.zeros(1, np.int64)
        if self.map is None and not self.squeeze and self.escape and not self.suffix and SPACE not in text and not self.user:
            return (SPACE if self.dummy_prefix else "") + text.replace(" ", SPACE), None
        src = text.encode("utf-8", "replace")
        out, origin = [], []
        mark = SPACE.encode() if self.escape else b" "

        def put(b: bytes, at: int):
            out.append(b)
            origin.extend([at] * len(b))

        parts = list(self._parts(src, text))
        if self.squeeze:
            while parts and parts[0][1] == b" ":
                parts.pop(0)
            if not parts:
                return "", np.full(1, len(src), np.int64)
        start = parts[0][0]
        if self.dummy_prefix and not self.suffix:
            put(mark, start)
        space = self.squeeze
        for at, b in parts:
            if self.squeeze and space:
                b = b.lstrip(b" ")
            if b:
                for c in re.split(b"( )", b):
                    if c:
                        put(mark if c == b" " else c, at)
                space = b.endswith(b" ")
            if not self.squeeze:
                space = False
        end = len(src)
        if self.squeeze:
            while out and out[-1] == mark:
                end = origin[-1]
                del origin[len(origin) - len(mark):]
                out.pop()
        if self.dummy_prefix and self.suffix:
            put(mark, end)
        return b"".join(out).decode(), np.array([*origin, end], np.int64)

    def _parts(self, src: bytes, text: str):
        """(source byte, replacement) of each longest prefix in turn."""
        keep = {}
        if self.user:
            for m in self.user.finditer(text):
                keep[len(text[:m.start()].encode())] = m[0].encode()
        at, n = 0, len(src)
        while at < n:
            if at in keep:
                yield at, keep[at]
                at += len(keep[at])
                continue
            hit = self.map.longest(src, at) if self.map else None
            if hit:
                yield at, hit[1]
                at += hit[0]
            else:
                c = src[at]
                k = 1 if c < 0x80 else 2 if c < 0xE0 else 3 if c < 0xF0 else 4
                yield at, src[at:at + k]
                at += k

    # -- BPE

    def merge(self, s: str) -> list[str]:
        """Pieces of a stretch: the best-scored (then leftmost) neighbouring
        pair that forms a known piece is joined until none is left."""
        if len(s) <= 64 and not self.user and not self.unused:
            return self._merge_short(s)
        return self._merge_long(s)

    def _merge_short(self, s: str) -> list[str]:
        get, none = self.scores.get, -math.inf
        out = list(s)
        rank = [get(a + b, none) for a, b in zip(out, out[1:], strict=False)]
        while rank:
            best = max(rank)
            if best == none:
                break
            k = rank.index(best)
            out[k] += out.pop(k + 1)
            del rank[k]
            if k:
                rank[k - 1] = get(out[k - 1] + out[k], none)
            if k < len(rank):
                rank[k] = get(out[k] + out[k + 1], none)
        return out

    def _merge_long(self, s: str) -> list[str]:
        """The same by a heap, with user-defined pieces kept whole and
        pieces marked unused taken apart again."""
        symbols: list[str | None] = []
        frozen: set[int] = set()
        if self.user:
            at = 0
            for m in self.user.finditer(s):
                symbols += s[at:m.start()]
                frozen.add(len(symbols))
                symbols.append(m[0])
                at = m.end()
            symbols += s[at:]
        else:
            symbols = list(s)
        n = len(symbols)
        left, right = list(range(-1, n - 1)), [*range(1, n), -1]
        scores, heap, made_of = self.scores, [], {}

        def offer(a: int, b: int):
            if a < 0 or b < 0 or a in frozen or b in frozen:
                return
            joined = symbols[a] + symbols[b]
            score = scores.get(joined)
            if score is not None:
                heapq.heappush(heap, (-score, a, b, len(joined), joined))
                if joined in self.unused:
                    made_of[joined] = (symbols[a], symbols[b])

        for k in range(n - 1):
            offer(k, k + 1)
        while heap:
            _, a, b, size, joined = heapq.heappop(heap)
            if symbols[a] is None or symbols[b] is None or len(symbols[a]) + len(symbols[b]) != size or right[a] != b:
                continue
            symbols[a], symbols[b] = joined, None
            right[a] = right[b]
            if right[b] >= 0:
                left[right[b]] = a
            offer(left[a], a)
            offer(a, right[a])
        out = [x for x in symbols if x is not None]
        while any(p in made_of and p in self.unused for p in out):
            out = list(chain.from_iterable(made_of[p] if p in made_of and p in self.unused else (p,) for p in out))
        return out

    def _stretch(self, s: str) -> bytes:
        """The pieces of a stretch as packed (id, size in normalised bytes,
        size in source bytes if a space mark stands for one byte)."""
        out = []
        for p in self.merge(s):
            known = self.known.get(p)
            if known is not None:
                out += known
                continue
            size = len(p.encode())
            source = size - 2 * p.count(SPACE)
            if self.byte_fallback:
                # one character in several pieces: the last holds its span, the others are empty at its start
                for c in p.encode()[:-1]:
                    out += (self.byte_id[c], 0, 0)
                out += (self.byte_id[p.encode()[-1]], size, source)
            elif out and out[-3] == self.unk:
                out[-2] += size
                out[-1] += source
            else:
                out += (self.unk, size, source)
        return array.array("I", out).tobytes()

    def _cached(self, keys: list[str], mark: str = "") -> bytes:
        """The packed pieces of stretches, joined.  Two generations of cache:
        when the younger is full it becomes the elder, so what recurs stays."""
        if len(self.young) > CACHE_SIZE:
            self.elder, self.young = self.young, {}
        young, elder = self.young, self.elder
        out = list(map(young.get, keys))
        if None in out:
            for k, got in enumerate(out):
                if got is None:
                    s = keys[k]
                    got = young.get(s) or elder.get(s) or self._stretch(mark + s)
                    if len(s) <= 64:
                        young[s] = got
                    out[k] = got
        return b"".join(out)

    def pieces_of(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Ids of a text and, for each, its span of source bytes: n x 2,
        half-open."""
        if self.plain and text and SPACE not in text and "  " not in text and text[0] != " " and text[-1] != " ":
            packed, origin = self._cached(text.split(" "), SPACE), None
        else:
            norm, origin = self.normalise(text)
            packed = self._cached(self.stretch.findall(norm))
        found = np.frombuffer(packed, "<u4").reshape(-1, 3)
        ends = np.cumsum(found[:, 2 if origin is None else 1], dtype=np.int64)
        if origin is None and self.dummy_prefix:
            ends -= 1  # the dummy prefix has no source byte
        starts = np.concatenate((np.zeros(min(1, len(ends)), np.int64), ends[:-1]))
        if origin is not None:
            starts, ends = origin[starts], origin[ends]
        return found[:, 0], np.stack([starts, ends], axis=1)

    def encode(self, text: str) -> list[int]:
        return self.pieces_of(text)[0].tolist()

    def decode(self, ids: list[int]) -> str:
        """Text of ids: byte pieces are joined as UTF-8 (U+FFFD for each byte
        that is not), the dummy prefix goes, space marks become spaces."""
        try:
            text = "".join([self.surface[i] for i in ids])
        except TypeError:
            return self._decode_any(ids)
        return text[1:] if ids and self.dummy_prefix and self.pieces[ids[0]][0][0] == SPACE else text

    def _decode_any(self, ids: list[int]) -> str:
        out, run = [], bytearray()
        first = self.dummy_prefix or self.squeeze

        def flush():
            if run:
                out.append(_utf8(bytes(run)))
                run.clear()

        for i in ids:
            b = self.id_byte.get(i)
            if b is not None:
                run.append(b)
                first = False
                continue
            flush()
            piece, _, kind = self.pieces[i]
            if kind == CONTROL:
                continue
            if kind == UNKNOWN:
                out.append(self.unk_surface)
                first = False
                continue
            if first and not self.suffix:
                if piece.startswith(SPACE):
                    piece = piece[1:]
                    first = self.squeeze and not piece
                else:
                    first = False
            out.append(piece.replace(SPACE, " "))
        flush()
        return "".join(out)


def _utf8(b: bytes) -> str:
    out, at = [], 0
    while at < len(b):
        c = b[at]
        k = 1 if c < 0x80 else 2 if 0xC2 <= c < 0xE0 else 3 if 0xE0 <= c < 0xF0 else 4 if 0xF0 <= c < 0xF5 else 0
        try:
            out.append(b[at:at + k].decode() if k and at + k <= len(b) else "�")
            at += k if k and at + k <= len(b) else 1
        except UnicodeDecodeError:
            out.append("�")
            at += 1
    return "".join(out)


# ---- Spark ---------------------------------------------------------------

_MODELS: dict[str, Model] = {}


def _model(shared) -> Model:
    """The worker's parsed model; its cache of stretches lives as long."""
    blob = shared.value
    key = hashlib.sha256(blob).hexdigest()
    if key not in _MODELS:
        _MODELS.clear()
        _MODELS[key] = Model(blob)
    return _MODELS[key]


def read_model(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()


def encode_documents(docs: DataFrame, model: bytes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, ids, starts, ends, decoded`` of every document; starts and ends
    are offsets into the text's UTF-8 bytes."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        m = _model(shared)
        for batch in batches:
            for k in range(0, batch.num_rows, 256):
                part = batch.slice(k, 256)
                ids, starts, ends, decoded = [], [], [], []
                for text in part.column("text"):
                    i, spans = m.pieces_of(text.as_py())
                    ids.append(i)
                    starts.append(spans[:, 0])
                    ends.append(spans[:, 1])
                    decoded.append(m.decode(i.tolist()))
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), pa.array([i.astype(np.int32) for i in ids], pa.list_(pa.int32())), pa.array(starts, pa.list_(pa.int64())),
                     pa.array(ends, pa.list_(pa.int64())), pa.array(decoded)], ["id", "ids", "starts", "ends", "decoded"])
    return id_text(docs, id_col, text_col).mapInArrow(
        run, "id long, ids array<int>, starts array<long>, ends array<long>, decoded string")


def digest_documents(docs: DataFrame, model: bytes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """What ``encode_documents`` gives, as digests made where it is computed:
    ``id, n_tokens, ids_sha256, decoded_sha256, spans_sha256`` (the last of
    the spans as little-endian 64-bit pairs)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        m = _model(shared)
        names = [str(i) for i in range(len(m.pieces))]
        sha = lambda b: hashlib.sha256(b).hexdigest()
        for batch in batches:
            n, a, b, c = [], [], [], []
            for text in batch.column("text"):
                found, spans = m.pieces_of(text.as_py())
                ids = found.tolist()
                n.append(len(ids))
                a.append(sha(",".join([names[i] for i in ids]).encode()))
                b.append(sha(m.decode(ids).encode("utf-8", "surrogatepass")))
                c.append(sha(spans.astype("<i8").tobytes()))
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(n, pa.int64()), pa.array(a), pa.array(b), pa.array(c)],
                                             ["id", "n_tokens", "ids_sha256", "decoded_sha256", "spans_sha256"])
    return id_text(docs, id_col, text_col).mapInArrow(
        run, "id long, n_tokens long, ids_sha256 string, decoded_sha256 string, spans_sha256 string")


def query(docs: DataFrame, model: bytes) -> DataFrame:
    return digest_documents(docs, model).withColumnRenamed("id", "doc_id")
