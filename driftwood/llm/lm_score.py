"""Language-model scoring by context-tree weighting over bytes.

A text is its UTF-8 bytes, A-Z lower-cased, between start and end marks.  A
byte is eight binary decisions; each decision (the bits of the byte so far)
has a context tree over the preceding bytes, nearest first, ``depth`` deep.
Every node keeps its counts' Krichevsky-Trofimov estimate, and the weighting
mixes the estimates of all depths: a node's probability is half its own plus
half the product of its children's.  The trees are learned from the training
documents and then stand still; a context never seen in training is closed,
that is, its nearest seen ancestor's estimate stands for it.  A text's score
is the log10 probability of its bytes, so its negative over log10(2) and the
number of bytes is its code length per byte.

Counts cover the whole corpus: each chunk of documents sends its distinct
byte strings of ``depth`` + 1 with counts, shuffled by their two nearest
context bytes; a part works out the subtrees below these and returns to every
chunk the probabilities of the strings that it asked for.  Only the counts at
depths 0 and 1 (at most 65,280 nodes) pass through the driver.  Token counts
for the unigram base are exchanged in the same way by 64-bit hash.

Defined results: null counts as empty; an empty text is scored by its end
mark alone and has one token, the end; without training documents every
estimate is one half; repeated rows give a row each and count as often;
ids may be null (bucket of the empty string); empty tables work; further
columns are not read.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .chunks import Chunk, chunk_table, cut, parts_for, rows_of, table_rows
from .common import fold_bytes, materialise, pack, pack_sorted, unpack, unpack_sorted, word_hashes

DEPTH = 4
FOLDS, HELD = 7, 2
END = np.uint64(0x656E642D6D61726B)  # the end token's hash
LIST_SCHEMA = "kind string, part int, chunk long, keys binary, counts binary"
_LIST = pa.schema([("kind", pa.string()), ("part", pa.int32()), ("chunk", pa.int64()), ("keys", pa.binary()),
                   ("counts", pa.binary())])
_LG = np.array([math.lgamma(i + 0.5) for i in range(512)])
_LF = np.array([math.lgamma(i + 1.0) for i in range(512)])
_LN2 = math.log(2)


def byte_strings(text: bytes, depth: int) -> np.ndarray:
    """Key of every byte of a text and of its end: the preceding bytes,
    nearest first, then the byte itself; NUL stands for both marks."""
    a = np.frombuffer(b"\0" * depth + text + b"\0", np.uint8).astype(np.uint64)
    n = len(text) + 1
    key = a[depth:].copy()
    for j in range(1, depth + 1):  # j bytes back
        key |= a[depth - j:depth - j + n] << np.uint64(8 * (depth + 1 - j))
    return key


def held_out(ids, nulls) -> np.ndarray:
    return np.array([zlib.crc32(b"" if z else str(i).encode()) % FOLDS == HELD
                     for i, z in zip(ids.tolist(), nulls.tolist(), strict=True)], bool)


def _count(keys: np.ndarray, train: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ascending distinct keys of all, with their numbers in ``train``."""
    every = np.unique(keys)
    seen, n = np.unique(train, return_counts=True)
    out = np.zeros(len(every), np.uint64)
    out[np.searchsorted(every, seen)] = n
    return every, out


def token_hashes(text: bytes) -> np.ndarray:
    return np.append(word_hashes(text), END)


def part_of(keys: np.ndarray, depth: int, parts: int) -> np.ndarray:
    """Part of byte strings: by the two context bytes nearest to the byte."""
    near = keys >> np.uint64(8 * (depth - 1))
    return ((near * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)) % np.uint64(parts)).astype(np.int64)


def split_keys(keys: np.ndarray, depth: int, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """Order of ascending byte strings by part, and where each part starts."""
    part = part_of(keys, depth, parts)
    by = np.argsort(part, kind="stable")
    return by, np.searchsorted(part[by], np.arange(parts + 1))


def count_lists(chunks: DataFrame, depth: int, parts: int) -> DataFrame:
    """Of each chunk its distinct byte strings and tokens with their counts
    in the training documents (0: only in held-out ones)."""
    def run(batches):
        for row in rows_of(batches):
            chunk = Chunk(row)
            texts = [fold_bytes(t) for t in chunk.texts]
            train = ~held_out(chunk.ids, chunk.nulls)

            def lists(of):
                made = [of(t) for t in texts]
                known = [m for m, y in zip(made, train, strict=True) if y]
                return _count(np.concatenate(made), np.concatenate(known) if known else np.empty(0, np.uint64))

            for kind, (keys, n) in (("bytes", lists(lambda t: byte_strings(t, depth))), ("token", lists(token_hashes))):
                if kind == "bytes":
                    by, at = split_keys(keys, depth, parts)
                    keys, n = keys[by], n[by]
                else:
                    at = cut(keys, parts)
                for p in range(parts):
                    a, b = at[p], at[p + 1]
                    if a < b:
                        yield pa.RecordBatch.from_pylist([{"kind": kind, "part": p, "chunk": row["chunk"],
                                                           "keys": pack_sorted(keys[a:b]), "counts": pack(n[a:b])}], _LIST)
    return chunks.mapInArrow(run, LIST_SCHEMA)


# ---- the trees -----------------------------------------------------------

def _lgamma_half(n: np.ndarray) -> np.ndarray:
    """log Gamma(n + 1/2) of whole numbers."""
    x = n + 0.5
    big = np.maximum(x, 100.0)
    return np.where(n < len(_LG), _LG[np.minimum(n, len(_LG) - 1).astype(np.int64)], _stirling(big))


def _lgamma_whole(n: np.ndarray) -> np.ndarray:
    """log Gamma(n + 1) of whole numbers."""
    big = np.maximum(n + 1.0, 100.0)
    return np.where(n < len(_LF), _LF[np.minimum(n, len(_LF) - 1).astype(np.int64)], _stirling(big))


def _stirling(x: np.ndarray) -> np.ndarray:
    return (x - 0.5) * np.log(x) - x + 0.5 * math.log(2 * math.pi) + 1 / (12 * x) - 1 / (360 * x ** 3)


def log_kt(n0: np.ndarray, n1: np.ndarray) -> np.ndarray:
    """Natural log of the Krichevsky-Trofimov probability of the counts."""
    return _lgamma_half(n0) + _lgamma_half(n1) - _lgamma_whole(n0 + n1) - math.log(math.pi)


class Level:
    """The nodes of one depth for one bit position, over ascending strings
    (context, byte) with counts: estimate, own weight and probability."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray, bit: int):
        byte = keys & np.uint64(255)
        node = (keys >> np.uint64(8)) << np.uint64(8) | np.uint64(1 << bit) | byte >> np.uint64(8 - bit)
        self.first = np.flatnonzero(np.concatenate(([True], node[1:] != node[:-1])))
        self.of = np.cumsum(np.concatenate(([False], node[1:] != node[:-1])))  # node of each string
        self.key = node[self.first]
        one = (byte >> np.uint64(7 - bit) & np.uint64(1)).astype(bool)
        self.one = one
        self.n1 = np.add.reduceat(np.where(one, counts, 0.0), self.first)
        self.n0 = np.add.reduceat(np.where(one, 0.0, counts), self.first)

    def weigh(self, below: np.ndarray | None) -> None:
        """``below``: sum of the children's log probabilities, None at the
        deepest level."""
        self.estimate = (self.n1 + 0.5) / (self.n0 + self.n1 + 1)
        own = log_kt(self.n0, self.n1)
        if below is None:
            self.log_p, self.stay = own, np.ones(len(own))
        else:
            self.log_p = np.logaddexp(own, below) - _LN2
            self.stay = np.exp(own - _LN2 - self.log_p)
        self.seen = self.n0 + self.n1 > 0


def tree_levels(keys: np.ndarray, counts: np.ndarray, depth: int, low: int):
    """Strings, counts and the place of each deeper string among them, from
    ``depth`` up to ``low``."""
    out = [(keys, counts, None)]
    for d in range(depth - 1, low - 1, -1):
        deep, n, _ = out[-1]
        shift = np.uint64(16)
        shorter = deep >> shift << np.uint64(8) | deep & np.uint64(255)
        up, at = np.unique(shorter, return_inverse=True)
        out.append((up, np.bincount(at, weights=n, minlength=len(up)), at))
    return out


def subtree(keys: np.ndarray, counts: np.ndarray, depth: int, low: int, bit: int) -> list[Level]:
    """Weighted levels from ``depth`` up to ``low`` for one bit position."""
    made, below, levels = tree_levels(keys, counts, depth, low), None, []
    for k, (up, n, at) in enumerate(made):
        level = Level(up, n, bit)
        if k:
            deep = levels[-1]
            level.parent_of_deep = level.of[at[deep.first]]
            below = np.bincount(level.parent_of_deep, weights=deep.log_p, minlength=len(level.key))
        level.weigh(below)
        level.at = at
        levels.append(level)
    return levels


def mixed(levels: list[Level]) -> tuple[np.ndarray, np.ndarray]:
    """For each of the deepest strings the mixed probability that its bit is
    one, as seen from the last level, and whether that level has counts."""
    q = seen = place = None
    for level in levels:
        place = np.arange(len(level.of)) if place is None else level.at[place]
        node = level.of[place]
        own, stay = level.estimate[node], level.stay[node]
        q = own if q is None else np.where(seen, stay * own + (1 - stay) * q, own)
        seen = level.seen[node]
    return q, seen


# ---- Spark ---------------------------------------------------------------

def merge_lists(t: pa.Table) -> tuple[list[dict], list[np.ndarray], np.ndarray, np.ndarray]:
    rows = table_rows(t)
    lists = [unpack_sorted(r["keys"]) for r in rows]
    keys, which = np.unique(np.concatenate(lists), return_inverse=True)
    total = np.bincount(which, weights=np.concatenate([unpack(r["counts"]) for r in rows]).astype(float), minlength=len(keys))
    at = np.cumsum([0, *map(len, lists)])
    return rows, [which[a:b] for a, b in zip(at, at[1:], strict=False)], keys, total


def top_nodes(lists: DataFrame, depth: int) -> DataFrame:
    """``node, n0, n1, below`` of the nodes at depth 1, summed over the parts
    that hold their children."""
    def run(t: pa.Table) -> pa.Table:
        _, _, keys, total = merge_lists(t)
        out = []
        for bit in range(8):
            deep = subtree(keys, total, depth, 2, bit)[-1]
            # context of two bytes, then the node: the farther byte goes
            up, at = np.unique(deep.key >> np.uint64(16) << np.uint64(8) | deep.key & np.uint64(255), return_inverse=True)
            out.append(pa.table({"node": up.astype(np.int64), **{
                c: np.bincount(at, weights=w, minlength=len(up)) for c, w in (("n0", deep.n0), ("n1", deep.n1), ("below", deep.log_p))}}))
        return pa.concat_tables(out)
    made = lists.where("kind = 'bytes'").groupBy("part").applyInArrow(run, "node long, n0 double, n1 double, below double")
    return made.groupBy("node").agg(*[F.sum(c).alias(c) for c in ("n0", "n1", "below")])


def weigh_top(rows) -> dict[str, np.ndarray]:
    """Estimates and weights at depths 0 and 1 by node number."""
    out = {k: np.zeros(65536) for k in ("estimate1", "stay1", "seen1")} | {k: np.zeros(256) for k in ("estimate0", "stay0", "seen0")}
    out["estimate0"] += 0.5
    out["estimate1"] += 0.5
    if not rows:
        return out
    node, n0, n1, below = (np.array([r[c] for r in rows]) for c in ("node", "n0", "n1", "below"))
    own = log_kt(n0, n1)
    p1 = np.logaddexp(own, below) - _LN2
    out["estimate1"][node], out["stay1"][node], out["seen1"][node] = (n1 + .5) / (n0 + n1 + 1), np.exp(own - _LN2 - p1), n0 + n1 > 0
    at = node & 255
    m0, m1, down = (np.bincount(at, weights=w, minlength=256) for w in (n0, n1, p1))
    own = log_kt(m0, m1)
    p0 = np.logaddexp(own, down) - _LN2
    out["estimate0"], out["stay0"], out["seen0"] = (m1 + .5) / (m0 + m1 + 1), np.exp(own - _LN2 - p0), m0 + m1 > 0
    return out


def string_log10(keys: np.ndarray, total: np.ndarray, depth: int, top: dict[str, np.ndarray]) -> np.ndarray:
    """log10 of each string's last byte's probability after its context."""
    out = np.zeros(len(keys))
    byte = (keys & np.uint64(255)).astype(np.int64)
    near = (keys >> np.uint64(8 * depth)).astype(np.int64)
    for bit in range(8):
        levels = subtree(keys, total, depth, 2, bit)
        q, seen = mixed(levels)
        node = 1 << bit | byte >> (8 - bit)
        for d, at in ((1, near << 8 | node), (0, node)):
            own, stay = top[f"estimate{d}"][at], top[f"stay{d}"][at]
            q = np.where(seen, stay * own + (1 - stay) * q, own)
            seen = top[f"seen{d}"][at] > 0
        out += np.log10(np.where(levels[0].one, q, 1 - q))
    return out


def answers(lists: DataFrame, depth: int, top) -> DataFrame:
    """To each chunk, for the byte strings it sent to a part, their log10
    probabilities in the same order."""
    def run(t: pa.Table) -> pa.Table:
        rows, which, keys, total = merge_lists(t)
        logs = string_log10(keys, total, depth, top.value).astype("<f4")
        return pa.table({"kind": ["bytes"] * len(rows), "part": pa.array([r["part"] for r in rows], pa.int32()),
                         "chunk": pa.array([r["chunk"] for r in rows], pa.int64()),
                         "values": pa.array([logs[w].tobytes() for w in which], pa.binary())})
    return lists.where("kind = 'bytes'").groupBy("part").applyInArrow(run, "kind string, part int, chunk long, values binary")


def token_answers(lists: DataFrame) -> DataFrame:
    """The same for tokens: their training counts; and of each part (chunk
    null) its numbers of training tokens and of distinct ones, packed."""
    def run(t: pa.Table) -> pa.Table:
        rows, which, _, total = merge_lists(t)
        total = total.astype(np.uint64)
        part = rows[0]["part"]
        sums = np.array([total.sum(dtype=np.uint64), (total > 0).sum()], np.uint64)
        return pa.table({"kind": ["token"] * (len(rows) + 1), "part": pa.array([part] * (len(rows) + 1), pa.int32()),
                         "chunk": pa.array([r["chunk"] for r in rows] + [None], pa.int64()),
                         "values": pa.array([pack(total[w]) for w in which] + [sums.tobytes()], pa.binary())})
    return lists.where("kind = 'token'").groupBy("part").applyInArrow(run, "kind string, part int, chunk long, values binary")


SCORE_SCHEMA = ("id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, "
                "score double, n_bytes long")


def score(docs: DataFrame, depth: int = DEPTH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, held_out, n_tokens, n_known, train_tokens, base_score, score,
    n_bytes`` of every document (n_bytes counts the end mark)."""
    if not 2 <= depth <= 7:
        raise ValueError("depth is from 2 to 7")
    sc = docs.sparkSession.sparkContext
    chunks = chunk_table(docs, id_col, text_col)
    parts = parts_for(chunks)
    lists = materialise(count_lists(chunks, depth, parts), "counts")
    top = sc.broadcast(weigh_top(top_nodes(lists, depth).collect()))  # at most 65,280 nodes
    tokens = materialise(token_answers(lists), "tokens")
    sums = [np.frombuffer(r["values"], "<u8") for r in tokens.where("chunk IS NULL").collect()]  # two numbers a part
    n_train, n_distinct = (int(sum(int(s[k]) for s in sums)) for k in (0, 1))
    back = answers(lists, depth, top).unionByName(tokens.where("chunk IS NOT NULL"))

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        found = {(r["kind"], r["part"]): r["values"] for r in right.to_pylist()}
        cols = [[] for _ in range(8)]
        for row in left.to_pylist():
            chunk = Chunk(row)
            texts = [fold_bytes(t) for t in chunk.texts]
            strings = [byte_strings(t, depth) for t in texts]
            keys = np.unique(np.concatenate(strings))
            by, _ = split_keys(keys, depth, parts)
            logs = np.empty(len(keys))
            logs[by] = np.concatenate([np.frombuffer(found["bytes", p], "<f4") for p in range(parts) if ("bytes", p) in found])
            hashes = [token_hashes(t) for t in texts]
            known = np.unique(np.concatenate(hashes))
            counts = np.concatenate([unpack(found["token", p]) for p in range(parts) if ("token", p) in found])
            norm = math.log10(n_train + n_distinct + 1)
            held = held_out(chunk.ids, chunk.nulls)
            for k, (s, h) in enumerate(zip(strings, hashes, strict=True)):
                c = counts[np.searchsorted(known, h)].astype(float)
                values = (None if chunk.nulls[k] else int(chunk.ids[k]), bool(held[k]), len(h), int((c > 0).sum()), n_train,
                          float(np.sum(np.log10(c + 1) - norm)), float(logs[np.searchsorted(keys, s)].sum()), len(s))
                for col, v in zip(cols, values, strict=True):
                    col.append(v)
        kinds = [pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.int64()]
        return pa.table([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)],
                        names=[c.split()[0] for c in SCORE_SCHEMA.split(", ")])

    return chunks.groupBy("chunk").cogroup(back.groupBy("chunk")).applyInArrow(run, SCORE_SCHEMA)


def query(docs: DataFrame) -> DataFrame:
    return score(docs).withColumnRenamed("id", "doc_id")
