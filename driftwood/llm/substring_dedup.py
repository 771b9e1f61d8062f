"""Substring dedup on the De Bruijn graph of token k-mers.

Nodes are the k-1-word sequences of the corpus, edges its k-word sequences
(k = 13), and every document is a walk.  Each edge is owned by the smallest
id whose text has it.  Edge lists, distinct within a chunk of documents, are
exchanged by 64-bit hash; a part of the hash space joins equal edges and
sends each shared one back, with its owner, to the chunks that have it, where
it is joined with the walks.  Consecutive repeated edges of a walk with one
owner are compacted to a path: a long repeated span with its coordinates
(first and last word, owner).

Paths are then verified at their source.  Within a chunk every edge is
compared with its owner's by a second, independent 64-bit hash of its words.
Across chunks a path claims its first and last edge, owners answer for theirs
with the second hash of their own words, and claims and answers are joined by
edge.  A path whose claim fails is taken out and its chunk is cut again
without the edge.

Defined results: words are maximal runs without white space, unchanged; null
texts have none; a text of fewer than ``k`` words has no window and keeps all
words; rows with the same id do not remove each other's words, and a null id
is larger than any; empty tables work; further columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .chunks import Chunk, chunk_table, cut, parts_for, rows_of, table_rows
from .common import materialise, mix, pack, pack_sorted, unpack, unpack_sorted, word_hashes

K = 13
EDGE_SCHEMA = "part int, chunk long, edges binary, base long, owners binary"
BACK_SCHEMA = "chunk long, edges binary, base long, owners binary"
PATH = "start:int,end:int,owner:bigint"
_COEF, _COEF2 = ([int(x) | 1 for x in mix(np.arange(100, 200, dtype=np.uint64), salt)] for salt in (3, 4))


class Walks:
    """The edges of a chunk's documents, in ascending order of id."""

    def __init__(self, chunk: Chunk, k: int, check: bool = False):
        self.order = np.argsort(chunk.ids, kind="stable")
        words = [word_hashes(chunk.texts[i]) for i in self.order]
        self.n_words = np.array([len(w) for w in words], np.int64)
        flat = np.concatenate(words) if words else np.empty(0, np.uint64)
        doc = np.repeat(np.arange(len(words), dtype=np.int32), self.n_words)
        n = len(flat) - k + 1
        if n <= 0:
            self.at = np.empty(0, np.int64)
            self.edges, self.doc, self.check = np.empty(0, np.uint64), doc[:0], np.empty(0, np.uint64)
        else:
            inside = doc[:n] == doc[k - 1:]
            self.at, self.doc = np.flatnonzero(inside), doc[:n][inside]
            self.edges = self._hash(flat, _COEF, k)[inside]
            if check:
                self.check = self._hash(mix(flat, 8), _COEF2, k)[inside]
        self.ids = chunk.ids[self.order]

    @staticmethod
    def _hash(words: np.ndarray, coef: list[int], k: int) -> np.ndarray:
        n = len(words) - k + 1
        out, term = np.zeros(n, np.uint64), np.empty(n, np.uint64)
        for j in range(k):
            np.multiply(words[j:n + j], np.uint64(coef[j]), out=term)
            out += term
        return mix(out, 5)

    def distinct(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ascending distinct edges, the smallest id that has each, and the
        place of that id's first such edge."""
        by = np.argsort(self.edges, kind="stable")  # walks come by id: the first of equal edges is of the smallest
        e = self.edges[by]
        first = np.concatenate(([True], e[1:] != e[:-1])) if len(e) else np.empty(0, bool)
        self.place = np.empty(len(e), np.int64)  # of every edge among the distinct ones
        self.place[by] = np.cumsum(first) - 1
        return e[first], self.ids[self.doc[by[first]]], by[first]


def joint(edges: np.ndarray, checks: np.ndarray) -> np.ndarray:
    """One hash of an edge's two."""
    return mix(edges + np.uint64(3) * checks, 6)


def _owners(ids: np.ndarray) -> tuple[int, bytes]:
    base = int(ids.min()) if len(ids) else 0
    return base, pack((ids - base).astype(np.uint64))


def _ids(base: int, owners: bytes) -> np.ndarray:
    return unpack(owners).astype(np.int64) + base


def edge_lists(chunks: DataFrame, k: int, parts: int) -> DataFrame:
    def run(batches):
        for row in rows_of(batches):
            edges, owners, _ = Walks(Chunk(row), k).distinct()
            at = cut(edges, parts)
            for p in range(parts):
                a, b = at[p], at[p + 1]
                if a < b:
                    base, held = _owners(owners[a:b])
                    yield pa.RecordBatch.from_pylist([{"part": p, "chunk": row["chunk"], "edges": pack_sorted(edges[a:b]),
                                                       "base": base, "owners": held}], _EDGE)
    return chunks.mapInArrow(run, EDGE_SCHEMA)


_EDGE = pa.schema([("part", pa.int32()), ("chunk", pa.int64()), ("edges", pa.binary()), ("base", pa.int64()),
                   ("owners", pa.binary())])
_BACK = pa.schema(list(_EDGE)[1:])


def join_edges(t: pa.Table) -> pa.Table:
    """Edges of one part that more than one chunk has, with their owner, to
    each of these chunks."""
    rows = table_rows(t)
    edges = [unpack_sorted(r["edges"]) for r in rows]
    where = np.repeat(np.arange(len(rows), dtype=np.int32), [len(e) for e in edges])
    own = np.concatenate([_ids(r["base"], r["owners"]) for r in rows])
    edges = np.concatenate(edges)
    by = np.argsort(edges, kind="stable")
    e = edges[by]
    same = e[1:] == e[:-1]
    shared = np.concatenate((same, [False])) | np.concatenate(([False], same))
    by, e = by[shared], e[shared]
    if not len(e):
        return _BACK.empty_table()
    start = np.flatnonzero(np.concatenate(([True], e[1:] != e[:-1])))
    least = np.repeat(np.minimum.reduceat(own[by], start), np.diff(np.concatenate((start, [len(e)]))))
    back = np.argsort(where[by], kind="stable")  # within a chunk the edges stay ascending
    w, e, least = where[by][back], e[back], least[back]
    out = []
    for k, r in enumerate(rows):
        a, b = np.searchsorted(w, [k, k + 1])
        if a < b:
            base, held = _owners(least[a:b])
            out.append({"chunk": r["chunk"], "edges": pack_sorted(e[a:b]), "base": base, "owners": held})
    return pa.Table.from_pylist(out, _BACK)


class Cut:
    """The paths of a chunk's documents, what they claim of other chunks and
    what the chunk answers for its own edges."""

    def __init__(self, chunk: Chunk, back: list[dict], k: int):
        self.walks = w = Walks(chunk, k, check=True)
        edges, owner, source = w.distinct()
        mine = owner.copy()
        shared = np.zeros(len(edges), bool)
        out = np.zeros(len(edges), bool)  # edges that failed
        for r in back:
            at = np.searchsorted(edges, unpack_sorted(r["edges"]))
            if r["owners"] is None:
                out[at] = True
            else:
                owner[at], shared[at] = _ids(r["base"], r["owners"]), True
        place = w.place
        own = owner[place]
        here = own == mine[place]  # the owner's edge is in this chunk: its words are at hand
        repeated = (own < w.ids[w.doc]) & ~out[place] & (~here | (w.check == w.check[source][place]))
        mine = shared & (owner == mine)
        self.answers = np.sort(joint(edges[mine], w.check[source][mine]))
        at, own, far = w.at[repeated], own[repeated], ~here[repeated]
        # a path breaks where the next edge is not the next window or has another owner
        new = np.concatenate(([True], (np.diff(at) != 1) | (np.diff(own) != 0))) if len(at) else np.empty(0, bool)
        first = np.flatnonzero(new)
        last = np.concatenate((first[1:], [len(at)])) - 1 if len(at) else first
        self.starts, self.stops, self.owners = at[first], at[last] + k, own[first]
        ends = np.unique(np.concatenate((first[far[first]], last[far[last]])))
        held = np.flatnonzero(repeated)[ends]
        claims = joint(w.edges[held], w.check[held])
        self.claims, keep = np.unique(claims, return_index=True)
        self.claimed = w.edges[held][keep]

    def documents(self):
        """For every document: its place, its paths (start, end, owner) and
        a mask of its words that no path covers."""
        w = self.walks
        last = np.cumsum(w.n_words)
        of = np.searchsorted(last, self.starts, side="right")
        cover = np.zeros(int(last[-1]) + 1 if len(last) else 1, np.int32)
        np.add.at(cover, self.starts, 1)
        np.add.at(cover, self.stops, -1)
        keep = np.cumsum(cover)[:-1] == 0
        lo = np.searchsorted(of, np.arange(len(last) + 1))
        for d, place in enumerate(w.order):
            a = int(last[d] - w.n_words[d])
            mine = slice(lo[d], lo[d + 1])
            yield place, np.stack([self.starts[mine] - a, self.stops[mine] - a, self.owners[mine]], axis=1), keep[a:int(last[d])]


_PATHS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("owner", pa.int64())]))
_OUT = pa.schema([("kind", pa.string()), ("chunk", pa.int64()), ("part", pa.int32()), ("id", pa.int64()), ("n_words", pa.int64()),
                  ("n_removed", pa.int64()), ("kept", pa.string()), ("paths", _PATHS), ("edges", pa.binary()), ("checks", pa.binary())])
OUT_SCHEMA = ("kind string, chunk long, part int, id long, n_words long, n_removed long, kept string, "
              f"paths array<struct<{PATH}>>, edges binary, checks binary")


def cut_chunks(chunks: DataFrame, back: DataFrame, k: int, parts: int, texts: bool) -> DataFrame:
    """Rows of three kinds: ``doc`` (``kept`` is the text, or its digest),
    ``claim`` and ``answer`` (joint hashes of edges, claims with the edges)."""
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        for row in left.to_pylist():
            chunk = Chunk(row)
            cut_up = Cut(chunk, right.to_pylist(), k)
            for place, paths, keep in cut_up.documents():
                words = chunk.texts[place].split()
                kept = b" ".join(words if keep.all() else [words[j] for j in np.flatnonzero(keep)])
                out.append({"kind": "doc", "chunk": row["chunk"], "id": None if chunk.nulls[place] else int(chunk.ids[place]),
                            "n_words": len(words), "n_removed": len(words) - int(keep.sum()),
                            "kept": kept.decode("utf-8", "replace") if texts else hashlib.sha256(kept).hexdigest(),
                            "paths": [{"start": a, "end": b, "owner": o} for a, b, o in paths.tolist()]})
            for kind, checks, edges in (("claim", cut_up.claims, cut_up.claimed), ("answer", cut_up.answers, None)):
                at = cut(checks, parts)
                for p in range(parts):
                    a, b = at[p], at[p + 1]
                    if a < b:
                        out.append({"kind": kind, "chunk": row["chunk"], "part": p, "checks": pack_sorted(checks[a:b]),
                                    "edges": None if edges is None else pack(edges[a:b])})
        return pa.Table.from_pylist(out, _OUT)
    return chunks.groupBy("chunk").cogroup(back.groupBy("chunk")).applyInArrow(run, OUT_SCHEMA)


def failed_claims(t: pa.Table) -> pa.Table:
    """Claims of one part that no answer for the edge agrees with."""
    rows = table_rows(t)
    good = np.unique(np.concatenate([np.empty(0, np.uint64), *[unpack_sorted(r["checks"]) for r in rows if r["kind"] == "answer"]]))
    out = []
    for r in rows:
        if r["kind"] == "claim":
            checks, edges = unpack_sorted(r["checks"]), unpack(r["edges"])
            at = np.searchsorted(good, checks)  # good ascends: sorting it anew for every claim row would cost its square
            bad = edges[(at == len(good)) | (good[np.minimum(at, len(good) - 1)] != checks)] if len(good) else edges
            if len(bad):
                out.append({"chunk": r["chunk"], "edges": pack_sorted(np.sort(bad)), "base": None, "owners": None})
    return pa.Table.from_pylist(out, _BACK)


def dedup_substrings(docs: DataFrame, k: int = K, id_col: str = "doc_id", text_col: str = "text",
                     texts: bool = True) -> DataFrame:
    """``id, n_words, n_removed, kept, paths`` of every document: the kept
    words joined by one space (without ``texts`` their SHA-256), and the
    compacted repeated paths with their owners."""
    chunks = chunk_table(docs, id_col, text_col, level=9)
    parts = parts_for(chunks)
    back = edge_lists(chunks, k, parts).groupBy("part").applyInArrow(join_edges, BACK_SCHEMA)
    made = materialise(cut_chunks(chunks, back, k, parts, texts), "paths")
    bad = materialise(made.where("kind <> 'doc'").select("part", "kind", "chunk", "edges", "checks")
                      .groupBy("part").applyInArrow(failed_claims, BACK_SCHEMA), "failed")
    done = made.where("kind = 'doc'")
    if not bad.isEmpty():
        again = bad.select("chunk").distinct()
        anew = cut_chunks(chunks.join(again, "chunk", "left_semi"), back.join(again, "chunk", "left_semi").unionByName(bad),
                          k, parts, texts)
        done = done.join(again, "chunk", "left_anti").unionByName(anew.where("kind = 'doc'"))
    return done.select("id", "n_words", "n_removed", "kept", "paths")


def query(docs: DataFrame) -> DataFrame:
    return dedup_substrings(docs, texts=False).selectExpr("id AS doc_id", "n_words", "n_removed", "kept AS kept_sha256")


SQL = rf"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (SELECT doc_id, i, array_to_string(w[i:i + {K - 1}], ' ') AS g
        FROM (SELECT doc_id, w, unnest(range(1, len(w) - {K - 2})) AS i FROM d WHERE len(w) >= {K})),
own AS (SELECT g, min(doc_id) AS o FROM win GROUP BY g),
gone AS (SELECT DISTINCT doc_id, i + unnest(range(0, {K})) AS i
         FROM (SELECT win.doc_id, i FROM win JOIN own USING (g) WHERE o < doc_id)),
word AS (SELECT doc_id, unnest(range(1, len(w) + 1)) AS i, unnest(w) AS x FROM d),
kept AS (SELECT doc_id, string_agg(x, ' ' ORDER BY i) AS t, count(*) AS n
         FROM word ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed,
       sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""
