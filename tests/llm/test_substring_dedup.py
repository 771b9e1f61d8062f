import hashlib
import random

import numpy as np
import pyarrow as pa

from driftwood.llm import substring_dedup as S
from driftwood.llm.chunks import Chunk, chunk_table
from driftwood.llm.common import pack, pack_sorted

from .helpers import DOCS, LOREM, by_id, docs_of, edge_docs, empty_docs


def brute(rows, k=13):
    own, top = {}, float("inf")
    split = [(top if i is None else i, (t or "").encode().split()) for i, t in rows]
    for i, w in split:
        for j in range(len(w) - k + 1):
            g = tuple(w[j:j + k])
            own[g] = min(own.get(g, i), i)
    out = []
    for (i, w), (real, _) in zip(split, rows, strict=True):
        gone = {q for j in range(len(w) - k + 1) if own[tuple(w[j:j + k])] < i for q in range(j, j + k)}
        kept = b" ".join(x for q, x in enumerate(w) if q not in gone)
        out.append((real, len(w), len(gone), hashlib.sha256(kept).hexdigest()))
    return by_id(out)


def test_edge_cases(spark):
    assert by_id(map(tuple, S.query(edge_docs(spark)).collect())) == brute(DOCS)
    assert S.query(empty_docs(spark)).count() == 0


def test_shared_passages(spark):
    rng = random.Random(4)
    rows = []
    for i in range(120):
        w = [f"v{rng.randrange(30)}" for _ in range(rng.randrange(0, 60))]
        for _ in range(rng.randrange(3)):
            a = rng.randrange(len(LOREM) - 14)
            at = rng.randrange(len(w) + 1)
            w[at:at] = LOREM[a:a + rng.randrange(10, 25)]
        rows.append((i, " ".join(w)))
    assert by_id(map(tuple, S.query(docs_of(spark, rows).repartition(4)).collect())) == brute(rows)


def test_paths_name_their_source(spark):
    rows = [(5, "p q " + " ".join(LOREM)), (9, " ".join(LOREM[2:]) + " z"), (7, "y " * 3)]
    got = {r.id: r for r in S.dedup_substrings(docs_of(spark, rows)).collect()}
    assert [tuple(p) for p in got[9].paths] == [(0, len(LOREM) - 2, 5)] and got[9].kept == "z"
    assert not got[5].paths and not got[7].paths and got[7].kept == "y y y"


def test_owner_changes_break_a_path(spark):
    a, b = [f"a{k}" for k in range(15)], [f"b{k}" for k in range(15)]
    rows = [(1, " ".join(a)), (2, " ".join(b)), (3, " ".join(a + b))]
    got = {r.id: r for r in S.dedup_substrings(docs_of(spark, rows)).collect()}
    assert [tuple(p) for p in got[3].paths] == [(0, 15, 1), (15, 30, 2)] and got[3].kept == ""


def test_paths_across_chunks_are_verified_at_their_source(spark):
    rows = [(i, f"x{i} " + " ".join(LOREM[i % 3:]) + f" y{i}") for i in range(12)]
    chunks = chunk_table(docs_of(spark, rows), size=300)
    assert chunks.count() > 3
    back = S.edge_lists(chunks, 13, 4).groupBy("part").applyInArrow(S.join_edges, S.BACK_SCHEMA)
    made = S.cut_chunks(chunks, back, 13, 4, True).cache()
    assert made.where("kind = 'claim'").count() and made.where("kind = 'answer'").count()
    failed = made.where("kind <> 'doc'").groupBy("part").applyInArrow(
        lambda t: S.failed_claims(t), S.BACK_SCHEMA)
    assert failed.count() == 0
    by = {r.id: r for r in made.where("kind = 'doc'").collect()}
    assert all(r.n_removed == (0 if i == 0 else len(LOREM[i % 3:])) for i, r in by.items())


def test_a_claim_without_a_true_answer_fails():
    def row(kind, chunk, pairs):
        both = sorted((int(S.joint(np.array([e], np.uint64), np.array([c], np.uint64))[0]), e) for e, c in pairs)
        return {"kind": kind, "part": 0, "chunk": chunk, "checks": pack_sorted(np.array([c for c, _ in both], np.uint64)),
                "edges": pack(np.array([e for _, e in both], np.uint64)) if kind == "claim" else None}
    t = pa.Table.from_pylist([row("answer", 1, [(5, 50), (7, 70)]), row("claim", 2, [(5, 50), (7, 71)]), row("claim", 3, [(9, 1)])])
    bad = S.failed_claims(t).to_pylist()
    assert [(r["chunk"], S.unpack_sorted(r["edges"]).tolist()) for r in bad] == [(2, [7]), (3, [9])]


def test_failed_edges_are_left_out(spark):
    text = " ".join(LOREM)
    row = chunk_table(docs_of(spark, [(9, text)])).first().asDict()
    edges, _, _ = S.Walks(Chunk(row), 13).distinct()
    base, owners = S._owners(np.full(len(edges), 4))
    back = [{"edges": pack_sorted(edges), "base": base, "owners": owners}]
    (_, paths, keep), = S.Cut(Chunk(row), back, 13).documents()
    assert paths.tolist() == [[0, len(LOREM), 4]] and not keep.any()
    first = S.Walks(Chunk(row), 13).edges[:1]
    back.append({"edges": pack_sorted(first), "base": None, "owners": None})
    (_, paths, keep), = S.Cut(Chunk(row), back, 13).documents()
    assert paths.tolist() == [[1, len(LOREM), 4]] and keep.tolist() == [True] + [False] * (len(LOREM) - 1)
