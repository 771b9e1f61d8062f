"""N-gram Jaccard join by prefix filters under several global token orders.

A document is the set of its distinct ``k``-word shingles.  If two sets have
Jaccard similarity t or more, they share a token among the first
n - ceil(t n) + 1 of each under *any* global order of tokens; so a candidate
pair must share a prefix token under every order tried, and the filters are
intersected before a pair is verified.  All orders begin with the tokens that
only one document has (these can match nothing): rarest first with two
different tie-breaks, and a plain hash order.  A document whose prefix is
used up by such tokens has no candidates at all.

How often a token occurs is found by exchanging hash lists, distinct within a
chunk of documents, so a token of a third of all documents is one entry a
chunk.  Equal sets are one class and only its first document takes part.

Documents that prefix tokens of the first order connect form a group.  Groups
are cut into blocks of bounded size, and a task takes one block, later two
blocks of a group together, with its documents' prefixes and sets: inverted
lists of the prefixes under each order give the candidates of a document, the
filters are intersected, and inverted lists of the shingles verify what is
left.  Only links that connect two components are put out, as stars, so
neither candidates nor links of a group become rows.  The second pass takes
what still shares a prefix token across components: blocks are of like set
sizes, and a document goes only to blocks of sizes near its own that hold one
of its tokens in another component.  Components are drawn together by
pointer jumping, so a chain of n links takes some log(n) rounds.

Defined results: words are maximal runs without white space, A-Z lower-cased;
a text of fewer than ``k`` words is one shingle of all its words; null or
wordless texts have no shingles and link with nothing, not even each other;
rows with the same id are separate documents that link by their texts; a
component of null ids only has a null id; empty tables work; further columns
are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .chunks import Chunk, chunk_table, cut, parts_for, rows_of, table_rows
from .common import (discard, fold_bytes, materialise, mix, pack, pack_sorted, release_memory, shingles, unpack, unpack_sorted,
                     word_hashes)
from .exact_dedup import BROADCAST_ROWS, drop_listed

K = 5
PERCENT = 80
TOKEN_BITS = 48
ROW_BITS = 20
ORDERS = 3
BLOCK_SHINGLES = 400_000
BLOCK_DOCS = 1000

DOC_SCHEMA = "rid long, id long, n int, print_a long, print_b long"
TOKENS_SCHEMA = "part int, chunk long, tokens binary, counts binary"
BACK_SCHEMA = "chunk long, tokens binary, counts binary"
CAND_SCHEMA = "rid long, n int, " + ", ".join(f"prefix{i} array<long>" for i in range(ORDERS)) + ", shingles binary"
_TOKENS = pa.schema([("part", pa.int32()), ("chunk", pa.int64()), ("tokens", pa.binary()), ("counts", pa.binary())])
_BACK = pa.schema(list(_TOKENS)[1:])


def shingle_sets(chunk: Chunk, k: int) -> list[np.ndarray]:
    """The ascending distinct shingles of each text of the chunk."""
    return [np.unique(shingles(word_hashes(fold_bytes(t)), k)) for t in chunk.texts]


def row_ids(chunk: Chunk) -> np.ndarray:
    """Numbers of the chunk's rows, one of each row of the corpus."""
    assert len(chunk.texts) <= 1 << ROW_BITS, "a chunk's rows would take the numbers of the next chunk's"
    return (np.int64(chunk.number) << ROW_BITS) + np.arange(len(chunk.texts), dtype=np.int64)


def set_table(chunks: DataFrame, k: int, digests: bool = False) -> DataFrame:
    """Every row's number, id, set size and two fingerprints of its set, with
    ``digests`` also the SHA-256 of its text."""
    def run(batches):
        for row in rows_of(batches):
            chunk = Chunk(row)
            sets = shingle_sets(chunk, k)
            prints = [np.array([mix(s, salt).sum(dtype=np.uint64) for s in sets], np.uint64).view(np.int64)
                      for salt in (11, 12)]
            of_text = [pa.array([hashlib.sha256(t).digest() for t in chunk.texts], pa.binary())] if digests else []
            yield pa.RecordBatch.from_arrays(
                [pa.array(row_ids(chunk)), chunk.id_array(), pa.array([len(s) for s in sets], pa.int32()),
                 *map(pa.array, prints), *of_text], ["rid", "id", "n", "print_a", "print_b", "digest"][:5 + digests])
            del chunk, sets
            release_memory()
    return chunks.mapInArrow(run, DOC_SCHEMA + ", digest binary" * digests)


def token_lists(chunks: DataFrame, k: int, parts: int) -> DataFrame:
    """Distinct tokens of each chunk, with the number of its rows that have
    each, cut by parts of the token space."""
    def run(batches):
        for row in rows_of(batches):
            sets = shingle_sets(Chunk(row), k)
            flat = np.concatenate(sets) >> np.uint64(64 - TOKEN_BITS)
            del sets
            tokens, counts = np.unique(flat, return_counts=True)
            del flat
            release_memory()
            at = cut(tokens, parts, TOKEN_BITS)
            for p in range(parts):
                a, b = at[p], at[p + 1]
                if a < b:
                    yield pa.RecordBatch.from_pylist([{"part": p, "chunk": row["chunk"], "tokens": pack_sorted(tokens[a:b]),
                                                       "counts": pack(counts[a:b].astype(np.uint64))}], _TOKENS)
    return chunks.mapInArrow(run, TOKENS_SCHEMA)


def repeated_tokens(t: pa.Table) -> pa.Table:
    """Tokens of one part that more than one row has, with their number of
    rows, back to the chunks that hold them."""
    rows = table_rows(t)
    lists = [unpack_sorted(r["tokens"]) for r in rows]
    sizes = [len(x) for x in lists]
    tokens = np.concatenate(lists)
    del lists
    counts = np.concatenate([unpack(r["counts"]).astype(np.uint32) for r in rows])
    by = np.argsort(tokens)
    tokens = tokens[by]
    start = np.flatnonzero(np.concatenate(([True], tokens[1:] != tokens[:-1])))
    del tokens
    total = np.add.reduceat(counts[by], start, dtype=np.uint64)
    total = np.repeat(np.minimum(total, 0xFFFFFFFF).astype(np.uint32), np.diff(np.concatenate((start, [len(by)]))))
    counts[by] = total  # of every entry, in the order of the lists
    out, at = [], 0
    for r, size in zip(rows, sizes, strict=True):
        n = counts[at:at + size]
        at += size
        if (n > 1).any():
            out.append({"chunk": r["chunk"], "tokens": pack_sorted(unpack_sorted(r["tokens"])[n > 1]),
                        "counts": pack(n[n > 1].astype(np.uint64))})
    made = pa.Table.from_pylist(out, _BACK)
    release_memory()
    return made


def prefix_size(n: int, percent: int) -> int:
    return n + (-percent * n) // 100 + 1


def prefixes(own: np.ndarray, back_tokens: np.ndarray, back_counts: np.ndarray, percent: int) -> list[np.ndarray] | None:
    """The repeated tokens in the prefix of an ascending shingle set under
    each order; None if there are none."""
    tokens = own >> np.uint64(64 - TOKEN_BITS)
    if not len(back_tokens):
        return None
    at = np.minimum(np.searchsorted(back_tokens, tokens), len(back_tokens) - 1)
    known = back_tokens[at] == tokens
    tokens, counts = tokens[known], back_counts[at[known]]
    size = prefix_size(len(own), percent) - (len(own) - len(tokens))
    if size <= 0:
        return None
    keys = [(tokens, counts), (mix(tokens, 21), counts), (mix(tokens, 22),)]
    return [np.unique(tokens[np.lexsort(k)[:size]]).view(np.int64) for k in keys]


def candidates(chunks: DataFrame, back: DataFrame, copies: DataFrame, k: int, percent: int) -> DataFrame:
    """``rid, n``, prefixes and shingles of the rows that may have partners;
    rows of ``copies(chunk, rid)`` take no part."""
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        found = table_rows(right)
        lists = [r for r in found if r["tokens"] is not None]
        skip = {r["rid"] for r in found if r["tokens"] is None}
        tokens = np.concatenate([unpack_sorted(r["tokens"]) for r in lists]) if lists else np.empty(0, np.uint64)
        counts = np.concatenate([unpack(r["counts"]) for r in lists]) if lists else tokens
        by = np.argsort(tokens, kind="stable")
        tokens, counts = tokens[by], counts[by]
        for row in left.to_pylist():
            chunk = Chunk(row)
            for rid, own in zip(row_ids(chunk).tolist(), shingle_sets(chunk, k), strict=True):
                if rid in skip or not len(own):
                    continue
                made = prefixes(own, tokens, counts, percent)
                if made:
                    out.append({"rid": rid, "n": len(own), **{f"prefix{i}": p for i, p in enumerate(made)},
                                "shingles": own.tobytes()})
        release_memory()
        return pa.Table.from_pylist(out, pa.schema([("rid", pa.int64()), ("n", pa.int32())]
                                                   + [(f"prefix{i}", pa.list_(pa.int64())) for i in range(ORDERS)]
                                                   + [("shingles", pa.binary())]))

    right = back.select("chunk", "tokens", "counts", F.lit(None).cast("long").alias("rid")).unionByName(
        copies.select("chunk", F.lit(None).cast("binary").alias("tokens"), F.lit(None).cast("binary").alias("counts"), "rid"))
    return chunks.groupBy("chunk").cogroup(right.groupBy("chunk")).applyInArrow(run, CAND_SCHEMA)


class Postings:
    """Inverted lists of a block's documents: which of them share tokens."""

    def __init__(self, lists: list[np.ndarray]):
        self.m = len(lists)
        self.ends = np.cumsum([0, *map(len, lists)])
        _, self.token, self.count = np.unique(np.concatenate(lists), return_inverse=True, return_counts=True)
        self.docs = np.repeat(np.arange(self.m), np.diff(self.ends))[np.argsort(self.token, kind="stable")]
        self.start = np.cumsum(self.count) - self.count

    def shared(self, i: int) -> np.ndarray:
        """Number of tokens each document shares with document ``i``."""
        t = self.token[self.ends[i]:self.ends[i + 1]]
        t = t[self.count[t] > 1]
        c = self.count[t]
        total = int(c.sum())
        at = np.repeat(self.start[t] - (np.cumsum(c) - c), c) + np.arange(total)
        return np.bincount(self.docs[at], minlength=self.m)


def block_links(t: pa.Table, percent: int) -> pa.Table:
    """Links between the components that the documents of one block are in,
    or of one block with those of another (column ``side``): of all that hang
    together, the least with every other."""
    rid, label, side, n = (np.array(t[c].to_pylist(), np.int64) for c in ("rid", "comp", "side", "n"))
    two = len(set(side.tolist())) > 1
    orders = [Postings([np.array(x, np.int64) for x in t[f"prefix{k}"].to_pylist()]) for k in range(ORDERS)]
    sets = Postings([np.frombuffer(x, "<u8") for x in t["shingles"].to_pylist()])
    given, joined = label.copy(), False
    for i in range(len(rid)):
        may = (100 * np.minimum(n, n[i]) >= percent * np.maximum(n, n[i])) & (label != label[i])
        may[:i + 1] = False
        if two:
            may &= side != side[i]
        for order in orders:
            if not may.any():
                break
            may &= order.shared(i) > 0
        if not may.any():
            continue
        both = sets.shared(i)
        for j in np.flatnonzero(may & (100 * both >= percent * (n + n[i] - both))):
            if label[j] != label[i]:
                label[label == label[j]], joined = label[i], True
    if not joined:
        return pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64())})
    # one row a given component, and of it the joined components' least
    _, first = np.unique(given, return_index=True)
    least = {int(k): int(given[first][label[first] == k].min()) for k in np.unique(label[first])}
    stars = [(least[int(label[f])], int(given[f])) for f in first if least[int(label[f])] != given[f]]
    return pa.table({"a": pa.array([x for x, _ in stars], pa.int64()), "b": pa.array([y for _, y in stars], pa.int64())})


def crossing(tokens: DataFrame, state: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``rid, token, comp`` of ``tokens(rid, token)``, and the tokens whose
    documents are in several components (with one of them, ``hub``)."""
    here = tokens.join(state, "rid")
    split = here.groupBy("token").agg(F.min("comp").alias("low"), F.max("comp").alias("high"),
                                      F.min("rid").alias("hub")).where("low < high").select("token", "hub")
    return here, materialise(split, "split")


def blocks_of(cands: DataFrame, here: DataFrame, split: DataFrame, state: DataFrame, percent: int) -> tuple[DataFrame, bool]:
    """Of the candidates that share a token across components: ``rid, comp,
    part, step, unit, blocks``, where ``part`` is the group they are connected
    to, and whether a group has several blocks.  A group of one block is one
    ``unit``; a larger one is cut by steps of the set size, so that sets of
    far steps cannot link, and within a step by hash."""
    spokes = materialise(here.join(split, "token").select("rid", "hub").distinct(), "spokes")
    nodes = spokes.select("rid").distinct()
    groups = components(nodes.withColumn("comp", F.col("rid")), spokes.where("rid <> hub").selectExpr("rid AS a", "hub AS b"))
    # sizes that are a factor of 100 / percent apart cannot link
    step = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(100.0 / percent)) + 1e-9).cast("int")
    member = groups.select("rid", F.col("comp").alias("part")).join(state, "rid").join(
        cands.select("rid", "n", step.alias("step")), "rid")
    need = F.expr(f"cast(greatest(ceil(sum(n) / {BLOCK_SHINGLES}), ceil(count(*) / {BLOCK_DOCS})) AS int)")
    size = materialise(member.groupBy("part").agg(need.alias("blocks")), "sizes")
    member = member.join(size, "part").withColumn("step", F.when(F.col("blocks") > 1, F.col("step")).otherwise(F.lit(0)))
    pieces = member.groupBy("part", "step").agg(need.alias("pieces"))
    member = member.join(pieces, ["part", "step"]).select("rid", "comp", "part", "step", "blocks", F.expr(
        "step * 4294967296L + pmod(xxhash64(rid), pieces)").alias("unit"))
    return materialise(member, "blocks"), not size.where("blocks > 1").isEmpty()


LINK_COLS = ["n", *[f"prefix{i}" for i in range(ORDERS)], "shingles"]


def link_components(cands: DataFrame, percent: int) -> DataFrame:
    """``rid, comp`` of all candidates: first the links inside blocks, then
    those between the blocks of a group, as far as components still meet."""
    tokens = materialise(cands.select("rid", F.explode("prefix0").alias("token")), "tokens")
    state = cands.select("rid", F.col("rid").alias("comp"))
    run = lambda t: block_links(t, percent)
    here, split = crossing(tokens, state)
    member, many = blocks_of(cands, here, split, state, percent)
    own = member.join(cands, "rid").select("part", "unit", F.lit(0).alias("side"), "rid", "comp", *LINK_COLS)
    links = materialise(own.groupBy("part", "unit").applyInArrow(run, "a long, b long"), "found")
    state = components(state, links)
    if not many:
        return state
    cut_up = member.where("blocks > 1").select("rid")
    here, split = crossing(tokens.join(cut_up, "rid", "left_semi"), state)
    member, _ = blocks_of(cands, here, split, state, percent)
    # a document goes to the units, of sizes near its own, that hold a token of its prefix in another component
    met = here.join(split.select("token"), "token", "left_semi").select("rid", "token").join(member, "rid")
    unit = met.groupBy("token", F.col("step").alias("other_step"), F.col("unit").alias("other")).agg(
        F.min("comp").alias("low"), F.max("comp").alias("high"))
    route = (met.join(unit, "token").where("abs(step - other_step) <= 1 AND (low <> comp OR high <> comp)")
             .select("rid", "comp", "part", F.least("unit", "other").alias("one"), F.greatest("unit", "other").alias("two"),
                     (F.col("unit") > F.col("other")).cast("int").alias("side")).distinct())
    # a unit with itself as well: its documents may have come together in other groups
    pairs = route.join(cands, "rid").select("part", "one", "two", "side", "rid", "comp", *LINK_COLS)
    more = materialise(pairs.groupBy("part", "one", "two").applyInArrow(run, "a long, b long"), "found")
    return components(state, more)


def _follow(falls: DataFrame) -> DataFrame:
    """``old, low`` with every label's last fall: pointers are doubled until
    none leads on."""
    while True:
        on = falls.select(F.col("old").alias("mid"), F.col("low").alias("end"))
        more = falls.join(on, F.col("low") == F.col("mid"), "left").select(
            "old", F.coalesce("end", "low").alias("low"), F.col("end").isNotNull().alias("fell"))
        more = materialise(more, "falls")
        discard(falls)
        falls = more.select("old", "low")
        falls.scratch = more.scratch
        if more.where("fell").isEmpty():
            return falls


def components(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """``rid, comp``: the smallest label reachable by ``links(a, b)`` between
    labels from that of each of ``nodes(rid, comp)``.  A round lets every
    label fall to its smallest neighbour, and on to where that falls, and
    draws the links together; only labels with links take part."""
    edges = materialise(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links")
    roots = None
    while True:
        falls = materialise(edges.groupBy(F.col("a").alias("old")).agg(F.min("b").alias("low")).where("low < old"), "falls")
        if falls.isEmpty():
            break
        falls = _follow(falls)
        if roots is None:
            roots = falls
        else:
            to = falls.select(F.col("old").alias("mid"), F.col("low").alias("end"))
            moved = roots.join(to, F.col("low") == F.col("mid"), "left").select("old", F.coalesce("end", "low").alias("low"))
            both = materialise(moved.unionByName(falls), "roots")
            discard(roots)
            discard(falls)
            roots = both
        drawn = edges
        for c in ("a", "b"):
            to = roots.select(F.col("old").alias("mid"), F.col("low").alias("end"))
            drawn = drawn.join(to, F.col(c) == F.col("mid"), "left").withColumn(c, F.coalesce("end", c)).select("a", "b")
        drawn = materialise(drawn.where("a <> b").distinct(), "links")
        discard(edges)
        edges = drawn
    if roots is None:
        return nodes
    return materialise(nodes.join(roots, F.col("comp") == F.col("old"), "left")
                       .select("rid", F.coalesce("low", "comp").alias("comp")), "comps")


def component_rows(docs: DataFrame, k: int, percent: int, id_col: str, text_col: str,
                   digests: bool = False) -> tuple[DataFrame, DataFrame]:
    """``rid, id, n, comp`` (and ``digest``) of every row, and those rows
    that are in a class or component of several."""
    chunks = chunk_table(docs, id_col, text_col, level=9)
    sets = materialise(set_table(chunks, k, digests), "sets")
    group, cols = ["n", "print_a", "print_b"], ["rid", "id", "n", *["digest"] * digests]
    classes = materialise(sets.where("n > 0").groupBy(*group).agg(F.min("rid").alias("first"), F.count(F.lit(1)).alias("size"))
                          .where("size > 1").drop("size"), "classes")
    rows = materialise(sets.join(classes, group, "left").select(*cols, F.coalesce("first", "rid").alias("first")), "rows")
    copies = rows.where("first <> rid").select(F.shiftright("rid", ROW_BITS).alias("chunk"), "rid")
    back = token_lists(chunks, k, parts_for(chunks)).groupBy("part").applyInArrow(repeated_tokens, BACK_SCHEMA)
    cands = materialise(candidates(chunks, back, copies, k, percent), "candidates")
    comps = link_components(cands, percent)
    joined = materialise(comps.where("comp <> rid").withColumnRenamed("rid", "first"), "joined")
    members = rows.join(joined, "first", "left").select(*cols, F.coalesce("comp", "first").alias("comp"))
    # only rows of a class or component of several have to be grouped
    many = materialise(joined.select("comp").unionByName(classes.select(F.col("first").alias("comp"))).distinct(), "many")
    return members, members.join(many, "comp", "left_semi")


def jaccard_components(docs: DataFrame, k: int = K, percent: int = PERCENT, id_col: str = "doc_id",
                       text_col: str = "text") -> DataFrame:
    """``rid, id, n_shingles, component_id`` of every row."""
    members, grouped = component_rows(docs, k, percent, id_col, text_col)
    least = materialise(grouped.groupBy("comp").agg(F.min("id").alias("least")), "least")
    return members.join(least, "comp", "left").select("rid", "id", F.col("n").cast("long").alias("n_shingles"),
                                                      F.coalesce("least", "id").alias("component_id"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One document of each component stays, that of the smallest id, with
    all columns; null ids come after all others, and of rows of one id that
    with the smallest text digest stays.  Rows that share both id and text
    are one document; rows that only share an id are decided each by itself."""
    _, grouped = component_rows(docs, K, PERCENT, id_col, text_col, digests=True)
    grouped = materialise(grouped.select("comp", "id", "digest"), "grouped")
    best = F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "digest"))
    keep = materialise(grouped.groupBy("comp").agg(best.alias("best")).select(
        "comp", F.col("best.id").alias("keep_id"), F.col("best.digest").alias("keep_digest")), "keep")
    gone = materialise(grouped.join(keep, "comp").where("NOT (id <=> keep_id AND digest = keep_digest)")
                       .select("id", "digest").distinct(), "gone")
    return drop_listed(docs, gone, id_col, text_col, BROADCAST_ROWS)


def query(docs: DataFrame) -> DataFrame:
    return jaccard_components(docs).select(F.col("id").alias("doc_id"), "n_shingles", "component_id")
