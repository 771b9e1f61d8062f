"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

Words are maximal runs of digits, letters and non-ASCII characters, A-Z
lower-cased.  The patterns are the benchmark's windows of ``window``
consecutive words; an item of fewer words is one shorter pattern, searched in
a class of its own length, so that it does not shorten the other shifts.  For
patterns of m words a table maps each block of two words to the distance of
its last occurrence from the pattern's end; other blocks shift by m - 1, so
most words of a document are never looked at.  A shift of zero selects the
bucket of patterns that end in this block; direct comparison confirms.

The benchmark is a stated query set: it is streamed through the driver in
blocks of at most ``block_words`` words; each block is one broadcast and one
map-side pass over all documents, and no document is shuffled.  Only with
several blocks are the results of a document's blocks merged by a group-by.

Defined results: null or wordless texts have no words and no hit; items with
a null or wordless text have no windows; windows of items with a null id hit
as any others, but no item is named or counted for them; repeated items or
documents give the same result each; empty tables work; further columns are
not read.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_text, materialise, ship

WINDOW = 10
BLOCK_WORDS = 250_000
_WORDS = bytes(c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else c + 32 if 65 <= c <= 90 else 32 for c in range(256))
SCHEMA = "id long, n_words long, hits array<int>, items array<string>, text_key binary"


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_WORDS).split()


class WuManber:
    """Search tables for word patterns of one length ``m``."""

    def __init__(self, m: int, patterns: dict[tuple[bytes, ...], list[int]]):
        self.m, self.patterns = m, patterns
        self.block = min(2, m)
        self.shift: dict[tuple[bytes, ...], int] = {}
        self.buckets: dict[tuple[bytes, ...], list[tuple[bytes, ...]]] = defaultdict(list)
        for p in patterns:
            for end in range(self.block, m + 1):
                key = p[end - self.block:end]
                self.shift[key] = min(self.shift.get(key, m), m - end)
            self.buckets[p[m - self.block:]].append(p)

    def find(self, words: list[bytes]) -> Iterator[tuple[int, tuple[bytes, ...]]]:
        """Start and pattern of every occurrence."""
        m, b, shift, far = self.m, self.block, self.shift.get, self.m - self.block + 1
        end, n = m, len(words)
        while end <= n:
            key = tuple(words[end - b:end])
            s = shift(key, far)
            if s:
                end += s
                continue
            here = tuple(words[end - m:end])
            for p in self.buckets[key]:
                if p == here:
                    yield end - m, p
            end += 1


def tables_of(items: list[tuple[int, list[bytes]]], window: int) -> list[WuManber]:
    by_length: dict[int, dict[tuple[bytes, ...], list[int]]] = defaultdict(lambda: defaultdict(list))
    for k, words in items:
        m = min(window, len(words))
        for i in range(len(words) - m + 1):
            by_length[m][tuple(words[i:i + m])].append(k)
    return [WuManber(m, dict(p)) for m, p in sorted(by_length.items()) if m]


def search(words: list[bytes], tables: list[WuManber]) -> tuple[list[int], list[int]]:
    """Hit word positions, ascending, and numbers of the items found."""
    hit: set[int] = set()
    found: set[int] = set()
    for t in tables:
        for at, p in t.find(words):
            hit.update(range(at, at + t.m))
            found.update(t.patterns[p])
    return sorted(hit), sorted(found)


def benchmark_blocks(bench: DataFrame, item_col: str, text_col: str, window: int,
                     block_words: int) -> Iterator[list[tuple[str | None, list[bytes]]]]:
    """The benchmark's items in blocks of about ``block_words`` words; an
    item longer than a block is cut into overlapping parts."""
    block: list[tuple[str | None, list[bytes]]] = []
    size = 0
    rows = bench.select(F.col(f"`{item_col}`").cast("string").alias("item"), F.col(f"`{text_col}`").alias("text"))
    for r in rows.where(F.col("text").isNotNull()).toLocalIterator():
        words = words_of(r["text"])
        for at in range(0, max(1, len(words) - window + 1), block_words):
            part = words[at:at + block_words + window - 1]
            if size and size + len(part) > block_words:
                yield block
                block, size = [], 0
            block.append((r["item"], part))
            size += len(part)
    yield block


def find_windows(docs: DataFrame, bench: DataFrame, window: int = WINDOW, block_words: int = BLOCK_WORDS,
                 id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
                 item_text: str = "text") -> DataFrame:
    """``id, n_words, hits, items`` of every document: positions of the words
    in any occurrence of a benchmark window, and the items they are of."""
    sc = docs.sparkSession.sparkContext
    rows, parts = id_text(docs, id_col, text_col), []

    def searcher(block):
        def run(batches):
            names = [i for i, _ in block.value]
            tables = tables_of([(k, w) for k, (_, w) in enumerate(block.value)], window)
            for batch in batches:
                n, hits, items = [], [], []
                for text in batch.column("text"):
                    words = words_of(text.as_py())
                    hit, found = search(words, tables)
                    n.append(len(words))
                    hits.append(hit)
                    items.append(sorted({names[k] for k in found} - {None}))
                yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(n, pa.int64()),
                                                  pa.array(hits, pa.list_(pa.int32())),
                                                  pa.array(items, pa.list_(pa.string())), batch.column("text_key")],
                                                 ["id", "n_words", "hits", "items", "text_key"])
        return run

    blocks = [sc.broadcast(b) for b in benchmark_blocks(bench, item_col, item_text, window, block_words)]
    key = F.lit(b"") if len(blocks) == 1 else F.unhex(F.md5(F.col("text").cast("binary")))
    for block in blocks:
        parts.append(rows.withColumn("text_key", key).mapInArrow(searcher(block), SCHEMA))
    if len(parts) == 1:
        return parts[0].drop("text_key")
    out = parts[0].withColumn("block", F.lit(0))
    for k, p in enumerate(parts[1:], 1):
        out = out.unionByName(p.withColumn("block", F.lit(k)))
    # rows of one id and text have the same results, so a set of one entry a block holds them all
    merged = out.groupBy("id", "text_key").agg(
        F.max("n_words").alias("n_words"), (F.count(F.lit(1)) / len(parts)).cast("int").alias("copies"),
        F.collect_set(F.when(F.size("hits") > 0, F.struct("hits", "items"))).alias("found"))
    return merged.select("id", "n_words", F.array_sort(F.array_distinct(F.flatten("found.hits"))).alias("hits"),
                         F.array_sort(F.array_distinct(F.flatten("found.items"))).alias("items"),
                         F.explode(F.sequence(F.lit(1), "copies"))).drop("col")


def drop_contaminated(docs: DataFrame, bench: DataFrame, window: int = WINDOW, block_words: int = BLOCK_WORDS,
                      text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """The rows of ``docs``, with all columns, that hold no benchmark window:
    each block of the benchmark filters what the one before left."""
    ship(docs.sparkSession)
    at = docs.columns.index(text_col)

    def keeper(block):
        def run(batches):
            tables = tables_of([(k, w) for k, (_, w) in enumerate(block.value)], window)
            for batch in batches:
                clean = [not any(True for t in tables for _ in t.find(words)) for words in
                         (words_of(x.as_py()) for x in batch.column(at))]
                yield batch.filter(pa.array(clean, pa.bool_()))
        return run

    for k, block in enumerate(benchmark_blocks(bench, item_col, item_text, window, block_words)):
        if k:  # one block's tables at a time in a worker
            docs = materialise(docs, "clean")
        docs = docs.mapInArrow(keeper(docs.sparkSession.sparkContext.broadcast(block)), docs.schema)
    return docs


def query(docs: DataFrame, bench: DataFrame) -> DataFrame:
    found = find_windows(docs, bench)
    return found.select(F.col("id").alias("doc_id"), "n_words", F.size("hits").cast("long").alias("n_hit"),
                        F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join(F.array_sort("items"), ",").cast("binary"), 256).alias("items_sha256"),
                        (F.size("hits") > 0).alias("contaminated"))


SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
             'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
             'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bw AS (SELECT DISTINCT item_id, least(len(w), 10) AS m, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS g
       FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
lens AS (SELECT DISTINCT m FROM bw),
dw AS (SELECT doc_id, m, i, array_to_string(w[i:i + m - 1], ' ') AS g
       FROM (SELECT doc_id, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM d, lens WHERE len(w) >= m)),
hit AS (SELECT doc_id, m, i, item_id FROM dw JOIN bw USING (m, g)),
pos AS (SELECT DISTINCT doc_id, i + unnest(range(0, m)) AS p FROM hit),
n AS (SELECT doc_id, count(*) AS n_hit FROM pos GROUP BY doc_id),
it AS (SELECT doc_id, count(DISTINCT item_id) AS n_items,
              array_to_string(list_sort(list_distinct(list(item_id::VARCHAR))), ',') AS s FROM hit GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(s, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN it USING (doc_id)
"""
