"""Exact dedup with a heavy-hitter split, in DataFrame functions only.

A text's digest is SHA-256 of its UTF-8 bytes.  A frequent-items sketch of
the Misra-Gries family (``approx_top_k_accumulate``; bounded size, merged
map-side) names candidate frequent digests.  An exact map-side combined
aggregate verifies their sizes and winners; these few rows (at most
``max_heavy``) are broadcast and settle all their copies without a shuffle.
The other digests are grouped by ordinary shuffling.

Defined results: a null text counts as empty; of equal texts the row with
the largest id stays; null ids are smaller than any id (a group with null
ids only has a null ``keep_id`` and keeps them); rows that share both id and
text are one document and share its decision; an empty table gives an empty
result; further columns, whatever their names, are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialise

#: Up to so many listed rows (some 40 bytes each) their list is broadcast, so that the texts of the others are not shuffled.
BROADCAST_ROWS = 1 << 19


def text_digest(text_col: str) -> Column:
    return F.unhex(F.sha2(F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).cast("binary"), 256))


def heavy_candidates(digests: DataFrame, max_heavy: int = 1024, min_share: float = 1 / 4096) -> DataFrame:
    """At most ``max_heavy`` digests whose sketched count is at least
    ``min_share`` of all rows (and two).  The sketch tracks eight times as
    many items, so a digest with that share is always among them."""
    sketch = digests.agg(F.expr(f"approx_top_k(hex(digest), {max_heavy}, {8 * max_heavy})").alias("top"),
                         F.count(F.lit(1)).alias("total"))
    return (sketch.select("total", F.explode("top").alias("t"))
            .where((F.col("t.count") >= 2) & (F.col("t.count") >= F.col("total") * min_share))
            .select(F.unhex("t.item").alias("digest")))


def split_groups(docs: DataFrame, id_col: str, text_col: str, max_heavy: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``id, digest`` of every row; ``digest, keep_id, group_size`` of the
    heavy digests, at most ``max_heavy``; and ``digest, id, keep_id,
    group_size`` of the rows of all other digests."""
    rows = materialise(docs.select(F.col(f"`{id_col}`").cast("long").alias("id"),
                                   text_digest(text_col).alias("digest")), "digests")
    best = [F.max("id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")]
    candidates = materialise(heavy_candidates(rows, max_heavy), "heavy")  # at most max_heavy rows
    winners = materialise(rows.join(F.broadcast(candidates), "digest", "left_semi").groupBy("digest").agg(*best),
                          "winners")  # at most max_heavy rows
    rest = rows.join(F.broadcast(winners), "digest", "left_anti")
    return rows, winners, rest.join(rest.groupBy("digest").agg(*best), "digest")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_heavy: int = 1024) -> DataFrame:
    """One row per input row: ``id, keep_id, group_size, kept, digest``."""
    rows, winners, light = split_groups(docs, id_col, text_col, max_heavy)
    heavy = rows.join(F.broadcast(winners), "digest")
    cols = ["id", "keep_id", "group_size", F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"), "digest"]
    return heavy.select(*cols).unionByName(light.select(*cols))


def drop_listed(docs: DataFrame, gone: DataFrame, id_col: str, text_col: str, bound: int = BROADCAST_ROWS) -> DataFrame:
    """``docs`` without the rows in the written table ``gone(id, digest)``.
    A list of more than ``bound`` rows meets the documents by a shuffle."""
    listed = gone.select(F.col("id").alias("__gone_id"), F.col("digest").alias("__gone_digest"))
    if gone.count() <= bound:
        listed = F.broadcast(listed)
    return docs.join(listed, F.col(f"`{id_col}`").cast("long").eqNullSafe(F.col("__gone_id"))
                     & (text_digest(text_col) == F.col("__gone_digest")), "left_anti")


def keep_exact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_heavy: int = 1024,
               bound: int = BROADCAST_ROWS) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns.  Copies of
    heavy digests go map-side by the broadcast winners; of the others only
    the rows that go are listed."""
    _, winners, light = split_groups(docs, id_col, text_col, max_heavy)
    gone = materialise(light.where("NOT id <=> keep_id").select("id", "digest").distinct(), "gone")
    heavy = winners.select(F.col("digest").alias("__heavy_digest"), F.col("keep_id").alias("__heavy_keep"))
    stays = F.col(f"`{id_col}`").cast("long").eqNullSafe(F.col("__heavy_keep"))
    docs = docs.join(F.broadcast(heavy), (text_digest(text_col) == F.col("__heavy_digest")) & ~stays, "left_anti")
    return drop_listed(docs, gone, id_col, text_col, bound)


def query(docs: DataFrame) -> DataFrame:
    return exact_dedup(docs).select(F.col("id").alias("doc_id"), "keep_id", "group_size", "kept",
                                    F.lower(F.hex("digest")).alias("text_sha256"))


SQL = """
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id IS NOT DISTINCT FROM max(doc_id) OVER w AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))
"""
