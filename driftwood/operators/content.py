"""Content operators: id sets, the three-way source join, the lookup that
builds the 14-column content row, and snapshot merging."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.ids import shard_has_score, shard_label
from ..functions.json_fields import BLANK, first_key, location_fields, split_field
from ..functions.tags import format_content_tags, format_title_tags
from ..schemas import CONTENT_COLUMNS
from ..session import scratch_root

ID = "content_id"
CONTENT_ID_INDEX = 24


def ids_from_text_rows(lines: DataFrame, index: int = CONTENT_ID_INDEX,
                       value_col: str = "value") -> DataFrame:
    """Content id column of saved positional training rows (null ids of
    short rows are dropped)."""
    return (lines.select(split_field(F.col(value_col), index).alias(ID))
            .where(F.col(ID).isNotNull()))


def distinct_ids(rows: DataFrame, id_col: str = ID) -> DataFrame:
    """Distinct non-null ids (partially aggregated before the shuffle)."""
    return rows.select(id_col).where(F.col(id_col).isNotNull()).distinct()


def new_ids(ids: DataFrame, snapshot: DataFrame, id_col: str = ID) -> DataFrame:
    """Ids not present in the snapshot (left anti join)."""
    return ids.join(snapshot.select(id_col), id_col, "left_anti")


#: Bits a block of the filter, and blocks up to which it is broadcast (256 bits each: 64 MiB).
BLOOM_LANES, BLOOM_BLOCKS = 8, 1 << 21
BLOOM_BITS_PER_ID = 16


def _bloom_place(id_col: str, blocks: int) -> list[Column]:
    """The block of an id, and a mask of one bit in each of its 32-bit lanes."""
    h = F.xxhash64(F.lit(1), id_col)
    lanes = [F.expr(f"shiftleft(1L, cast(shiftrightunsigned(xxhash64(2, `{id_col}`), {5 * k}) & 31 as int))")
             for k in range(BLOOM_LANES)]
    return [F.pmod(h, F.lit(blocks)).alias("_block"), *[lane.alias(f"_bit{k}") for k, lane in enumerate(lanes)]]


def bloom_of(ids: DataFrame, n_ids: int, id_col: str = ID) -> tuple[DataFrame, int]:
    """A blocked Bloom filter of the ids as a table ``_block, _lane0..7`` (16
    bits an id, one block touched an id), and its number of blocks."""
    blocks = max(1, -(-n_ids * BLOOM_BITS_PER_ID // (32 * BLOOM_LANES)))
    bits = ids.where(F.col(id_col).isNotNull()).select(*_bloom_place(id_col, blocks))
    return bits.groupBy("_block").agg(*[F.bit_or(f"_bit{k}").alias(f"_lane{k}") for k in range(BLOOM_LANES)]), blocks


def maybe_in(rows: DataFrame, bloom: DataFrame, blocks: int, id_col: str = ID) -> DataFrame:
    """The rows whose id the filter cannot rule out.  The filter must be
    small enough to broadcast (``BLOOM_BLOCKS``); nothing is shuffled."""
    cols = rows.columns
    held = rows.select(*cols, *_bloom_place(id_col, blocks)).join(F.broadcast(bloom), "_block")
    hit = None
    for k in range(BLOOM_LANES):
        one = F.col(f"_lane{k}").bitwiseAND(F.col(f"_bit{k}")) != 0
        hit = one if hit is None else hit & one
    return held.where(hit).select(*cols)


def new_ids_filtered(ids: DataFrame, snapshot: DataFrame, n_ids: int, id_col: str = ID) -> DataFrame:
    """``new_ids`` for a snapshot much larger than the ids: a Bloom filter of
    the ids (about ``n_ids`` of them) drops the snapshot rows that cannot be
    asked for before they are shuffled; the anti join that follows is exact.
    A filter too large to broadcast is not made: the plain anti join then."""
    bloom, blocks = bloom_of(ids, n_ids, id_col)
    if blocks > BLOOM_BLOCKS:
        return new_ids(ids, snapshot, id_col)
    return new_ids(ids, maybe_in(snapshot.select(id_col), bloom, blocks, id_col), id_col)


def known_ids(ids: DataFrame, snapshot: DataFrame, id_col: str = ID) -> DataFrame:
    """Ids present in the snapshot (left semi join)."""
    return ids.join(snapshot.select(id_col), id_col, "left_semi")


def id_counts(ids: DataFrame, snapshot: DataFrame, id_col: str = ID) -> DataFrame:
    """One row: distinct ids, ids new to the snapshot, ids already known.
    One join pass instead of separate counting jobs."""
    d = distinct_ids(ids, id_col)
    known = snapshot.select(id_col).distinct().withColumn("_known", F.lit(1))
    j = d.join(known, id_col, "left")
    return j.agg(F.count(F.lit(1)).alias("total_ids"),
                 F.count_if(F.col("_known").isNull()).alias("new_ids"),
                 F.count_if(F.col("_known").isNotNull()).alias("known_ids"))


def content_join3(t_content: DataFrame, t_signal: DataFrame, t_news: DataFrame,
                  keys=(ID, "shard")) -> DataFrame:
    """``t_content`` inner ``t_signal`` inner ``t_news_manager`` on the id
    (and shard, when the tables carry one)."""
    k = [c for c in keys if c in t_content.columns and c in t_signal.columns
         and c in t_news.columns]
    return t_content.join(t_signal, k, "inner").join(t_news, k, "inner")


def stored_join3(t_content: DataFrame, t_signal: DataFrame, t_news: DataFrame) -> DataFrame:
    """``content_join3`` of stored tables (``sinks.write_content_store``): a
    row's month is the one its id begins with, rows elsewhere are left out,
    and the tables meet on the id they are bucketed by, without a shuffle."""
    month = F.concat(F.substring(ID, 1, 4), F.lit("_"), F.substring(ID, 5, 2))
    own = [t.where(F.col("shard") == month) for t in (t_content, t_signal, t_news)]
    return content_join3(own[0], *[t.drop("shard") for t in own[1:]], keys=(ID,))


def first_per_id(found: DataFrame, id_col: str | list[str] = ID) -> DataFrame:
    """One row per id (or per key columns) even if a source repeats an id:
    the smallest row, so the choice is deterministic."""
    keys = [id_col] if isinstance(id_col, str) else list(id_col)
    rest = [c for c in found.columns if c not in keys]
    return (found.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("_r"))
            .select(*keys, "_r.*").select(*found.columns))


def content_row(found: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Joined source columns -> the 14-column content row (plus ``keep``).

    ``publisher_score`` is a blank for shards whose table lacks it (month
    number below 8) or when the column is absent; the location comes from
    the first ``local.v1`` element; the group key is the first key of
    ``group_id.v2``; tags are reformatted to ``word=weight`` text.
    """
    loc = location_fields(F.col("local"))
    if "publisher_score" in found.columns:
        score = F.col("publisher_score")
        if "shard" in found.columns:
            score = F.when(shard_has_score(F.col("shard")), score).otherwise(F.lit(BLANK))
    else:
        score = F.lit(BLANK)
    out = found.select(
        F.col(ID),
        F.col("body_images_count").cast("string"),
        F.col("image_auditstate").cast("string"),
        score.cast("string").alias("publisher_score"),
        F.col("publish_time").cast("string"),
        F.col("content_words_num").cast("string"),
        F.col("title_words_num").cast("string"),
        loc["country"].alias("country"), loc["city"].alias("city"), loc["state"].alias("state"),
        F.col("ero_cal_result").cast("string"),
        first_key(F.col("group_id")).alias("group_key"),
        format_content_tags(F.col("tags")).alias("tags"),
        format_title_tags(F.col("tags_title")).alias("tags_title"),
        *[F.col(k) for k in keep],
    )
    assert out.columns[:14] == CONTENT_COLUMNS
    return out


def with_shard(ids: DataFrame, id_col: str = ID, **rule) -> DataFrame:
    """Add the ``shard`` label each id routes to (null when none)."""
    return ids.withColumn("shard", shard_label(F.col(id_col), **rule))


def content_lookup(ids: DataFrame, t_content: DataFrame, t_signal: DataFrame,
                   t_news: DataFrame, id_col: str = ID, dedupe_source: bool = True,
                   ids_distinct: bool = False, shards: list[str] | None = None,
                   checkpoint_ids: bool = False, with_found: bool = False, by_month: bool = False,
                   by_bucket: bool = False, **shard_rule) -> DataFrame:
    """Content rows for the requested ids, one output row per input row
    (other columns of ``ids`` are carried along after the content columns).

    Each distinct id is routed to its month shard (``shard_label``) and
    looked up once by a left join on ``(content_id, shard)`` -- no per-id
    query, no driver collect; with shard-partitioned source tables the join
    prunes months.  Ids that route nowhere or are not found get a row whose
    columns 1-11 are a blank and whose tags are empty.

    When ``ids`` may repeat an id (e.g. one row per log line, where one id
    can hold a third of all rows), the distinct ids are looked up first and
    the requested rows are then joined to that result on the id alone: both
    sides of that join are shuffled, so AQE can split a hot id's partition
    or broadcast the lookup result when it is measured small.  Pass
    ``ids_distinct=True`` when the ids are already distinct to skip it.

    Before the three-way join each source table is semi-joined to the
    requested ``(content_id, shard)`` pairs, so joining, deduplicating and
    formatting touch only the needed rows rather than all content.

    ``shards`` (e.g. the months a refresh can meet) restricts the source
    tables to those months; on shard-partitioned tables that is a partition
    filter applied at planning time.  Ids of other months are not found.

    The distinct requested ids are read by the three source filters and the
    final join; Spark recomputes their (usually cheap, column-pruned)
    lineage per use.  ``checkpoint_ids=True`` instead writes them once to the
    session's reliable checkpoint folder (an eager ``checkpoint()``), worth
    it when that lineage is expensive, as in the daily refresh.

    ``by_month`` is for tables stored by month (``shard`` folders): the
    months that the requested ids route to -- at most one row a month, which
    is what bounds the broadcast -- filter each scan at run time, so only
    their folders are read (dynamic partition pruning, whatever the join with
    the ids themselves becomes).

    ``by_bucket`` is for tables bucketed by id (``sinks.write_content_store``):
    a row's month follows from its id, so rows in another month than theirs
    are left out and every join is on the id alone; the tables then meet each
    other and the ids without being shuffled.

    ``with_found`` adds ``_found``: whether the id was found.
    """
    extra = [c for c in ids.columns if c != id_col]
    req = ids.select(F.col(id_col).alias(ID), *extra)
    uniq = req if ids_distinct else req.select(ID).distinct()
    routed = with_shard(uniq, ID, **shard_rule)
    if checkpoint_ids:
        scratch_root(ids.sparkSession)
        routed = routed.checkpoint(eager=True)
    if shards is not None:
        t_content, t_signal, t_news = (t.where(F.col("shard").isin(*shards))
                                       for t in (t_content, t_signal, t_news))
    # Reduce each source table to the requested ids before joining, deduping
    # and formatting: a refresh asks for few ids out of all content, and the
    # optimizer does not push a left join's keys into its right side.  The
    # semi join is broadcast when the id set is measured small.
    need = routed.where(F.col("shard").isNotNull()).select(ID, "shard")
    sources = [t_content, t_signal, t_news]
    if by_month:
        # a label has 7 characters; the comparison marks the ids' side as selective
        months = need.where(F.length("shard") == 7).select("shard").distinct()
        sources = [t.join(F.broadcast(months), "shard", "left_semi") for t in sources]
    # ids are asked for in the month they route to, so rows of any other month go before they are shuffled
    sources = [t.where(F.col("shard") == shard_label(F.col(ID), **shard_rule)) if "shard" in t.columns else t for t in sources]
    keys = [[ID, "shard"] if "shard" in t.columns and not by_bucket else [ID] for t in sources]
    sources = [t.join(need.select(*k), k, "left_semi") for t, k in zip(sources, keys)]
    if dedupe_source:
        # reduced before they are joined, so an id that repeats in all three
        # does not multiply; the least joined row is made of the three least
        sources = [first_per_id(t, k) for t, k in zip(sources, keys)]
    if by_bucket:
        sources[1:] = [t.drop("shard") for t in sources[1:]]
    found = content_join3(*sources)
    if "shard" not in found.columns:
        found = with_shard(found, ID, **shard_rule)
    found = found.where(F.col("shard").isNotNull())
    rows = content_row(found, keep=("shard",)).withColumn("_found", F.lit(True))
    looked = (routed.drop("shard").join(rows.drop("shard"), ID, "left") if by_bucket
              else routed.join(rows, [ID, "shard"], "left").drop("shard"))
    if not ids_distinct:
        looked = req.join(looked.where(F.col(ID).isNotNull()), ID, "left")
    present = F.col("_found").isNotNull()
    cols = [F.col(ID)]
    for c in CONTENT_COLUMNS[1:]:
        default = "" if c in ("tags", "tags_title") else BLANK
        cols.append(F.when(present, F.col(c)).otherwise(F.lit(default)).alias(c))
    if with_found:
        cols.append(present.alias("_found"))
    return looked.select(*cols, *extra)


def render_content_text(rows: DataFrame) -> DataFrame:
    """The 14-column content row as one comma-joined ``value`` text, nulls
    written as ``null`` (the saved snapshot format; nothing is quoted)."""
    return rows.select(F.concat_ws(",", *[F.coalesce(F.col(c).cast("string"), F.lit("null"))
                                          for c in CONTENT_COLUMNS]).alias("value"))


def snapshot_merge(new_rows: DataFrame, old_rows: DataFrame,
                   disjoint_distinct: bool = False) -> DataFrame:
    """New rows union old snapshot rows, duplicates removed over the whole
    row (two versions of one id both survive if any field differs).

    ``disjoint_distinct=True`` states that both inputs are already distinct
    and share no id (the refresh looks up only ids absent from a snapshot
    it wrote itself); the union is then already distinct and the shuffle of
    the whole snapshot is skipped."""
    u = new_rows.select(*CONTENT_COLUMNS).unionByName(old_rows.select(*CONTENT_COLUMNS))
    return u if disjoint_distinct else u.distinct()


def dedup_content(rows: DataFrame, id_col: str = ID) -> DataFrame:
    """One row per content id (the smallest, for determinism)."""
    return first_per_id(rows, id_col)
