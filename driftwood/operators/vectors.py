"""Word-vector operators: token lookup, weighted sums per id, keyword /
category vectors, norms and cosine similarity.

Tokens are rows ``(id..., word, weight)``; vectors are rows
``(word, vec ARRAY<FLOAT>)`` with one row per word -- a raw vector file that
may repeat a word is first reduced with ``first_vectors_unpartitioned`` (or
``first_vectors``).  The weighted sum is an ordinary aggregate:
one ``sum(weight * vec[i])`` per dimension, which keeps a fixed-width
buffer (``HashAggregate``), aggregates partially before the shuffle (a hot
id is reduced on the map side) and never holds a group's tokens in memory.
Out-of-vocabulary tokens are dropped by an inner join before that shuffle.
Beyond ``DIRECT_DIMS`` dimensions that many sums leave generated code, so
the vocabulary is cut into blocks of ``BLOCK_DIMS`` positions, each summed
by itself, and an id's few blocks are put together at the end.

A vector is some hundred times its tokens, so where the number of rows is
given and the vocabulary is counted small enough to broadcast
(``vocab_fits``), rows and tokens are dealt by their id *before* they meet it:
sums, blocks and parts of an id are then put together where they stand, no
vector is shuffled, and the number of parts (``dealt_parts``) grows with the
rows so that the sums of one part stay in memory.  A larger vocabulary meets
the tokens by a shuffle; each known token's vector then travels once, as it
is, to its id's part, and is cut and summed there.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import FloatType

from ..functions.tags import KEYWORD_EMPTY, is_keyword_format, parse_keywords
from ..functions.vectors import fit_dim, l1_norm, l2_norm, scale, zeros


#: Up to so many sums (and the keys) stay in generated code; longer vectors go by blocks of positions.
DIRECT_DIMS = 90
BLOCK_DIMS = 50
#: At most so many words count as hot, if they hold that share of all tokens.
MAX_HOT = 256
HOT_SHARE = 1 / 2048
#: Sums of one dealt part (``dealt_parts``).
PART_BYTES = 64 << 20
#: A broadcast vocabulary takes at most so many bytes, and that part of a driver's or executor's heap.
VOCAB_BYTES = 512 << 20
VOCAB_HEAP_PART = 8


def dealt_parts(spark: SparkSession, n_vectors: int, dim: int) -> int:
    """Parts to deal rows into that end as ``n_vectors`` vectors of ``dim``
    doubles: about ``PART_BYTES`` each, as many as other shuffles have at least."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n_vectors * dim * 8 // PART_BYTES))


def vocab_fits(vectors: DataFrame, dim: int) -> bool:
    """Whether the vocabulary, as counted, can be broadcast whatever Spark
    guesses of its size: ``VOCAB_BYTES`` at most, a ``VOCAB_HEAP_PART``-th of
    the smaller heap and half of what the driver may collect."""
    spark = vectors.sparkSession
    conf, sizes = spark.sparkContext.getConf(), spark._jvm.org.apache.spark.network.util.JavaUtils
    heap = min(sizes.byteStringAsMb(conf.get(f"spark.{of}.memory", "1g")) for of in ("driver", "executor")) << 20
    most = min(VOCAB_BYTES, heap // VOCAB_HEAP_PART, (sizes.byteStringAsBytes(conf.get("spark.driver.maxResultSize", "1g")) or heap) // 2)
    n, chars = _vocab(vectors).agg(F.count(F.lit(1)), F.sum(F.octet_length("word"))).first()
    blocks = -(-dim // BLOCK_DIMS) if dim > DIRECT_DIMS else 1
    width = 4 if isinstance(vectors.schema["vec"].dataType.elementType, FloatType) else 8
    return n * (dim * width + 64 * blocks) + (chars or 0) * blocks <= most


def tag_tokens(rows: DataFrame, text_col: str, keep: Sequence[str], here: Column | None = None) -> DataFrame:
    """``word=weight`` text -> one row per token: ``keep..., pos, word,
    weight``.

    The text is split and exploded first and each token is then parsed with
    plain string functions, which stay in generated code (parsing the array
    with ``transform``/``filter`` first is interpreted per element; measured
    0.21 s vs 0.38 s for 1.9M tokens).  Same rules as ``parse_tags``: a
    missing, blank or non-numeric weight is 1.0 and blank words are dropped;
    ``pos`` is the token's index in the space-split text.  Tokens that fulfil
    ``here`` come with ``_here`` true and stay even if blank, with a null word.
    """
    e = rows.select(*keep, F.posexplode(
        F.split(F.trim(F.coalesce(F.col(text_col), F.lit(""))), " ", -1)).alias("pos", "_tok"))
    parts = F.split(F.col("_tok"), "=", -1)
    weight = F.coalesce(F.trim(F.try_element_at(parts, F.lit(2))).try_cast("double"), F.lit(1.0))
    word = F.element_at(parts, 1)
    if here is None:
        return e.select(*keep, "pos", word.alias("word"), weight.alias("weight")).where(F.trim(F.col("word")) != "")
    return (e.select(*keep, "pos", F.when(F.trim(word) != "", word).alias("word"), weight.alias("weight"), here.alias("_here"))
            .where(F.col("word").isNotNull() | F.col("_here")))


def keyword_segments(rows: DataFrame, text_col: str, keep: Sequence[str]) -> DataFrame:
    """``cat:tags;cat:-1;...`` -> one row per segment that has a ``:``:
    ``keep..., pos, category, tags`` (``pos``: index in the ``;``-split)."""
    e = rows.select(*keep, F.posexplode(
        F.split(F.coalesce(F.col(text_col), F.lit("")), ";", -1)).alias("pos", "_seg"))
    parts = F.split(F.col("_seg"), ":", -1)
    return (e.select(*keep, "pos", F.element_at(parts, 1).alias("category"),
                     F.trim(F.try_element_at(parts, F.lit(2))).alias("tags"))
            .where(F.col("tags").isNotNull()))


def _vocab(vectors: DataFrame) -> DataFrame:
    return vectors.select("word", "vec").where(F.col("word").isNotNull())


def hot_words(tokens: DataFrame, max_hot: int = MAX_HOT, min_share: float = HOT_SHARE) -> DataFrame:
    """``word`` of at most ``max_hot`` words that a frequent-items sketch
    (bounded size, merged map-side) counts in ``min_share`` of all tokens or
    more.  The sketch tracks eight times as many words, so one that holds
    ``min_share`` of all tokens is among them."""
    sketch = tokens.where(F.col("word").isNotNull()).agg(
        F.expr(f"approx_top_k(word, {max_hot}, {8 * max_hot})").alias("top"), F.count(F.lit(1)).alias("total"))
    return (sketch.select("total", F.explode("top").alias("t"))
            .where((F.col("t.count") >= 2) & (F.col("t.count") >= F.col("total") * min_share)).select(F.col("t.item").alias("word")))


def join_words(tokens: DataFrame, vocab: DataFrame, how: str = "inner", hot: DataFrame | None = None) -> DataFrame:
    """Tokens with the columns of ``vocab``.  The tokens of ``hot`` words
    (see ``hot_words``) stay where they are and meet their few vectors by a
    broadcast, whose size does not grow with the vocabulary; only the others
    go by the ordinary join.  Any set of hot words gives the same rows."""
    if hot is None:
        return tokens.join(vocab, "word", how)
    few = F.broadcast(vocab.join(F.broadcast(hot), "word", "left_semi"))
    heavy = tokens.join(F.broadcast(hot), "word", "left_semi").join(few, "word", how)
    return heavy.unionByName(tokens.join(F.broadcast(hot), "word", "left_anti").join(vocab, "word", how))


def token_vectors(tokens: DataFrame, vectors: DataFrame, dim: int, hot: DataFrame | None = None) -> DataFrame:
    """Each token's vector times its weight; unknown words give zeros.  The
    join strategy is Spark's (AQE turns it into a broadcast when the
    vocabulary side is measured small, and splits skewed words otherwise),
    but for the tokens of ``hot`` words (``join_words``)."""
    j = join_words(tokens, _vocab(vectors), "left", hot)
    return j.withColumn("vec", fit_dim(scale(F.col("vec"), F.col("weight")), dim))


def first_vectors(vectors: DataFrame) -> DataFrame:
    """One vector per word: the first in read order when ``pos`` exists,
    else the smallest."""
    if "pos" in vectors.columns:
        return vectors.groupBy("word").agg(F.min_by("vec", "pos").alias("vec"))
    return vectors.groupBy("word").agg(F.min("vec").alias("vec"))


def first_vectors_unpartitioned(vectors: DataFrame) -> DataFrame:
    """Same rows as ``first_vectors``, but as a filter of the raw table: the
    non-first rows of repeated words (normally few) are removed by an anti
    join, whose strategy Spark takes from measured sizes; when it broadcasts
    them the raw layout stays and a later join on ``word`` shuffles it, which
    lets AQE split a hot word.  Needs a ``pos`` column."""
    dup = (vectors.groupBy("word").agg(F.min("pos").alias("_first"), F.count(F.lit(1)).alias("_n"))
           .where(F.col("_n") > 1))
    extra = (vectors.select("word", "pos").join(dup, "word")
             .where(F.col("pos") != F.col("_first")).select("word", "pos"))
    return vectors.join(extra, ["word", "pos"], "left_anti")


def token_vectors_broadcast(tokens: DataFrame, vectors: DataFrame, dim: int) -> DataFrame:
    """Word -> vector by first match; a miss or blank word gives zeros; the
    weight is not applied (as the source does).  The source broadcasts its
    vocabulary; here the plan has no size guess and no hint: AQE broadcasts
    the vocabulary when its shuffle is measured small, else splits hot words."""
    raw = vectors.where(F.col("word").isNotNull())
    vocab = first_vectors_unpartitioned(raw) if "pos" in raw.columns else first_vectors(raw)
    j = tokens.join(vocab.select("word", "vec"), "word", "left")
    return j.withColumn("vec", fit_dim(F.col("vec"), dim))


def _dim_sums(vec: Column, weight: Column, dim: int, prefix: str,
              cond: Column | None = None) -> list[Column]:
    """``sum(weight * vec[i])`` for each i; vectors longer than ``dim`` add
    nothing, shorter ones add to their own positions only."""
    n = F.size(vec)
    out = []
    for i in range(dim):
        ok = (n <= dim) & (n > i)
        if cond is not None:
            ok = ok & cond
        term = F.when(ok, vec.getItem(i).cast("double") * weight)
        out.append(F.sum(term).alias(f"{prefix}{i}"))
    return out


def _assemble(prefix: str, dim: int) -> Column:
    return F.array(*[F.coalesce(F.col(f"{prefix}{i}"), F.lit(0.0)) for i in range(dim)])


def combine_repeats(tokens: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One token per (keys, word) with its weights added up: worth its
    shuffle where a word repeats within an id, since the vocabulary join and
    the vector arithmetic then meet it once."""
    return tokens.groupBy(*keys, "word").agg(F.sum("weight").alias("weight"))


def _blocks(dim: int, width: int = BLOCK_DIMS) -> Column:
    return F.array(*[F.slice("vec", at + 1, width) for at in range(0, dim, width)])


def block_vocab(vectors: DataFrame, dim: int, width: int = BLOCK_DIMS) -> DataFrame:
    """``word, _b, _seg``: every vector of at most ``dim`` components cut
    into blocks of ``width`` positions."""
    return _vocab(vectors).where(F.size("vec") <= dim).select("word", F.posexplode(_blocks(dim, width)).alias("_b", "_seg"))


def vector_sums(tokens: DataFrame, vectors: DataFrame, ids: Sequence[str], dim: int, part_col: str | None = None,
                parts: Sequence[str] = (), present: DataFrame | None = None, hot: DataFrame | None = None,
                here: str | None = None, near: bool = False, deal: tuple[int, Sequence[str]] | None = None) -> DataFrame:
    """Weighted sums per ``ids`` of the known tokens, as ``vec``, or as
    ``<part>_vec`` for each value of ``part_col``.  Unknown words add zeros,
    so the join drops them before the aggregate's shuffle; tokens of ``hot``
    words are not shuffled for it (``join_words``).  The rows of ``present(ids)``
    join the aggregate as tokens without a vector, so that each has a result
    (zeros) without a join afterwards; tokens whose column ``here`` is true do
    so where they stand, known or not, which leaves tokens dealt by id as they are.
    ``near``: the vocabulary is broadcast (see ``vocab_fits``).  ``deal``
    (into how many parts, by which of the ``ids``): known tokens go to their
    part with their whole vector, which is half a partial sum, and are cut
    and summed there."""
    ids, keys = list(ids), [*ids, *([part_col] if part_col else [])]
    blocks = range(-(-dim // BLOCK_DIMS)) if dim > DIRECT_DIMS else None
    seg, width, at = ("_seg", BLOCK_DIMS, ["_b"]) if blocks else ("vec", dim, [])
    if blocks and deal:
        vocab = _vocab(vectors).where(F.size("vec") <= dim)
    else:
        vocab = block_vocab(vectors, dim) if blocks else _vocab(vectors)
    known = join_words(tokens, F.broadcast(vocab) if near else vocab, "left" if here else "inner", None if near else hot)
    hit = F.col("vec" if deal else seg).isNotNull()
    if here:
        known = known.where(hit | F.col(here))
    if deal:
        known = known.select(*keys, F.when(hit, F.col("weight")).alias("weight"), "vec").repartition(deal[0], *deal[1])
        if blocks:
            known = known.select(*keys, "weight", F.posexplode_outer(F.when(hit, _blocks(dim))).alias("_b", "_seg"))
    known = known.select(*keys, *at, "weight", seg)
    if present is not None:
        none = [F.lit(parts[0]).alias(part_col)] if part_col else []
        none += [F.lit(0).alias(c) for c in at]
        known = known.unionByName(present.select(*ids, *none, F.lit(None).cast("double").alias("weight"),
                                                 F.lit(None).cast(known.schema[seg].dataType).alias(seg)))
    sums = known.groupBy(*keys, *at).agg(*_dim_sums(F.col(seg), F.col("weight"), width, "_d"))
    names = [(f"{p}_vec", F.col(part_col) == p) for p in parts] if part_col else [("vec", F.lit(True))]
    whole = _assemble("_d", width)
    if not blocks and not part_col:
        return sums.select(*ids, whole.alias("vec"))
    # at most one row of an id for each part and block
    folded = sums.groupBy(*ids).agg(*[
        F.max(F.when(of & (F.col("_b") == b) if blocks else of, whole)).alias(f"_{name}_{b}")
        for name, of in names for b in blocks or [0]])
    return folded.select(*ids, *[
        F.slice(F.concat(*[F.coalesce(F.col(f"_{name}_{b}"), zeros(width)) for b in blocks or [0]]), 1, dim).alias(name)
        for name, _ in names])


def tag_vector(tokens: DataFrame, vectors: DataFrame, id_cols: Sequence[str] | str,
               dim: int, all_ids: bool = True, hot: DataFrame | None = None,
               n_tokens: int | None = None) -> DataFrame:
    """Weighted vector sum per id: ``(id..., vec ARRAY<DOUBLE>)``.

    Repeated words add up; ``hot`` words are joined map-side.  With ``all_ids`` every id of ``tokens`` is
    returned, ids whose words are all unknown with zeros (a distinct of the
    ids joined back, both sides partitioned by id).  With ``n_tokens``
    (their number, at least about) the tokens are dealt by id: before they
    meet a vocabulary that can be broadcast, and nothing is shuffled after
    them, else once they have met it.  That is for ids that hold no large
    share of all tokens each.  A null id's vector is zeros either way."""
    ids = [id_cols] if isinstance(id_cols, str) else list(id_cols)
    if n_tokens is not None:
        near, n = vocab_fits(vectors, dim), dealt_parts(tokens.sparkSession, n_tokens, dim)
        by = {"near": True} if near else {"hot": hot, "deal": (n, ids)}
        dealt = tokens.repartition(n, *ids) if near else tokens
        if not all_ids:
            return vector_sums(dealt, vectors, ids, dim, **by)
        whole = F.lit(True)
        for c in ids:
            whole = whole & F.col(c).isNotNull()
        return vector_sums(dealt.withColumns({"word": F.when(whole, F.col("word")), "_here": F.lit(True)}),
                           vectors, ids, dim, here="_here", **by)
    v = vector_sums(tokens, vectors, ids, dim, hot=hot)
    if not all_ids:
        return v
    return with_zero_vectors(tokens.select(*ids).distinct(), v, ids, ["vec"], dim)


def tag_vectors_multi(tokens: DataFrame, vectors: DataFrame, id_cols: Sequence[str],
                      part_col: str, parts: Sequence[str], dim: int,
                      all_ids: bool = True) -> DataFrame:
    """Several weighted sums per id (e.g. body and title tags): output
    ``id..., <part>_vec`` for each part.

    Summed per ``(id, part)``, then the (at most ``len(parts)``) rows of an
    id are folded into one.  Measured faster than one aggregate with
    ``dim * len(parts)`` conditional sums (64-d: 0.60 s vs 0.95 s; 300-d: 2.5 s
    vs 5.9 s at sf0.1); both shuffles carry partially aggregated rows only."""
    ids = list(id_cols)
    v = vector_sums(tokens.where(F.col(part_col).isin(*parts)), vectors, ids, dim, part_col, parts)
    if not all_ids:
        return v
    return with_zero_vectors(tokens.select(*ids).distinct(), v, ids, [f"{p}_vec" for p in parts], dim)


def with_zero_vectors(ids: DataFrame, vecs: DataFrame, id_cols: Sequence[str],
                      vec_cols: Sequence[str], dim: int) -> DataFrame:
    """Every id of ``ids``, with zero vectors where ``vecs`` has none."""
    j = ids.select(*id_cols).join(vecs, list(id_cols), "left")
    return j.select(*id_cols, *[F.coalesce(F.col(c), zeros(dim)).alias(c) for c in vec_cols])


#: What a distinct row is dealt by, and what it is told apart by, besides its id.
DEALT = ("_deal",)
VERSION = (*DEALT, "_ver", "_copies")


def _versions(rows: DataFrame, id_col: str, text_cols: Sequence[str], n_parts: int | None) -> DataFrame:
    """``id, texts, _deal, _ver, _copies``: every distinct row once, with a
    digest of its texts (nulls told from empty ones) and how often it comes,
    dealt by id and a few bits of the texts' hash (versions of one id lie
    apart); the digest is made after that and not shuffled."""
    dealt = [id_col, *DEALT]
    few = F.pmod(F.xxhash64(*text_cols), F.lit(1 << 15)).cast("short").alias("_deal")
    rows = rows.select(id_col, *text_cols, few)
    rows = rows.repartition(*dealt) if n_parts is None else rows.repartition(n_parts, *dealt)
    ver = rows.select("*", F.unhex(F.sha2(F.to_json(F.struct(*text_cols)), 256)).alias("_ver"))
    return ver.groupBy(*dealt, "_ver", *text_cols).agg(F.count(F.lit(1)).alias("_copies"))


def _row_sums(toks: DataFrame, vectors: DataFrame, id_col: str, dim: int, n_parts: int | None, *parts) -> DataFrame:
    """Sums of the tokens of ``_versions`` rows, dealt into ``n_parts`` (None: as Spark does)."""
    by = {}
    if n_parts is not None:
        by = {"near": True} if vocab_fits(vectors, dim) else {"deal": (n_parts, [id_col, *DEALT])}
    return vector_sums(toks, vectors, [id_col, *VERSION], dim, *parts, here="_here", **by)


def _each_copy(vecs: DataFrame, id_col: str, vec_cols: Sequence[str]) -> DataFrame:
    return vecs.select(id_col, *vec_cols, F.explode(F.sequence(F.lit(1).cast("long"), F.col("_copies")))).select(id_col, *vec_cols)


def content_vectors(rows: DataFrame, vectors: DataFrame, dim: int, id_col: str = "content_id",
                    tags_col: str = "tags", title_col: str = "tags_title", n_rows: int | None = None) -> DataFrame:
    """``(content_id, tags_vec, title_vec)``, one row for each content row:
    each text is split into weighted tokens and summed against the
    vocabulary.  An id may come in several versions; each distinct (id,
    texts) is summed once, its number of copies goes through the sum as part
    of the key, and it is put out as often: nothing is joined back.  Both
    texts of a row are exploded from one two-element array.  ``n_rows`` (how
    many rows there are) sets into how many parts they are dealt; without it
    Spark does, by the size of the texts."""
    n_parts = None if n_rows is None else dealt_parts(rows.sparkSession, 2 * n_rows, dim)
    given = _versions(rows, id_col, [tags_col, title_col], n_parts)
    key = [id_col, *VERSION]
    texts = F.array(F.struct(F.lit("tags").alias("_part"), F.col(tags_col).alias("_txt")),
                    F.struct(F.lit("title").alias("_part"), F.col(title_col).alias("_txt")))
    toks = tag_tokens(given.select(*key, F.inline(texts)), "_txt", [*key, "_part"],
                      here=(F.col("pos") == 0) & (F.col("_part") == "tags"))
    v = _row_sums(toks, vectors, id_col, dim, n_parts, "_part", ["tags", "title"])
    return _each_copy(v, id_col, ["tags_vec", "title_vec"])


def category_vector(rows: DataFrame, vectors: DataFrame, dim: int, id_col: str,
                    text_col: str, title_col: str, n_rows: int | None = None) -> DataFrame:
    """Vector of a keyword-or-tags text plus a title text, one row for each
    row of ``rows`` (an id may repeat with other texts; see
    ``content_vectors``, also for ``n_rows``).

    Keyword text (``cat:tags;cat:-1;...``, recognised only when the title is
    empty) sums every category's tags except ``-1``; otherwise the text is
    read as tags.  The title's tags are added.  Both empty -> zeros.  The
    texts to sum are gathered per row (a short array), exploded, and then
    tokenised like ``tag_tokens``."""
    s, title = F.col(text_col), F.col(title_col)
    n_parts = None if n_rows is None else dealt_parts(rows.sparkSession, n_rows, dim)
    given = _versions(rows, id_col, [text_col, title_col], n_parts)
    key = [id_col, *VERSION]
    kw_texts = F.transform(
        F.filter(parse_keywords(s), lambda c: c["tags"] != KEYWORD_EMPTY), lambda c: c["tags"])
    texts = F.concat(F.when(is_keyword_format(s, title), kw_texts).otherwise(F.array(s)),
                     F.array(title))
    toks = tag_tokens(given.select(*key, F.posexplode(texts).alias("_t", "_txt")), "_txt", [*key, "_t"],
                      here=(F.col("pos") == 0) & (F.col("_t") == 0))
    v = _row_sums(toks, vectors, id_col, dim, n_parts)
    return _each_copy(v, id_col, ["vec"])


def vector_norms(vectors: DataFrame, vec_col: str = "vec") -> DataFrame:
    """Add ``l1`` and ``l2`` norms."""
    v = F.col(vec_col)
    return vectors.withColumns({"l1": l1_norm(v), "l2": l2_norm(v)})


def vector_lookup_one(vectors: DataFrame, key: str) -> DataFrame:
    """The first vector of ``key`` with its L2 norm (empty when absent)."""
    hit = vectors.where(F.col("word") == F.lit(key))
    if "pos" in hit.columns:
        hit = hit.orderBy("pos")
    return hit.limit(1).select("word", "vec", l2_norm(F.col("vec")).alias("l2"))
