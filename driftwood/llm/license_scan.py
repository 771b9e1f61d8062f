"""License scans: MinHash bands over overlapping windows find templates,
exact shingle containment verifies them; DataFrame functions only.

Words are runs of letters and digits, lower-cased; shingles are runs of five
words (a template of fewer words is one shingle of its own width).  A
template of m distinct shingles is of the size class W, the least power of
two with W >= m.  Windows of W + S - 1 shingles start every S = max(1, W/2)
shingles, so any stretch of m shingles lies whole in one.  A template of
which ``percent`` are contained in a window has a Jaccard similarity of at
least ``least_similarity`` with it; ``bands_for`` gives the number of
one-row bands at which such a pair collides with probability ``SURE``.

A band can only collide in a window that holds the shingle with the
template's least hash in that band.  Windows without any of these anchor
shingles are therefore not hashed at all: no collision is lost, and almost
all texts are passed over by one overlap test.

The templates are a stated list, bounded by ``MAX_TEMPLATE_WORDS``, and are
broadcast.  Defined results: null counts as empty; texts without a match give
a row with no licenses; rows that share id and text share their result, and
repeated rows give a row each; empty tables work; further columns are not
read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialise
from .license_texts import TEMPLATES

K = 5
PERCENT = 80
SURE = 0.9999
MAX_TEMPLATE_WORDS = 100_000


def least_similarity(percent: int) -> float:
    """Least Jaccard similarity of a window with a template that it contains
    to ``percent``: the window has under 3/2 W shingles and m > W/2."""
    c = percent / 100
    return c / 2 / (3 / 2 + (1 - c) / 2)


def bands_for(similarity: float, sure: float = SURE) -> int:
    return math.ceil(math.log(1 - sure) / math.log(1 - similarity))


def words(text: Column) -> Column:
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def shingle_hashes(text: Column, width: int) -> Column:
    """Hash of every run of ``width`` words, in order."""
    spread = F.transform(words(text), lambda w: F.xxhash64(w))
    # the list of word hashes is bound once, by a one-element transform
    return F.flatten(F.transform(F.array(spread), lambda h: F.when(F.size(h) >= width, F.transform(
        F.sequence(F.lit(0), F.size(h) - width), lambda i: F.xxhash64(*[F.get(h, i + j) for j in range(width)])))
        .otherwise(F.array().cast("array<bigint>"))))


def _hash(band: int):
    return lambda s: F.xxhash64(s, F.lit(band))


def _is_least(band: int):
    return lambda s: F.xxhash64(s, F.lit(band)) == F.get("low", F.lit(band))


def min_hashes(shingles: Column, bands: int) -> Column:
    return F.array(*[F.array_min(F.transform(shingles, _hash(b))) for b in range(bands)])


def template_table(spark: SparkSession, templates: dict[str, str], bands: int) -> DataFrame:
    """``name, width, m, size, own`` (distinct shingles), ``low`` (a minimum
    for each band) and ``anchors`` (the shingles these minima come from)."""
    rows = spark.createDataFrame(sorted(templates.items()), "name string, text string").withColumn("w", F.size(words(F.col("text"))))
    rows = rows.where("w > 0").withColumn("width", F.least(F.lit(K), "w"))
    own = F.lit(None).cast("array<bigint>")
    for width in range(1, K + 1):
        own = F.when(F.col("width") == width, F.array_distinct(shingle_hashes(F.col("text"), width))).otherwise(own)
    rows = rows.withColumn("own", own).withColumn("m", F.size("own"))
    rows = rows.withColumn("size", F.pow(F.lit(2), F.ceil(F.log2("m"))).cast("int")).withColumn("low", min_hashes(F.col("own"), bands))
    anchors = F.array_distinct(F.flatten(F.array(*[F.filter("own", _is_least(b)) for b in range(bands)])))
    return rows.withColumn("anchors", anchors).select("name", "width", "m", "size", "own", "low", "anchors", "w")


def windows(rows: DataFrame, anchors: dict[int, list[int]]) -> DataFrame:
    """Windows of ``rows(.., shingles)`` that hold an anchor shingle of their
    size class (``anchors`` by size): ``.., size, step, at`` (first shingle)
    and ``held``.  All classes are taken in one pass."""
    classes = F.array(*[F.struct(F.lit(size).alias("size"), F.lit(max(1, size // 2)).alias("step"), F.array(*[F.lit(a) for a in known])
                                 .alias("known")) for size, known in sorted(anchors.items())])
    step, length = F.col("c.step"), F.col("c.size") + F.col("c.step") - 1
    hits = F.filter(F.transform("shingles", lambda s, i: F.when(F.array_contains("c.known", s), i)), lambda i: i.isNotNull())
    first = lambda i: F.greatest(F.lit(0), F.ceil((i - length + 1) / step)).cast("int")
    starts = F.array_distinct(F.flatten(F.transform(hits, lambda i: F.sequence(first(i), F.floor(i / step).cast("int")))))
    held = F.array_distinct(F.slice("shingles", F.col("at") + 1, length))
    return (rows.withColumn("c", F.explode(classes)).where(F.arrays_overlap("shingles", F.col("c.known")))
            .withColumn("n", F.explode(starts)).withColumn("at", (F.col("n") * step).cast("int")).withColumn("held", held)
            .select("id", "mark", "c.size", "c.step", "at", "held"))


def find_templates(docs: DataFrame, templates: dict[str, str] | None = None, percent: int = PERCENT,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, mark, name, contained, start, end``: the best window of each
    template found in a text (``mark`` tells texts of one id apart); start
    and end are word positions."""
    spark = docs.sparkSession
    bands = bands_for(least_similarity(percent))
    # a bounded list: read once here, so that its few anchors can stand in the plan
    held = template_table(spark, TEMPLATES if templates is None else templates, bands).collect()
    if sum(r["w"] for r in held) > MAX_TEMPLATE_WORDS:
        raise ValueError("too many template words; scan with several lists")
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    out = None
    for width in sorted({r["width"] for r in held}):
        of = [r for r in held if r["width"] == width]
        every = sorted({a for r in of for a in r["anchors"]})
        rows = (docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.xxhash64(text).alias("mark"),
                            shingle_hashes(text, width).alias("shingles"))
                .where(F.arrays_overlap("shingles", F.array(*[F.lit(a) for a in every]))))
        rows = materialise(rows, "shingles")  # only texts with some anchor shingle
        signed = windows(rows, {size: sorted({a for r in of if r["size"] == size for a in r["anchors"]})
                                for size in {r["size"] for r in of}}).withColumn("low", min_hashes(F.col("held"), bands))
        known = spark.createDataFrame([(r["name"], r["size"], r["m"], r["own"], r["low"]) for r in of],
                                      "name string, size int, m int, own array<bigint>, known array<bigint>")
        # one row a band on either side; a window meets a template once, whatever the number of equal bands
        banded = known.select("name", "size", F.posexplode("known").alias("band", "value"))
        met = (signed.select("id", "mark", "size", "step", "at", "held", F.posexplode("low").alias("band", "value"))
               .join(F.broadcast(banded), ["size", "band", "value"]).select("id", "mark", "size", "step", "at", "held", "name")
               .dropDuplicates(["id", "mark", "at", "name"]))
        found = (met.join(F.broadcast(known.select("name", "m", "own")), "name")
                 .withColumn("both", F.size(F.array_intersect("held", "own"))).where(F.col("both") * 100 >= F.col("m") * percent)
                 .select("id", "mark", "name", (F.col("both") / F.col("m")).alias("contained"), F.col("at").alias("start"),
                         (F.col("at") + F.col("size") + F.col("step") - 2 + width).alias("end")))
        out = found if out is None else out.unionByName(found)
    if out is None:
        return spark.createDataFrame([], "id long, mark long, name string, contained double, start int, end int")
    best = F.max_by(F.struct("contained", "start", "end"), F.struct("contained", -F.col("start"))).alias("best")
    return out.groupBy("id", "mark", "name").agg(best).select("id", "mark", "name", "best.*")


def scan_licenses(docs: DataFrame, templates: dict[str, str] | None = None, percent: int = PERCENT,
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, licenses`` of every document: array of ``(name, contained,
    start, end)`` by name."""
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    found = (find_templates(docs, templates, percent, id_col, text_col).groupBy("id", "mark")
             .agg(F.array_sort(F.collect_list(F.struct("name", "contained", "start", "end"))).alias("licenses")))
    found = materialise(found.withColumnRenamed("id", "found_id"), "licenses")
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.xxhash64(text).alias("mark"))
    none = F.array().cast("array<struct<name:string,contained:double,start:int,end:int>>")
    return rows.join(found.withColumnRenamed("mark", "found_mark"),
                     F.col("id").eqNullSafe(F.col("found_id")) & (F.col("mark") == F.col("found_mark")), "left") \
        .select("id", F.coalesce("licenses", none).alias("licenses"))


def query(docs: DataFrame) -> DataFrame:
    return scan_licenses(docs).select(F.col("id").alias("doc_id"), F.size("licenses").cast("long").alias("n_licenses"),
                                      F.array_join("licenses.name", ",").alias("licenses"))
