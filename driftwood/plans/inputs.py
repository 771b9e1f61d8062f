"""Stand-in inputs derived from the supplied tables.

The supplied tables hold no raw logs, content shards or word vectors, so
each input of the jobs is derived from them with Spark (its size grows with
the tables):

* raw logs        <- ``events``: ``view`` lines are impressions (``e23``),
  ``click``/``purchase`` lines are clicks (``e24``); ``error`` lines are
  truncated (malformed JSON) and ``signup`` lines carry no item object;
  purchase lines store ``e30`` as text.
* content shards  <- ``orders`` (+ ``customer``, ``nation``, ``lineitem``):
  id = ``yyyyMM`` of the order date followed by the order key.
* log content ids <- ``lineitem`` joined to ``orders`` (one per line item).
* tokens          <- ``lineitem``: id ``l_orderkey``, word ``l_partkey``,
  weight ``l_quantity``.
* word vectors    <- ``embeddings``: word ``vec_id``, vector ``embedding``.

The per-order tag JSON and keyword text gather an order's line items with
``collect_list``; those groups are bounded by the data model (an order has at
most 7 line items), standing in for a JSON column of a source table.  No
library operator collects a group.
"""

from __future__ import annotations

import os
from collections.abc import Callable
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.ids import shard_label
from ..session import scratch_path
from ..sources.content import read_shards_parquet
from ..sources.sinks import write_content_store, write_partitioned

# Fixed values of the stand-ins.
STRATEGY = 0            # e30 = k % 3; strategy 0 is the one kept
SHARD_RULE = {"years": ("1998", "1999"), "start_year": "1998", "start_month": 8}
SNAPSHOT_BEFORE = "1999-01-01"   # old snapshot: content of orders before this date
VECTOR_DIM = 64
WIDE_DIM = 300


_MAKERS: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_PREPARED: dict[str, str] = {}


def stand_in(make: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """A derived input, or the table that ``prepare`` wrote of it."""
    @wraps(make)
    def read(spark: SparkSession, sf_dir: str) -> DataFrame:
        root = _PREPARED.get(sf_dir)
        return spark.read.parquet(f"{root}/{make.__name__}") if root else make(spark, sf_dir)
    _MAKERS[make.__name__] = make
    return read


def prepare(spark: SparkSession, sf_dir: str, root: str) -> None:
    """Write every stand-in below ``root``; from then on they are read from
    there, so that timings show the jobs and not the making of inputs."""
    for name, make in _MAKERS.items():
        make(spark, sf_dir).write.parquet(f"{root}/{name}")
    _PREPARED[sf_dir] = root


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


#: Line items of an order-wise part: their lists are sorted in memory.
PART_LINES = 500_000


def _lines_by_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items dealt by order, narrow as they are, into parts whose number
    grows with them; what is gathered per order then stays where it is."""
    li = table(spark, sf_dir, "lineitem")
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-li.count() // PART_LINES))
    return li.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_returnflag",
                     F.dayofmonth("l_shipdate").alias("ship_day")).repartition(parts, "l_orderkey")


# ---------------------------------------------------------------- raw logs

def _k(props: Column) -> Column:
    return F.get_json_object(props, "$.k").try_cast("int")


def _log_struct(e: DataFrame) -> DataFrame:
    k = _k(F.col("props"))
    eid, uid, typ = F.col("event_id"), F.col("user_id"), F.col("event_type")
    item = F.struct(
        F.floor("value").alias("e12"),
        typ.alias("e14"),
        (k % 5).cast("string").alias("e15"),
        F.struct(
            (k % 3).alias("e30"),
            (uid % 13).cast("string").alias("e31"),
            F.when(k % 2 == 0, F.struct(F.concat(F.lit("L"), (k % 4).cast("string")).alias("l1"))).alias("e37"),
            F.date_format("ts", "yyyyMMdd").alias("e38"),
        ).alias("o2"),
    )
    log = F.struct(
        eid.alias("p1"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("p3"),
        typ.alias("p5"),
        F.concat(F.lit("ch"), (uid % 3).cast("string")).alias("p6"),
        uid.alias("p7"),
        F.concat(F.lit("dev"), uid.cast("string")).alias("p17"),
        k.alias("p20"),
        F.when(eid % 4 != 3, F.struct(
            (k % 7).cast("string").alias("p31"),
            typ.alias("p32"),
            F.when(eid % 2 == 0, F.concat(F.lit("g"), k.cast("string"))).alias("e11"),
        )).alias("p30"),
        F.when(uid % 11 != 10, (uid % 11).cast("string")).alias("e11"),
        F.when(eid % 5 != 4, F.struct(
            typ.alias("e3"), (uid % 5).cast("string").alias("e5"), F.lit("z").alias("e39"),
        )).alias("e2"),
        F.when(typ == "view", item).alias("e23"),
        F.when(typ.isin("click", "purchase"), item).alias("e24"),
    )
    # emitted through a one-row generator so that filters on ``value`` are
    # not pushed below it (which would render the JSON twice)
    t = e.select(F.inline(F.array(F.struct(
        eid.alias("_id"), typ.alias("_type"), F.date_format("ts", "yyyyMMdd").alias("day"),
        F.date_format(F.date_add(F.to_date("ts"), F.when(eid % 17 == 0, 1).otherwise(0)), "yyyyMMdd").alias("folder_day"),
        F.to_json(log).alias("value")))))
    # some keys are there with a null
    v = F.when(F.col("_id") % 6 == 1, F.regexp_replace("value", r'"p31":"[^"]*"', '"p31":null')).otherwise(F.col("value"))
    return t.withColumn("value", F.when(F.col("_id") % 10 == 3, F.regexp_replace(v, '"e39":"z"', '"e39":null')).otherwise(v))


def log_text(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(impression lines, click lines): ``value`` JSON text plus ``day`` (of
    the line's time) and ``folder_day`` (the day folder it is logged in; one
    line in 17 comes a day late)."""
    return imp_text(spark, sf_dir), clk_text(spark, sf_dir)


@stand_in
def imp_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return log_text_from(table(spark, sf_dir, "events"))[0]


@stand_in
def clk_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return log_text_from(table(spark, sf_dir, "events"))[1]


def log_text_from(events: DataFrame) -> tuple[DataFrame, DataFrame]:
    t = _log_struct(events)
    v = F.col("value")
    v = (F.when(F.col("_type") == "error", F.expr("substring(value, 1, length(value) - 1)"))
         .when(F.col("_type") == "purchase",
               F.regexp_replace(v, r'"e30":(-?\d+)', '"e30":"$1"'))
         .otherwise(v))
    t = t.withColumn("value", v)
    imp = t.where(F.col("_type").isin("view", "error", "signup")).select("day", "folder_day", "value")
    clk = t.where(F.col("_type").isin("click", "purchase")).select("day", "folder_day", "value")
    return imp, clk


def line_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``side`` (``imp`` or ``clk``), ``folder_day, value``: lines that name
    content ids, one impression per line item in the folder of its shipping
    day's day of the month, and a click for returned ones.  Both lines of an
    item come from one row, so that items meet their orders once."""
    li = _lines_by_order(spark, sf_dir)
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    j = li.join(o, li.l_orderkey == o.o_orderkey).select(
        "l_orderkey", "l_linenumber", "l_suppkey", "l_returnflag",
        content_id_of(F.col("o_orderdate"), F.col("l_orderkey")).alias("content_id"),
        F.lpad(F.col("ship_day").cast("string"), 2, "0").alias("dd"))
    item = F.struct(F.col("content_id").alias("e15"), F.struct(F.lit(STRATEGY).alias("e30")).alias("o2"))

    def line(side: str, key: str) -> Column:
        log = F.struct(F.concat_ws("-", "l_orderkey", "l_linenumber").alias("p1"),
                       F.concat(F.lit("2024-01-"), "dd", F.lit(" 08:00:00")).alias("p3"),
                       F.concat(F.lit("dev"), "l_suppkey").alias("p17"), item.alias(key))
        return F.struct(F.lit(side).alias("side"), F.concat(F.lit("202401"), "dd").alias("folder_day"), F.to_json(log).alias("value"))
    both = F.array(line("imp", "e23"), F.when(F.col("l_returnflag") == "R", line("clk", "e24")))
    return j.select(F.inline(both)).where(F.col("side").isNotNull())


# ---------------------------------------------------------- content shards

def content_id_of(date: Column, key: Column) -> Column:
    return F.concat(F.date_format(date, "yyyyMM"), key.cast("string"))


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.withColumns({
        "content_id": content_id_of(F.col("o_orderdate"), F.col("o_orderkey")),
        "shard": F.date_format("o_orderdate", "yyyy_MM"),
    })


@stand_in
def t_content(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _orders(spark, sf_dir).select(
        "content_id", "shard",
        (F.col("o_custkey") % 10).cast("string").alias("body_images_count"),
        F.col("o_orderstatus").alias("image_auditstate"),
        F.floor("o_totalprice").cast("string").alias("publisher_score"),
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("publish_time"),
        F.col("o_orderpriority").alias("content_type"),
    )


def _order_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per order: tag JSON of its line items (word = part key, weight =
    quantity, in line order, ties by entry text) and title JSON of its first
    line's supplier (ties: smallest supplier)."""
    li = _lines_by_order(spark, sf_dir)
    entry = F.concat(F.lit('"'), F.col("l_partkey").cast("string"), F.lit('":{"weight":'),
                     F.col("l_quantity").cast("string"), F.lit("}"))
    g = li.groupBy("l_orderkey").agg(
        F.sort_array(F.collect_list(F.struct("l_linenumber", entry.alias("e")))).alias("es"),
        F.min_by("l_suppkey", F.struct("l_linenumber", "l_suppkey")).alias("sk"),
    )
    return g.select(
        F.col("l_orderkey").alias("o_orderkey"),
        F.concat(F.lit('{"v8":{'), F.array_join(F.transform("es", lambda x: x["e"]), ","),
                 F.lit("}}")).alias("tags"),
        F.concat(F.lit('{"v4":{"'), F.col("sk").cast("string"),
                 F.lit('":{"weight":1.01}}}')).alias("tags_title"),
    )


@stand_in
def t_signal(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = _orders(spark, sf_dir).where(F.col("o_orderpriority") != "5-LOW")
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation")
    cn = c.join(n, c.c_nationkey == n.n_nationkey, "left")
    j = (o.join(cn, o.o_custkey == cn.c_custkey, "left")
         .join(_order_tags(spark, sf_dir), "o_orderkey", "left"))
    local = F.when(F.col("c_mktsegment") == "BUILDING", F.lit('{"v1":[]}')).otherwise(
        F.concat(F.lit('{"v1":[{"country":"'), F.col("n_name"), F.lit('","city":"'),
                 F.col("c_name"), F.lit('"}]}')))
    group = F.concat(F.lit('{"v2":{"'), F.col("c_mktsegment"), F.lit('":{},"n'),
                     F.col("c_nationkey").cast("string"), F.lit('":{}}}'))
    return j.select(
        "content_id", "shard",
        (F.col("o_orderkey") % 997).cast("string").alias("content_words_num"),
        F.length("o_orderpriority").cast("string").alias("title_words_num"),
        local.alias("local"), group.alias("group_id"), "tags", "tags_title",
    )


@stand_in
def t_news(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (_orders(spark, sf_dir).where(F.col("o_orderstatus") != "P")
            .select("content_id", "shard", F.col("o_orderpriority").alias("ero_cal_result")))


def content_tables(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    return t_content(spark, sf_dir), t_signal(spark, sf_dir), t_news(spark, sf_dir)


_STORES: dict[tuple[str, str, str], tuple] = {}
STORE_BUCKETS = 8
#: Rows of a bucket over all months: one task writes and sorts them in memory.
BUCKET_ROWS = 250_000


def _stored(kind: str, write: Callable) -> Callable[[SparkSession, str], tuple[DataFrame, DataFrame, DataFrame]]:
    """The content tables as written once a session and data folder."""
    def read(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
        key = (spark.sparkContext.applicationId, sf_dir, kind)
        if key not in _STORES:
            tables = content_tables(spark, sf_dir)
            buckets = max(STORE_BUCKETS, -(-tables[0].count() // BUCKET_ROWS))
            _STORES[key] = tuple(write(spark, t, name, buckets) for name, t in zip(
                ("t_content", "t_signal", "t_news"), tables, strict=True))
        return tuple(reader() for reader in _STORES[key])
    return read


def _write_shards(spark: SparkSession, t: DataFrame, name: str, _buckets: int) -> Callable[[], DataFrame]:
    path = scratch_path(spark, f"shards-{name}")
    write_partitioned(t, path, ["shard"], mode="errorifexists", rebalance=True)
    return lambda: read_shards_parquet(spark, path)


def _write_store(spark: SparkSession, t: DataFrame, name: str, buckets: int) -> Callable[[], DataFrame]:
    path = scratch_path(spark, f"store-{name}")
    table_name = f"{name}_{os.path.basename(path)[-12:]}"
    write_content_store(t, table_name, path, buckets)
    return lambda: spark.table(table_name)


#: The content tables in month folders, and in month folders with buckets by id.
shard_tables = _stored("shards", _write_shards)
store_tables = _stored("store", _write_store)


@stand_in
def log_content_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Content id of every saved log row (one per line item; repeats kept)."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    j = li.join(o, li.l_orderkey == o.o_orderkey)
    return j.select("l_orderkey", "l_linenumber",
                    content_id_of(F.col("o_orderdate"), F.col("l_orderkey")).alias("content_id"))


@stand_in
def snapshot_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids already in the previous snapshot: content of orders dated before
    ``SNAPSHOT_BEFORE``."""
    o = _orders(spark, sf_dir).where(F.col("o_orderdate") < F.lit(SNAPSHOT_BEFORE).cast("timestamp_ntz"))
    return o.select("content_id")


def routed_shard(c: Column) -> Column:
    return shard_label(c, **SHARD_RULE)


# ------------------------------------------------------- tokens and vectors

@stand_in
def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "embeddings")
    return e.select(F.col("vec_id").cast("string").alias("word"), F.col("embedding").alias("vec"),
                    F.col("vec_id").alias("pos"))


def vector_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The vector table rendered as ``word v1 ... vd`` text lines."""
    e = table(spark, sf_dir, "embeddings")
    return e.select(F.concat_ws(" ", F.col("vec_id").cast("string"),
                                F.array_join(F.transform("embedding", lambda x: x.cast("string")), " "))
                    .alias("value"))


@stand_in
def wide_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``vectors`` at the source's 300 dimensions: the components come again
    with rising factors."""
    v = F.transform(F.sequence(F.lit(0), F.lit(WIDE_DIM - 1)), lambda i: (
        F.element_at("embedding", (i % VECTOR_DIM + 1).cast("int")) * (1 + F.floor(i / VECTOR_DIM))).cast("float"))
    return table(spark, sf_dir, "embeddings").select(F.col("vec_id").cast("string").alias("word"), v.alias("vec"),
                                                     F.col("vec_id").alias("pos"))


@stand_in
def line_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.select("l_orderkey", "l_linenumber", "l_returnflag",
                     F.col("l_partkey").cast("string").alias("word"),
                     F.col("l_quantity").alias("weight"))


@stand_in
def hot_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The line tokens, with one word that every order has (its first line)."""
    word = F.when(F.col("l_linenumber") == 1, F.lit("1")).otherwise(F.col("word"))
    return line_tokens(spark, sf_dir).withColumn("word", word)


@stand_in
def keyword_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per order: keyword text ``line:part=qty supp;...`` (``-1`` for lines
    flagged N; empty for 1-URGENT orders) and a title (empty for status F)."""
    li = _lines_by_order(spark, sf_dir)
    seg = F.concat(F.col("l_linenumber").cast("string"), F.lit(":"),
                   F.when(F.col("l_returnflag") == "N", F.lit("-1")).otherwise(
                       F.concat(F.col("l_partkey").cast("string"), F.lit("="),
                                F.col("l_quantity").cast("string"), F.lit(" "),
                                F.col("l_suppkey").cast("string"))))
    g = li.groupBy("l_orderkey").agg(
        F.sort_array(F.collect_list(F.struct("l_linenumber", seg.alias("s")))).alias("ss"),
        F.min_by("l_suppkey", F.struct("l_linenumber", "l_suppkey")).alias("sk"))
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    j = o.join(g, o.o_orderkey == g.l_orderkey, "left")
    kw = F.when(F.col("o_orderpriority") == "1-URGENT", F.lit("")).otherwise(
        F.coalesce(F.array_join(F.transform("ss", lambda x: x["s"]), ";"), F.lit("")))
    title = F.when(F.col("o_orderstatus") == "F", F.lit("")).otherwise(
        F.concat(F.coalesce(F.col("sk").cast("string"), F.lit("")), F.lit("=1.5")))
    return j.select("o_orderkey", kw.alias("keywords"), title.alias("title"))
