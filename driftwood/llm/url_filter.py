"""URL filters: host/path rules first, then a list of canonical URLs behind a
blocked Bloom filter, in DataFrame functions only.

The list (any size) is reduced to distinct canonical URLs and hashed into
blocks of 8 lanes of 32 bits, one bit a lane; a probe reads one block.
Possible hits go on to an exact hash join on the canonical URL, which removes
the false positives; all other pages never meet the list.

Defined results: a null url or one without ``://`` has an empty host and
path, fits no rule, is never listed and is allowed; of fitting rules the
longest (host and path together) wins, a block rule before an allow rule of
the same length; repeated pages give a row each; an empty list or page table
works; further columns are not read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialise

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LANES = 8
BITS_PER_URL = 16
BROADCAST_BYTES = 32 << 20
# Query parameters that name how a page was reached, not which
TRACKING = "utm_[^=&]*|ref|fbclid|gclid"


def url_parts(url: Column) -> tuple[Column, Column, Column]:
    """Host (A-Z lower-cased), path and query of a url; empty without ``://``."""
    u = F.coalesce(url, F.lit(""))
    rest = F.when(F.instr(u, "://") > 0, F.substring(u, F.instr(u, "://") + 3, F.length(u))).otherwise(F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), UPPER, LOWER)
    path = F.regexp_extract(rest, r"^[^/?#]*(/[^?#]*)", 1)
    return host, path, F.regexp_extract(rest, r"^[^?#]*\?([^#]*)", 1)


def canonical_url(url: Column) -> Column:
    """Host without ``www.`` and default port, path without index file and
    closing slash, other than tracking parameters sorted; null if no host."""
    host, path, query = url_parts(url)
    host = F.regexp_replace(F.regexp_replace(host, r"^www\.", ""), r":(80|443)$", "")
    path = F.regexp_replace(F.regexp_replace(path, r"/index\.html?$", "/"), r"/+$", "")
    kept = F.array_sort(F.filter(F.split(query, "&"),
                                 lambda p: (p != "") & ~p.rlike(rf"^({TRACKING})(=|$)")))
    return F.when(host != "", F.concat(host, path, F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&")))
                                       .otherwise(F.lit(""))))


def rule_column(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """``struct(rule, verdict)`` of the longest fitting rule, or null.
    ``rules``: (verdict, "host/path") pairs, a short driver-side list."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, text in sorted(rules, key=lambda r: (len(r[1]), r[0] == "block")):
        at, _, below = text.partition("/")
        fits = ((host == at) | host.endswith("." + at)) & path.startswith("/" + below)
        out = F.when(fits, F.struct(F.lit(text).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def _hash(url: str) -> Column:
    return F.xxhash64(F.col(url))


def _lane(i: int) -> Column:
    return F.expr(f"shiftleft(1L, cast(xxhash64(h, {i}) & 31 as int))")


def blocked_bloom(urls: DataFrame, n_blocks: int) -> DataFrame:
    """``urls(url)`` -> one row a used block: ``block, lane0 .. lane7``."""
    return (urls.select(_hash("url").alias("h"))
            .select(F.expr(f"pmod(h, {n_blocks})").alias("block"), *[_lane(i).alias(f"m{i}") for i in range(LANES)])
            .groupBy("block").agg(*[F.bit_or(f"m{i}").alias(f"lane{i}") for i in range(LANES)]))


def possible_hits(pages: DataFrame, bloom: DataFrame, n_blocks: int) -> DataFrame:
    """Rows of ``pages(.., url)`` that the filter lets pass."""
    if n_blocks * (LANES + 2) * 8 <= BROADCAST_BYTES:  # else both sides are shuffled on the block
        bloom = F.broadcast(bloom)
    probe = pages.withColumn("h", _hash("url")).withColumn("block", F.expr(f"pmod(h, {n_blocks})"))
    hit = None
    for i in range(LANES):
        one = F.col(f"lane{i}").bitwiseAND(_lane(i)) != 0
        hit = one if hit is None else hit & one
    return probe.join(bloom, "block").where(hit).select(*pages.columns)


def filter_urls(pages: DataFrame, listed: DataFrame, rules: Sequence[tuple[str, str]], id_col: str = "page_id",
                url_col: str = "url", listed_col: str = "url") -> DataFrame:
    """``id, host, path, rule, verdict, canonical`` of every page: the rule's
    verdict, else ``block`` if the canonical URL is listed, else ``allow``."""
    urls = materialise(listed.select(canonical_url(F.col(f"`{listed_col}`")).alias("url"))
                       .where(F.col("url").isNotNull()).distinct(), "listed")
    n_blocks = max(1, -(-urls.count() * BITS_PER_URL // (32 * LANES)))
    bloom = blocked_bloom(urls, n_blocks)
    host, path, _ = url_parts(F.col("raw"))
    judged = (pages.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{url_col}`").alias("raw"))
              .select("id", host.alias("host"), path.alias("path"), canonical_url(F.col("raw")).alias("url"))
              .withColumn("r", rule_column(F.col("host"), F.col("path"), rules))
              .select("id", "host", "path", F.col("r.rule").alias("rule"), F.col("r.verdict").alias("verdict"), "url"))
    open_ = F.col("verdict").isNull() & F.col("url").isNotNull()
    # one decision a distinct URL, so that a URL of very many pages costs one probe and one join row a task
    wanted = judged.where(open_).select("url").distinct()
    blocked = materialise(possible_hits(wanted, bloom, n_blocks).join(urls, "url", "left_semi"), "blocked")
    hits = judged.where(open_).join(blocked.withColumn("hit", F.lit(True)), "url", "left")
    rest = judged.where(~open_).withColumn("hit", F.lit(None).cast("boolean"))
    verdict = F.coalesce("verdict", F.when(F.col("hit"), "block").otherwise("allow"))
    cols = ["id", "host", "path", "rule", verdict.alias("verdict"), F.col("url").alias("canonical")]
    return hits.select(*cols).unionByName(rest.select(*cols))


RULES = [("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"),
         ("block", "net/fr/")]
FLAGGED_WORDS = ["idiot", "moron", "loser"]


def flagged_pages(pages: DataFrame) -> DataFrame:
    """The query's list: urls of the pages whose html holds a flagged word,
    standing alone, in small letters."""
    return pages.where(F.col("html").rlike(rf"\b({'|'.join(FLAGGED_WORDS)})\b")).select("url")


def query(pages: DataFrame) -> DataFrame:
    return filter_urls(pages, flagged_pages(pages), RULES).select(
        F.col("id").alias("page_id"), "host", "path", "rule", "verdict")


_RULE_SQL = " ".join(
    f"WHEN (host = '{h}' OR host LIKE '%.{h}') AND starts_with(path, '/{p}') THEN '{h}/{p}'"
    for h, p in (r[1].split("/", 1) for r in sorted(RULES, key=lambda r: (-len(r[1]), r[0] != "block"))))
_VERDICT_SQL = " ".join(f"WHEN '{r}' THEN '{v}'" for v, r in RULES)
SQL = rf"""
WITH u AS (SELECT page_id, html, CASE WHEN contains(coalesce(url, ''), '://')
                  THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
p AS (SELECT page_id, html, translate(regexp_extract(rest, '^([^/?#]*)', 1), '{UPPER}', '{LOWER}') AS host,
             regexp_extract(rest, '^[^/?#]*(/[^?#]*)', 1) AS path,
             regexp_extract(rest, '^[^?#]*\?([^#]*)', 1) AS query FROM u),
k AS (SELECT *, list_sort(list_filter(string_split(query, '&'),
                lambda x: x <> '' AND NOT regexp_matches(x, '^({TRACKING})(=|$)'))) AS kept FROM p),
c AS (SELECT *, CASE WHEN host <> '' THEN regexp_replace(regexp_replace(host, '^www\.', ''), ':(80|443)$', '')
        || regexp_replace(regexp_replace(path, '/index\.html?$', '/'), '/+$', '')
        || CASE WHEN len(kept) > 0 THEN '?' || array_to_string(kept, '&') ELSE '' END END AS canonical FROM k),
r AS (SELECT *, CASE {_RULE_SQL} END AS rule FROM c),
l AS (SELECT DISTINCT canonical FROM c WHERE regexp_matches(html, '\b({'|'.join(FLAGGED_WORDS)})\b')
        AND canonical IS NOT NULL)
SELECT page_id, host, path, rule, CASE rule {_VERDICT_SQL} ELSE
       CASE WHEN canonical IN (SELECT canonical FROM l) THEN 'block' ELSE 'allow' END END AS verdict
FROM r
"""
