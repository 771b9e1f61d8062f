"""DuckDB SQL equivalents of the registered queries, written independently of
the Spark code from the stand-in definitions in ``plans.inputs``."""

from __future__ import annotations

# ---------------------------------------------------------------- shared CTEs

EV = """ev AS (
  SELECT event_id, ts, user_id, event_type, value,
         TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
         strftime(ts, '%Y-%m-%d %H:%M:%S') AS p3,
         strftime(ts, '%Y-%m-%d') AS d10,
         strftime(ts, '%Y%m%d') AS d8,
         strftime(CASE WHEN event_id % 17 = 0 THEN ts + INTERVAL 1 DAY ELSE ts END, '%Y%m%d') AS f8
  FROM events)"""


def _sides(strategy: bool) -> str:
    cond = " AND k % 3 = 0" if strategy else ""
    return f"""imp AS (SELECT * FROM ev WHERE event_type = 'view'{cond}),
clk AS (SELECT * FROM ev WHERE event_type IN ('click', 'purchase'){cond})"""


KEYCOLS = ("CAST(k % 5 AS VARCHAR) AS content_id, 'dev' || CAST(user_id AS VARCHAR) AS device_id, "
           "d10 AS day")

def _lab(more: str = "") -> str:
    """Pairing by (content, device, day) and the ``more`` columns."""
    return f"""u AS (
  SELECT {KEYCOLS}{more}, event_id, 'imp' AS side FROM imp
  UNION ALL
  SELECT {KEYCOLS}{more}, event_id, 'click' AS side FROM clk),
lab AS (
  SELECT content_id, device_id, day{more},
         CAST(CASE WHEN bool_or(side = 'imp') AND bool_or(side = 'click') THEN 1 ELSE 0 END AS INTEGER) AS is_click,
         CASE WHEN bool_or(side = 'imp') THEN 'imp' ELSE 'click' END AS side,
         CASE WHEN bool_or(side = 'imp') THEN min(event_id) FILTER (WHERE side = 'imp')
              ELSE min(event_id) FILTER (WHERE side = 'click') END AS log_event
  FROM u GROUP BY content_id, device_id, day{more})"""


LAB = _lab()

NV = "CAST(NULL AS VARCHAR)"

FLAT_COLS = f"""
  l.is_click AS is_click,
  CAST(e.event_id AS VARCHAR) AS p1, e.p3 AS p3, e.event_type AS p5,
  'ch' || CAST(e.user_id % 3 AS VARCHAR) AS p6, CAST(e.user_id AS VARCHAR) AS p7,
  {NV} AS p9, {NV} AS p10, {NV} AS p11, {NV} AS p13, {NV} AS p14,
  'dev' || CAST(e.user_id AS VARCHAR) AS p17, CAST(e.k AS VARCHAR) AS p20,
  {NV} AS p21, {NV} AS p22, {NV} AS p23, {NV} AS p24, {NV} AS p25,
  CASE WHEN e.event_id % 4 <> 3 AND e.event_id % 6 <> 1 THEN CAST(e.k % 7 AS VARCHAR) END AS p31,
  CASE WHEN e.event_id % 4 <> 3 THEN e.event_type END AS p32,
  {NV} AS p33,
  CASE WHEN e.event_id % 4 <> 3 AND e.event_id % 2 = 0 AND e.user_id % 11 <> 10 THEN CAST(e.user_id % 11 AS VARCHAR) END AS e11,
  CAST(CAST(floor(e.value) AS BIGINT) AS VARCHAR) AS e12, e.event_type AS e14,
  CAST(e.k % 5 AS VARCHAR) AS content_id,
  CAST(e.user_id % 13 AS VARCHAR) AS e31, {NV} AS e35, {NV} AS e36,
  CASE WHEN e.k % 2 = 0 THEN 'L' || CAST(e.k % 4 AS VARCHAR) END AS l1, {NV} AS l2,
  e.d8 AS e38,
  CASE WHEN e.event_id % 5 <> 4 THEN e.event_type END AS e3, {NV} AS e4,
  CASE WHEN e.event_id % 5 <> 4 THEN CAST(e.user_id % 5 AS VARCHAR) END AS e5,
  {NV} AS e6, {NV} AS e7, {NV} AS e8, {NV} AS e9,
  CASE WHEN e.event_id % 5 <> 4 AND e.event_id % 10 <> 3 THEN 'z' END AS e39"""

TRAINING = ["is_click", "p1", "p3", "p5", "p6", "p7", "p9", "p10", "p11", "p13", "p14", "p17",
            "p20", "p21", "p22", "p23", "p24", "p25", "p31", "p32", "p33", "e11", "e12", "e14",
            "content_id", "e31", "e35", "e36", "l1", "l2", "e38", "e3", "e4", "e5", "e6", "e7",
            "e8", "e9", "e39"]


def _training(strategy: bool = True) -> str:
    return f"""WITH {EV},
{_sides(strategy)},
{LAB},
tr AS (SELECT {FLAT_COLS} FROM lab l JOIN ev e ON e.event_id = l.log_event)"""


# columns of keys that some lines hold with a null: text ``null``, not empty
_NULL_TEXT = {"p31": "CAST(p1 AS BIGINT) % 4 <> 3 AND CAST(p1 AS BIGINT) % 6 = 1",
              "e11": "CAST(p1 AS BIGINT) % 4 <> 3 AND CAST(p1 AS BIGINT) % 2 = 0",
              "e39": "CAST(p1 AS BIGINT) % 5 <> 4 AND CAST(p1 AS BIGINT) % 10 = 3"}


def _text_render(alias: str = "tr") -> str:
    parts = []
    for i, c in enumerate(TRAINING):
        v = f"CAST({alias}.{c} AS VARCHAR)"
        if c in _NULL_TEXT:
            parts.append(f"coalesce({v}, CASE WHEN {_NULL_TEXT[c]} THEN 'null' ELSE '' END)")
        else:
            parts.append(f"coalesce({v}, '{'null' if 1 <= i <= 17 else ''}')")
    return "concat_ws(',', " + ", ".join(parts) + ")"


# content shards
CONTENT = """ord AS (
  SELECT o.*, strftime(o_orderdate, '%Y%m') || CAST(o_orderkey AS VARCHAR) AS content_id,
         strftime(o_orderdate, '%Y_%m') AS shard
  FROM orders o),
tc AS (
  SELECT content_id, shard, CAST(o_custkey % 10 AS VARCHAR) AS body_images_count,
         o_orderstatus AS image_auditstate,
         CAST(CAST(floor(o_totalprice) AS BIGINT) AS VARCHAR) AS publisher_score,
         strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS publish_time, o_orderpriority AS content_type
  FROM ord),
otags AS (
  SELECT l_orderkey AS o_orderkey,
         '{"v8":{' || string_agg(ent, ',' ORDER BY l_linenumber, ent) || '}}' AS tags,
         '{"v4":{"' || CAST(arg_min(l_suppkey, CAST(l_linenumber AS BIGINT) * 1000000000 + l_suppkey) AS VARCHAR) || '":{"weight":1.01}}}' AS tags_title
  FROM (SELECT *, '"' || CAST(l_partkey AS VARCHAR) || '":{"weight":' || CAST(l_quantity AS VARCHAR) || '}' AS ent
        FROM lineitem) li GROUP BY l_orderkey),
tsig AS (
  SELECT o.content_id, o.shard, CAST(o.o_orderkey % 997 AS VARCHAR) AS content_words_num,
         CAST(length(o.o_orderpriority) AS VARCHAR) AS title_words_num,
         CASE WHEN c.c_mktsegment = 'BUILDING' THEN '{"v1":[]}'
              ELSE '{"v1":[{"country":"' || n.n_name || '","city":"' || c.c_name || '"}]}' END AS local,
         '{"v2":{"' || c.c_mktsegment || '":{},"n' || CAST(c.c_nationkey AS VARCHAR) || '":{}}}' AS group_id,
         t.tags, t.tags_title
  FROM ord o LEFT JOIN customer c ON o.o_custkey = c.c_custkey
             LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
             LEFT JOIN otags t ON t.o_orderkey = o.o_orderkey
  WHERE o.o_orderpriority <> '5-LOW'),
tnews AS (SELECT content_id, shard, o_orderpriority AS ero_cal_result FROM ord WHERE o_orderstatus <> 'P'),
j3 AS (
  SELECT content_id, shard, body_images_count, image_auditstate, publisher_score, publish_time,
         content_type, content_words_num, title_words_num, local, group_id, tags, tags_title,
         ero_cal_result
  FROM tc JOIN tsig USING (content_id, shard) JOIN tnews USING (content_id, shard)),
crow AS (
  SELECT content_id, shard, body_images_count, image_auditstate,
         CASE WHEN TRY_CAST(substr(shard, 6, 2) AS INTEGER) >= 8 THEN publisher_score ELSE ' ' END AS publisher_score,
         publish_time, content_words_num, title_words_num,
         coalesce(json_extract_string(local, '$.v1[0].country'), ' ') AS country,
         coalesce(json_extract_string(local, '$.v1[0].city'), ' ') AS city,
         coalesce(json_extract_string(local, '$.v1[0].state'), ' ') AS state,
         ero_cal_result,
         coalesce(json_keys(json_extract(group_id, '$.v2'))[1], ' ') AS group_key,
         replace(replace(replace(replace(replace(replace(coalesce(tags, ''), '{"v8":{"', ''),
           '":{"weight":', '='), '},"', ' '), '}}}', ''), ' =', '='), '{"v99":{"', '') AS tags,
         replace(replace(replace(replace(replace(coalesce(tags_title, ''), '{"v4":{"', ''),
           '":{"weight":', '='), '},"', ' '), '}}}', ''), ' =', '=') AS tags_title
  FROM j3),
logids AS (
  SELECT l.l_orderkey, l.l_linenumber,
         strftime(o.o_orderdate, '%Y%m') || CAST(l.l_orderkey AS VARCHAR) AS content_id
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey),
snapids AS (SELECT content_id FROM ord WHERE o_orderdate < TIMESTAMP '1999-01-01')"""

CONTENT_COLS = ["content_id", "body_images_count", "image_auditstate", "publisher_score",
                "publish_time", "content_words_num", "title_words_num", "country", "city",
                "state", "ero_cal_result", "group_key", "tags", "tags_title"]


def _shard_expr(c: str) -> str:
    m = f"TRY_CAST(substr({c}, 5, 2) AS INTEGER)"
    y = f"substr({c}, 1, 4)"
    return (f"CASE WHEN length({c}) >= 6 AND {m} IS NOT NULL AND {y} IN ('1998', '1999') "
            f"AND NOT ({y} = '1998' AND {m} < 8) AND {m} <= 12 "
            f"THEN {y} || '_' || substr({c}, 5, 2) END")


def _lookup_cte(name: str, ids_sql: str) -> str:
    """``name`` = content rows for every row of ``ids_sql`` (a query with a
    ``content_id`` column)."""
    cols = ["r.content_id AS content_id"]
    for c in CONTENT_COLS[1:]:
        d = "''" if c in ("tags", "tags_title") else "' '"
        cols.append(f"CASE WHEN c.content_id IS NOT NULL THEN c.{c} ELSE {d} END AS {c}")
    return f"""{name}_r AS (SELECT content_id, {_shard_expr('content_id')} AS shard FROM ({ids_sql}) x),
{name} AS (SELECT {', '.join(cols)} FROM {name}_r r LEFT JOIN crow c
           ON r.content_id = c.content_id AND r.shard = c.shard)"""


NEW_IDS = ("SELECT DISTINCT content_id FROM logids "
           "WHERE content_id NOT IN (SELECT content_id FROM snapids)")

# vectors
VOCAB = """vocab AS (SELECT CAST(vec_id AS VARCHAR) AS word, embedding AS vec FROM embeddings),
tok AS (SELECT l_orderkey, l_linenumber, l_returnflag, CAST(l_partkey AS VARCHAR) AS word,
               l_quantity AS weight FROM lineitem)"""


def _r(x: str) -> str:
    return f"(round({x}, 4) + 0.0)"


def _vsum(v: str, p: str) -> str:
    """Summary of a list column (same definitions as the Spark side)."""
    return (f"{_r(f'list_sum(list_transform({v}, lambda x: CAST(x AS DOUBLE)))')} AS {p}_sum, "
            f"{_r(f'sqrt(list_sum(list_transform({v}, lambda x: CAST(x AS DOUBLE) * CAST(x AS DOUBLE))))')} AS {p}_l2, "
            f"{_r(f'list_sum(list_transform({v}, lambda x, i: CAST(x AS DOUBLE) * i))')} AS {p}_wsum, "
            f"CAST(len({v}) AS BIGINT) AS {p}_dim")


def _dims_summary(p: str, dim: int = 64) -> str:
    """Summary columns from per-dimension sums ``{p}s`` (sum), ``{p}q``
    (sum of squares) and ``{p}w`` (position-weighted)."""
    return (f"{_r(f'coalesce({p}s, 0.0)')} AS {p}_sum, {_r(f'coalesce(sqrt({p}q), 0.0)')} AS {p}_l2, "
            f"{_r(f'coalesce({p}w, 0.0)')} AS {p}_wsum, CAST({dim} AS BIGINT) AS {p}_dim")


def _dim_sums(tokens_sql: str, keys: str, label: str = "", dim: int = 64) -> str:
    """Per-dimension weighted sums of the tokens in ``tokens_sql`` (columns
    ``keys``, word, weight) grouped by ``keys``, then folded to s/q/w."""
    return f"""(SELECT {keys}, sum(s) AS {label}s, sum(s * s) AS {label}q, sum(i * s) AS {label}w FROM (
       SELECT {keys}, i, sum(t.weight * CAST(v.vec[i] AS DOUBLE)) AS s
       FROM ({tokens_sql}) t JOIN vocab v ON v.word = t.word, range(1, {dim + 1}) r(i)
       GROUP BY {keys}, i) d GROUP BY {keys})"""


# ------------------------------------------------------------------ queries

SQL: dict[str, str] = {}

SQL["log_scan"] = f"""WITH {EV}
SELECT CASE WHEN event_type = 'error' THEN NULL ELSE CAST(event_id AS VARCHAR) END AS p1,
       CASE WHEN event_type = 'error' THEN NULL ELSE event_type END AS p5,
       event_type = 'view' AS has_imp,
       event_type IN ('click', 'purchase') AS has_click,
       CASE WHEN event_type IN ('view', 'click', 'purchase') THEN CAST(k % 3 AS VARCHAR) END AS e30
FROM ev"""

SQL["strategy_filter"] = f"""WITH {EV}, {_sides(True)}
SELECT CAST(event_id AS VARCHAR) AS p1, 'imp' AS side FROM imp
UNION ALL SELECT CAST(event_id AS VARCHAR) AS p1, 'click' AS side FROM clk"""

SQL["reject_totals"] = f"""WITH {EV}
SELECT CASE WHEN event_type IN ('click', 'purchase') THEN 'click' ELSE 'imp' END AS side,
       CASE WHEN event_type = 'error' THEN 'malformed' WHEN event_type = 'signup' THEN 'no_side'
            WHEN k % 3 = 0 THEN 'kept' ELSE 'other_strategy' END AS fate, count(*) AS n
FROM ev WHERE event_type IN ('view', 'error', 'signup', 'click', 'purchase') GROUP BY ALL"""

SQL["pair_key"] = f"""WITH {EV}, {_sides(True)}
SELECT CAST(event_id AS VARCHAR) AS p1, {KEYCOLS} FROM imp
UNION ALL SELECT CAST(event_id AS VARCHAR) AS p1, {KEYCOLS} FROM clk"""

SQL["dedup_daily"] = f"""WITH {EV}, {_sides(True)}
SELECT content_id, device_id, day, side, CAST(min(event_id) AS VARCHAR) AS log_id
FROM (SELECT {KEYCOLS}, event_id, 'imp' AS side FROM imp
      UNION ALL SELECT {KEYCOLS}, event_id, 'click' AS side FROM clk) x GROUP BY content_id, device_id, day, side"""

SQL["click_label"] = f"""WITH {EV}, {_sides(True)}, {LAB}
SELECT content_id, device_id, day, is_click, side, CAST(log_event AS VARCHAR) AS log_id FROM lab"""

SQL["label_json"] = f"""WITH {EV}, {_sides(True)}, {LAB}
SELECT content_id, device_id, day, CAST(is_click AS VARCHAR) AS is_click,
       CAST(log_event AS VARCHAR) AS log_id FROM lab"""

SQL["flatten_log"] = f"""WITH {EV},
{_sides(False)},
{LAB}
SELECT {FLAT_COLS} FROM lab l JOIN ev e ON e.event_id = l.log_event"""

SQL["training_rows"] = _training() + "\nSELECT * FROM tr"
SQL["csv_roundtrip"] = SQL["training_rows"]
SQL["flatten_log_text"] = _training() + f"\nSELECT {_text_render()} AS value FROM tr"
SQL["training_rows_variant"] = SQL["training_rows"]
SQL["flatten_text_variant"] = SQL["flatten_log_text"]
SQL["split_field"] = _training() + "\nSELECT p1, content_id FROM tr"
SQL["sink_partitioned"] = f"""WITH {EV}, {_sides(True)}, {_lab(', f8')}
SELECT {FLAT_COLS}, substr(l.f8, 1, 6) AS month, l.f8 AS day FROM lab l JOIN ev e ON e.event_id = l.log_event"""
SQL["daily_rows"] = SQL["sink_partitioned"]
SQL["published_rows"] = SQL["sink_partitioned"]

SQL["day_part"] = "SELECT event_id, strftime(ts, '%Y-%m-%d') AS day FROM events"

SQL["date_label"] = f"""WITH {EV}
SELECT event_id,
       strftime(CAST(ts AS DATE) - CAST(k % 10 AS INTEGER), '%Y%m%d') AS day_label,
       strftime(CAST(ts AS DATE) - CAST(k % 10 AS INTEGER), '%Y%m') AS month_label,
       strftime(ts, '%Y%m%d%H%M') AS stamp
FROM ev"""

SQL["day_range_scan"] = f"""WITH {EV}
SELECT CASE WHEN event_type IN ('click', 'purchase') THEN 'click' ELSE 'imp' END AS side, d8 AS day,
       CASE WHEN event_type = 'error' THEN NULL ELSE CAST(event_id AS VARCHAR) END AS p1
FROM ev WHERE event_type IN ('view', 'error', 'signup', 'click', 'purchase') AND d8 BETWEEN '20240105' AND '20240111'"""

SQL["multi_path_scan"] = f"""WITH {EV}
SELECT d10 AS day, count(*) AS n FROM ev
WHERE event_type IN ('view', 'signup', 'click', 'purchase')
  AND (d8 IN ('20240103', '20240110') OR d8 LIKE '2024012%')
GROUP BY d10"""

SQL["is_numeric"] = """SELECT o_orderkey,
  coalesce(regexp_full_match(strftime(o_orderdate, '%Y%m') || CAST(o_orderkey AS VARCHAR), '[0-9]*'), false) AS id_numeric,
  coalesce(regexp_full_match(o_orderpriority, '[0-9]*'), false) AS priority_numeric,
  coalesce(regexp_full_match(substr(o_orderpriority, 1, 1), '[0-9]*'), false) AS prefix_numeric,
  coalesce(regexp_full_match(regexp_replace(o_orderpriority, '[^0-9]', '', 'g'), '[0-9]*'), false) AS digits_numeric
FROM orders"""

SQL["shard_route"] = f"""WITH x AS (
  SELECT o_orderkey, strftime(o_orderdate, '%Y%m') || CAST(o_orderkey AS VARCHAR) AS content_id FROM orders),
y AS (SELECT o_orderkey, content_id, {_shard_expr('content_id')} AS shard FROM x)
SELECT o_orderkey, content_id, shard,
       coalesce(TRY_CAST(substr(shard, 6, 2) AS INTEGER) >= 8, false) AS has_score FROM y"""

_C = f"WITH {CONTENT}"

SQL["distinct_ids"] = _C + "\nSELECT DISTINCT content_id FROM logids"
SQL["new_ids"] = _C + "\n" + NEW_IDS
SQL["known_ids"] = _C + ("\nSELECT DISTINCT content_id FROM logids "
                         "WHERE content_id IN (SELECT content_id FROM snapids)")
SQL["id_counts"] = _C + f""",
fetched AS (SELECT DISTINCT x.content_id FROM ({NEW_IDS}) x JOIN crow c ON c.content_id = x.content_id
            AND c.shard = {_shard_expr('x.content_id')})
SELECT CAST(count(*) AS BIGINT) AS total_ids,
       CAST(count(*) FILTER (WHERE content_id NOT IN (SELECT content_id FROM snapids)) AS BIGINT) AS new_ids,
       CAST(count(*) FILTER (WHERE content_id IN (SELECT content_id FROM snapids)) AS BIGINT) AS known_ids,
       (SELECT CAST(count(*) AS BIGINT) FROM fetched) AS fetched_rows
FROM (SELECT DISTINCT content_id FROM logids) d"""

SQL["content_join3"] = _C + """
SELECT content_id, shard, image_auditstate, content_words_num, ero_cal_result FROM j3"""

SQL["content_row"] = _C + f"\nSELECT {', '.join(CONTENT_COLS)} FROM crow"

SQL["content_lookup"] = _C + ",\n" + _lookup_cte("lk", NEW_IDS) + "\nSELECT * FROM lk"
SQL["content_lookup_all"] = (_C + ",\n" + _lookup_cte("lk", "SELECT content_id FROM logids")
                             + "\nSELECT * FROM lk")
SQL["sharded_lookup"] = SQL["stored_lookup"] = SQL["content_lookup"]
SQL["stored_join3"] = SQL["content_join3"]
SQL["new_ids_filtered"] = SQL["new_ids"]
_REFRESH = (_C + ",\n" + _lookup_cte("fresh", NEW_IDS) + ",\n"
            + _lookup_cte("old", "SELECT content_id FROM snapids") + ",\n"
            + "merged AS (SELECT * FROM fresh UNION SELECT * FROM old)")
SQL["content_refresh"] = _REFRESH + "\nSELECT * FROM merged"
SQL["incremental_snapshot"] = SQL["content_refresh"]
_RANGE_IDS = """SELECT DISTINCT strftime(o.o_orderdate, '%Y%m') || CAST(l.l_orderkey AS VARCHAR) AS content_id
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey WHERE day(l.l_shipdate) BETWEEN 1 AND 20"""
_RANGE_NEW = f"SELECT content_id FROM ({_RANGE_IDS}) y WHERE content_id NOT IN (SELECT content_id FROM snapids)"
SQL["refresh_from_rows"] = (_C + ",\n" + _lookup_cte("fresh", _RANGE_NEW) + ",\n"
                            + _lookup_cte("old", "SELECT content_id FROM snapids")
                            + "\nSELECT * FROM fresh UNION SELECT * FROM old")
SQL["refresh_totals"] = _C + f"""
SELECT (SELECT count(*) FROM ({_RANGE_IDS}) a) AS total_ids, (SELECT count(*) FROM ({_RANGE_NEW}) b) AS new_ids,
       (SELECT count(*) FROM ({_RANGE_NEW}) x JOIN crow c ON c.content_id = x.content_id
        AND c.shard = {_shard_expr('x.content_id')}) AS found"""
SQL["repaired_rows"] = _C + "\nSELECT " + ", ".join(f"coalesce({c}, 'null') AS {c}" for c in CONTENT_COLS) + " FROM crow"
SQL["sink_snapshot"] = _REFRESH + "\nSELECT " + ", ".join(
    f"coalesce({c}, 'null') AS {c}" for c in CONTENT_COLS) + " FROM merged"


def _slice_ids(lo: str, hi: str) -> str:
    return (f"SELECT strftime(o_orderdate, '%Y%m') || CAST(o_orderkey AS VARCHAR) AS content_id "
            f"FROM orders WHERE o_orderdate BETWEEN TIMESTAMP '{lo}' AND TIMESTAMP '{hi}'")


_SLICES = (_C + ",\n" + _lookup_cte("sa", _slice_ids("1998-06-01", "9999-12-31")) + ",\n"
           + _lookup_cte("sb", _slice_ids("0001-01-01", "1998-12-31")))
SQL["snapshot_merge"] = _SLICES + "\nSELECT * FROM sa UNION SELECT * FROM sb"
_rest = ", ".join(f"{c} ASC NULLS FIRST" for c in CONTENT_COLS[1:])
SQL["dedup_content"] = _SLICES + f""",
sb2 AS (SELECT * REPLACE (lower(image_auditstate) AS image_auditstate) FROM sb),
m AS (SELECT * FROM sa UNION SELECT * FROM sb2),
rk AS (SELECT *, row_number() OVER (PARTITION BY content_id ORDER BY {_rest}) AS rn FROM m)
SELECT {', '.join(CONTENT_COLS)} FROM rk WHERE rn = 1"""

SQL["location_fields"] = _C + """
SELECT content_id,
       coalesce(json_extract_string(local, '$.v1[0].country'), ' ') AS country,
       coalesce(json_extract_string(local, '$.v1[0].city'), ' ') AS city,
       coalesce(json_extract_string(local, '$.v1[0].state'), ' ') AS state
FROM tsig"""

SQL["first_group_key"] = _C + """
SELECT content_id, coalesce(json_keys(json_extract(group_id, '$.v2'))[1], ' ') AS group_key FROM tsig"""

_FMT_TAGS = """replace(replace(replace(replace(replace(replace(coalesce(tags, ''), '{"v8":{"', ''),
           '":{"weight":', '='), '},"', ' '), '}}}', ''), ' =', '='), '{"v99":{"', '')"""
SQL["format_tags"] = _C + f"""
SELECT content_id, {_FMT_TAGS} AS tags,
       replace(replace(replace(replace(replace(coalesce(tags_title, ''), '{{"v4":{{"', ''),
           '":{{"weight":', '='), '}},"', ' '), '}}}}}}', ''), ' =', '=') AS tags_title
FROM tsig"""

SQL["parse_tags"] = _C + f""",
ft AS (SELECT content_id, {_FMT_TAGS} AS t FROM tsig),
tk AS (SELECT content_id, unnest(string_split(trim(t), ' ')) AS tok,
              generate_subscripts(string_split(trim(t), ' '), 1) - 1 AS pos FROM ft)
SELECT content_id, CAST(pos AS INTEGER) AS pos, split_part(tok, '=', 1) AS word,
       coalesce(TRY_CAST(trim(split_part(tok, '=', 2)) AS DOUBLE), 1.0) AS weight
FROM tk WHERE trim(split_part(tok, '=', 1)) <> ''"""

_KW = """kwl AS (
  SELECT l_orderkey, string_agg(seg, ';' ORDER BY l_linenumber, seg) AS ss,
         arg_min(l_suppkey, CAST(l_linenumber AS BIGINT) * 1000000000 + l_suppkey) AS sk
  FROM (SELECT *, CAST(l_linenumber AS VARCHAR) || ':' ||
                  CASE WHEN l_returnflag = 'N' THEN '-1'
                       ELSE CAST(l_partkey AS VARCHAR) || '=' || CAST(l_quantity AS VARCHAR) || ' ' || CAST(l_suppkey AS VARCHAR) END AS seg
        FROM lineitem) li GROUP BY l_orderkey),
kw AS (
  SELECT o.o_orderkey,
         CASE WHEN o.o_orderpriority = '1-URGENT' THEN '' ELSE coalesce(k.ss, '') END AS keywords,
         CASE WHEN o.o_orderstatus = 'F' THEN '' ELSE coalesce(CAST(k.sk AS VARCHAR), '') || '=1.5' END AS title
  FROM orders o LEFT JOIN kwl k ON o.o_orderkey = k.l_orderkey)"""

SQL["parse_keywords"] = f"""WITH {_KW},
seg AS (SELECT o_orderkey, unnest(string_split(keywords, ';')) AS s,
               generate_subscripts(string_split(keywords, ';'), 1) - 1 AS pos FROM kw)
SELECT o_orderkey, CAST(pos AS INTEGER) AS pos, split_part(s, ':', 1) AS category,
       trim(split_part(s, ':', 2)) AS tags
FROM seg WHERE s LIKE '%:%'"""

SQL["unwrap_parens"] = r"""SELECT page_id, regexp_extract(html, '\(([^()]*)', 1) AS inner FROM pages"""

SQL["vector_table_scan"] = f"""SELECT CAST(vec_id AS VARCHAR) AS word, {_vsum('embedding', 'vec')} FROM embeddings"""

SQL["vector_lookup_one"] = """SELECT CAST(vec_id AS VARCHAR) AS word,
  (round(sqrt(list_sum(list_transform(embedding, lambda x: CAST(x AS DOUBLE) * CAST(x AS DOUBLE)))), 4) + 0.0) AS l2
FROM embeddings WHERE CAST(vec_id AS VARCHAR) = '7'"""

SQL["vector_norms"] = """SELECT CAST(vec_id AS VARCHAR) AS word,
  (round(list_sum(list_transform(embedding, lambda x: abs(CAST(x AS DOUBLE)))), 4) + 0.0) AS l1,
  (round(sqrt(list_sum(list_transform(embedding, lambda x: CAST(x AS DOUBLE) * CAST(x AS DOUBLE)))), 4) + 0.0) AS l2
FROM embeddings"""

_ZERO = "list_transform(range(64), lambda x: 0.0)"
SQL["token_vectors"] = f"""WITH {VOCAB}
SELECT t.l_orderkey, t.l_linenumber,
       {_vsum(f"coalesce(list_transform(v.vec, lambda x: CAST(x AS DOUBLE) * t.weight), {_ZERO})", 'vec')}
FROM tok t LEFT JOIN vocab v ON v.word = t.word"""

SQL["token_vectors_broadcast"] = f"""WITH {VOCAB}
SELECT t.l_orderkey, t.l_linenumber,
       {_vsum(f"coalesce(list_transform(v.vec, lambda x: CAST(x AS DOUBLE)), {_ZERO})", 'vec')}
FROM tok t LEFT JOIN vocab v ON v.word = t.word"""

SQL["tag_vector"] = f"""WITH {VOCAB},
agg AS {_dim_sums('SELECT l_orderkey, word, weight FROM tok', 'l_orderkey', 'vec')}
SELECT ids.l_orderkey, {_dims_summary('vec')}
FROM (SELECT DISTINCT l_orderkey FROM tok) ids LEFT JOIN agg USING (l_orderkey)"""

SQL["tag_vector_hot"] = SQL["tag_vector"].replace(
    "CAST(l_partkey AS VARCHAR) AS word", "CASE WHEN l_linenumber = 1 THEN '1' ELSE CAST(l_partkey AS VARCHAR) END AS word")

WIDE = """vocab AS (SELECT CAST(vec_id AS VARCHAR) AS word, list_transform(range(300), lambda i:
             CAST(embedding[i % 64 + 1] * CAST(1 + i // 64 AS DOUBLE) AS FLOAT)) AS vec FROM embeddings),
tok AS (SELECT l_orderkey, CAST(l_partkey AS VARCHAR) AS word, l_quantity AS weight FROM lineitem)"""

SQL["tag_vector_wide"] = f"""WITH {WIDE},
agg AS {_dim_sums('SELECT l_orderkey, word, weight FROM tok', 'l_orderkey', 'vec', 300)}
SELECT ids.l_orderkey, {_dims_summary('vec', 300)}
FROM (SELECT DISTINCT l_orderkey FROM tok) ids LEFT JOIN agg USING (l_orderkey)"""

SQL["content_vectors_wide"] = _C + f""",
{WIDE},
vrow AS (SELECT row_number() OVER () AS rid, content_id, tags, tags_title FROM crow),
ctok AS (
  SELECT rid, unnest(string_split(trim(tags), ' ')) AS tok, 'tags' AS part FROM vrow
  UNION ALL
  SELECT rid, unnest(string_split(trim(tags_title), ' ')) AS tok, 'title' AS part FROM vrow),
cw AS (SELECT rid, part, split_part(tok, '=', 1) AS word,
              coalesce(TRY_CAST(trim(split_part(tok, '=', 2)) AS DOUBLE), 1.0) AS weight FROM ctok),
ctags AS {_dim_sums("SELECT rid, word, weight FROM cw WHERE part = 'tags'", 'rid', 'tags', 300)},
ctitle AS {_dim_sums("SELECT rid, word, weight FROM cw WHERE part = 'title'", 'rid', 'title', 300)}
SELECT ids.content_id, {_dims_summary('tags', 300)}, {_dims_summary('title', 300)}
FROM (SELECT rid, content_id FROM vrow) ids
LEFT JOIN ctags USING (rid) LEFT JOIN ctitle USING (rid)"""

SQL["content_vectors"] = _C + f""",
{VOCAB},
vrow AS (SELECT row_number() OVER () AS rid, * FROM (
  SELECT content_id, tags, tags_title FROM crow
  UNION ALL SELECT content_id, tags || ' 7=2' AS tags, tags_title FROM crow WHERE content_id LIKE '%7'
  UNION ALL SELECT content_id, tags, tags_title FROM crow WHERE content_id LIKE '%3') x),
ctok AS (
  SELECT rid, unnest(string_split(trim(tags), ' ')) AS tok, 'tags' AS part FROM vrow
  UNION ALL
  SELECT rid, unnest(string_split(trim(tags_title), ' ')) AS tok, 'title' AS part FROM vrow),
cw AS (SELECT rid, part, split_part(tok, '=', 1) AS word,
              coalesce(TRY_CAST(trim(split_part(tok, '=', 2)) AS DOUBLE), 1.0) AS weight FROM ctok),
ctags AS {_dim_sums("SELECT rid, word, weight FROM cw WHERE part = 'tags'", 'rid', 'tags')},
ctitle AS {_dim_sums("SELECT rid, word, weight FROM cw WHERE part = 'title'", 'rid', 'title')}
SELECT ids.content_id, {_dims_summary('tags')}, {_dims_summary('title')}
FROM (SELECT rid, content_id FROM vrow) ids
LEFT JOIN ctags USING (rid) LEFT JOIN ctitle USING (rid)"""

SQL["category_vector"] = f"""WITH {VOCAB}, {_KW},
kwv AS (SELECT row_number() OVER () AS rid, * FROM (
  SELECT o_orderkey, keywords, title FROM kw
  UNION ALL SELECT o_orderkey, keywords, title || ' 9=3' AS title FROM kw WHERE o_orderkey % 10 = 7
  UNION ALL SELECT o_orderkey, keywords, title FROM kw WHERE o_orderkey % 10 = 3) x),
kwfmt AS (SELECT rid, o_orderkey, keywords, title,
                 title = '' AND regexp_full_match(split_part(keywords, ':', 1), '[0-9]*') AS is_kw FROM kwv),
segs AS (SELECT rid, trim(split_part(s, ':', 2)) AS tags FROM
           (SELECT rid, unnest(string_split(keywords, ';')) AS s FROM kwfmt WHERE is_kw) x
         WHERE s LIKE '%:%'),
texts AS (
  SELECT rid, tags AS txt FROM segs WHERE tags <> '-1'
  UNION ALL SELECT rid, keywords AS txt FROM kwfmt WHERE NOT is_kw
  UNION ALL SELECT rid, title AS txt FROM kwfmt),
toks AS (SELECT rid, unnest(string_split(trim(txt), ' ')) AS tok FROM texts),
tw AS (SELECT rid, split_part(tok, '=', 1) AS word,
              coalesce(TRY_CAST(trim(split_part(tok, '=', 2)) AS DOUBLE), 1.0) AS weight FROM toks),
agg AS {_dim_sums('SELECT rid, word, weight FROM tw', 'rid', 'vec')}
SELECT ids.o_orderkey, {_dims_summary('vec')}
FROM (SELECT rid, o_orderkey FROM kwv) ids LEFT JOIN agg USING (rid)"""

SQL["cosine_pairs"] = f"""WITH {VOCAB},
d AS (SELECT t.l_orderkey, i,
             sum(CASE WHEN t.l_returnflag = 'A' THEN t.weight * CAST(v.vec[i] AS DOUBLE) END) AS a,
             sum(CASE WHEN t.l_returnflag = 'R' THEN t.weight * CAST(v.vec[i] AS DOUBLE) END) AS b
      FROM tok t JOIN vocab v ON v.word = t.word, range(1, 65) r(i)
      GROUP BY t.l_orderkey, i),
s AS (SELECT l_orderkey, sum(coalesce(a, 0) * coalesce(b, 0)) AS dot,
             sqrt(sum(coalesce(a, 0) * coalesce(a, 0))) AS na, sqrt(sum(coalesce(b, 0) * coalesce(b, 0))) AS nb
      FROM d GROUP BY l_orderkey)
SELECT ids.l_orderkey,
       (round(CASE WHEN s.na * s.nb > 0 THEN s.dot / (s.na * s.nb) ELSE 0.0 END, 4) + 0.0) AS cosine
FROM (SELECT DISTINCT l_orderkey FROM tok) ids LEFT JOIN s USING (l_orderkey)"""
