"""Declared schemas.

The source format fixes fields by position in comma-joined text; here every
layout is an explicit ``StructType`` so that readers never infer a schema and
so that Catalyst can prune nested fields.
"""

from __future__ import annotations

from pyspark.sql import types as T

S = T.StringType()


def _struct(*names: str, overrides: dict | None = None) -> T.StructType:
    overrides = overrides or {}
    return T.StructType([T.StructField(n, overrides.get(n, S), True) for n in names])


# Top-level scalar log fields, in the order the training row
# writes them (columns 1-17 of the 39-column row).
TOP_FIELDS = [
    "p1", "p3", "p5", "p6", "p7", "p9", "p10", "p11", "p13",
    "p14", "p17", "p20", "p21", "p22", "p23", "p24", "p25",
]
# Nested objects and their fields, in output order.
P30_FIELDS = ["p31", "p32", "p33", "e11"]
ITEM_FIELDS = ["e12", "e14", "e15"]
O2_FIELDS = ["e30", "e31", "e35", "e36", "e37", "e38"]
E37_FIELDS = ["l1", "l2"]
E2_FIELDS = ["e3", "e4", "e5", "e6", "e7", "e8", "e9", "e39"]

# Every leaf is STRING: a STRING leaf accepts both 7 and "7", while an INT
# leaf would turn "7" into null.  Numeric tests use try_cast afterwards.
E37_SCHEMA = _struct(*E37_FIELDS)
O2_SCHEMA = _struct(*O2_FIELDS, overrides={"e37": E37_SCHEMA})
ITEM_SCHEMA = T.StructType(
    [T.StructField(n, S, True) for n in ITEM_FIELDS]
    + [T.StructField("o2", O2_SCHEMA, True)]
)

LOG_SCHEMA = T.StructType(
    [T.StructField(n, S, True) for n in TOP_FIELDS]
    + [
        T.StructField("p30", _struct(*P30_FIELDS), True),
        T.StructField("e11", S, True),
        T.StructField("e2", _struct(*E2_FIELDS), True),
        T.StructField("e23", ITEM_SCHEMA, True),
        T.StructField("e24", ITEM_SCHEMA, True),
    ]
)

# What the strategy test and the pairing need of a line: parsed before the
# shuffle; the whole record is parsed for the surviving lines only.
_KEY_ITEM = T.StructType([T.StructField("e15", S, True), T.StructField("o2", _struct("e30"), True)])
PAIR_SCHEMA = T.StructType([T.StructField(n, S, True) for n in ("p1", "p3", "p17")]
                           + [T.StructField(n, _KEY_ITEM, True) for n in ("e23", "e24")])
# Which keys an object has, null or not: for the text rendering.
KEYS_SCHEMA = T.StructType([T.StructField("e11", S, True)]
                           + [T.StructField(n, T.MapType(S, S), True) for n in ("p30", "e2", "e23", "e24")])

IMPRESSION_KEY = "e23"
CLICK_KEY = "e24"

# Column names of the 39-column training row.  Index 24 is the
# content id.
TRAINING_COLUMNS = (
    ["is_click"]
    + TOP_FIELDS
    + ["p31", "p32", "p33", "e11"]
    + ["e12", "e14", "content_id"]
    + ["e31", "e35", "e36", "l1", "l2", "e38"]
    + ["e3", "e4", "e5", "e6", "e7", "e8", "e9", "e39"]
)
assert len(TRAINING_COLUMNS) == 39 and TRAINING_COLUMNS[24] == "content_id"

TRAINING_SCHEMA = T.StructType(
    [T.StructField("is_click", T.IntegerType(), True)]
    + [T.StructField(n, S, True) for n in TRAINING_COLUMNS[1:]]
)
#: With the folders they are saved in; a new StructType: ``add`` would modify TRAINING_SCHEMA in place.
DAY_SCHEMA = T.StructType(TRAINING_SCHEMA.fields + [T.StructField("month", S), T.StructField("day", S)])
DAY_TEXT_SCHEMA = T.StructType([T.StructField(n, S) for n in ("value", "month", "day")])

# The 14-column content row.
CONTENT_COLUMNS = [
    "content_id", "body_images_count", "image_auditstate", "publisher_score",
    "publish_time", "content_words_num", "title_words_num", "country", "city",
    "state", "ero_cal_result", "group_key", "tags", "tags_title",
]

# Source tables of the content lookup and the columns each contributes.
T_CONTENT_COLUMNS = [
    "content_id", "body_images_count", "image_auditstate", "publisher_score",
    "publish_time", "content_type",
]
T_SIGNAL_COLUMNS = [
    "content_id", "content_words_num", "title_words_num", "local", "group_id",
    "tags", "tags_title",
]
T_NEWS_COLUMNS = ["content_id", "ero_cal_result"]
