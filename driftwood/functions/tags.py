"""Tag text: JSON tag maps to ``word=weight`` text, and text to token arrays."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .ids import is_numeric

# The wrappers stripped from stored tag JSON, and the literal
# replacements that turn {"word":{"weight":w},...} into "word=w ...".
TAGS_PREFIX = '{"v8":{"'
TAGS_ALT_PREFIX = '{"v99":{"'
TITLE_PREFIX = '{"v4":{"'
TAG_REPLACEMENTS = [
    ('":{"weight":', "="),
    ('},"', " "),
    ("}}}", ""),
    (" =", "="),
]
KEYWORD_EMPTY = "-1"


def _replace(c: Column, search: str, repl: str) -> Column:
    return F.replace(c, F.lit(search), F.lit(repl))


def format_tags(js: Column, prefix: str = TAGS_PREFIX) -> Column:
    """Stored tag JSON -> ``word=weight`` text by literal replacements.
    Null input gives empty text."""
    out = _replace(F.coalesce(js, F.lit("")), prefix, "")
    for search, repl in TAG_REPLACEMENTS:
        out = _replace(out, search, repl)
    return out


def format_content_tags(js: Column) -> Column:
    """Body tags: the ``v8`` wrapper, and the ``v99`` one when present."""
    return _replace(format_tags(js, TAGS_PREFIX), TAGS_ALT_PREFIX, "")


def format_title_tags(js: Column) -> Column:
    """Title tags: the ``v4`` wrapper."""
    return format_tags(js, TITLE_PREFIX)


def parse_tags(s: Column) -> Column:
    """``"w1=0.4 w2 w3=1.5"`` -> ``ARRAY<STRUCT<word, weight>>``.

    Tokens are split on single spaces; a missing, blank or non-numeric weight
    is 1.0; blank words (which add nothing to a vector sum) are dropped.
    Null or blank text gives an empty array.
    """
    toks = F.split(F.trim(F.coalesce(s, F.lit(""))), " ", -1)

    def to_struct(t: Column) -> Column:
        parts = F.split(t, "=", -1)
        word = F.element_at(parts, 1)
        weight = F.coalesce(
            F.trim(F.try_element_at(parts, F.lit(2))).try_cast("double"), F.lit(1.0))
        return F.struct(word.alias("word"), weight.alias("weight"))

    parsed = F.transform(toks, to_struct)
    return F.filter(parsed, lambda x: F.trim(x["word"]) != "")


def parse_keywords(s: Column) -> Column:
    """``"817:-1;141:w=2.6 v=1.9"`` -> ``ARRAY<STRUCT<category, tags>>``
    (segments without ``:`` are dropped, tags are trimmed)."""
    segs = F.split(F.coalesce(s, F.lit("")), ";", -1)

    def to_struct(x: Column) -> Column:
        parts = F.split(x, ":", -1)
        return F.struct(F.element_at(parts, 1).alias("category"),
                        F.trim(F.try_element_at(parts, F.lit(2))).alias("tags"))

    return F.filter(F.transform(segs, to_struct), lambda c: c["tags"].isNotNull())


def is_keyword_format(s: Column, title: Column) -> Column:
    """Keyword text is recognised only when the title is empty and the piece
    before the first ``:`` is all digits."""
    return (F.coalesce(title, F.lit("")) == "") & is_numeric(
        F.element_at(F.split(F.coalesce(s, F.lit("")), ":", -1), 1))
