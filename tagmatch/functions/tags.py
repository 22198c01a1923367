"""Column expressions for item tags."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def normalize_tag(tag: Column) -> Column:
    """One blank for each run of white space, no blanks at the ends, lower case."""
    return F.lower(F.trim(F.regexp_replace(tag, r"\s+", " ")))


def normalize_tags(tags: Column) -> Column:
    return F.transform(tags, normalize_tag)


def tag_words(tags: Column) -> Column:
    """Words of a tag list. A comma ends a word, also inside a tag; NULL tags are
    skipped, empty words are kept, and words are not trimmed again."""
    return F.split(F.concat_ws(",", normalize_tags(tags)), ",")


def has_tags(tags: Column) -> Column:
    return F.size(tags) > 0
