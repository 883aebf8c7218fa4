"""Id lists and id prefixes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def stripped(text: Column) -> Column:
    """Without leading and trailing white space of any kind."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def parse_id_list(text: Column) -> Column:
    """Split on commas, strip, drop empties; null is the empty list."""
    return F.filter(F.transform(F.split(F.coalesce(text, F.lit("")), ","), stripped), lambda x: x != "")


def format_id_list(ids: Column) -> Column:
    """Comma list without repeats, in first-seen order."""
    return F.array_join(F.array_distinct(ids), ",")


def source_of(entity_id: Column) -> Column:
    """The part before the first hyphen."""
    return F.substring_index(entity_id, "-", 1)
