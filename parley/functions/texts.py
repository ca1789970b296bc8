"""Strings."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def concat_nulls_empty(*parts: Column | str) -> Column:
    """Concatenation that reads null as the empty string; plain strings are literals."""
    return F.concat_ws("", *[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def ellipsize(text: Column, limit: int) -> Column:
    """The first ``limit`` characters, with ``...`` where something was cut; null stays null.

    Compares bytes, which are at hand, so long texts are not counted to their end.
    """
    head = F.left(text, F.lit(limit))
    was_cut = F.octet_length(head) < F.octet_length(text)
    return F.when(was_cut, F.concat(head, F.lit("..."))).otherwise(text)


def char_count(text: Column) -> Column:
    return F.length(text).cast("bigint")


def not_blank(text: Column) -> Column:
    """True where the text has a character other than a space."""
    return F.trim(text) != ""
