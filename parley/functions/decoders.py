"""Decoders for rich message bodies: ``Column -> Column`` functions for ``text_backfill``."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def utf8(body: Column) -> Column:
    """The whole blob as UTF-8; null for an empty blob and for bytes that are no UTF-8 text."""
    return F.when(F.octet_length(body) > 0, F.try_validate_utf8(body.cast("string")))
