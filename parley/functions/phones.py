"""Phone numbers and chat identifiers."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from parley.functions.rules import first_match


def digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def without_us_prefix(number: Column) -> Column:
    """Drop the leading 1 of an eleven-digit number."""
    is_us = number.startswith("1") & (F.length(number) == 11)
    return F.when(is_us, F.substring(number, 2, 10)).otherwise(number)


def normalize_us(text: Column) -> Column:
    return without_us_prefix(digits(text))


def phone_type(number: Column) -> Column:
    # \A and \z, because $ would also match in front of a final newline.
    return first_match(
        [
            (number.startswith("+1"), F.lit("us_number")),
            (number.startswith("+"), F.lit("international")),
            (number.rlike(r"\A[0-9]{10}\z"), F.lit("us_local")),
            (number.rlike(r"\A[0-9]{4,6}\z"), F.lit("short_code")),
        ],
        F.lit("other"),
    )


def is_email(identifier: Column) -> Column:
    return identifier.contains("@")


def is_group_identifier(identifier: Column) -> Column:
    return identifier.startswith("chat")


def without_country_code(identifier: Column) -> Column:
    """Strip ``+1`` in front of a chat identifier."""
    return F.when(identifier.startswith("+1"), F.substr(identifier, F.lit(3))).otherwise(identifier)
