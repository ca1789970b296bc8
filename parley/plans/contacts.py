"""Contacts, and their match to chats."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parley.functions.phones import (
    digits,
    is_email,
    is_group_identifier,
    phone_type,
    without_country_code,
    without_us_prefix,
)
from parley.functions.rules import first_match
from parley.functions.texts import char_count, not_blank

SHORTEST_NUMBER = 4
FULL_NUMBER_LENGTH = 10


def contacts_normalized(contacts: DataFrame) -> DataFrame:
    """Contacts with a usable number, in a form that can be matched to chats."""
    first, last, number = F.col("first_name"), F.col("last_name"), F.col("full_number")
    named = first.isNotNull() | last.isNotNull()
    return (
        contacts.filter(not_blank(number))
        .withColumn("clean_digits", digits(number))
        .filter(F.length("clean_digits") >= SHORTEST_NUMBER)
        .select(
            first,
            last,
            number,
            "clean_digits",
            without_us_prefix(F.col("clean_digits")).alias("normalized_number"),
            F.when(named, F.concat_ws(" ", first, last)).alias("contact_display_name"),
            phone_type(number).alias("phone_type"),
            char_count(F.col("clean_digits")).alias("digit_count"),
            F.when(named, 1).otherwise(2).alias("contact_priority"),
        )
    )


def chat_identity(chat: DataFrame) -> DataFrame:
    """What the identifier of a chat says about the other party; one row per chat."""
    identifier = F.col("chat_identifier")
    return chat.select(
        F.col("row_id").alias("chat_id"),
        identifier,
        "display_name",
        digits(identifier).alias("chat_clean_digits"),
    ).select(
        "*",
        without_us_prefix(F.col("chat_clean_digits")).alias("chat_normalized_number"),
        without_country_code(identifier).alias("conversation_partner"),
    )


def chat_contacts(identity: DataFrame, contacts: DataFrame, dedupe_contacts: bool = False) -> DataFrame:
    """Chats with their matching contacts: one row per (chat, contact), or one without contact.

    The match depends on the chat alone, so it is settled here, between two dimension tables, and
    never on messages. ``contact_rank`` counts the ``contact_count`` contacts of a chat from 1; with
    ``dedupe_contacts`` only the contact of the best priority stays. Contacts are ranked once for each
    number, not for each chat that has it. E-mail and group chats and identifiers with fewer digits than any
    contact number never enter the match, where they would all meet in one task; matched and unmatched
    chats are an inner and an anti join, which can both be split at runtime.
    """
    identifier, number = F.col("chat_identifier"), F.col("chat_normalized_number")
    can_match = (
        ~is_email(identifier) & ~is_group_identifier(identifier) & (F.length(number) >= SHORTEST_NUMBER)
    )
    can_match = F.coalesce(can_match, F.lit(False))

    tie_break = [F.asc_nulls_last(c) for c in ("contact_phone_number", "first_name", "last_name")]
    of_number = Window.partitionBy("normalized_number")
    ranked = contacts.withColumnRenamed("full_number", "contact_phone_number")
    if dedupe_contacts:
        best_first = of_number.orderBy("contact_priority", *tie_break)
        ranked = (
            ranked.withColumn("contact_rank", F.row_number().over(best_first))
            .filter("contact_rank = 1")
            .withColumn("contact_count", F.lit(1).cast("bigint"))
        )
    else:
        ranked = ranked.withColumn(
            "contact_rank", F.row_number().over(of_number.orderBy(*tie_break))
        ).withColumn("contact_count", F.count("*").over(of_number))
    ranked = ranked.select(
        "normalized_number",
        "first_name",
        "last_name",
        "contact_display_name",
        "contact_phone_number",
        "phone_type",
        "contact_priority",
        F.col("contact_rank").cast("bigint"),
        "contact_count",
    )
    numbers = contacts.select("normalized_number").distinct()
    same = F.col("chat_normalized_number") == F.col("normalized_number")
    matchable = identity.filter(can_match)
    matched = matchable.join(ranked, same).drop("normalized_number")
    alone = matchable.join(numbers, same, "left_anti").unionByName(identity.filter(~can_match))
    directory = matched.unionByName(alone, allowMissingColumns=True)
    group_name = F.col("display_name")
    return (
        directory.withColumn(
            "partner_display_name",
            F.coalesce(F.when(not_blank(group_name), group_name), "contact_display_name", identifier),
        )
        .withColumn(
            "contact_match_type",
            first_match(
                [
                    (F.col("contact_rank").isNotNull(), F.lit("exact_match")),
                    (is_email(identifier), F.lit("email")),
                    (F.length("chat_clean_digits") < FULL_NUMBER_LENGTH, F.lit("short_code")),
                ],
                F.lit("unknown_number"),
            ),
        )
        .fillna({"contact_rank": 1, "contact_count": 1})
    )
