"""Staging models over the source tables."""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parley.functions import decoders
from parley.sources import schemas

# The chat columns that the staging model reads.
CHAT_COLUMNS = [
    "guid", "style", "state", "account_id", "properties", "chat_identifier", "service_name",
    "room_name", "account_login", "is_archived", "last_addressed_handle", "display_name", "group_id",
    "is_filtered", "successful_query", "engram_id", "server_change_token", "ck_sync_state",
    "original_group_id", "last_read_message_timestamp", "cloudkit_record_id",
    "last_addressed_sim_id", "is_blackholed", "syndication_date", "syndication_type",
    "is_recovered", "is_deleting_incoming_messages",
]


def stg_message(message: DataFrame) -> DataFrame:
    return message


def stg_chat(chat: DataFrame) -> DataFrame:
    return chat.select(F.col("rowid").alias("row_id"), *CHAT_COLUMNS)


def stg_chat_message_join(link: DataFrame) -> DataFrame:
    return link.select(*schemas.required(schemas.CHAT_MESSAGE_JOIN))


def stg_attributed_body(cleaned: DataFrame) -> DataFrame:
    return cleaned.select(F.col("rowid").alias("row_id"), "guid", "text", "attributed_body")


def with_backfilled_text(
    message: DataFrame, decode_fn: Callable[[Column], Column] = decoders.utf8
) -> DataFrame:
    """Messages, all columns, with the text of the rich body where the plain text is null."""
    return message.withColumn("text", F.coalesce("text", decode_fn(F.col("attributedbody"))))


def undecoded(message: DataFrame, decode_fn: Callable[[Column], Column] = decoders.utf8) -> DataFrame:
    """One row: how many messages have a body that was needed and gave no text."""
    body = F.col("attributedbody")
    lost = F.col("text").isNull() & (F.octet_length(body) > 0) & decode_fn(body).isNull()
    return message.agg(F.count_if(lost).alias("undecoded_messages"))


def text_backfill(
    message: DataFrame, decode_fn: Callable[[Column], Column] = decoders.utf8
) -> DataFrame:
    """Message texts, taken from the rich body where the plain text is null."""
    return with_backfilled_text(message, decode_fn).select(
        "rowid", "guid", "text", F.col("attributedbody").alias("attributed_body")
    )


def stg_contacts(record: DataFrame, phone: DataFrame, ordered: bool = False) -> DataFrame:
    """Distinct (first name, last name, number); contacts without a phone keep a null number.

    A left join could not be split at runtime on its right side, so a contact that owns a large part
    of all phones would land in one task. The inner join can be split on either side, and the
    contacts without any phone come from an anti join against one row per owner. With ``ordered``
    the rows are sorted by name and by the lowest position the number has in its contact.
    """
    names = record.select(
        "z_pk", F.col("zfirstname").alias("first_name"), F.col("zlastname").alias("last_name")
    )
    numbers = phone.groupBy("zowner", F.col("zfullnumber").alias("full_number")).agg(
        F.min("zorderingindex").alias("position")
    )
    owners = phone.select("zowner").distinct()
    with_phone = names.join(numbers, names.z_pk == numbers.zowner)
    without_phone = names.join(owners, names.z_pk == owners.zowner, "left_anti").select(
        "*", F.lit(None).cast("string").alias("full_number"), F.lit(None).cast("int").alias("position")
    )
    columns = ["first_name", "last_name", "full_number"]
    contacts = (
        with_phone.select(*columns, "position")
        .union(without_phone.select(*columns, "position"))
        .groupBy(*columns)
        .agg(F.min("position").alias("position"))
    )
    if ordered:
        contacts = contacts.orderBy(*map(F.asc_nulls_last, ["last_name", "first_name", "position"]))
    return contacts.select(*columns)
