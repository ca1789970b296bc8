"""Full rebuild of every model table, in dependency order."""

from collections.abc import Callable
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession

from parley.functions import decoders
from parley.plans import contacts, contract, conversations, messages, staging, threads, timeseries
from parley.sources import schemas
from parley.sources.tables import conform, read_table, write_table


def rebuild(
    spark: SparkSession,
    source_dir: str,
    model_dir: str,
    as_of: date,
    first_name: str | None = None,
    decode_fn: Callable[[Column], Column] | None = None,
) -> dict[str, DataFrame]:
    """Read the landed source tables, replace all model tables and return them.

    Each model reads the written tables it builds on, so no join or window runs twice. With ``decode_fn`` messages
    without plain text have the text of their rich body in every model; ``undecoded_messages`` then counts the bodies
    that gave none.
    """
    source = {
        name: read_table(spark, f"{source_dir}/{name}", name)
        for name in (
            schemas.MESSAGE,
            schemas.CHAT_MESSAGE_JOIN,
            schemas.CHAT,
            schemas.CONTACT_RECORD,
            schemas.CONTACT_PHONE,
        )
    }
    models: dict[str, DataFrame] = {}

    def model(name: str, df: DataFrame) -> DataFrame:
        path = f"{model_dir}/{name}"
        write_table(df, path)
        models[name] = spark.read.schema(df.schema).parquet(path)
        return models[name]

    message = source[schemas.MESSAGE]
    cleaned = model(schemas.ATTRIBUTED_BODY, staging.text_backfill(message, decode_fn or decoders.utf8))
    model("undecoded_messages", staging.undecoded(message, decode_fn or decoders.utf8))
    model("stg_attributed_body", staging.stg_attributed_body(conform(cleaned, schemas.ATTRIBUTED_BODY)))
    stg_contacts = model(
        "stg_contacts",
        staging.stg_contacts(source[schemas.CONTACT_RECORD], source[schemas.CONTACT_PHONE]),
    )
    normalized = model("int_contacts_normalized", contacts.contacts_normalized(stg_contacts))
    link = staging.stg_chat_message_join(source[schemas.CHAT_MESSAGE_JOIN])
    chat = model("stg_chat", staging.stg_chat(source[schemas.CHAT]))
    model("int_chat", chat)

    def int_messages_of(**options) -> DataFrame:
        return messages.int_messages(staging.stg_message(message), link, chat, normalized, decode_fn=decode_fn, **options)

    int_messages = messages.written_messages(int_messages_of(), f"{model_dir}/int_messages")
    models["int_messages"] = int_messages.select(messages.MESSAGE_COLUMNS)
    model("int_conversations", conversations.int_conversations(int_messages_of(dedupe_contacts=True)))
    model("int_message_threads", threads.message_threads(staging.stg_message(message)))
    model("mart_conversations", conversations.mart_conversations(int_messages, as_of))
    series = timeseries.mart_message_timeseries(int_messages, first_name)
    _, report = contract.written_with_report(series, lambda rows: model("mart_message_timeseries", rows))
    model("contract_report", report)
    return models
