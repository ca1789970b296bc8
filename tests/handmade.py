"""Small source tables, row by row."""

from datetime import datetime

from fixtures.views import Sources
from parley.sources import schemas
from parley.sources.tables import conform

STORE_EPOCH = datetime(2001, 1, 1)


def ns(moment: datetime | str | None) -> int | None:
    if moment is None:
        return None
    if isinstance(moment, str):
        moment = datetime.fromisoformat(moment)
    delta = moment - STORE_EPOCH
    return (delta.days * 86_400_000_000 + delta.seconds * 1_000_000 + delta.microseconds) * 1000


def message(rowid, at, sent=0, text="hello", chat=1, **other):
    """A message and the chat it is in."""
    row = {
        "rowid": rowid, "guid": f"g{rowid}", "text": text, "attributedbody": None, "date": ns(at),
        "date_read": 0, "date_delivered": 0, "is_from_me": sent, "is_system_message": 0,
        "cache_has_attachments": 0, "is_read": 0, "is_delivered": 0, "service": "iMessage", "type": 0,
        "thread_originator_guid": None, "reply_to_guid": None, "handle_id": None, "is_sent": None,
        "is_service_message": None, "associated_message_guid": None, "associated_message_type": None,
        "chat": chat, **other,
    }
    return row


def chat(rowid, identifier="+15550000001", display_name=None):
    return (rowid, f"c{rowid}", identifier, "iMessage", display_name)


def sources(spark, messages, chats=(chat(1),), records=(), phones=(), links=None):
    message_ddl = ", ".join(schemas.DECLARED[schemas.MESSAGE])
    columns = [*schemas.required(schemas.MESSAGE), *schemas.optional(schemas.MESSAGE)]
    rows = [tuple(m[name] for name in columns) for m in messages]
    if links is None:
        links = [(m["chat"], m["rowid"], m["date"]) for m in messages]

    def table(name, data, ddl=None):
        return conform(spark.createDataFrame(list(data), ddl or schemas.DECLARED[name][0]), name)

    return Sources(
        message=table(schemas.MESSAGE, rows, message_ddl),
        link=table(schemas.CHAT_MESSAGE_JOIN, links),
        chat=table(schemas.CHAT, chats),
        record=table(schemas.CONTACT_RECORD, records),
        phone=table(schemas.CONTACT_PHONE, phones),
    )


def int_messages(s, **options):
    from parley.plans import contacts, messages, staging

    return messages.int_messages(
        s.message,
        staging.stg_chat_message_join(s.link),
        staging.stg_chat(s.chat),
        contacts.contacts_normalized(staging.stg_contacts(s.record, s.phone)),
        **options,
    )


def by_sequence(df):
    return df.orderBy("chat_id", "message_sequence").collect()
