from datetime import date

import pytest

from parley.functions import decoders
from parley.plans import rebuild
from parley.sources import schemas
from tests.handmade import chat, message, sources


@pytest.fixture
def landed(spark, tmp_path):
    s = sources(
        spark,
        [message(i, f"2024-01-0{i % 9 + 1} 00:00:00", sent=i % 2) for i in range(1, 40)],
        [chat(1)], [(1, "Ann", None)], [(1, "5550000001", 0)],
    )
    tables = {
        schemas.MESSAGE: s.message, schemas.CHAT_MESSAGE_JOIN: s.link, schemas.CHAT: s.chat,
        schemas.CONTACT_RECORD: s.record, schemas.CONTACT_PHONE: s.phone,
    }
    for name, df in tables.items():
        df.write.parquet(str(tmp_path / "source" / name))
    return tmp_path


def test_rebuild_writes_all_models_and_can_run_again(spark, landed):
    for first_name, rows in [("Ann", 39), ("Bek", 0)]:
        models = rebuild.rebuild(
            spark, str(landed / "source"), str(landed / "models"), date(2024, 2, 2), first_name
        )
        assert models["mart_message_timeseries"].count() == rows
    assert {name: len(df.columns) for name, df in models.items()} == {
        "attributed_body_cleaned": 4, "stg_attributed_body": 4, "stg_contacts": 3,
        "int_contacts_normalized": 9, "int_messages": 30, "mart_conversations": 49,
        "mart_message_timeseries": 59, "stg_chat": 28, "int_chat": 28, "undecoded_messages": 1,
        "int_conversations": 10, "int_message_threads": 5, "contract_report": 5,
    }
    (row,) = models["mart_conversations"].collect()
    assert (row.total_messages, row.partner_display_name) == (39, "Ann")


def test_large_chats_from_files(spark, landed):
    """Cuts, edges and rows all start from the same files here, unlike with rows made in memory."""
    from parley.plans import contacts, messages, staging
    from parley.sources.tables import read_table

    source = {n: read_table(spark, str(landed / "source" / n), n) for n in schemas.DECLARED if n != schemas.ATTRIBUTED_BODY}
    normalized = contacts.contacts_normalized(
        staging.stg_contacts(source[schemas.CONTACT_RECORD], source[schemas.CONTACT_PHONE])
    )

    def built(parts):
        return messages.int_messages(
            source[schemas.MESSAGE], source[schemas.CHAT_MESSAGE_JOIN],
            staging.stg_chat(source[schemas.CHAT]), normalized, parts=parts,
        ).orderBy("message_sequence").collect()

    assert built(12) == built(1)


def test_rich_bodies_reach_the_models(spark, tmp_path):
    rows = [
        message(1, "2024-01-01 00:00:00"),
        message(2, "2024-01-01 00:01:00", text=None, attributedbody=bytearray("höre".encode())),
        message(3, "2024-01-01 00:02:00", text=None, attributedbody=bytearray(b"\x04\x0bstream\xff\xfe")),
        message(4, "2024-01-01 00:03:00", text=None, attributedbody=bytearray()),
    ]
    s = sources(spark, rows, [chat(1)], [(1, "Bek", None)], [(1, "5550000001", 0)])
    tables = {
        schemas.MESSAGE: s.message, schemas.CHAT_MESSAGE_JOIN: s.link, schemas.CHAT: s.chat,
        schemas.CONTACT_RECORD: s.record, schemas.CONTACT_PHONE: s.phone,
    }
    for name, df in tables.items():
        df.write.parquet(str(tmp_path / "source" / name))

    def built(decode_fn):
        return rebuild.rebuild(spark, str(tmp_path / "source"), str(tmp_path / "models"), date(2024, 2, 2), decode_fn=decode_fn)

    assert [r.message_text for r in built(None)["int_messages"].collect()] == ["hello"]
    models = built(decoders.utf8)
    assert sorted(r.message_text for r in models["int_messages"].collect()) == ["hello", "höre"]
    assert models["undecoded_messages"].first()[0] == 1
    assert models["mart_message_timeseries"].count() == 2
