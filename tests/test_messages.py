from datetime import datetime

import pytest

from parley.plans import messages, staging
from tests.handmade import by_sequence, chat, int_messages, message, ns, sources


def test_response_time_counts_minute_boundaries(spark):
    s = sources(spark, [
        message(1, "2024-01-01 00:00:59", sent=1),
        message(2, "2024-01-01 00:01:00"),
        message(3, "2024-01-01 00:05:00"),
        message(4, "2024-01-01 01:05:00", sent=1),
    ])
    rows = by_sequence(int_messages(s))
    assert [r.response_time_minutes for r in rows] == [None, 1, None, 60]
    assert [r.is_consecutive_message for r in rows] == [False, False, True, False]
    assert [r.is_conversation_starter for r in rows] == [True, False, False, False]


def test_equal_dates_follow_message_id(spark):
    at = "2024-01-01 00:00:00"
    s = sources(spark, [message(9, at), message(3, at), message(5, at, sent=1)])
    assert [r.message_id for r in by_sequence(int_messages(s))] == [3, 5, 9]


def test_filters(spark):
    at = "2024-01-01 00:00:00"
    s = sources(spark, [
        message(1, at, text=None),
        message(2, at, text=""),
        message(3, at, is_system_message=1),
        message(4, at, is_system_message=None),
        message(5, at, text=" "),
        message(6, at, chat=99),
    ])
    assert [r.message_id for r in int_messages(s).collect()] == [5]


def test_read_and_delivery_time(spark):
    at = datetime(2024, 1, 1, 12)
    s = sources(spark, [
        message(1, at, date_read=ns(datetime(2024, 1, 1, 11, 58)), date_delivered=ns(at)),
        message(2, at, sent=1, date_read=ns(at), date_delivered=ns(datetime(2024, 1, 1, 12, 0, 7))),
        message(3, at),
    ])
    rows = by_sequence(int_messages(s))
    assert [r.read_time_minutes for r in rows] == [-2, None, None]
    assert [r.delivery_time_seconds for r in rows] == [None, 7, None]
    assert rows[2].date_read is None


CHATS = [
    chat(1, "+15550000001"),
    chat(2, "someone@example.com"),
    chat(3, "chat15550000001", "Friends"),
    chat(4, "88888"),
    chat(5, "+445550000009", ""),
    chat(6, None),
]
RECORDS = [(1, "Ann", "Lee"), (2, "Bob", None), (3, None, None)]
PHONES = [(1, "(555) 000-0001", 0), (2, "15550000001", 0), (3, "88888", 0)]


def test_contact_match(spark):
    s = sources(
        spark,
        [message(i, "2024-01-01 00:00:00", chat=i) for i in range(1, 7)],
        CHATS, RECORDS, PHONES,
    )
    got = {
        (r.chat_id, r.first_name): (r.partner_display_name, r.contact_match_type, r.contact_priority)
        for r in int_messages(s).collect()
    }
    assert got == {
        (1, "Ann"): ("Ann Lee", "exact_match", 1),
        (1, "Bob"): ("Bob", "exact_match", 1),
        (2, None): ("someone@example.com", "email", None),
        (3, None): ("Friends", "unknown_number", None),
        (4, None): ("88888", "exact_match", 2),
        (5, None): ("+445550000009", "unknown_number", None),
        (6, None): (None, "unknown_number", None),
    }


def test_fan_out_repeats_messages_in_sequence(spark):
    s = sources(
        spark,
        [message(1, "2024-01-01 00:00:00", sent=1), message(2, "2024-01-01 00:10:00")],
        CHATS, RECORDS, PHONES,
    )
    rows = by_sequence(int_messages(s))
    assert [(r.message_id, r.first_name) for r in rows] == [(1, "Ann"), (1, "Bob"), (2, "Ann"), (2, "Bob")]
    assert [r.message_sequence for r in rows] == [1, 2, 3, 4]
    assert [r.response_time_minutes for r in rows] == [None, None, 10, None]
    assert [r.is_consecutive_message for r in rows] == [False, True, False, True]


def test_dedupe_keeps_the_best_contact(spark):
    named_last = [(1, None, None), (2, "Bob", None)]
    phones = [(1, "+15550000001", 0), (2, "5550000001", 0)]
    s = sources(spark, [message(1, "2024-01-01 00:00:00")], CHATS, named_last, phones)
    assert len(int_messages(s).collect()) == 2
    (row,) = int_messages(s, dedupe_contacts=True).collect()
    assert (row.first_name, row.message_sequence) == ("Bob", 1)


def test_message_in_two_chats(spark):
    m = message(1, "2024-01-01 00:00:00")
    s = sources(spark, [m], [chat(1), chat(2, "x@y")], links=[(1, 1, 0), (2, 1, 0)])
    assert sorted(r.chat_id for r in int_messages(s).collect()) == [1, 2]


@pytest.mark.parametrize("parts", [2, 9, 40])
def test_cut_chats_give_the_same_messages(spark, parts):
    many = [
        message(i, f"2024-01-{1 + i % 9:02d} 0{i % 7}:00:00" if i % 11 else None, sent=i * i % 3 % 2)
        for i in range(1, 150)
    ] + [message(1000 + i, "2024-03-01 00:00:00", chat=2) for i in range(5)]
    links = [(m["chat"], m["rowid"], m["date"] if m["rowid"] % 2 else 0) for m in many]
    s = sources(spark, many, CHATS, RECORDS, PHONES, links)
    whole = by_sequence(int_messages(s))
    assert by_sequence(int_messages(s, parts=parts)) == whole
    assert [r.message_sequence for r in whole if r.chat_id == 1] == list(range(1, 299))


def test_numbering_does_not_need_the_date_of_the_link(spark):
    many = [message(i, f"2024-01-{1 + i % 28:02d} 00:00:00") for i in range(400)]
    s = sources(spark, many, links=[(1, m["rowid"], 0) for m in many])
    numbered = messages.numbered_links(s.message, s.link, 9).collect()
    in_order = sorted(many, key=lambda m: (m["date"], m["rowid"]))
    assert {r.message_id: r.position for r in numbered} == {m["rowid"]: i for i, m in enumerate(in_order, 1)}


def test_context_looks_both_ways(spark):
    s = sources(spark, [message(i, f"2024-01-01 0{i}:00:00", sent=i % 2) for i in range(1, 4)])
    from parley.plans import contacts

    normalized = contacts.contacts_normalized(staging.stg_contacts(s.record, s.phone))
    rows = by_sequence(
        messages.message_context(s.message, s.link, staging.stg_chat(s.chat), normalized)
    )
    assert [r.prev_is_from_me for r in rows] == [None, True, False]
    assert [r.next_is_from_me for r in rows] == [False, True, None]
    assert rows[0].next_message_date == datetime(2024, 1, 1, 2)


def test_ordered_output(spark):
    s = sources(spark, [message(i, f"2024-01-01 0{9 - i}:00:00") for i in range(1, 6)])
    assert [r.message_id for r in int_messages(s, ordered=True).collect()] == [5, 4, 3, 2, 1]
