from datetime import datetime, timedelta

import pytest

from parley.plans import timeseries
from parley.session import cut_lineage
from tests.handmade import by_sequence, chat, int_messages, message, sources


def table(spark, messages, **options):
    return cut_lineage(int_messages(sources(spark, messages, **options)))


@pytest.fixture(scope="module")
def busy(spark):
    """A chat with bursts, long days, equal dates, a fan-out of two and messages without a date."""
    start = datetime(2024, 1, 1, 20)
    at = [start + timedelta(minutes=m) for m in (0, 1, 3, 40, 41, 41, 41, 300)]
    at += [start + timedelta(hours=3 + h) for h in range(0, 90, 3)]
    at += [start + timedelta(days=9, minutes=i // 4) for i in range(60)]
    messages = [message(i, t, sent=i % 5 // 3, text="x" * (i * 7 % 600 + 1)) for i, t in enumerate(at)]
    messages += [message(900 + i, None, sent=i % 2) for i in range(3)]
    messages += [message(1000 + i, start, chat=2) for i in range(4)]
    return table(
        spark, messages, chats=[chat(1), chat(2, "a@b")],
        records=[(1, "Ann", "Lee"), (2, "Bob", None)],
        phones=[(1, "5550000001", 0), (2, "+15550000001", 0)],
    )


@pytest.mark.parametrize("rows_per_segment", [6, 25, 64])
def test_cut_chats_give_the_same_series(busy, rows_per_segment):
    whole = by_sequence(timeseries.mart_message_timeseries(busy))
    assert len(whole) == busy.count() == 206
    cut = timeseries.mart_message_timeseries(busy, rows_per_segment=rows_per_segment)
    assert by_sequence(cut) == whole


@pytest.mark.parametrize("rows_per_segment", [6, 2_000_000])
def test_first_name_filter_comes_after_the_windows(busy, rows_per_segment):
    whole = [r for r in by_sequence(timeseries.mart_message_timeseries(busy)) if r.first_name == "Bob"]
    named = timeseries.mart_message_timeseries(
        busy, first_name="Bob", rows_per_segment=rows_per_segment
    )
    assert by_sequence(named) == whole != []


def test_ordered_newest_first(busy):
    dates = [r.message_date for r in timeseries.mart_message_timeseries(busy, ordered=True).collect()]
    known = [d for d in dates if d is not None]
    assert known == sorted(known, reverse=True)
    assert dates[len(known):] == [None] * (len(dates) - len(known))


def test_figures(spark):
    rows = by_sequence(
        timeseries.mart_message_timeseries(
            table(spark, [
                message(1, "2024-01-01 23:58:00", sent=1, text="a" * 10),
                message(2, "2024-01-01 23:59:00", sent=1, text="b" * 201),
                message(3, "2024-01-02 00:29:00", text="c" * 51),
                message(4, "2024-01-02 01:00:00", text="d" * 501),
            ])
        )
    )
    column = lambda name: [r[name] for r in rows]
    assert column("daily_message_sequence") == [1, 2, 1, 2]
    assert column("cumulative_sent_in_conversation") == [1, 2, 2, 2]
    assert column("cumulative_received_in_conversation") == [0, 0, 1, 2]
    assert column("minutes_since_prev_message") == [None, 1, 30, 31]
    assert column("minutes_until_next_message") == [1, 30, 31, None]
    assert column("response_timing_category") == [
        "conversation_start", "immediate_follow_up", "within_hour", "within_hour",
    ]
    assert column("is_session_start") == [True, False, False, True]
    assert column("is_part_of_streak") == [False, True, False, True]
    assert column("conversation_momentum") == [
        "minimal_momentum", "low_momentum", "low_momentum", "medium_momentum",
    ]
    assert column("message_length_category") == ["very_short", "long", "medium", "very_long"]
    assert column("avg_length_last_5_messages") == [10.0, 105.5, 262 / 3, 763 / 4]
    assert column("messages_per_day_to_date") == [1.0, 2.0, 1.5, 2.0]
    assert rows[0].formatted_message == "Me at 2024-01-01 23:58 (night, Monday): " + "a" * 10
    assert rows[1].formatted_message.endswith("): " + "b" * 200 + "...")
    assert rows[2].temporal_context == (
        "Message 3 in conversation with +15550000001. Sent on Tuesday at night (30 min response time)"
    )
    assert rows[3].temporal_context.endswith("at night")


def test_gap_is_a_parameter(spark):
    messages = [message(1, "2024-01-01 00:00:00"), message(2, "2024-01-01 00:10:00")]
    rows = by_sequence(timeseries.mart_message_timeseries(table(spark, messages), gap_minutes=5))
    assert [r.is_session_start for r in rows] == [True, True]


def test_unknown_partner_drops_out(spark):
    messages = [message(1, "2024-01-01 00:00:00"), message(2, "2024-01-01 00:00:00", chat=2)]
    mart = timeseries.mart_message_timeseries(
        table(spark, messages, chats=[chat(1), chat(2, None, " ")])
    )
    assert [r.chat_id for r in mart.collect()] == [1]


def test_class_edges(spark):
    gaps = [2, 3, 15, 16, 60, 61, 1440, 1441, 1, 1]
    lengths = [10, 11, 50, 51, 200, 201, 500, 501, 1, 1, 1]
    at = datetime(2024, 1, 1)
    messages = []
    for i, length in enumerate(lengths):
        messages.append(message(i, at, text="x" * length))
        at += timedelta(minutes=gaps[i] if i < len(gaps) else 0)
    rows = by_sequence(timeseries.mart_message_timeseries(table(spark, messages)))
    assert [r.response_timing_category for r in rows] == [
        "conversation_start", "immediate_follow_up", "quick_response", "quick_response",
        "within_hour", "within_hour", "within_day", "within_day", "delayed_response",
        "immediate_follow_up", "immediate_follow_up",
    ]
    assert [r.message_length_category for r in rows[:8]] == [
        "very_short", "short", "short", "medium", "medium", "long", "long", "very_long",
    ]
    momentum = ["minimal_momentum"] + ["low_momentum"] * 2 + ["medium_momentum"] * 4 + ["high_momentum"] * 4
    assert [r.conversation_momentum for r in rows] == momentum
    assert [r.messages_last_10 for r in rows] == [1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 10]
