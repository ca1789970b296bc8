"""The contract of the message time series: 67 checks, as data."""

from collections.abc import Callable

from pyspark.sql import DataFrame

from parley.operators import quality
from parley.operators.quality import RowCheck, SetCheck

UNIQUE = ["message_id", "message_guid"]

NOT_NULL = [
    "message_id", "chat_id", "message_guid", "contact_name", "chat_identifier", "message_length",
    "is_from_me", "message_date", "message_hour", "message_date_day", "message_week",
    "message_month", "message_quarter", "message_year", "hour_of_day", "day_of_week",
    "day_of_month", "month_of_year", "year", "message_sequence", "daily_message_sequence",
    "cumulative_messages_in_conversation", "cumulative_sent_in_conversation",
    "cumulative_received_in_conversation", "service", "messages_last_10",
    "messages_per_day_to_date", "formatted_message", "temporal_context",
]

BOOLEAN = [True, False]
ACCEPTED_VALUES = {
    "contact_match_type": ["exact_match", "email", "short_code", "unknown_number"],
    "phone_type": ["us_number", "international", "us_local", "short_code", "other"],
    "message_length_category": ["very_short", "short", "medium", "long", "very_long"],
    "is_from_me": BOOLEAN,
    "message_direction": ["sent", "received"],
    "time_of_day": ["morning", "afternoon", "evening", "night"],
    "day_type": ["weekday", "weekend"],
    "day_name": [
        "Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday",
    ],
    "response_timing_category": [
        "conversation_start", "immediate_follow_up", "quick_response", "within_hour", "within_day",
        "delayed_response",
    ],
    "conversation_momentum": [
        "high_momentum", "medium_momentum", "low_momentum", "minimal_momentum",
    ],
    "is_conversation_starter": BOOLEAN,
    "is_consecutive_message": BOOLEAN,
    "is_part_of_streak": BOOLEAN,
    "is_session_start": BOOLEAN,
    "is_first_daily_message": BOOLEAN,
    "is_delivered": BOOLEAN,
    "is_read": BOOLEAN,
    "cache_has_attachments": BOOLEAN,
}

ACCEPTED_RANGE = {
    "message_length": (0, None),
    "hour_of_day": (0, 23),
    "day_of_week": (0, 6),
    "day_of_month": (1, 31),
    "month_of_year": (1, 12),
    "year": (2007, 2030),
    "message_sequence": (1, None),
    "daily_message_sequence": (1, None),
    "cumulative_messages_in_conversation": (1, None),
    "cumulative_sent_in_conversation": (0, None),
    "cumulative_received_in_conversation": (0, None),
    "messages_last_10": (1, 10),
    "messages_per_day_to_date": (0, None),
}

EXPRESSIONS = {
    "date_delivered IS NULL OR date_delivered >= message_date": "warn",
    "date_read IS NULL OR date_read >= message_date": "warn",
    "cumulative_sent_in_conversation + cumulative_received_in_conversation"
    " = cumulative_messages_in_conversation": "error",
    "response_time_minutes IS NULL OR response_time_minutes <= 10080": "warn",
}

SEQUENTIAL = ("message_sequence", ["chat_id"])


#: What the set checks read of a written mart.
SET_CHECK_COLUMNS = [*UNIQUE, SEQUENTIAL[0], *SEQUENTIAL[1]]


def row_checks() -> list[RowCheck]:
    return [
        *[RowCheck("not_null", c, quality.is_null(c)) for c in NOT_NULL],
        *[
            RowCheck("accepted_values", c, quality.not_accepted(c, values))
            for c, values in ACCEPTED_VALUES.items()
        ],
        *[
            RowCheck("accepted_range", c, quality.out_of_range(c, lo, hi))
            for c, (lo, hi) in ACCEPTED_RANGE.items()
        ],
        *[
            RowCheck("expression_is_true", e, quality.is_false(e), severity)
            for e, severity in EXPRESSIONS.items()
        ],
    ]


def set_checks(mart: DataFrame) -> list[SetCheck]:
    column, by = SEQUENTIAL
    return [
        *[SetCheck("unique", c, quality.unique(mart, c)) for c in UNIQUE],
        SetCheck("sequential_values", column, quality.sequential_values(mart, column, by)),
    ]


def timeseries_report(mart: DataFrame) -> DataFrame:
    """Run the contract on a written mart: one pass over its rows, and three over one or two columns."""
    return quality.report(mart, row_checks(), set_checks(mart))


def written_with_report(mart: DataFrame, write: Callable[[DataFrame], DataFrame]) -> tuple[DataFrame, DataFrame]:
    """Write the mart and run the contract in the same pass; ``write`` returns the written table, or at least its
    SET_CHECK_COLUMNS. The mart's wide rows are made once and never read for the contract."""
    return quality.checked_while_written(mart, row_checks(), write, set_checks)
