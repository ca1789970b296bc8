"""The message time series: every message with time dimensions, running figures and text lines."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parley.functions.moments import (
    days_between,
    minutes_between,
    time_classes,
    time_dims,
    truncated,
)
from parley.functions.rules import at_least, holds, up_to
from parley.functions.texts import concat_nulls_empty, ellipsize
from parley.operators.segments import ROWS_PER_SEGMENT, with_halo
from parley.plans.messages import POSITION, resolved, with_length

# Thresholds and labels of the classes.
SESSION_GAP_MINUTES = 30
GAP_CLASSES = [
    (2, "immediate_follow_up"), (15, "quick_response"), (60, "within_hour"), (1440, "within_day"),
]
MOMENTUM_CLASSES = [(8, "high_momentum"), (4, "medium_momentum"), (2, "low_momentum")]
LENGTH_CLASSES = [(10, "very_short"), (50, "short"), (200, "medium"), (500, "long")]
MOMENTUM_ROWS = 10
LENGTH_ROWS = 5
LINE_CHARS = 200
# What the windows look at, besides the position.
FIGURES_FROM = ["message_date", "is_from_me", "partner_display_name", "message_length"]


def message_base(int_messages: DataFrame) -> DataFrame:
    """Messages with a known partner.

    The partner is null only where the chat has neither name nor identifier, so whole chats drop out
    and ``message_sequence`` stays dense.
    """
    return int_messages.filter(F.col("partner_display_name").isNotNull())


def chat_offsets(messages: DataFrame, rows_per_segment: int = ROWS_PER_SEGMENT) -> DataFrame:
    """What the segments of a large chat must know of the segments before them.

    Large chats are the ones with a message number ``rows_per_segment + 1``, a filter the scan answers
    from column statistics; only their rows are aggregated, first per (segment, day) and with map-side
    combine. The result holds one row per segment after the first, so at most one per
    ``rows_per_segment`` messages, and none when every chat is small.
    """
    large = messages.filter(F.col("message_sequence") == rows_per_segment + 1).select("chat_id")
    day = truncated("day", F.col("message_date"))
    by_day = (
        messages.join(large, "chat_id", "left_semi")
        .groupBy(
            "chat_id",
            F.floor((F.col("message_sequence") - 1) / F.lit(rows_per_segment)).alias("segment"),
            day.alias("day"),
        )
        .agg(
            F.min("message_sequence").alias("first_sequence"),
            F.max("message_sequence").alias("last_sequence"),
            F.min("message_date").alias("first_date"),
            F.count_if(F.col("is_from_me")).alias("sent"),
            F.count_if(~F.col("is_from_me")).alias("received"),
        )
    )
    same_day = Window.partitionBy("chat_id", "day")
    by_segment = (
        by_day.withColumn("day_start", F.min("first_sequence").over(same_day))
        .groupBy("chat_id", "segment")
        .agg(
            F.max_by("day_start", "last_sequence").alias("last_day_start"),
            F.min("first_date").alias("first_date"),
            F.sum("sent").alias("sent"),
            F.sum("received").alias("received"),
        )
    )
    order = Window.partitionBy("chat_id").orderBy("segment")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    return by_segment.select(
        "chat_id",
        "segment",
        F.sum("sent").over(before).alias("sent_before"),
        F.sum("received").over(before).alias("received_before"),
        F.lag("last_day_start").over(order).alias("open_day_start"),
        F.min("first_date").over(before).alias("chat_first_date"),
    ).filter("segment > 0")


def windowed_metrics(
    int_messages: DataFrame,
    first_name: str | None = None,
    rows_per_segment: int = ROWS_PER_SEGMENT,
) -> DataFrame:
    """Neighbours, gaps, running and rolling figures of each message within its chat.

    Windows run over narrow rows: who, when, how long. Ordered by ``message_sequence``, one exchange and one sort on
    (chat, segment) serve all of them, the daily position included. Texts and all other columns join the figures
    by (chat, position); from the written table (``messages.written_messages``) they come as they lie, without an exchange.

    With ``first_name`` the (chat, segment) pairs that hold a message of that contact are looked up first and only
    these are computed; the wide rows are read by a filter on the name, which the scan answers from the statistics of pages
    that hold neighbouring messages of a chat.
    """
    base = with_length(message_base(int_messages))
    narrow = base.select(*POSITION, *FIGURES_FROM)
    offsets = chat_offsets(narrow, rows_per_segment)
    rows = with_halo(narrow, "message_sequence", LENGTH_ROWS - 1, 1, rows_per_segment)
    if first_name is not None:
        base = base.filter(F.col("first_name") == first_name)
        wanted = base.select(
            "chat_id",
            F.floor((F.col("message_sequence") - 1) / F.lit(rows_per_segment)).cast("bigint").alias("segment"),
        )
        rows = rows.join(wanted.distinct(), ["chat_id", "segment"], "left_semi")

    order = Window.partitionBy("chat_id", "segment").orderBy("message_sequence")
    so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    last_five = order.rowsBetween(1 - LENGTH_ROWS, Window.currentRow)
    own, sent, at = F.col("is_own"), F.col("is_from_me"), F.col("message_date")
    day, sequence = F.col("message_date_day"), F.col("message_sequence")

    neighbours = {
        "prev_message_date": F.lag("message_date").over(order),
        "prev_message_from_me": F.lag("is_from_me").over(order),
        "prev_message_sender": F.lag("partner_display_name").over(order),
        "next_message_date": F.lead("message_date").over(order),
        "next_message_from_me": F.lead("is_from_me").over(order),
        "prev_sequence": F.lag("message_sequence").over(order),
        "prev_day": F.lag("message_date_day").over(order),
    }
    day_opens = F.col("prev_sequence").isNull() | ~F.col("prev_day").eqNullSafe(day)
    running = {
        "sent_here": F.count_if(own & sent).over(so_far),
        "received_here": F.count_if(own & ~sent).over(so_far),
        "day_start_here": F.max(F.when(own & day_opens, sequence)).over(so_far),
        "first_date_here": F.first("message_date").over(so_far),
        "avg_length_last_5_messages": F.avg("message_length").over(last_five),
    }
    zero = F.lit(0)
    figures = (
        rows.withColumn("message_date_day", truncated("day", at))
        .withColumns(neighbours)
        .withColumns(running)
        .filter("is_own")
        .join(offsets, ["chat_id", "segment"], "left")
        .select(
            *POSITION,
            day,
            "prev_message_date", "prev_message_from_me", "prev_message_sender",
            "next_message_date", "next_message_from_me", "avg_length_last_5_messages",
            (sequence - F.coalesce("day_start_here", "open_day_start") + 1).alias("daily_message_sequence"),
            (F.col("sent_here") + F.coalesce("sent_before", zero)).alias("cumulative_sent_in_conversation"),
            (F.col("received_here") + F.coalesce("received_before", zero)).alias("cumulative_received_in_conversation"),
            F.when(F.col("segment") == 0, F.col("first_date_here"))
            .otherwise(F.col("chat_first_date"))
            .alias("first_message_date"),
        )
    )
    # Columns of its own for either side of the join: both come from the same table.
    return base.join(figures.toDF(*figures.columns), POSITION).withColumns(
        {
            "minutes_since_prev_message": minutes_between(F.col("prev_message_date"), at),
            "minutes_until_next_message": minutes_between(at, F.col("next_message_date")),
            "cumulative_messages_in_conversation": sequence,
            "messages_last_10": F.least(sequence, F.lit(MOMENTUM_ROWS).cast("bigint")),
        }
    )


def session_start(gap_minutes: int = SESSION_GAP_MINUTES) -> Column:
    gap = F.col("minutes_since_prev_message")
    return gap.isNull() | (gap > gap_minutes)


def timeseries_enriched(metrics: DataFrame, gap_minutes: int = SESSION_GAP_MINUTES) -> DataFrame:
    """Time dimensions, classes and flags; all of it from the row itself."""
    at, gap = F.col("message_date"), F.col("minutes_since_prev_message")
    days_so_far = days_between(F.col("first_message_date"), at) + 1
    return metrics.withColumns({**time_dims(at), **time_classes(at)}).withColumns(
        {
            "response_timing_category": F.when(gap.isNull(), "conversation_start").otherwise(
                up_to(gap, GAP_CLASSES, "delayed_response")
            ),
            "conversation_momentum": at_least(
                F.col("messages_last_10"), MOMENTUM_CLASSES, "minimal_momentum"
            ),
            "is_part_of_streak": holds(
                F.col("is_consecutive_message")
                & (F.col("prev_message_from_me") == F.col("is_from_me"))
            ),
            "is_session_start": session_start(gap_minutes),
            "is_first_daily_message": F.col("daily_message_sequence") == 1,
            "message_length_category": up_to(
                F.col("message_length"), LENGTH_CLASSES, "very_long"
            ),
            "messages_per_day_to_date": F.col("cumulative_messages_in_conversation").cast("double")
            / days_so_far,
        }
    )


def contact_name() -> Column:
    return F.coalesce("partner_display_name", "chat_identifier")


def formatted_message() -> Column:
    """One line per message: who, when, what."""
    return concat_nulls_empty(
        F.when(F.col("is_from_me"), "Me").otherwise(contact_name()),
        " at ",
        F.substring(F.col("message_date").cast("string"), 1, 16),  # to the minute, in no zone
        " (", F.col("time_of_day"), ", ", F.col("day_name"), "): ",
        ellipsize(F.col("message_text"), LINE_CHARS),
    )


def temporal_context() -> Column:
    """One sentence on position, time and response time of a message."""
    response = F.col("response_time_minutes").cast("string")
    return concat_nulls_empty(
        "Message ", F.col("message_sequence"), " in conversation with ", contact_name(),
        ". Sent on ", F.col("day_name"), " at ", F.col("time_of_day"),
        F.concat(F.lit(" ("), response, F.lit(" min response time)")),
    )


# The columns of the time series.
TIMESERIES_COLUMNS = [
    "message_id", "chat_id", "message_guid", "first_name", "last_name", "contact_phone_number",
    "chat_identifier", "contact_match_type", "phone_type", "message_text",
    "message_length_category", "is_from_me", "message_date", "message_hour", "message_date_day",
    "message_week", "message_month", "message_quarter", "message_year", "hour_of_day",
    "day_of_week", "day_of_month", "month_of_year", "year", "time_of_day", "day_type", "day_name",
    "message_sequence", "daily_message_sequence", "cumulative_messages_in_conversation",
    "cumulative_sent_in_conversation", "cumulative_received_in_conversation",
    "response_time_minutes", "read_time_minutes", "minutes_since_prev_message",
    "minutes_until_next_message", "response_timing_category", "conversation_momentum",
    "is_conversation_starter", "is_consecutive_message", "is_part_of_streak", "is_session_start",
    "is_first_daily_message", "date_delivered", "date_read", "is_delivered", "is_read",
    "delivery_time_seconds", "service", "type", "cache_has_attachments", "messages_last_10",
    "avg_length_last_5_messages", "messages_per_day_to_date", "contact_name", "message_length",
    "message_direction", "formatted_message", "temporal_context",
]


def mart_message_timeseries(
    int_messages: DataFrame,
    first_name: str | None = None,
    gap_minutes: int = SESSION_GAP_MINUTES,
    rows_per_segment: int = ROWS_PER_SEGMENT,
    ordered: bool = False,
    content: DataFrame | None = None,
) -> DataFrame:
    """The message time series, of all contacts or of one first name.

    ``int_messages`` is read once for the rows and, column-pruned, for the windows and the large chats: pass the written
    table. ``content`` has the texts of messages that are ``referred``; they meet the finished figures.
    """
    metrics = windowed_metrics(int_messages, first_name, rows_per_segment)
    if content is not None:
        metrics = resolved(metrics, content, "message_text", [*metrics.columns, "message_text"])
    mart = (
        timeseries_enriched(metrics, gap_minutes)
        .withColumns(
            {
                "contact_name": contact_name(),
                "message_direction": F.when(F.col("is_from_me"), "sent").otherwise("received"),
                "formatted_message": formatted_message(),
                "temporal_context": temporal_context(),
            }
        )
        .select(TIMESERIES_COLUMNS)
    )
    return mart.orderBy(F.desc_nulls_last("message_date")) if ordered else mart
