"""The expected results, as plain DuckDB SQL over the driver tables.

Each query is a chain of CTEs in front of one SELECT. The chain repeats the models in ordinary SQL:
one window per chat, the fan-out of contacts before the windows, a recursive walk for threads. With the
Spark jobs it shares only lists of column names and the contract.
"""

from fixtures.views import duckdb_ctes
from parley.plans import contract, timeseries
from parley.sources import schemas

AS_OF = "DATE '2024-02-02'"
NAMED_CONTACT = "Customer#000000000"

# Bounds and labels of the classes, stated here once more, so that a wrong bound in the jobs shows.
RECENCY = [(7, "very_active"), (30, "active"), (90, "moderately_active"), (365, "inactive")]
ENGAGED = [(1000, 10, "high_engagement"), (100, 5, "medium_engagement"), (10, 0, "low_engagement")]
RESPONDERS = [(5, "immediate_responder"), (60, "quick_responder"), (1440, "daily_responder")]
GAPS = [(2, "immediate_follow_up"), (15, "quick_response"), (60, "within_hour"), (1440, "within_day")]
MOMENTA = [(8, "high_momentum"), (4, "medium_momentum"), (2, "low_momentum")]
LENGTHS = [(10, "very_short"), (50, "short"), (200, "medium"), (500, "long")]

CHAT_ORDER = "PARTITION BY chat_id ORDER BY message_date, message_id, contact_phone_number, first_name, last_name"



def ladder(value: str, comparison: str, bounds: list, otherwise: str) -> str:
    """A searched CASE over (bound, label) pairs."""
    steps = " ".join(f"WHEN {value} {comparison} {bound} THEN '{label}'" for bound, label in bounds)
    return f"CASE {steps} ELSE '{otherwise}' END"


ACTIVITY = ladder(
    "date_diff('microsecond', last_message_date, as_of_midnight)",
    "<=",
    [(f"{days} * 86400000000", label) for days, label in RECENCY],
    "dormant",
)
ENGAGEMENT = (
    "CASE "
    + " ".join(
        f"WHEN total_messages >= {volume} AND messages_per_active_day >= {pace} THEN '{label}'"
        for volume, pace, label in ENGAGED
    )
    + " ELSE 'minimal_engagement' END"
)
RESPONDER = ladder("avg_response_time_minutes", "<=", RESPONDERS, "slow_responder")
GAP = ladder("minutes_since_prev_message", "<=", GAPS, "delayed_response")
MOMENTUM = ladder("messages_last_10", ">=", MOMENTA, "minimal_momentum")
LENGTH = ladder("length(message_text)", "<=", LENGTHS, "very_long")

MODELS = {
    "stg_contacts": """
SELECT DISTINCT zfirstname AS first_name, zlastname AS last_name, zfullnumber AS full_number
FROM contact_record LEFT JOIN contact_phone ON zowner = z_pk""",
    "contact_digits": """
SELECT *, regexp_replace(full_number, '[^0-9]', '', 'g') AS clean_digits
FROM stg_contacts WHERE trim(full_number) <> ''""",
    "int_contacts_normalized": """
SELECT first_name, last_name, full_number, clean_digits,
  CASE WHEN regexp_full_match(clean_digits, '1[0-9]{10}') THEN clean_digits[2:] ELSE clean_digits END AS normalized_number,
  coalesce(first_name || ' ' || last_name, first_name, last_name) AS contact_display_name,
  CASE WHEN starts_with(full_number, '+1') THEN 'us_number'
    WHEN starts_with(full_number, '+') THEN 'international'
    WHEN regexp_full_match(full_number, '[0-9]{10}') THEN 'us_local'
    WHEN regexp_full_match(full_number, '[0-9]{4,6}') THEN 'short_code' ELSE 'other' END AS phone_type,
  length(clean_digits) AS digit_count,
  if(coalesce(first_name, last_name) IS NULL, 2, 1) AS contact_priority
FROM contact_digits WHERE length(clean_digits) >= 4""",
    "chat_messages": """
SELECT message_id, chat_id, guid AS message_guid, text, is_from_me::BOOLEAN AS is_from_me,
  TIMESTAMP '2001-01-01' + to_seconds(date / 1e9) AS message_date,
  TIMESTAMP '2001-01-01' + to_seconds(nullif(date_read, 0) / 1e9) AS date_read,
  TIMESTAMP '2001-01-01' + to_seconds(nullif(date_delivered, 0) / 1e9) AS date_delivered,
  is_delivered::BOOLEAN AS is_delivered, is_read::BOOLEAN AS is_read,
  is_system_message::BOOLEAN AS is_system_message, service, type,
  cache_has_attachments::BOOLEAN AS cache_has_attachments
FROM message JOIN chat_message_join ON message_id = rowid
WHERE text <> '' AND is_system_message = 0""",
    "chat_identity": """
SELECT rowid AS chat_id, chat_identifier, display_name, d AS chat_clean_digits,
  CASE WHEN regexp_full_match(d, '1[0-9]{10}') THEN d[2:] ELSE d END AS chat_normalized_number,
  regexp_replace(chat_identifier, '^\\+1', '') AS conversation_partner
FROM (SELECT *, regexp_replace(chat_identifier, '[^0-9]', '', 'g') AS d FROM chat)""",
    "base_messages": "SELECT * FROM chat_messages JOIN chat_identity USING (chat_id)",
    "messages_with_contacts": """
SELECT b.*, first_name, last_name, contact_display_name, full_number AS contact_phone_number, phone_type,
  contact_priority,
  coalesce(if(trim(display_name) = '', NULL, display_name), contact_display_name, chat_identifier) AS partner_display_name,
  CASE WHEN normalized_number IS NOT NULL THEN 'exact_match' WHEN contains(chat_identifier, '@') THEN 'email'
    WHEN length(chat_clean_digits) < 10 THEN 'short_code' ELSE 'unknown_number' END AS contact_match_type
FROM base_messages b LEFT JOIN int_contacts_normalized
  ON chat_normalized_number = normalized_number
  AND NOT contains(chat_identifier, '@') AND NOT starts_with(chat_identifier, 'chat')""",
    "message_context": f"""
SELECT *, lag(message_date) OVER w AS prev_message_date, lag(is_from_me) OVER w AS prev_is_from_me,
  lead(message_date) OVER w AS next_message_date, lead(is_from_me) OVER w AS next_is_from_me,
  row_number() OVER w AS message_sequence
FROM messages_with_contacts WINDOW w AS ({CHAT_ORDER})""",
    "int_messages": """
SELECT message_id, chat_id, message_guid, text AS message_text, is_from_me, message_date, date_read,
  date_delivered, is_delivered, is_read, service, type, cache_has_attachments, chat_identifier,
  display_name, conversation_partner, first_name, last_name, contact_display_name,
  contact_phone_number, phone_type, contact_priority, partner_display_name, contact_match_type,
  message_sequence,
  if(prev_is_from_me <> is_from_me, date_diff('minute', prev_message_date, message_date), NULL) AS response_time_minutes,
  if(NOT is_from_me, date_diff('minute', message_date, date_read), NULL) AS read_time_minutes,
  if(is_from_me, date_diff('second', message_date, date_delivered), NULL) AS delivery_time_seconds,
  (prev_is_from_me = is_from_me) IS TRUE AS is_consecutive_message,
  message_sequence = 1 AS is_conversation_starter
FROM message_context""",
    "typed_messages": """
SELECT *, CASE WHEN display_name IS NOT NULL OR starts_with(chat_identifier, 'chat') THEN 'group_chat'
    WHEN contact_match_type = 'email' THEN 'email_conversation'
    WHEN contact_match_type = 'short_code' THEN 'business_sms'
    ELSE 'individual_conversation' END AS conversation_type
FROM int_messages""",
    "conversation_base": """
SELECT chat_id, chat_identifier, partner_display_name, contact_match_type, first_name, last_name,
  phone_type, conversation_type,
  count(*) AS total_messages,
  count(*) FILTER (is_from_me) AS messages_sent,
  count(*) FILTER (NOT is_from_me) AS messages_received,
  min(message_date) AS first_message_date, max(message_date) AS last_message_date,
  max(message_date) FILTER (is_from_me) AS last_sent_date,
  max(message_date) FILTER (NOT is_from_me) AS last_received_date,
  date_diff('day', min(message_date), max(message_date)) AS conversation_duration_days,
  count(DISTINCT date_trunc('day', message_date)) AS active_days,
  count(DISTINCT date_trunc('week', message_date)) AS active_weeks,
  count(DISTINCT date_trunc('month', message_date)) AS active_months,
  avg(response_time_minutes) AS avg_response_time_minutes,
  quantile_cont(response_time_minutes, 0.5) AS median_response_time_minutes,
  avg(read_time_minutes) AS avg_read_time_minutes,
  avg(length(message_text)) AS avg_message_length,
  count(*) FILTER (cache_has_attachments) AS messages_with_attachments,
  count(*) FILTER (service = 'iMessage') AS imessage_count,
  count(*) FILTER (service = 'SMS') AS sms_count,
  avg(delivery_time_seconds) AS avg_delivery_time_seconds,
  count(*) FILTER (is_read AND NOT is_from_me) AS received_messages_read,
  count(*) FILTER (NOT is_from_me) AS total_received_messages,
  count(*) FILTER (is_consecutive_message) AS consecutive_message_count,
  max(message_sequence) FILTER (is_from_me) AS last_sent_sequence,
  max(message_sequence) FILTER (NOT is_from_me) AS last_received_sequence
FROM typed_messages GROUP BY ALL""",
    "conversation_ratios": """
SELECT *, messages_sent::DOUBLE / total_messages AS sent_ratio,
  messages_sent::DOUBLE / nullif(messages_received, 0) AS sent_received_ratio,
  total_messages::DOUBLE / greatest(conversation_duration_days, 1) AS messages_per_day,
  total_messages::DOUBLE / active_days AS messages_per_active_day,
  coalesce(received_messages_read::DOUBLE / nullif(total_received_messages, 0), 0) AS read_rate,
  messages_with_attachments::DOUBLE / total_messages AS attachment_rate
FROM conversation_base""",
    "conversation_enriched": f"""
SELECT * EXCLUDE (as_of_midnight), {ACTIVITY} AS activity_status, {ENGAGEMENT} AS engagement_level,
  {RESPONDER} AS response_behavior,
  CASE WHEN imessage_count::DOUBLE / total_messages > 0.8 THEN 'prefers_imessage'
    WHEN sms_count::DOUBLE / total_messages > 0.8 THEN 'prefers_sms' ELSE 'mixed_messaging' END AS messaging_preference,
  (last_sent_date > last_received_date) IS TRUE AS last_message_was_sent,
  date_diff('day', last_message_date, as_of_midnight) AS days_since_last_message,
  date_diff('day', last_sent_date, as_of_midnight) AS days_since_last_sent,
  date_diff('day', last_received_date, as_of_midnight) AS days_since_last_received
FROM (SELECT *, {AS_OF}::TIMESTAMP AS as_of_midnight FROM conversation_ratios)""",
    "recent_message_preview": """
SELECT chat_id, string_agg(line, ' | ' ORDER BY rank) AS recent_message_preview
FROM (
  SELECT chat_id, if(is_from_me, 'Me', partner_display_name) || ': ' || message_text[:100]
      || if(length(message_text) > 100, '...', '') AS line,
    row_number() OVER (PARTITION BY chat_id ORDER BY message_date DESC NULLS LAST, message_sequence DESC) AS rank
  FROM int_messages WHERE trim(message_text) <> '')
WHERE rank <= 3 GROUP BY chat_id""",
    "scored_conversations": """
SELECT e.*, recent_message_preview,
  concat('Conversation with ', partner_display_name, ' (', conversation_type, '): ', total_messages,
    ' messages over ', conversation_duration_days, ' days. Activity: ', activity_status,
    ', Engagement: ', engagement_level, ', Response time: ', response_behavior,
    '. Last message: ', days_since_last_message, ' days ago.') AS conversation_summary,
  total_messages / 100.0 * 0.3
    + CASE activity_status WHEN 'very_active' THEN 1.0 WHEN 'active' THEN 0.7 ELSE 0.3 END * 0.4
    + messages_per_active_day / 20.0 * 0.3 AS conversation_importance_score
FROM conversation_enriched e LEFT JOIN recent_message_preview USING (chat_id)""",
    "mart_conversations": "SELECT * FROM scored_conversations WHERE conversation_type = 'individual_conversation'",
    "message_base": """
SELECT *, date_trunc('hour', message_date) AS message_hour, date_trunc('day', message_date) AS message_date_day,
  date_trunc('week', message_date) AS message_week, date_trunc('month', message_date) AS message_month,
  date_trunc('quarter', message_date) AS message_quarter, date_trunc('year', message_date) AS message_year,
  hour(message_date) AS hour_of_day, dayofweek(message_date) AS day_of_week, day(message_date) AS day_of_month,
  month(message_date) AS month_of_year, year(message_date) AS year,
  CASE hour(message_date) // 6 WHEN 1 THEN 'morning' WHEN 2 THEN 'afternoon'
    WHEN 3 THEN if(hour(message_date) < 22, 'evening', 'night') ELSE 'night' END AS time_of_day,
  if(isodow(message_date) > 5, 'weekend', 'weekday') AS day_type, dayname(message_date) AS day_name
FROM int_messages WHERE partner_display_name IS NOT NULL""",
    "windowed_metrics": f"""
SELECT *, lag(message_date) OVER w AS prev_message_date, lag(is_from_me) OVER w AS prev_message_from_me,
  lag(partner_display_name) OVER w AS prev_message_sender,
  lead(message_date) OVER w AS next_message_date, lead(is_from_me) OVER w AS next_message_from_me,
  date_diff('minute', lag(message_date) OVER w, message_date) AS minutes_since_prev_message,
  date_diff('minute', message_date, lead(message_date) OVER w) AS minutes_until_next_message,
  row_number() OVER ({CHAT_ORDER.replace("chat_id", "chat_id, message_date_day", 1)}) AS daily_message_sequence,
  count(*) OVER (w ROWS UNBOUNDED PRECEDING) AS cumulative_messages_in_conversation,
  count(*) FILTER (is_from_me) OVER (w ROWS UNBOUNDED PRECEDING) AS cumulative_sent_in_conversation,
  count(*) FILTER (NOT is_from_me) OVER (w ROWS UNBOUNDED PRECEDING) AS cumulative_received_in_conversation,
  count(*) OVER (w ROWS 9 PRECEDING) AS messages_last_10,
  avg(length(message_text)) OVER (w ROWS 4 PRECEDING) AS avg_length_last_5_messages,
  first_value(message_date) OVER w AS first_message_date
FROM message_base WINDOW w AS ({CHAT_ORDER})""",
    "timeseries_enriched": f"""
SELECT *,
  if(minutes_since_prev_message IS NULL, 'conversation_start', {GAP}) AS response_timing_category,
  {MOMENTUM} AS conversation_momentum,
  (is_consecutive_message AND prev_message_from_me = is_from_me) IS TRUE AS is_part_of_streak,
  coalesce(minutes_since_prev_message > 30, TRUE) AS is_session_start,
  daily_message_sequence = 1 AS is_first_daily_message,
  {LENGTH} AS message_length_category,
  cumulative_messages_in_conversation::DOUBLE
    / (date_diff('day', first_message_date, message_date) + 1) AS messages_per_day_to_date
FROM windowed_metrics""",
    "timeseries_lines": """
SELECT *, coalesce(partner_display_name, chat_identifier) AS contact_name,
  length(message_text) AS message_length, if(is_from_me, 'sent', 'received') AS message_direction,
  concat(if(is_from_me, 'Me', partner_display_name), ' at ', strftime(message_date, '%Y-%m-%d %H:%M'),
    ' (', time_of_day, ', ', day_name, '): ', message_text[:200],
    if(length(message_text) > 200, '...', '')) AS formatted_message,
  concat('Message ', message_sequence, ' in conversation with ', partner_display_name, '. Sent on ',
    day_name, ' at ', time_of_day, ' (' || response_time_minutes || ' min response time)') AS temporal_context
FROM timeseries_enriched""",
    "mart_message_timeseries": f"SELECT {', '.join(timeseries.TIMESERIES_COLUMNS)} FROM timeseries_lines",
    "thread_link": """
SELECT rowid, guid, date, thread_originator_guid, coalesce(reply_to_guid, thread_originator_guid) AS parent FROM message
WHERE coalesce(reply_to_guid, thread_originator_guid) IS NOT NULL""",
    "thread_chain": """
SELECT DISTINCT parent AS guid, parent AS root, 0::BIGINT AS depth FROM thread_link WHERE parent NOT IN (SELECT guid FROM thread_link)
UNION ALL
SELECT l.guid, c.root, c.depth + 1 FROM thread_link l JOIN thread_chain c ON l.parent = c.guid""",
}

DUCKDB_TYPES = {"bigint": "BIGINT", "binary": "BLOB", "string": "VARCHAR"}
OPTIONAL_CHAT = ", ".join(
    f"NULL::{DUCKDB_TYPES[kind]} AS {name}" for name, kind in schemas.optional(schemas.CHAT).items()
)
STG_CHAT = f"SELECT rowid AS row_id, guid, chat_identifier, service_name, display_name, {OPTIONAL_CHAT} FROM chat"
BACKFILL = "SELECT rowid{alias}, guid, coalesce(text, decode(attributedbody)) AS text, hex(attributedbody) AS attributed_body FROM message"
ALL_CONVERSATION_KEYS = (
    "chat_id, chat_identifier, partner_display_name, contact_match_type, first_name, last_name,"
    " phone_type, conversation_type"
)


def _report_sql() -> str:
    def counted(rule: str, subject: str, breaks: str, severity: str = "error") -> str:
        return (
            f"SELECT '{rule}' AS rule, '{subject}' AS subject, '{severity}' AS severity,"
            f" count(*) FILTER ({breaks}) AS failures FROM mart_message_timeseries"
        )

    def listed(values) -> str:
        return ", ".join(str(v).upper() if isinstance(v, bool) else f"'{v}'" for v in values)

    def outside(column, lo, hi) -> str:
        ends = [f"{column} < {lo}" if lo is not None else "", f"{column} > {hi}" if hi is not None else ""]
        return " OR ".join(filter(None, ends))

    parts = [counted("not_null", c, f"{c} IS NULL") for c in contract.NOT_NULL]
    parts += [
        counted("accepted_values", c, f"{c} NOT IN ({listed(values)})")
        for c, values in contract.ACCEPTED_VALUES.items()
    ]
    parts += [
        counted("accepted_range", c, outside(c, lo, hi))
        for c, (lo, hi) in contract.ACCEPTED_RANGE.items()
    ]
    parts += [
        counted("expression_is_true", e, f"NOT ({e})", severity)
        for e, severity in contract.EXPRESSIONS.items()
    ]
    parts += [
        f"SELECT 'unique', '{c}', 'error', count(*) FROM (SELECT {c} FROM mart_message_timeseries"
        f" WHERE {c} IS NOT NULL GROUP BY {c} HAVING count(*) > 1)"
        for c in contract.UNIQUE
    ]
    column, (by,) = contract.SEQUENTIAL
    parts.append(
        f"SELECT 'sequential_values', '{column}', 'error', count(*) FILTER ({column} <> before + 1) FROM"
        f" (SELECT {column}, lag({column}) OVER (PARTITION BY {by} ORDER BY {column}) AS before"
        " FROM mart_message_timeseries)"
    )
    union = " UNION ALL ".join(parts)
    return (
        "SELECT *, CASE WHEN failures = 0 THEN 'pass' WHEN severity = 'warn' THEN 'warn' ELSE 'fail' END"
        f" AS outcome FROM ({union})"
    )


TIME_COLUMNS = (
    "message_hour, message_date_day, message_week, message_month, message_quarter, message_year,"
    " hour_of_day, day_of_week, day_of_month, month_of_year, year"
)

QUERIES = {
    "stg_message": """
SELECT * REPLACE (hex(attributedbody) AS attributedbody), NULL::BIGINT AS handle_id, NULL::INTEGER AS is_sent,
  NULL::INTEGER AS is_service_message, NULL::VARCHAR AS associated_message_guid, NULL::INTEGER AS associated_message_type
FROM message""",
    "stg_chat": STG_CHAT,
    "int_chat": STG_CHAT,
    "stg_chat_message_join": "SELECT * FROM chat_message_join",
    "stg_attributed_body": BACKFILL.format(alias=" AS row_id"),
    "int_attributed_body": BACKFILL.format(alias=" AS row_id"),
    "text_backfill": BACKFILL.format(alias=""),
    "sink_roundtrip": "SELECT * FROM int_contacts_normalized",
    "stg_contacts": "SELECT * FROM stg_contacts",
    "int_contacts_normalized": "SELECT * FROM int_contacts_normalized",
    "phone_normalize": """
SELECT zowner, zfullnumber, d AS clean_digits, length(d) AS digit_count,
  CASE WHEN regexp_full_match(d, '1[0-9]{10}') THEN d[2:] ELSE d END AS normalized_number
FROM (SELECT *, regexp_replace(zfullnumber, '[^0-9]', '', 'g') AS d FROM contact_phone)""",
    "phone_type": """
SELECT zowner, zfullnumber, CASE WHEN zfullnumber LIKE '+1%' THEN 'us_number'
    WHEN zfullnumber LIKE '+%' THEN 'international'
    WHEN regexp_full_match(zfullnumber, '\\d{10}') THEN 'us_local'
    WHEN regexp_full_match(zfullnumber, '\\d{4,6}') THEN 'short_code' ELSE 'other' END AS phone_type
FROM contact_phone""",
    "base_messages": "SELECT * FROM base_messages",
    "contact_match_type": """
SELECT chat_id, chat_identifier, contact_phone_number, partner_display_name, contact_match_type, count(*) AS messages
FROM messages_with_contacts GROUP BY ALL""",
    "messages_with_contacts": "SELECT * FROM messages_with_contacts",
    "message_context": "SELECT * FROM message_context",
    "epoch_to_timestamp": """
SELECT rowid, TIMESTAMP '2001-01-01' + to_seconds((date + rowid * 37 % 1000) / 1e9) AS message_date,
  TIMESTAMP '2001-01-01' + to_seconds(nullif(date_read, 0) / 1e9) AS date_read FROM message""",
    "response_time": """
SELECT message_id, chat_id, message_sequence, is_from_me, response_time_minutes, is_consecutive_message FROM int_messages""",
    "read_delivery_time": """
SELECT message_id, chat_id, message_sequence, is_from_me, read_time_minutes, delivery_time_seconds FROM int_messages""",
    "int_messages": "SELECT * FROM int_messages",
    "int_messages_cut": "SELECT * FROM int_messages",
    "int_messages_backfilled": "SELECT * FROM int_messages",
    "conversation_type": "SELECT chat_id, conversation_type, count(*) AS messages FROM typed_messages GROUP BY ALL",
    "conversation_base": "SELECT * FROM conversation_base",
    "active_periods": f"SELECT {ALL_CONVERSATION_KEYS}, active_days, active_weeks, active_months FROM conversation_base",
    "median_response": f"SELECT {ALL_CONVERSATION_KEYS}, median_response_time_minutes FROM conversation_base",
    "median_response_sketch": f"SELECT {ALL_CONVERSATION_KEYS}, count(response_time_minutes) AS responses, true AS rank_is_close FROM typed_messages GROUP BY ALL HAVING count(response_time_minutes) > 0",
    "conversation_ratios": "SELECT * FROM conversation_ratios",
    "conversation_enriched": "SELECT * FROM conversation_enriched",
    "recent_message_preview": "SELECT * FROM recent_message_preview",
    "conversation_summary": f"SELECT {ALL_CONVERSATION_KEYS}, conversation_summary FROM scored_conversations",
    "importance_score": f"SELECT {ALL_CONVERSATION_KEYS}, conversation_importance_score FROM scored_conversations",
    "mart_conversations": "SELECT * FROM mart_conversations",
    "time_dims": f"SELECT message_id, chat_id, message_sequence, {TIME_COLUMNS} FROM message_base",
    "time_classes": "SELECT message_id, chat_id, message_sequence, time_of_day, day_type, day_name FROM message_base",
    "windowed_metrics": """
SELECT message_id, chat_id, message_sequence, prev_message_date, prev_message_from_me, prev_message_sender,
  next_message_date, next_message_from_me, minutes_since_prev_message, minutes_until_next_message,
  daily_message_sequence, cumulative_messages_in_conversation, cumulative_sent_in_conversation,
  cumulative_received_in_conversation, messages_last_10, avg_length_last_5_messages, first_message_date
FROM windowed_metrics""",
    "timeseries_enriched": """
SELECT message_id, chat_id, message_sequence, response_timing_category, conversation_momentum, is_part_of_streak,
  is_session_start, is_first_daily_message, message_length_category, messages_per_day_to_date
FROM timeseries_enriched""",
    "session_starts": """
SELECT message_id, chat_id, message_sequence, message_date, minutes_since_prev_message
FROM timeseries_enriched WHERE is_session_start""",
    "formatted_message": "SELECT message_id, chat_id, message_sequence, formatted_message FROM timeseries_lines",
    "temporal_context": "SELECT message_id, chat_id, message_sequence, temporal_context FROM timeseries_lines",
    "mart_message_timeseries": "SELECT * FROM mart_message_timeseries",
    "mart_message_timeseries_cut": "SELECT * FROM mart_message_timeseries",
    "mart_message_timeseries_named_cut": f"SELECT * FROM mart_message_timeseries WHERE first_name = '{NAMED_CONTACT}'",
    "mart_message_timeseries_named": f"SELECT * FROM mart_message_timeseries WHERE first_name = '{NAMED_CONTACT}'",
    "int_conversations": """
SELECT chat_id AS conversation_id, if(is_group_chat, NULL, conversation_partner) AS conversation_partner, is_group_chat,
  min(message_date) AS first_message_date, max(message_date) AS last_message_date, count(*) AS total_messages,
  count(*) FILTER (is_from_me) AS messages_sent, count(*) FILTER (NOT is_from_me) AS messages_received,
  avg(wait) / 60 AS avg_response_time_hours,
  date_diff('day', min(message_date), max(message_date)) AS conversation_duration_days
FROM (
  SELECT *, display_name IS NOT NULL OR starts_with(chat_identifier, 'chat') AS is_group_chat,
    if(lag(is_from_me) OVER w <> is_from_me, date_diff('minute', lag(message_date) OVER w, message_date), NULL) AS wait
  FROM base_messages WINDOW w AS (PARTITION BY chat_id ORDER BY message_date, message_id))
GROUP BY chat_id, conversation_partner, is_group_chat""",
    "int_message_threads": """
SELECT coalesce(r.thread_originator_guid, c.root) AS thread_id, o.rowid AS original_message_id, r.rowid AS reply_message_id,
  CASE WHEN coalesce(a.root, r.thread_originator_guid) = c.root AND coalesce(a.depth, 0) < c.depth
    THEN c.depth - coalesce(a.depth, 0) ELSE c.depth END AS thread_depth,
  date_diff('minute', TIMESTAMP '2001-01-01' + to_seconds(o.date / 1e9),
    TIMESTAMP '2001-01-01' + to_seconds(r.date / 1e9)) AS time_to_reply_minutes
FROM thread_link r LEFT JOIN thread_chain c ON c.guid = r.guid LEFT JOIN thread_chain a ON a.guid = r.thread_originator_guid
LEFT JOIN message o ON o.guid = coalesce(r.thread_originator_guid, c.root)""",
    "dq_unique": "SELECT message_id, count(*) AS occurrences FROM int_messages GROUP BY message_id HAVING count(*) > 1",
    "dq_not_null": "SELECT message_id, chat_id, message_sequence FROM int_messages WHERE first_name IS NULL",
    "dq_accepted_values": """
SELECT message_id, chat_id, message_sequence, service FROM int_messages WHERE service NOT IN ('iMessage', 'RCS')""",
    "dq_accepted_range": """
SELECT message_id, chat_id, message_sequence, read_time_minutes FROM int_messages
WHERE read_time_minutes NOT BETWEEN 2 AND 30""",
    "dq_sequential_values": """
SELECT chat_id, message_id, count(*) AS failures
FROM (SELECT chat_id, message_id, lag(message_id) OVER (PARTITION BY chat_id ORDER BY message_id) AS before FROM int_messages)
WHERE before <> message_id - 1 GROUP BY ALL""",
    "dq_expression": """
SELECT message_id, chat_id, message_sequence, response_time_minutes FROM int_messages
WHERE NOT (response_time_minutes IS NULL OR response_time_minutes <= 60)""",
    "dq_report": _report_sql(),
}


def with_models(query: str, backfilled: bool = False) -> str:
    """A query with the fixture views and models it may name in front of it."""
    ctes = {**duckdb_ctes(), **MODELS}
    if backfilled:
        ctes["message"] = f"SELECT * REPLACE (coalesce(text, decode(attributedbody)) AS text) FROM ({ctes['message']})"
    reused = {"ev", "message", "messages_with_contacts", "int_messages", "mart_message_timeseries"}
    chain = ",\n".join(
        f"{name} AS {'MATERIALIZED ' if name in reused else ''}({text.strip()})"
        for name, text in ctes.items()
    )
    return f"WITH RECURSIVE {chain}\n{query.strip()}"


def oracle_sql() -> dict[str, str]:
    return {name: with_models(query, name == "int_messages_backfilled") for name, query in QUERIES.items()}
