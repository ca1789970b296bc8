"""Declared columns of the source tables. Required columns come first; the rest may be absent."""

MESSAGE = "message"
CHAT_MESSAGE_JOIN = "chat_message_join"
CHAT = "chat"
CONTACT_RECORD = "contact_record"
CONTACT_PHONE = "contact_phone"
ATTRIBUTED_BODY = "attributed_body_cleaned"

# Table -> (required columns, optional columns), as DDL
DECLARED = {
    MESSAGE: (
        "rowid bigint, guid string, text string, date bigint, date_read bigint, date_delivered bigint,"
        " is_from_me int, is_system_message int, cache_has_attachments int, is_read int,"
        " is_delivered int, service string, type int",
        "attributedbody binary, thread_originator_guid string, reply_to_guid string, handle_id bigint, is_sent int,"
        " is_service_message int, associated_message_guid string, associated_message_type int",
    ),
    CHAT_MESSAGE_JOIN: ("chat_id bigint, message_id bigint, message_date bigint", ""),
    CHAT: (
        "rowid bigint, guid string, chat_identifier string, service_name string, display_name string",
        "style bigint, state bigint, account_id string, properties binary, room_name string,"
        " account_login string, is_archived bigint, last_addressed_handle string, group_id string,"
        " is_filtered bigint, successful_query bigint, engram_id string, server_change_token string,"
        " ck_sync_state bigint, original_group_id string, last_read_message_timestamp bigint,"
        " cloudkit_record_id string, last_addressed_sim_id string, is_blackholed bigint,"
        " syndication_date bigint, syndication_type bigint, is_recovered bigint,"
        " is_deleting_incoming_messages bigint",
    ),
    CONTACT_RECORD: (
        "z_pk bigint, zfirstname string, zlastname string",
        "zorganization string, znickname string",
    ),
    CONTACT_PHONE: ("zowner bigint, zfullnumber string, zorderingindex int", "zlabel string"),
    ATTRIBUTED_BODY: ("rowid bigint, guid string, text string, attributed_body binary", ""),
}


def required(table: str) -> dict[str, str]:
    """Name and type of the columns a table must have."""
    return _columns(DECLARED[table][0])


def optional(table: str) -> dict[str, str]:
    """Name and type of the columns that are null where a table lacks them."""
    return _columns(DECLARED[table][1])


def _columns(ddl: str) -> dict[str, str]:
    return dict(column.split() for column in ddl.split(",") if column)
