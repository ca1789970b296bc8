"""The physical plans the models are built for, with broadcasts off as for large tables."""

from datetime import date

import pytest

from parley.operators import chains
from parley.plans import conversations, messages, staging, timeseries
from parley.sources.tables import write_clustered
from tests.handmade import chat, int_messages, message, sources


@pytest.fixture(scope="module")
def table(spark, tmp_path_factory):
    rows = [message(i, f"2024-01-01 00:{i:02d}:00", sent=i % 2) for i in range(30)]
    s = sources(spark, rows, [chat(1)], [(1, "Ann", None)], [(1, "5550000001", 0)])
    path = str(tmp_path_factory.mktemp("plans") / "int_messages")
    int_messages(s).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture
def plan(spark):
    """Physical plan of a DataFrame without adaptive execution and size-based broadcasts."""
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {key: spark.conf.get(key) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield lambda df: df._jdf.queryExecution().executedPlan().toString()
    for key, value in before.items():
        spark.conf.set(key, value)


def lines(text, *words):
    return [line for line in text.splitlines() if all(w in line for w in words)]


def test_message_filters_reach_the_scan(spark, tmp_path, plan):
    s = sources(spark, [message(1, "2024-01-01 00:00:00")])
    s.message.write.parquet(str(tmp_path / "message"))
    stored = staging.stg_message(spark.read.parquet(str(tmp_path / "message")))
    text = plan(messages.chat_messages(stored, s.link))
    (scan,) = lines(text, "FileScan parquet")
    assert "EqualTo(is_system_message,0)" in scan
    assert "Not(EqualTo(text,))" in scan
    assert "attributedbody" not in scan.split("ReadSchema")[1]


def test_wide_rows_move_once_to_their_links(spark, plan):
    """Numbering runs on the links alone; texts move to meet them, and no window stands above a text."""
    s = sources(spark, [message(1, "2024-01-01 00:00:00")])
    text = plan(int_messages(s))
    assert len([x for x in lines(text, "Exchange hashpartitioning") if "rowid" in x]) == 1
    windows = lines(text, "Window [")
    assert windows and not any("text" in x for x in windows)


def test_one_exchange_serves_all_series_windows(table, plan):
    text = plan(timeseries.windowed_metrics(table))
    ordered = lines(text, "Window [", "message_sequence#")
    assert len(ordered) == 2
    indent = {line.index("Window [") for line in ordered}
    assert max(indent) - min(indent) <= 9, "no exchange or sort between the two"
    assert "ResolvedHint" not in text and "BroadcastExchange" not in text
    assert "EqualTo(message_sequence,2000001)" in text


@pytest.fixture(scope="module")
def clustered(spark, tmp_path_factory):
    """The message table as the models write it: two chats, the contact of one of them named."""
    rows = [message(i, f"2024-01-01 00:{i:02d}:00", sent=i % 2, chat=1 + i % 2) for i in range(30)]
    s = sources(spark, rows, [chat(1), chat(2, "+15550000002")], [(1, "Ann", None)], [(1, "5550000001", 0)])
    return messages.written_messages(int_messages(s), str(tmp_path_factory.mktemp("plans") / "clustered"))


def test_no_text_moves_between_the_message_table_and_the_series(clustered, plan):
    text = plan(timeseries.mart_message_timeseries(clustered))
    assert lines(text, "FileScan parquet", "message_text", "Bucketed: true")
    assert not lines(text, "Exchange", "message_text")
    assert "Generate" not in text
    under_windows = text[text.index("Window [") :]
    narrow = under_windows[: under_windows.index("FileScan parquet")]
    assert "message_text" not in narrow and "message_guid" not in narrow


def test_no_text_below_a_window(clustered, plan):
    """Not even where it is read from a plain table: the one text below a window is its length."""
    text = plan(timeseries.windowed_metrics(clustered))
    depth = None
    for line in text.splitlines():
        at = len(line) - len(line.lstrip(" :+-"))
        if depth is not None and at <= depth:
            depth = None
        if "Window [" in line and depth is None:
            depth = at
        assert depth is None or "message_text" not in line


def test_named_series_is_pruned_by_the_scan(clustered, plan):
    text = plan(timeseries.mart_message_timeseries(clustered, first_name="Ann"))
    wide = [x for x in lines(text, "FileScan parquet", "message_text")]
    assert wide and all("EqualTo(first_name,Ann)" in x for x in wide)
    assert "LeftSemi" in text


def test_conversations_read_texts_for_the_preview_only(clustered, plan):
    text = plan(conversations.mart_conversations(clustered, date(2024, 2, 2)))
    scans = lines(text, "FileScan parquet")
    assert len([x for x in scans if "message_text" in x.split("ReadSchema")[1]]) == 1 < len(scans)


def test_clustered_table_keeps_its_rows_and_a_catalog_name(spark, clustered, tmp_path):
    assert clustered.count() == 30 and "message_length" in clustered.columns
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("clustered_")]
    kept = messages.written_messages(clustered, str(tmp_path / "kept"), table="kept_messages")
    assert sorted(kept.collect()) == sorted(clustered.collect())
    assert sorted(spark.table("kept_messages").collect()) == sorted(clustered.collect())
    spark.sql("DROP TABLE kept_messages")
    assert spark.read.parquet(str(tmp_path / "kept")).count() == 30


def test_preview_limits_before_the_shuffle(table, plan):
    text = plan(conversations.recent_message_preview(table))
    assert lines(text, "WindowGroupLimit", "Partial")
    assert len(lines(text, "Exchange hashpartitioning")) == 1


def test_conversations_aggregate_before_the_shuffle(table, plan):
    """Raw rows meet hash aggregates only; the median sees response times with their counts."""
    text = plan(conversations.conversation_base(table, "individual_conversation"))
    raw = [line for line in lines(text, "HashAggregate(", "functions=[partial_") if "ObjectHashAggregate" not in line]
    assert len(raw) == 3, "totals, response times and masks"
    assert "percentile(minutes" in text
    assert "collect_" not in text and "Expand" not in text and "SortAggregate" not in text
    for unused in ("date_read", "message_guid", "conversation_partner"):
        assert unused not in lines(text, "FileScan parquet")[0].split("ReadSchema")[1]


def test_periods_are_hash_aggregates_of_masks(table, plan):
    text = plan(conversations.active_periods(table))
    assert "bit_or" in text and len(lines(text, "HashAggregate(")) == 4
    assert not any(x in text for x in ("ObjectHashAggregate", "SortAggregate", "collect_"))


def test_only_open_links_move_in_a_round(spark, tmp_path, plan):
    """Links of earlier rounds are met where they lie: what moves is requests, summed up before, and open links."""

    def table(name):
        links = spark.createDataFrame([(i, i - 1, 1) for i in range(1, 20)], "node bigint, ancestor bigint, depth bigint")
        return write_clustered(links, str(tmp_path / name), ["node"])

    open_links, first, second = table("open"), table("first"), table("second")
    text = plan(chains.next_step(open_links, [first, second]))
    moved = [x for x in lines(text, "Exchange hashpartitioning") if "Reused" not in x]
    assert len(moved) == 2
    assert len(lines(text, "ReusedExchange")) == 2
    for known in (first, second):
        name = known._jdf.queryExecution().analyzed().toString().split("clustered_")[1][:32]
        assert all("Bucketed: true" in x for x in lines(text, "FileScan", name)) and lines(text, "FileScan", name)


def test_no_python_and_no_pair_joins_in_any_plan(table, plan):
    for df in (
        conversations.mart_conversations(table, date(2024, 2, 2)),
        timeseries.mart_message_timeseries(table, first_name="Ann"),
    ):
        text = plan(df)
        for operator in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin"):
            assert operator not in text
