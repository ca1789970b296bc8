import random

from parley.operators.chains import resolve_chains
from parley.plans.threads import message_threads
from tests.handmade import message, sources


def threads(spark, messages):
    rows = message_threads(sources(spark, messages).message).collect()
    return {r.reply_message_id: (r.thread_id, r.original_message_id, r.thread_depth, r.time_to_reply_minutes) for r in rows}


def test_chain_dangling_and_originator(spark):
    at = "2024-01-01 00:0{}:00"
    got = threads(spark, [
        message(1, at.format(0)),
        message(2, at.format(1), reply_to_guid="g1"),
        message(3, at.format(2), reply_to_guid="g2"),
        message(4, at.format(3), reply_to_guid="g3", thread_originator_guid="g2"),
        message(5, at.format(4), thread_originator_guid="g1"),
        message(6, at.format(5), reply_to_guid="lost"),
        message(7, at.format(6), reply_to_guid="g6"),
    ])
    assert got == {
        2: ("g1", 1, 1, 1),
        3: ("g1", 1, 2, 2),
        4: ("g2", 2, 2, 2),
        5: ("g1", 1, 1, 4),
        6: ("lost", None, 1, None),
        7: ("lost", None, 2, None),
    }


def test_cycles_are_kept_without_thread(spark):
    at = "2024-01-01 00:00:00"
    got = threads(spark, [
        message(1, at, reply_to_guid="g2"),
        message(2, at, reply_to_guid="g1"),
        message(3, at, reply_to_guid="g2"),
        message(4, at, reply_to_guid="g5"),
        message(5, at),
        message(6, at, reply_to_guid="g6"),
    ])
    nowhere = (None, None, None, None)
    assert got == {1: nowhere, 2: nowhere, 3: nowhere, 4: ("g5", 5, 1, 0), 6: nowhere}


def test_random_forest_equals_walking(spark):
    rng = random.Random(5)
    parent = {i: (i - 1 if rng.random() < 0.8 else rng.randrange(i)) for i in range(1, 300) if rng.random() < 0.97}
    expected = {}
    for node in parent:
        root, depth = node, 0
        while root in parent:
            root, depth = parent[root], depth + 1
        expected[node] = (root, depth)
    links = spark.createDataFrame(list(parent.items()), "node bigint, parent bigint")
    assert {r.node: (r.root, r.depth) for r in resolve_chains(links).collect()} == expected


def test_no_replies(spark):
    assert threads(spark, [message(1, "2024-01-01 00:00:00")]) == {}
