"""Reply threads."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parley.functions.moments import epoch_ns, minutes_between
from parley.operators.chains import resolve_chains


def message_threads(message: DataFrame) -> DataFrame:
    """One row per reply: its thread, the original message, its depth and the minutes since the original.

    A reply points to ``reply_to_guid``, or to the thread's originator where that is all it states. The
    thread is the stated originator, else the message the reply chain starts from; the original stays
    null where that message is not in the store. Depth counts the steps to the originator where the chain
    passes it, else to the chain's start. Replies on a cycle have no depth, and no thread without an originator.
    """
    replies = message.select(
        "rowid",
        "guid",
        "date",
        "thread_originator_guid",
        F.coalesce("reply_to_guid", "thread_originator_guid").alias("parent"),
    ).filter(F.col("parent").isNotNull())
    chains = resolve_chains(replies.select(F.col("guid").alias("node"), "parent"))
    originals = message.select(
        F.col("guid").alias("thread_id"),
        F.col("rowid").alias("original_message_id"),
        epoch_ns(F.col("date")).alias("original_date"),
    )
    # An originator that is no reply itself is the root of its own chain.
    of_originator = chains.select(
        F.col("node").alias("thread_originator_guid"),
        F.col("root").alias("originator_root"),
        F.col("depth").alias("originator_depth"),
    )
    above = F.coalesce("originator_depth", F.lit(0))
    passed = (F.coalesce("originator_root", "thread_originator_guid") == F.col("root")) & (above < F.col("depth"))
    return (
        replies.join(chains, replies.guid == chains.node)
        .join(of_originator, "thread_originator_guid", "left")
        .withColumn("depth", F.when(passed, F.col("depth") - above).otherwise(F.col("depth")))
        .withColumn("thread_id", F.coalesce("thread_originator_guid", "root"))
        .join(originals, "thread_id", "left")
        .select(
            "thread_id",
            "original_message_id",
            F.col("rowid").alias("reply_message_id"),
            F.col("depth").alias("thread_depth"),
            minutes_between(F.col("original_date"), epoch_ns(F.col("date"))).alias(
                "time_to_reply_minutes"
            ),
        )
    )
