"""Following parent links to the end."""

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parley.session import new_table_path
from parley.sources.tables import write_clustered

STEP = ["node", "ancestor", "depth"]


def next_step(open_links: DataFrame, known: Sequence[DataFrame]) -> DataFrame:
    """Open links (node, ancestor, depth) moved on by what their ancestors know: (node, ancestor, depth, at_root).

    Links ask: one request for each ancestor that any of them waits for, answered by a join with the links of the same round
    and with the ``known`` ones of earlier rounds. Both lie clustered by node, where requests come to them; so rows
    that move are open links, requests and answers, never links that are done.
    """
    requests = open_links.select(F.col("ancestor").alias("node")).distinct()

    def answers(links: DataFrame) -> DataFrame:
        held = links.select("node", F.col("ancestor").alias("further"), F.col("depth").alias("further_depth"))
        return requests.join(held.toDF(*held.columns), "node")

    told = reduce(DataFrame.unionByName, map(answers, [open_links, *known])).withColumnRenamed("node", "ancestor")
    return open_links.join(told, "ancestor", "left").select(
        "node",
        F.coalesce("further", "ancestor").alias("ancestor"),
        (F.col("depth") + F.coalesce("further_depth", F.lit(0))).alias("depth"),
        F.col("further").isNull().alias("at_root"),
    )


def resolve_chains(links: DataFrame) -> DataFrame:
    """(node, parent) -> (node, root, depth) for every node that has a parent.

    A root is a key without a parent of its own, whether or not it occurs as a node. Every round moves the links that
    still have somewhere to go on by what their ancestors know, and so doubles the distance they span: a
    chain of depth d takes about log2(d) rounds. Only open links are written per round; the ones that
    reached their root stay in the round they were written in. A parent that many nodes share is one request, and one
    large key on the probing side alone, which adaptive execution splits.

    Nodes on a cycle, or leading into one, have no root: they come back with null root and depth once
    the rounds suffice for a chain through all links.
    """
    spark = links.sparkSession
    depth = F.lit(1).cast("bigint").alias("depth")
    first = links.select("node", F.col("parent").alias("ancestor"), depth)
    open_links = write_clustered(first, new_table_path(spark), ["node"])
    rounds = open_links.count().bit_length() + 1
    known: list[DataFrame] = []
    for _ in range(rounds):
        stepped = write_clustered(next_step(open_links, known), new_table_path(spark), ["node"])
        known.append(stepped.filter("at_root").drop("at_root"))
        open_links = stepped.filter("not at_root").drop("at_root")
        if open_links.isEmpty():
            break
    endless = open_links.select(
        "node",
        F.lit(None).cast(open_links.schema["ancestor"].dataType).alias("ancestor"),
        F.lit(None).cast("bigint").alias("depth"),
    )
    return reduce(DataFrame.union, known, endless).withColumnRenamed("ancestor", "root")
