"""Connected components by repeated minimum and pointer jumping, as DataFrame joins.

Every round writes its labels to the checkpoint folder, so lineage stays short and a lost executor costs a round.
Nodes with very many edges meet in an inner join (which adaptive execution splits) and in a minimum (which is
combined before the shuffle). Edges and labels never reach the driver; it sees one number a round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parley.llm.chunks import settled, settled_with_sum


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for the nodes of edges (a, b); component is the least node that can be reached.

    Edges with a null end, loops and repeated edges change nothing; no edges give no rows.
    """
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = settled(both.where("a is not null and b is not null").distinct())
    labels = settled(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("component")))
    moved = 1
    while moved:
        seen = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("component").alias("near"))
        lower = labels.join(seen, "node").select("node", "component", F.least("component", "near").alias("least"))
        ahead = labels.select(F.col("node").alias("least"), F.col("component").alias("further"))
        jumped = lower.join(ahead, "least").select("node", F.least("least", "further").alias("next"), "component")
        marked = jumped.select("node", F.col("next").alias("component"), (F.col("next") != F.col("component")).cast("long").alias("moved"))
        after, moved = settled_with_sum(marked, "moved")
        labels = after.drop("moved")
    return labels
