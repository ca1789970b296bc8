"""Windows over groups of any size.

A plain window puts a whole group into one task. Here a group is cut along its order into segments, windows
run per (group, segment), and what a row needs from outside its segment is brought to it:

* ``sequence_rows`` numbers the rows of a group 1..n in the order of (time, id), where nothing is known
  of the positions yet. Segments are the parts of a range partitioning, which Spark balances by a sample of
  the keys: any group, time or run of equal times is split as far as its size asks for.
* ``with_halo`` cuts rows that already carry such a dense position, and copies the few rows next to a
  cut into the neighbouring segment.

Where the cuts are only decides which task does what; any set of them gives the same result.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parley.session import cut_lineage

ROWS_PER_SEGMENT = 2_000_000

_LAST = (1 << 63) - 1


def sequence_rows(
    rows: DataFrame, group: str, at: Column, tie: str, carry: Sequence[str], parts: int | None = None, along: Sequence[str] = ()
) -> DataFrame:
    """(group, tie, *carry, *along) of each row with its ``position`` 1..n in its group, by (at, tie), and ``prev_*`` and
    ``next_*`` of carry.

    A null time sorts last; tie must be unique within the group. Rows should be narrow: the wide ones join
    the result by tie. ``parts`` is the number of parts, by default Spark's own choice. The parts are
    written once, because the sample that places the cuts may come out differently when it is taken again.
    """
    keys = rows.select(group, F.coalesce(at, F.lit(_LAST)).alias("_at"), tie, *carry, *along)
    order = (group, "_at", tie)
    dealt = keys.repartitionByRange(parts, *order) if parts else keys.repartitionByRange(*order)
    dealt = cut_lineage(dealt.withColumn("_part", F.spark_partition_id()))
    # A checkpoint keeps the column identities of the rows it came from; joins need its own.
    dealt = dealt.toDF(*dealt.columns)

    row = F.struct(F.col("_at"), F.col(tie), *carry)
    sizes = dealt.groupBy(group, "_part").agg(
        F.count("*").alias("_rows"), F.min(row).alias("_first"), F.max(row).alias("_last")
    )
    parts_of = Window.partitionBy(group).orderBy("_part")
    before = parts_of.rowsBetween(Window.unboundedPreceding, -1)
    # Groups within one part need nothing from elsewhere; the others have a row for each part they touch.
    edges = (
        sizes.select(
            group,
            "_part",
            "_rows",
            F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"),
            F.lag("_last").over(parts_of).alias("_row_before"),
            F.lead("_first").over(parts_of).alias("_row_after"),
        )
        .filter(F.col("_row_before").isNotNull() | F.col("_row_after").isNotNull())
    )
    edges = edges.toDF(*edges.columns)

    inside = Window.partitionBy(group, "_part").orderBy("_at", tie)
    numbered = dealt.withColumns(
        {
            "position": F.row_number().over(inside).cast("bigint"),
            **{f"prev_{c}": F.lag(c).over(inside) for c in carry},
            **{f"next_{c}": F.lead(c).over(inside) for c in carry},
        }
    )
    position = F.col("position")
    stitched = {"position": position + F.coalesce("_before", F.lit(0))}
    for c in carry:
        prev, following = f"prev_{c}", f"next_{c}"
        stitched[prev] = F.when(position == 1, F.col(f"_row_before.{c}")).otherwise(F.col(prev))
        stitched[following] = F.when(position == F.col("_rows"), F.col(f"_row_after.{c}")).otherwise(F.col(following))
    return (
        numbered.join(edges, [group, "_part"], "left")
        .withColumns(stitched)
        .select(group, tie, *[c for c in carry if c != tie], *along, "position", *[f"{side}_{c}" for side in ("prev", "next") for c in carry])
    )


def with_halo(
    rows: DataFrame, position: str, before: int, after: int, rows_per_segment: int = ROWS_PER_SEGMENT
) -> DataFrame:
    """Cut rows by their dense position within the group, 1..n.

    Adds ``segment`` and ``is_own``. The last ``before`` rows of a segment appear again at the head of
    the next one and the first ``after`` rows at the tail of the previous one, with ``is_own`` false:
    windows reach over the cut through these copies, which are dropped afterwards. The copies are taken by filters of
    their own, whose first part is a bound on the position that the statistics of a table answer: where no group is
    longer than a segment, nothing is read for them.
    """
    if rows_per_segment <= before + after:
        raise ValueError("a segment must be longer than its halo")
    index = F.col(position) - 1
    home = F.floor(index / F.lit(rows_per_segment)).cast("bigint")
    offset = index % rows_per_segment

    def placed(part: DataFrame, segment: Column, own: bool) -> DataFrame:
        return part.withColumns({"segment": segment, "is_own": F.lit(own)})

    last = rows.filter((F.col(position) > rows_per_segment - before) & (offset >= rows_per_segment - before))
    first = rows.filter((F.col(position) > rows_per_segment) & (offset < after))
    return placed(rows, home, True).unionByName(placed(last, home + 1, False)).unionByName(placed(first, home - 1, False))
