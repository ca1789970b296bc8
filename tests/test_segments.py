"""Split groups must give what one window per group would give."""

import random

import pytest
from pyspark.sql import functions as F

from parley.operators import segments


def brute_force(rows):
    """(group, id) -> (position, previous value, next value), null times last."""
    result = {}
    for group in {r[0] for r in rows}:
        ordered = sorted((r for r in rows if r[0] == group), key=lambda r: (r[1] is None, r[1] or 0, r[2]))
        for i, row in enumerate(ordered):
            before = ordered[i - 1][3] if i else None
            after = ordered[i + 1][3] if i + 1 < len(ordered) else None
            result[row[0], row[2]] = (i + 1, before, after)
    return result


def random_rows(seed, size):
    """One group holds most rows; half of that group shares one time and some have none."""
    rng = random.Random(seed)
    rows = []
    for i in range(size):
        group = rng.choice([0, 0, 0, 1, 2, rng.randrange(3, 40)])
        at = rng.choice([7, rng.randrange(100), rng.randrange(-50, 10**6), None])
        rows.append((group, at, i, rng.choice(["a", "b", "c", None])))
    return rows


@pytest.mark.parametrize("parts", [None, 1, 2, 16, 90, 300])
def test_sequence_equals_brute_force(spark, parts):
    rows = random_rows(parts or 0, 900)
    df = spark.createDataFrame(rows, "grp bigint, at bigint, id bigint, v string").repartition(5)
    got = {
        (r.grp, r.id): (r.position, r.prev_v, r.next_v)
        for r in segments.sequence_rows(df, "grp", F.col("at"), "id", ["v"], parts).collect()
    }
    assert got == brute_force(rows)


def test_no_rows_to_sequence(spark):
    df = spark.createDataFrame([], "grp bigint, at bigint, id bigint, v string")
    assert segments.sequence_rows(df, "grp", F.col("at"), "id", ["v"]).count() == 0


def test_no_cuts_in_rows_and_no_lambdas(spark):
    """Cuts never travel with the rows, as arrays that are searched."""
    df = spark.createDataFrame(random_rows(1, 50), "grp bigint, at bigint, id bigint, v string")
    plan = segments.sequence_rows(df, "grp", F.col("at"), "id", ["v"], 8)._jdf.queryExecution().executedPlan().toString()
    assert "lambda" not in plan and "array" not in plan


def test_halo_copies_the_rows_next_to_a_cut(spark):
    df = spark.range(1, 21).withColumnRenamed("id", "n")
    halo = segments.with_halo(df, "n", before=2, after=1, rows_per_segment=8)
    got = {}
    for r in halo.collect():
        got.setdefault(r.segment, {"own": set(), "copy": set()})["own" if r.is_own else "copy"].add(r.n)
    assert got == {
        0: {"own": set(range(1, 9)), "copy": {9}},
        1: {"own": set(range(9, 17)), "copy": {7, 8, 17}},
        2: {"own": {17, 18, 19, 20}, "copy": {15, 16}},
    }


def test_halo_must_fit(spark):
    with pytest.raises(ValueError, match="halo"):
        segments.with_halo(spark.range(1), "id", before=4, after=1, rows_per_segment=5)
