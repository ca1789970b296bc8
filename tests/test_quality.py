import random

import pytest
from pyspark.sql import functions as F

from parley.operators import quality
from parley.operators.quality import RowCheck, SetCheck
from parley.plans import contract


@pytest.fixture(scope="module")
def df(spark):
    rows = [(1, "a", 5, True), (2, "b", 0, False), (2, None, 11, None), (None, "c", None, True)]
    return spark.createDataFrame(rows, "id bigint, kind string, n int, flag boolean")


def test_unique(df):
    assert [tuple(r) for r in quality.unique(df, "id").collect()] == [(2, 2)]
    assert quality.unique(df, "n").count() == 0


def test_not_null(df):
    assert quality.not_null(df, "kind").count() == 1
    assert quality.not_null(df.filter("kind is not null"), "kind").count() == 0


def test_accepted_values(df):
    assert [r.kind for r in quality.accepted_values(df, "kind", ["a", "b"]).collect()] == ["c"]
    assert quality.accepted_values(df, "flag", [True, False]).count() == 0
    assert quality.accepted_values(df, "flag", [True]).count() == 1


def test_accepted_range(df):
    assert sorted(r.n for r in quality.accepted_range(df, "n", 1, 10).collect()) == [0, 11]
    assert [r.n for r in quality.accepted_range(df, "n", lo=1).collect()] == [0]
    assert [r.n for r in quality.accepted_range(df, "n", hi=10).collect()] == [11]
    assert quality.accepted_range(df, "n", 0, 11).count() == 0


def test_expression(df):
    assert [r.n for r in quality.expression_is_true(df, "n > 0 OR flag").collect()] == [0]


def sequence_failures(values, interval=1):
    failures = {}
    for group in {g for g, _ in values}:
        ordered = sorted(v for g, v in values if g == group and v is not None)
        for before, value in zip(ordered, ordered[1:], strict=False):
            if value != before + interval:
                failures[group, value] = failures.get((group, value), 0) + 1
    return failures


@pytest.mark.parametrize(("values_per_segment", "interval"), [(4, 1), (50, 1), (4, 2), (2_000_000, 1)])
def test_sequential_values(spark, values_per_segment, interval):
    rng = random.Random(values_per_segment)
    values = [(0, v * interval) for v in range(-20, 60) if rng.random() < 0.9]
    values += [(1, v) for v in range(30)] + [(2, 7)] * 5 + [(None, 3), (None, 90), (3, None)]
    values += [(0, rng.randrange(40)) for _ in range(10)]
    rows = spark.createDataFrame(values, "g bigint, v bigint")
    got = quality.sequential_values(rows, "v", ["g"], interval, values_per_segment)
    assert {(r.g, r.v): r.failures for r in got.collect()} == sequence_failures(values, interval)


def test_report(df):
    checks = [
        RowCheck("not_null", "kind", quality.is_null("kind")),
        RowCheck("not_null", "flag", quality.is_null("flag"), "warn"),
        RowCheck("accepted_range", "n", quality.out_of_range("n", 0, 11)),
    ]
    sets = [SetCheck("unique", "id", quality.unique(df, "id"))]
    got = {(r.rule, r.subject): (r.severity, r.failures, r.outcome) for r in quality.report(df, checks, sets).collect()}
    assert got == {
        ("not_null", "kind"): ("error", 1, "fail"),
        ("not_null", "flag"): ("warn", 1, "warn"),
        ("accepted_range", "n"): ("error", 0, "pass"),
        ("unique", "id"): ("error", 1, "fail"),
    }


def test_report_over_nothing(df):
    empty = df.filter(F.lit(False))
    report = quality.report(empty, [RowCheck("not_null", "kind", quality.is_null("kind"))], [])
    assert [r.outcome for r in report.collect()] == ["pass"]


def test_contract_has_every_check():
    assert len(contract.NOT_NULL) == 29
    assert len(contract.ACCEPTED_VALUES) == 18
    assert len(contract.ACCEPTED_RANGE) == 13
    assert len(contract.EXPRESSIONS) == 4
    assert len(contract.UNIQUE) + 1 == 3


def test_checks_counted_while_written(spark, tmp_path):
    """The same report as from the written table, which row checks never read."""
    df = spark.createDataFrame([(1, "a"), (2, None), (2, "z"), (None, "b")], "x int, y string").repartition(3)
    rows = [quality.RowCheck("not_null", "y", quality.is_null("y")), quality.RowCheck("accepted_values", "y", quality.not_accepted("y", ["a", "b"]), "warn")]
    sets = lambda t: [quality.SetCheck("unique", "x", quality.unique(t, "x"))]
    path = str(tmp_path / "written")

    def write(d):
        d.write.parquet(path)
        return spark.read.parquet(path).select("x")

    written, report = quality.checked_while_written(df, rows, write, sets)
    want = sorted(quality.report(df, rows, sets(df)).collect())
    assert sorted(report.collect()) == want
    assert spark.read.parquet(path).count() == 4
    assert {r["subject"]: r["failures"] for r in want} == {"x": 1, "y": 1} and len(want) == 3


@pytest.mark.parametrize("how", ["known to be empty", "found empty"])
def test_checks_of_an_empty_table(spark, tmp_path, how):
    path = str(tmp_path / "empty")

    def write(d):
        d.write.parquet(path)
        return spark.read.schema("x int").parquet(path)

    empty = spark.createDataFrame([], "x int") if how == "found empty" else spark.range(3).selectExpr("cast(id as int) as x").filter("false")
    _, report = quality.checked_while_written(empty, [quality.RowCheck("not_null", "x", quality.is_null("x"))], write, lambda t: [])
    assert [tuple(r) for r in report.collect()] == [("not_null", "x", "error", 0, "pass")]
