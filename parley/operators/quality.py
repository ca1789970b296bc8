"""Data-quality operators: each returns the rows that break its rule; null breaks only ``not_null``."""

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from typing import Any

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from parley.operators.segments import ROWS_PER_SEGMENT


def unique(df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once, with their count."""
    return (
        df.filter(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count("*").alias("occurrences"))
        .filter("occurrences > 1")
    )


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(is_null(column))


def accepted_values(df: DataFrame, column: str, values: Sequence[Any]) -> DataFrame:
    return df.filter(not_accepted(column, values))


def accepted_range(df: DataFrame, column: str, lo: Any = None, hi: Any = None) -> DataFrame:
    """Rows outside the inclusive range; either end may be open."""
    return df.filter(out_of_range(column, lo, hi))


def expression_is_true(df: DataFrame, expression: str) -> DataFrame:
    return df.filter(is_false(expression))


def is_null(column: str) -> Column:
    return F.col(column).isNull()


def not_accepted(column: str, values: Sequence[Any]) -> Column:
    return ~F.col(column).isin(list(values))


def out_of_range(column: str, lo: Any = None, hi: Any = None) -> Column:
    below = F.lit(False) if lo is None else F.col(column) < lo
    above = F.lit(False) if hi is None else F.col(column) > hi
    return below | above


def is_false(expression: str) -> Column:
    return ~F.expr(expression)


def sequential_values(
    df: DataFrame,
    column: str,
    by: Sequence[str],
    interval: int = 1,
    values_per_segment: int = ROWS_PER_SEGMENT,
) -> DataFrame:
    """Values of an integer column that do not follow the one before them in their group by ``interval``.

    Repeats are counted first, so a value that fills the table is one row here. Values are then compared
    within (group, value range): the last ``interval`` values of a range are also given to the next one,
    so a value without a neighbour there has no predecessor at the right distance at all. That is a
    failure unless it is the lowest of its group. Returns the failing values with the number of failing
    rows.
    """
    value = F.col(column)
    counted = df.filter(value.isNotNull()).groupBy(*by, column).agg(F.count("*").alias("copies"))
    home = F.floor(value / F.lit(values_per_segment)).cast("bigint")
    offset = F.pmod(value, F.lit(values_per_segment))
    ranges = F.when(offset >= values_per_segment - interval, F.array(home, home + 1)).otherwise(
        F.array(home)
    )
    order = Window.partitionBy(*by, "segment").orderBy(column)
    previous = F.col("previous_value")
    breaks = previous.isNull() | (previous != value - interval)
    suspects = (
        counted.withColumn("segment", F.explode(ranges))
        .withColumn("previous_value", F.lag(column).over(order))
        .filter(F.col("segment") == home)
        .withColumn("failures", F.col("copies") - 1 + breaks.cast("bigint"))
        .filter("failures > 0")
    )
    lowest = df.groupBy(*by).agg(F.min(column).alias(column)).withColumn("is_lowest", F.lit(1))
    is_lowest = F.coalesce("is_lowest", F.lit(0))
    same = [suspects[c].eqNullSafe(lowest[c]) for c in by] + [suspects[column] == lowest[column]]
    condition = same[0]
    for term in same[1:]:
        condition = condition & term
    return (
        suspects.join(lowest, condition, "left")
        .select(*[suspects[c] for c in by], suspects[column], (F.col("failures") - is_lowest).alias("failures"))
        .filter("failures > 0")
    )


@dataclass(frozen=True)
class RowCheck:
    """A rule on single rows: ``breaks`` holds for the rows that break it."""

    rule: str
    subject: str
    breaks: Column
    severity: str = "error"


@dataclass(frozen=True)
class SetCheck:
    """A rule on the table as a whole: ``failing`` has the column ``failures`` or one row per failure."""

    rule: str
    subject: str
    failing: DataFrame
    severity: str = "error"


def report(df: DataFrame, row_checks: Sequence[RowCheck], set_checks: Sequence[SetCheck]) -> DataFrame:
    """One row per check: rule, subject, severity, failures and outcome.

    All row checks share one pass over the table; only their counts leave the tasks.
    """
    counts = df.agg(*_counts(row_checks))
    lines = F.array(
        *[_line(check, F.col(f"c{i}")) for i, check in enumerate(row_checks)]
    )
    return with_outcome(_with_sets(counts.select(F.inline(lines)), set_checks))


def checked_while_written(
    df: DataFrame,
    row_checks: Sequence[RowCheck],
    write: Callable[[DataFrame], DataFrame],
    set_checks: Callable[[DataFrame], Sequence[SetCheck]],
) -> tuple[DataFrame, DataFrame]:
    """The table that ``write`` wrote and returned, and its report.

    Row checks are counted while the rows pass to the files (observed metrics of the writing tasks), so they cost no read
    at all. Set checks read their few columns of what was written. ``write`` must write the rows as they come: behind a
    further exchange a lost executor would have rows counted again.
    """
    seen = Observation()
    written = write(df.observe(seen, *_counts(row_checks)))
    try:
        counted = seen.get
    except Py4JJavaError:
        # Where the optimizer finds beforehand that there are no rows, it leaves the observation out.
        if not written.isEmpty():
            raise
        counted = {f"c{i}": 0 for i in range(len(row_checks))}
    found = [(c.rule, c.subject, c.severity, int(counted[f"c{i}"])) for i, c in enumerate(row_checks)]
    findings = df.sparkSession.createDataFrame(found, "rule string, subject string, severity string, failures bigint")
    return written, with_outcome(_with_sets(findings, set_checks(written)))


def _counts(row_checks: Sequence[RowCheck]) -> list[Column]:
    return [F.count_if(check.breaks).alias(f"c{i}") for i, check in enumerate(row_checks)]


def _with_sets(findings: DataFrame, set_checks: Sequence[SetCheck]) -> DataFrame:
    for check in set_checks:
        each = F.col("failures") if "failures" in check.failing.columns else F.lit(1)
        total = check.failing.agg(F.coalesce(F.sum(each), F.lit(0)).cast("bigint").alias("n"))
        findings = findings.union(total.select(F.inline(F.array(_line(check, F.col("n"))))))
    return findings


def with_outcome(findings: DataFrame) -> DataFrame:
    outcome = F.when(F.col("failures") == 0, "pass").otherwise(
        F.when(F.col("severity") == "warn", "warn").otherwise("fail")
    )
    return findings.withColumn("outcome", outcome)


def _line(check: RowCheck | SetCheck, failures: Column) -> Column:
    return F.struct(
        F.lit(check.rule).alias("rule"),
        F.lit(check.subject).alias("subject"),
        F.lit(check.severity).alias("severity"),
        failures.alias("failures"),
    )
