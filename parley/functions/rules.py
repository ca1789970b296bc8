"""Ordered class rules."""

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def first_match(rules: Sequence[tuple[Column, Column | str]], otherwise: Column | str | None = None) -> Column:
    """The value of the first rule that holds; null (or ``otherwise``) when none does."""
    (condition, value), *rest = rules
    chain = F.when(condition, value)
    for condition, value in rest:
        chain = chain.when(condition, value)
    return chain if otherwise is None else chain.otherwise(otherwise)


def up_to(value: Column, bounds: Sequence[tuple[float, str]], above: str) -> Column:
    """Label of the first bound that ``value`` does not exceed; null counts as above all bounds."""
    return first_match([(value <= bound, F.lit(label)) for bound, label in bounds], F.lit(above))


def at_least(value: Column, bounds: Sequence[tuple[float, str]], below: str) -> Column:
    """Label of the first bound that ``value`` reaches; null counts as below all bounds."""
    return first_match([(value >= bound, F.lit(label)) for bound, label in bounds], F.lit(below))


def between_rule(value: Column, ranges: Sequence[tuple[int, int, str]], otherwise: str) -> Column:
    """Label of the first inclusive range that holds ``value``."""
    return first_match([(value.between(lo, hi), F.lit(label)) for lo, hi, label in ranges], F.lit(otherwise))


def holds(condition: Column) -> Column:
    """The condition with null read as false."""
    return F.coalesce(condition, F.lit(False))


def share(part: Column, whole: Column, empty: Column | None) -> Column:
    """``part / whole`` in double precision; ``empty`` where ``whole`` is not positive."""
    ratio = F.when(whole > 0, part.cast("double") / whole)
    return ratio if empty is None else ratio.otherwise(empty.cast("double"))
