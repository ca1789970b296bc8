from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from parley.functions import decoders, moments, phones, rules, texts

c = F.col


def evaluate(spark, expression, value, ddl):
    """One expression over one value in column x."""
    return spark.createDataFrame([(value,)], f"x {ddl}").select(expression.alias("r")).first().r


@pytest.mark.parametrize(
    ("ns", "expected"),
    [
        (0, datetime(2001, 1, 1)),
        (None, None),
        (1_500_000_000, datetime(2001, 1, 1, 0, 0, 1, 500000)),
        (728_352_000_000_000_000, datetime(2024, 1, 31)),
        (1_600, datetime(2001, 1, 1, 0, 0, 0, 2)),
        (-1_000_000_000, datetime(2000, 12, 31, 23, 59, 59)),
    ],
)
def test_epoch(spark, ns, expected):
    assert evaluate(spark, moments.epoch_ns(c("x")), ns, "bigint") == expected


def test_epoch_zero_means_never(spark):
    assert evaluate(spark, moments.epoch_ns_or_null(c("x")), 0, "bigint") is None


@pytest.mark.parametrize(
    ("start", "end", "minutes", "seconds", "days"),
    [
        ("2024-01-01 00:00:59", "2024-01-01 00:01:00", 1, 1, 0),
        ("2024-01-01 00:00:00", "2024-01-01 00:00:59.999", 0, 59, 0),
        ("2024-01-01 23:59:59", "2024-01-02 00:00:00", 1, 1, 1),
        ("2024-01-01 00:01:00", "2024-01-01 00:00:59", -1, -1, 0),
        ("1969-12-31 23:59:30", "1970-01-01 00:00:30", 1, 60, 1),
    ],
)
def test_boundaries_between(spark, start, end, minutes, seconds, days):
    row = (
        spark.createDataFrame([(start, end)], "a string, b string")
        .select(c("a").cast("timestamp_ntz").alias("a"), c("b").cast("timestamp_ntz").alias("b"))
        .select(
            moments.minutes_between(c("a"), c("b")).alias("m"),
            moments.seconds_between(c("a"), c("b")).alias("s"),
            moments.days_between(c("a"), c("b")).alias("d"),
        )
        .first()
    )
    assert (row.m, row.s, row.d) == (minutes, seconds, days)


def test_time_dims_and_classes(spark):
    at = F.lit("2024-02-04 22:15:30").cast("timestamp_ntz")
    columns = {**moments.time_dims(at), **moments.time_classes(at)}
    row = spark.range(1).select(*[v.alias(k) for k, v in columns.items()]).first().asDict()
    assert row == {
        "message_hour": datetime(2024, 2, 4, 22),
        "message_date_day": datetime(2024, 2, 4),
        "message_week": datetime(2024, 1, 29),
        "message_month": datetime(2024, 2, 1),
        "message_quarter": datetime(2024, 1, 1),
        "message_year": datetime(2024, 1, 1),
        "hour_of_day": 22,
        "day_of_week": 0,
        "day_of_month": 4,
        "month_of_year": 2,
        "year": 2024,
        "time_of_day": "night",
        "day_type": "weekend",
        "day_name": "Sunday",
    }


@pytest.mark.parametrize(
    ("hour", "expected"),
    [(5, "night"), (6, "morning"), (11, "morning"), (12, "afternoon"), (17, "afternoon"),
     (18, "evening"), (21, "evening"), (22, "night"), (0, "night")],
)
def test_time_of_day_edges(spark, hour, expected):
    at = c("x").cast("timestamp_ntz")
    value = f"2024-01-01 {hour:02d}:00:00"
    assert evaluate(spark, moments.time_classes(at)["time_of_day"], value, "string") == expected


@pytest.mark.parametrize(
    ("number", "normalized"),
    [
        ("+1 (555) 010-1234", "5550101234"),
        ("15550101234", "5550101234"),
        ("25550101234", "25550101234"),
        ("5550101234", "5550101234"),
        ("155501012345", "155501012345"),
        ("no digits", ""),
        (None, None),
    ],
)
def test_normalize(spark, number, normalized):
    assert evaluate(spark, phones.normalize_us(c("x")), number, "string") == normalized


@pytest.mark.parametrize(
    ("number", "expected"),
    [
        ("+15550101234", "us_number"),
        ("+445550101234", "international"),
        ("1234567890", "us_local"),
        ("1234567890\n", "other"),
        ("88888", "short_code"),
        ("1234567", "other"),
        ("911", "other"),
    ],
)
def test_phone_type(spark, number, expected):
    assert evaluate(spark, phones.phone_type(c("x")), number, "string") == expected


def test_without_country_code(spark):
    for identifier, expected in [("+15550", "5550"), ("+445550", "+445550"), ("a@b", "a@b")]:
        assert evaluate(spark, phones.without_country_code(c("x")), identifier, "string") == expected


def test_ellipsize_counts_characters(spark):
    for text, expected in [("abcde", "abcde"), ("abcdef", "abcde..."), ("äöüßé", "äöüßé"),
                           ("äöüßéx", "äöüßé..."), ("", ""), (None, None)]:
        assert evaluate(spark, texts.ellipsize(c("x"), 5), text, "string") == expected


def test_concat_reads_null_as_empty(spark):
    assert evaluate(spark, texts.concat_nulls_empty("a", c("x"), "b"), None, "bigint") == "ab"


def test_not_blank_trims_spaces_only(spark):
    for text, expected in [("  ", False), ("\t", True), ("", False), (None, None)]:
        assert evaluate(spark, texts.not_blank(c("x")), text, "string") == expected


def test_bucket_rules_and_null(spark):
    bounds = [(2, "low"), (5, "mid")]
    for value, up, least in [(2, "low", "low"), (3, "mid", "low"), (9, "high", "low"), (None, "high", "none")]:
        assert evaluate(spark, rules.up_to(c("x"), bounds, "high"), value, "int") == up
        assert evaluate(spark, rules.at_least(c("x"), bounds, "none"), value, "int") == least


def test_share_of_nothing(spark):
    zero = F.lit(0)
    assert evaluate(spark, rules.share(F.lit(3), c("x"), zero), 0, "int") == 0.0
    assert evaluate(spark, rules.share(F.lit(3), c("x"), None), 0, "int") is None
    assert evaluate(spark, rules.share(F.lit(3), c("x"), zero), 4, "int") == 0.75


def test_utf8_decoder(spark):
    for body, text in [(b"", None), (None, None), ("grüß".encode(), "grüß"), (b"a\xffb", None), (b"\x04\x0bstream\x81\xe8", None)]:
        assert evaluate(spark, decoders.utf8(c("x")), body, "binary") == text


def test_days_between_date_and_timestamp(spark):
    days = moments.days_between(c("x").cast("timestamp_ntz"), F.lit(date(2024, 2, 2)))
    assert evaluate(spark, days, "2024-01-30 23:59:59", "string") == 3
