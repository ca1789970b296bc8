"""Results do not depend on the session's time zone."""

import pytest

from parley.plans import timeseries
from tests.handmade import int_messages, message, sources

# Around a clock change of either zone or neither; the times are naive.
MOMENTS = ["2024-03-10 01:59:30", "2024-03-10 02:30:00", "2024-03-10 03:00:10", "2024-11-03 01:30:00", "2024-11-03 06:59:59", "1985-12-31 23:50:00"]


@pytest.fixture
def in_zone(spark):
    before = spark.conf.get("spark.sql.session.timeZone")

    def built(zone):
        spark.conf.set("spark.sql.session.timeZone", zone)
        rows = [message(i, at, sent=i % 2, date_read=800_000_000_000_000_000) for i, at in enumerate(MOMENTS, 1)]
        messages = int_messages(sources(spark, rows))
        series = timeseries.mart_message_timeseries(messages)
        return sorted(map(str, messages.collect())), sorted(map(str, series.collect()))

    yield built
    spark.conf.set("spark.sql.session.timeZone", before)


@pytest.mark.parametrize("zone", ["America/New_York", "Asia/Kathmandu"])
def test_same_in_every_zone(in_zone, zone):
    assert in_zone(zone) == in_zone("UTC")
