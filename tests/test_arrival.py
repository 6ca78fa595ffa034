from datetime import UTC, datetime, timedelta, timezone

import pytest

from tidewell.functions.arrival import arrival, frontier, window_of


def at(h, m, s=0):
    return datetime(2024, 5, 1, h, m, s, tzinfo=UTC)


@pytest.mark.parametrize(
    ("event", "ingested", "late", "very", "future"),
    [
        (at(10, 1), at(10, 8), True, False, False),
        (at(10, 1), at(10, 5), True, False, False),
        (at(10, 1), at(10, 4, 59), False, False, False),
        (at(10, 1), at(10, 30), True, True, False),
        (at(10, 1), at(10, 11), True, False, False),
        (at(10, 10), at(10, 4), False, False, True),
        (at(10, 10), at(10, 5), False, False, False),
        (at(10, 1), None, False, False, False),
    ],
)
def test_arrivals_as_specified_and_in_spark(spark, event, ingested, late, very, future):
    from pyspark.sql import functions as F

    from tidewell.operators.windows import with_arrival

    got = arrival(event, ingested)
    assert (got["is_late"], got["is_very_late"], got["is_future_dated"]) == (late, very, future)
    assert got["is_ingestion_unknown"] is (ingested is None)
    naive = lambda t: t and t.replace(tzinfo=None)
    post = spark.createDataFrame([("t", 0, 1, naive(event), naive(ingested))], "log_topic string, log_partition int, log_offset long, event_time timestamp_ntz, ingested_at timestamp_ntz")
    row = with_arrival(post).select("*", F.col("window_start").alias("s")).first()
    assert (row.is_late, row.is_very_late, row.is_future_dated, row.is_ingestion_unknown) == (int(late), int(very), int(future), int(ingested is None))
    assert row.window_start == naive(got["window_start"]) and row.delay_seconds == got["delay_seconds"]


def test_windows_are_half_open_and_in_utc():
    assert window_of(at(10, 4, 59))[0] == at(10, 0) and window_of(at(10, 5))[0] == at(10, 5)
    assert window_of(datetime(2024, 5, 1, 12, 1, tzinfo=timezone(timedelta(hours=2))))[0] == at(10, 0)
    with pytest.raises(ValueError):
        window_of(datetime(2024, 5, 1))


def test_frontier():
    lag = timedelta(minutes=10)
    assert frontier(at(10, 8), lag) == at(9, 58) < at(10, 1)
    assert frontier(at(10, 20), lag) == at(10, 10) > at(10, 2)
    with pytest.raises(ValueError):
        frontier(at(10, 0), timedelta(seconds=-1))
