import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from smeltworks.streaming.events import Arrivals, EventWindows, per_window

KIND = "ts timestamp, event_type string, value decimal(10,2)"


def minute(n):
    return datetime.datetime(2024, 1, 1, tzinfo=datetime.timezone.utc) + datetime.timedelta(minutes=n)


@pytest.fixture
def stream(spark, tmp_path):
    inbox = f"file://{tmp_path}/inbox"
    schema = T._parse_datatype_string(KIND)
    windows = EventWindows(spark, inbox, schema, f"file://{tmp_path}/home", "10 minutes", "5 minutes", ["event_type"], total=F.sum("value"))

    def arrive(*minutes):
        spark.createDataFrame([(minute(m), "a" if m % 2 else "b", 1) for m in minutes], "ts timestamp, event_type string, value int").selectExpr(
            "ts", "event_type", "cast(value AS decimal(10,2)) AS value"
        ).coalesce(1).write.mode("append").parquet(inbox)
        windows.run()

    return windows, arrive


def shown(df):
    return sorted((r.window_start.minute + 60 * r.window_start.hour, r.event_type, r.events, int(r.total)) for r in df.collect())


def test_windows_close_when_the_watermark_has_passed(stream):
    windows, arrive = stream
    arrive(1, 2, 3, 11)
    assert shown(windows.closed()) == [] and windows.arrivals() == Arrivals(4, 0, 4, 0)
    # 14 is within five minutes of the end of the first window, 16 is not.
    arrive(4, 14)
    assert shown(windows.closed()) == []
    arrive(5, 16)
    assert shown(windows.closed()) == [(0, "a", 3, 3), (0, "b", 2, 2)]
    assert windows.arrivals() == Arrivals(8, 5, 3, 0)
    # The first window is closed for good, the second one is not.
    arrive(6, 7, 12)
    assert windows.arrivals() == Arrivals(11, 5, 4, 2)
    arrive(40)
    assert shown(windows.closed()) == [(0, "a", 3, 3), (0, "b", 2, 2), (10, "a", 1, 1), (10, "b", 3, 3)]
    assert windows.arrivals() == Arrivals(12, 9, 1, 2)


def test_a_run_without_new_files_changes_nothing(stream):
    windows, arrive = stream
    arrive(1, 30)
    before = (shown(windows.closed()), windows.arrivals())
    windows.run()
    assert (shown(windows.closed()), windows.arrivals()) == before == ([(0, "a", 1, 1)], Arrivals(2, 1, 1, 0))


def test_a_table_gives_the_same_windows(spark):
    rows = spark.createDataFrame([(minute(m), "a", 1) for m in (1, 2, 11)], "ts timestamp, event_type string, value int")
    got = per_window(rows, "10 minutes", ["event_type"], total=F.sum("value"))
    assert shown(got) == [(0, "a", 2, 2), (10, "a", 1, 1)]
