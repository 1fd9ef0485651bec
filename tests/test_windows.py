"""Windows over a stream that stops and goes on."""

from datetime import datetime, timedelta

from trackloom.streaming import windows

T0 = datetime(2024, 1, 1)


def events(spark, rows):
    return spark.createDataFrame([(T0 + timedelta(minutes=m) if m is not None else None, k, v) for m, k, v in rows], "at timestamp, kind string, value double")


def told(df):
    return sorted((r.start, r.kind, r.n, r.total) for r in df.collect())


def test_windows_of_a_stopped_stream(spark):
    parts = [events(spark, [(1, "a", 1.0), (59, "a", 2.0), (61, "b", 4.0), (None, "a", 9.0)]), events(spark, [(62, "b", 8.0), (200, "a", 16.0)]), events(spark, [(10, "a", 99.0), (11, "b", 99.0), (201, "a", 1.0)])]
    found, late = windows.closed(parts, "1 hour", "10 minutes")
    assert told(found) == [(T0, "a", 2, 3.0), (T0 + timedelta(hours=1), "b", 2, 12.0), (T0 + timedelta(hours=3), "a", 2, 17.0)]
    assert late == 2


def test_no_events(spark):
    found, late = windows.closed([events(spark, [])], "1 hour", "10 minutes")
    assert told(found) == [] and late == 0
