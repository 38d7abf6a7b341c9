"""The event stream against a batch: late rows, a restart, a run without news."""

from datetime import datetime

from frames import rows

from martlet.streaming import windows

SCHEMA = "ts timestamp, event_type string, value double"


def at(day, hour=12):
    return datetime(2024, 3, day, hour)


def test_late_rows_and_restart(spark, tmp_path):
    stage, target, state = (str(tmp_path / n) for n in ("stage", "out", "state"))

    def run(*events):
        if events:
            spark.createDataFrame(list(events), SCHEMA).write.mode("append").parquet(stage)
        windows.close_days(spark, stage, SCHEMA, target, state, "2 days")
        return rows(windows.closed_days(spark, target), "day", "event_type", "n_events", "value_c")

    def so_far():
        got = windows.days_so_far(spark, stage, SCHEMA, target)
        return rows(got, "day", "event_type", "n_events", "value_c")

    def batch(*events):
        frame = spark.createDataFrame(list(events), SCHEMA)
        return rows(windows.by_day(frame), "day", "event_type", "n_events", "value_c")

    first = [(at(d), kind, d + 0.25) for d in range(1, 11) for kind in ("view", "click")]
    first += [(at(3), "view", None), (at(3), None, 1.0)]
    closed = run(*first)
    # newest event 10 March 12:00, so days up to 7 March are closed
    assert closed == batch(*[e for e in first if e[0] < at(8, 0)])
    assert so_far() == batch(*first)

    late, in_time = (at(2), "view", 100.0), (at(9), "view", 7.0)
    second = [in_time, *[(at(d), "view", 1.0) for d in (11, 12, 13)]]
    closed = run(late, *second)
    kept = [*first, *second]
    assert closed == batch(*[e for e in kept if e[0] < at(11, 0)])
    assert so_far() == batch(*kept)

    assert run() == closed and so_far() == batch(*kept)


def test_no_day_closed_yet(spark, tmp_path):
    stage, target, state = (str(tmp_path / n) for n in ("stage", "out", "state"))
    events = [(at(1), "view", 1.0), (None, "view", 1.0)]
    spark.createDataFrame(events, SCHEMA).write.parquet(stage)
    windows.close_days(spark, stage, SCHEMA, target, state)
    assert windows.closed_days(spark, target).isEmpty()
    got = rows(windows.days_so_far(spark, stage, SCHEMA, target), "event_type", "n_events", "value_c")
    assert got == [("view", 1, 100)]
