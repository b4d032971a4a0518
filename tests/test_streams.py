"""Streams over time: metric buckets of published runs (W2), continuous alarms."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from claimsdq.operators.alarms import AlarmDef, alarm_definitions, alarm_events, alarm_transitions
from claimsdq.plans.batch import run_csv_job
from claimsdq.plans.store import Store
from claimsdq.streaming.alarm_stream import alarm_events_of, start_alarms
from claimsdq.streaming.metric_stream import hourly_now, start_published_hours
from test_ingest_pipeline import _at, _line, _write


def _done(q):
    q.awaitTermination()
    assert q.exception() is None


def _batch_buckets(store):
    p = store.points(folders=False).withColumn("period_start", F.date_trunc("hour", "ts").cast("timestamp_ntz"))
    return sorted(map(tuple, p.groupBy("namespace", "metric_name", "source_file", "period_start").agg(
        F.avg("value"), F.sum("value"), F.max("value"), F.min("value"), F.count("*")).collect()))


def test_metric_stream_follows_published_runs_only(spark, tmp, monkeypatch):
    src, out = f"{tmp}/raw", f"{tmp}/out"
    store = Store(spark, out)

    def stream():
        _done(start_published_hours(spark, out, f"{tmp}/hourly", f"{tmp}/ck"))
        return sorted(map(tuple, hourly_now(spark, f"{tmp}/hourly").collect()))

    def run(lines, at, **kw):
        _write(f"{src}/claims/a.csv", lines)
        run_csv_job(spark, f"{src}/claims", out, key_root=src, run_ts=at, **kw)

    _write(f"{src}/claims/b.csv", [_line(50)])
    run([_line(1), _line(2, npi="x")], _at(1))
    assert stream() == _batch_buckets(store) and len(stream()) == 14
    # a run that dies before it publishes feeds nothing
    with monkeypatch.context() as m:
        m.setattr(Store, "publish", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            run([_line(1), _line(3), _line(4)], _at(2, 5), run_id="again")
    assert stream() == _batch_buckets(store)
    # its retry is fed once
    run([_line(1), _line(3), _line(4)], _at(2, 5), run_id="again")
    buckets = stream()
    assert buckets == _batch_buckets(store)
    assert [r[5] for r in buckets if r[1] == "TotalRecords" and r[2] == "claims/a.csv"] == [3.0]
    # a corrected file in another hour, then a file that is empty now: what was fed is taken back
    run([_line(1)], _at(3, 7))
    assert stream() == _batch_buckets(store)
    run([], _at(4))
    buckets = stream()
    assert buckets == _batch_buckets(store) and {r[2] for r in buckets} == {"claims/b.csv"}
    # compacting the manifest feeds the same runs again and changes nothing
    store.compact_manifest()
    assert stream() == buckets


T0 = dt.datetime(2024, 1, 1)
HOUR = dt.timedelta(hours=1)
SCHEMA = "namespace string, metric_name string, source_file string, ts timestamp_ntz, value double, unit string"


def _defs():
    return [AlarmDef("two", "ns", "M", "f/", "Average", "LessThanThreshold", 5.0, 2, 3600, "low", "act"),
            AlarmDef("one", "ns", "N", None, "Sum", "GreaterThanThreshold", 10.0, 1, 3600, "high", "act"),
            AlarmDef("quiet", "ns", "N", None, "Maximum", "GreaterThanOrEqualToThreshold", 9.0, 3, 3600, None, None)]


class Feed:
    """Points given hour by hour; every push is a file and one run of the stream."""

    def __init__(self, spark, tmp):
        self.spark, self.tmp, self.all = spark, tmp, []

    def push(self, *points):
        rows = [("ns", m, d, T0 + at * HOUR, float(v), "None") for m, d, at, v in points]
        self.all += rows
        self.spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(f"{self.tmp}/points")
        src = self.spark.readStream.schema(SCHEMA).parquet(f"{self.tmp}/points")
        _done(start_alarms(self.spark, src, _defs(), f"{self.tmp}/out", f"{self.tmp}/ck", delay="1 hour"))

    def changes(self):
        rows = self.spark.read.parquet(f"{self.tmp}/out/changes").orderBy("timestamp", "alarm_name").collect()
        return [(r.alarm_name, r.state, (r.timestamp - T0) // HOUR) for r in rows]


def test_alarms_begin_and_end_on_the_stream(spark, tmp):
    feed = Feed(spark, tmp)
    feed.push(("M", "f/", 0, 1), ("M", "f/", 0.5, 3), ("M", "other/", 0, 0), ("N", "x", 0, 11))
    feed.push(("M", "f/", 1, 2), ("N", "x", 1, 3), ("N", "y", 1.2, 4))
    feed.push(("M", "f/", 2, 4))                 # "one" has no points in hour 2
    feed.push(("M", "f/", 3, 9))
    for end in (9, 20):
        feed.push(("Z", "clock", end, 0))        # time goes on, nothing else comes
    assert feed.changes() == [("one", "ALARM", 1), ("one", "OK", 2), ("two", "ALARM", 2), ("two", "OK", 4)]


def test_a_missing_period_ends_an_alarm_by_a_timer(spark, tmp):
    feed = Feed(spark, tmp)
    feed.push(("N", "x", 0, 50))
    feed.push(("Z", "clock", 2.5, 0))            # hour 0 is judged
    assert feed.changes() == [("one", "ALARM", 1)]
    feed.push(("Z", "clock", 6, 0))              # hour 1 never had a point
    assert feed.changes() == [("one", "ALARM", 1), ("one", "OK", 2)]
    feed.push(("N", "x", 6, 50))                 # and it begins anew
    feed.push(("Z", "clock", 20, 0))             # judges hour 6
    feed.push(("Z", "clock", 30, 0))             # tells that hour 7 is over too
    assert feed.changes()[2:] == [("one", "ALARM", 7), ("one", "OK", 8)]


def test_random_series_match_the_batch_evaluator(spark, tmp):
    r, feed = random.Random(11), Feed(spark, tmp)
    for start in range(0, 60, 12):
        feed.push(*[(r.choice("MN"), "f/", at + r.random(), r.choice([0, 3, 4, 6, 9, 12])) for at in range(start, start + 12)
                    for _ in range(2) if r.random() < 0.6], ("Z", "clock", start, 0))
    for end in (100, 200):
        feed.push(("Z", "clock", end, 0))
    points = spark.createDataFrame(feed.all, SCHEMA)
    want = [(x.alarm_name, (x.period_start - T0) // HOUR + 1) for x in
            alarm_transitions(points, alarm_definitions(spark, defs=_defs())).collect()]
    assert sorted(want) == sorted((name, at) for name, state, at in feed.changes() if state == "ALARM")
    events = alarm_events_of(spark.read.parquet(f"{feed.tmp}/out/changes"))
    assert sorted(map(str, events.collect())) == sorted(
        map(str, alarm_events(points, alarm_definitions(spark, defs=_defs())).select(*events.columns).collect()))
    # every alarm that began has ended
    assert sum(s == "ALARM" for _, s, _ in feed.changes()) == sum(s == "OK" for _, s, _ in feed.changes())
