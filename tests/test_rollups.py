"""Rollups that follow runs equal a full pass over what holds."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from claimsdq.plans.rollups import KEY, LEVELS, PARTIALS, Rollups, full_pass
from claimsdq.plans.store import Store
from test_ingest_pipeline import UTC

SCHEMA = "namespace string, metric_name string, source_file string, ts timestamp_ntz, value double, unit string, date date"
T0 = dt.datetime(2024, 3, 1)


def _publish(store, run, at, points, files):
    rows = [("ns", m, f, ts, float(v), "Count", ts.date()) for m, f, ts, v in points]
    store.write("metrics/points", run, store.spark.createDataFrame(rows, SCHEMA))
    if files is not None:
        store.publish(run, store.spark.createDataFrame([(f,) for f in files], "source_file string"), at)


def _equal(store):
    rollups = Rollups(store)
    want = sorted((r["level"], *[r[k] for k in KEY], *[round(r[p], 6) for p in PARTIALS]) for r in
                  full_pass(store.points(folders=False)).collect())
    got = sorted((level, *[r[k] for k in KEY], *[round(r[p], 6) for p in PARTIALS]) for level in LEVELS
                 for r in rollups.read(level).collect())
    assert got == want
    return got


@pytest.mark.parametrize("seed", [1])
def test_random_runs_and_reruns(spark, tmp, seed):
    r, store = random.Random(seed), Store(spark, f"{tmp}/out")
    rollups = Rollups(store)
    files = [f"claims/{n}.csv" for n in range(5)] + ["other/x.csv"]
    for n in range(4):
        some = r.sample(files, r.randint(1, 4)) if n else files
        points = [(m, f, T0 + dt.timedelta(hours=r.randint(0, 24 * 70), minutes=r.randint(0, 59)), r.randint(-50, 50))
                  for f in some for m in ("A", "B") for _ in range(r.randint(0, 6))]
        _publish(store, f"run{n}", dt.datetime(2024, 6, 1 + n, tzinfo=UTC), points, some)
        assert rollups.apply_all() == [f"run{n}"] and rollups.apply(f"run{n}") == n
        _equal(store)


def test_extremes_come_back_and_only_touched_rows_are_written(spark, tmp):
    store = Store(spark, f"{tmp}/out")
    rollups, day = Rollups(store), dt.timedelta(days=1)
    at = lambda n: dt.datetime(2024, 6, n, tzinfo=UTC)
    _publish(store, "a", at(1), [("M", "c/1", T0, 5), ("M", "c/2", T0, 9), ("M", "c/2", T0 + 40 * day, 1), ("M", "c/3", T0 + day, 4)],
             ["c/1", "c/2", "c/3"])
    _publish(store, "dead", None, [("M", "c/1", T0, 1000)], None)               # never published
    assert rollups.apply_all() == ["a"]
    _publish(store, "b", at(2), [("M", "c/2", T0, 6)], ["c/2"])                  # the greatest and the least value go
    rollups.apply("b")
    rows = _equal(store)
    assert ("hour", "ns", "M", "c/", T0, 11.0, 2, 5.0, 6.0) in rows
    written = spark.read.parquet(f"{store.root}/rollups/hour/epoch=1")
    assert {x.period_start for x in written.collect()} == {T0, T0 + 40 * day}    # not the hour of file 3
    _publish(store, "late", at(1), [("M", "c/2", T0, 77)], ["c/2"])              # an older run that is published later
    rollups.apply("late")
    _equal(store)
    _publish(store, "c", at(3), [], ["c/1", "c/2", "c/3"])                       # all files are empty now
    rollups.apply("c")
    assert _equal(store) == []


def test_a_run_that_dies_while_it_is_applied(spark, tmp, monkeypatch):
    store = Store(spark, f"{tmp}/out")
    _publish(store, "a", dt.datetime(2024, 6, 1, tzinfo=UTC), [("M", "c/1", T0, 5)], ["c/1"])
    Rollups(store).apply_all()
    _publish(store, "b", dt.datetime(2024, 6, 2, tzinfo=UTC), [("M", "c/1", T0, 7), ("M", "c/1", T0, 8)], ["c/1"])
    whole = Rollups._write

    def dies(self, name, *rest):
        if name == "applied":
            raise RuntimeError("lost")
        whole(self, name, *rest)
    with monkeypatch.context() as m:
        m.setattr(Rollups, "_write", dies)
        with pytest.raises(RuntimeError):
            Rollups(store).apply("b")
    assert [r.sum for r in Rollups(store).read("day").collect()] == [5.0]        # nothing of it is seen
    assert Rollups(store).apply_all() == ["b"]
    assert [r.sum for r in Rollups(store).read("day").collect()] == [15.0] and _equal(store)
    assert Rollups(store).read("day").filter(F.col("source_file") == "c/").count() == 1
