"""Arrivals that lose nothing: sweeps, notices, uploads while a run goes on."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from claimsdq.plans import batch
from claimsdq.plans.batch import run_csv_job
from claimsdq.plans.store import Store
from claimsdq.streaming import file_ingest
from claimsdq.streaming.arrival_events import start_event_ingest
from claimsdq.streaming.file_ingest import ingest_arrivals
from test_ingest_pipeline import _at, _ids, _line, _write

LATER = 1_900_000_000


def _put(path, lines, at=None):
    _write(path, lines)
    if at:
        os.utime(path, (at, at))


@pytest.mark.parametrize("step", ["before the rows are read", "before the run is published"])
def test_uploads_while_the_batch_job_runs_are_taken_by_the_next_sweep(spark, tmp, monkeypatch, step):
    src, out = f"{tmp}/raw", f"{tmp}/processed"
    _put(f"{src}/claims/a.csv", [_line(1)], 1_500_000_000)
    _put(f"{src}/claims/b.csv", [_line(2)], 1_500_000_000)

    def upload():
        _put(f"{src}/claims/a.csv", [_line(11), _line(12)], LATER)
        _put(f"{src}/claims/new.csv", [_line(13)], 1_400_000_000)    # an old time, as from a copied file

    if step.startswith("before the rows"):
        whole = batch.run_tiers
        monkeypatch.setattr(batch, "run_tiers", lambda *a, **k: (upload(), whole(*a, **k))[1])
    else:
        whole = Store.publish
        monkeypatch.setattr(Store, "publish", lambda *a, **k: (upload(), whole(*a, **k))[1])
    run_csv_job(spark, f"{src}/claims", out, key_root=src, run_ts=_at(1))
    monkeypatch.undo()
    store = Store(spark, out)
    published = {r.source_file: r.modified for r in store.current().collect()}
    assert set(published) == {"claims/a.csv", "claims/b.csv"}
    assert len(ingest_arrivals(spark, f"{src}/claims", out, key_root=src, run_ts=_at(2))) == 1
    assert _ids(store, "gold") == ["C11", "C12", "C13", "C2"]
    assert ingest_arrivals(spark, f"{src}/claims", out, key_root=src) == []


def test_uploads_while_a_sweep_goes_on(spark, tmp, monkeypatch):
    src, out = f"{tmp}/raw", f"{tmp}/processed"
    for n in range(4):
        _put(f"{src}/claims/f{n}.csv", [_line(n)], 1_500_000_000 + n)
    listings, list_files, run = [], file_ingest.list_claim_files, file_ingest.run_tiers
    monkeypatch.setattr(file_ingest, "list_claim_files", lambda *a, **k: (listings.append(1), list_files(*a, **k))[1])

    def meanwhile(*a, **k):
        if not os.path.exists(f"{src}/claims/late.csv"):
            _put(f"{src}/claims/f0.csv", [_line(100)], LATER)           # of the batch that is being run
            _put(f"{src}/claims/f3.csv", [_line(103)], LATER + 1)       # of a batch still to come
            _put(f"{src}/claims/late.csv", [_line(104)], LATER + 2)
        return run(*a, **k)
    monkeypatch.setattr(file_ingest, "run_tiers", meanwhile)
    assert len(ingest_arrivals(spark, f"{src}/claims", out, key_root=src, max_files=2, run_ts=_at(1))) == 2
    assert len(listings) == 1
    ingest_arrivals(spark, f"{src}/claims", out, key_root=src, run_ts=_at(2))
    assert _ids(Store(spark, out), "gold") == ["C1", "C100", "C103", "C104", "C2"]
    assert ingest_arrivals(spark, f"{src}/claims", out, key_root=src) == []


def test_names_that_paths_encode_or_globs_know(spark, tmp):
    src, out = f"{tmp}/raw", f"{tmp}/processed"
    names = ["a b.csv", "a+b.csv", "a%20b.csv", "x[1].csv", "y{1,2}.csv", "é.csv"]
    for n, name in enumerate(names):
        _put(f"{src}/claims/{name}", [_line(n)])
    run_csv_job(spark, f"{src}/claims", out, key_root=src, run_ts=_at(1))
    store = Store(spark, out)
    assert {r.source_file for r in store.read("gold").collect()} == {f"claims/{n}" for n in names}
    assert ingest_arrivals(spark, f"{src}/claims", out, key_root=src) == []
    run_csv_job(spark, f"{src}/claims", f"{tmp}/no-root", run_ts=_at(1))      # without a key root
    assert len(_ids(Store(spark, f"{tmp}/no-root"), "gold")) == len(names)
    run_csv_job(spark, f"{tmp}", f"{tmp}/none", key_root=src, only="*.none", run_ts=_at(1))
    assert _ids(Store(spark, f"{tmp}/none"), "gold") == []


def _notice(folder, n, *records):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{n}.json", "w") as f:
        f.write(json.dumps({"Records": [
            {"eventName": name, "eventTime": f"2024-12-{day:02d}T00:00:00.000Z", "s3": {
                "bucket": {"name": "raw"}, "object": {"key": key, "size": 1, "versionId": version}}}
            for name, key, version, day in records]}) + "\n")


def test_notices_feed_runs_without_a_listing(spark, tmp, monkeypatch):
    src, out, box = f"{tmp}/raw", f"{tmp}/processed", f"{tmp}/box"
    monkeypatch.setattr(file_ingest, "list_claim_files", None)           # no listing anywhere

    def run():
        q = start_event_ingest(spark, box, out, f"{tmp}/ck", src, files_per_run=2)
        q.awaitTermination()
        assert q.exception() is None
        store = Store(spark, out)
        return store, store.manifest().select("run").distinct().count(), \
            sorted((r.key, r.version, r.outcome) for r in store.table("notices").collect())

    new = "ObjectCreated:Put"
    _put(f"{src}/claims/a.csv", [_line(1)], 1_500_000_000)
    _put(f"{src}/claims/2024/x y.csv", [_line(2)], 1_500_000_000)
    _put(f"{src}/claims/unknown.csv", [_line(3)])                        # never noticed
    _notice(box, 1, (new, "claims/a.csv", "v1", 1), (new, "claims/2024/x+y.csv", "v1", 1),
            (new, "claims/gone.csv", "v1", 1), (new, "claims/notes.txt", "v1", 1), (new, "other/b.csv", "v1", 1),
            ("ObjectRemoved:Delete", "claims/unknown.csv", "v1", 1))
    store, runs, notices = run()
    assert _ids(store, "gold") == ["C1", "C2"] and runs == 1
    assert notices == [("claims/2024/x y.csv", "v1", "run"), ("claims/a.csv", "v1", "run"), ("claims/gone.csv", "v1", "missing")]
    # delivered twice, then uploaded again twice over: one run that reads what is there now
    _notice(box, 2, (new, "claims/a.csv", "v1", 1))
    _, runs, again = run()
    assert runs == 1 and again == notices
    _put(f"{src}/claims/a.csv", [_line(1, npi="bad"), _line(4)], LATER)
    _notice(box, 3, (new, "claims/a.csv", "v2", 2), (new, "claims/a.csv", "v3", 3), (new, "claims/a.csv", "v2", 2))
    store, runs, notices = run()
    assert runs == 2 and _ids(store, "gold") == ["C2", "C4"] and _ids(store, "silver") == ["C1"]
    assert [n for n in notices if n[0] == "claims/a.csv"] == [("claims/a.csv", v, o) for v, o in
                                                            (("v1", "run"), ("v2", "superseded"), ("v3", "run"))]
    # a sweep beside the stream finds only what was never noticed; a notice after it makes no run
    monkeypatch.undo()
    assert len(ingest_arrivals(spark, f"{src}/claims", out, key_root=src)) == 1
    _notice(box, 4, (new, "claims/unknown.csv", "v9", 4))
    _, runs, notices = run()
    assert runs == 3 and ("claims/unknown.csv", "v9", "known") in notices


def test_bad_records_are_kept_with_their_place(spark, tmp):
    src, out = f"{tmp}/raw", f"{tmp}/processed"
    lines = [_line(i, amount="zz" if i % 97 == 5 else "1.5") for i in range(3000)]
    lines[700] = "C700,MBR700"
    _write(f"{src}/claims/big.csv", lines)
    _write(f"{src}/claims/fine.csv", [_line(9000)])
    _write(f"{src}/claims/blank.csv", [_line(9001), "", _line(9002, svc="2024-13-45")])
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(32 << 10))    # the big file in several splits
    try:
        run_csv_job(spark, f"{src}/claims", out, key_root=src, run_ts=_at(1), rescue=True)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    store = Store(spark, out)
    got = {(r.source_file, r.record): (r.claim_id, r.raw, r.fields) for r in store.read("bad_records").collect()}
    want = {("claims/big.csv", i + 1): (f"C{i}", lines[i], 2 if i == 700 else 14) for i in range(3000) if i % 97 == 5 or i == 700}
    assert got == want | {("claims/blank.csv", 2): ("C9002", _line(9002, svc="2024-13-45"), 14)}
    counted = {r.source_file: r.bad_records for r in store.read("metrics/files").collect()}
    assert counted == {"claims/big.csv": len(want), "claims/fine.csv": 0, "claims/blank.csv": 1}
    # a mended file has no bad record left
    _write(f"{src}/claims/blank.csv", [_line(9002)])
    run_csv_job(spark, f"{src}/claims/blank.csv", out, key_root=src, run_ts=_at(2), rescue=True)
    assert store.read("bad_records").filter("source_file = 'claims/blank.csv'").count() == 0


def test_only_changed_files_are_read_and_judged_against_all(spark, tmp):
    src, out = f"{tmp}/raw", f"{tmp}/processed"
    base = 90_000.0                                 # a large common part
    for n in range(3):
        _put(f"{src}/claims/f{n}.csv", [_line(n * 100 + i, amount=str(base + (i * 7 + n) % 11)) for i in range(40)], 1_500_000_000)
    run_csv_job(spark, f"{src}/claims", out, key_root=src, run_ts=_at(1))
    _put(f"{src}/claims/f1.csv", [_line(100 + i, amount=str(base + (i * 5) % 13)) for i in range(40)] + [_line(199, amount="90099.5")], LATER)
    part = run_csv_job(spark, f"{src}/claims", out, key_root=src, run_ts=_at(2), changed_only=True)
    assert part.counts["total_records"] == 41
    run_csv_job(spark, f"{src}/claims", f"{tmp}/full", key_root=src, run_ts=_at(2))
    a, b = (Store(spark, root).read("quarantine").filter("claim_id = 'C199'").first() for root in (out, f"{tmp}/full"))
    assert abs(a.z_score - b.z_score) < 1e-9 and abs(a.stddev_amount - b.stddev_amount) < 1e-9
    assert abs(a.avg_amount - b.avg_amount) < 1e-9
    assert run_csv_job(spark, f"{src}/claims", out, key_root=src, run_ts=_at(3), changed_only=True).counts["total_records"] == 0
    assert Store(spark, out).read("gold").count() == Store(spark, f"{tmp}/full").read("gold").count()
