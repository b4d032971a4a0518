"""The store: snapshots, plans of its reads, retention, packing, versions, the ledger."""

import datetime as dt
import json
import os
import random

import pytest
from pyspark.sql import functions as F

from claimsdq.operators.anomaly import amount_stats
from claimsdq.operators.moments import file_moments, merged_stats
from claimsdq.plans.batch import run_csv_job, run_tiers
from claimsdq.plans.job import main
from claimsdq.plans import remediate as RM
from claimsdq.plans.remediate import audit_log, quarantine_files, quarantined, remediate, status_as_of, status_intervals
from claimsdq.plans.store import Store
from conftest import claim, claims_df
from test_ingest_pipeline import UTC, _at, _ids, _line, _write


def _files(root):
    return sum(n.endswith((".parquet", ".json")) for _, _, names in os.walk(root) for n in names)


def _scan_filters(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [part.split("]")[0] for part in plan.split("PartitionFilters: [")[1:]], plan


def test_reads_prune_run_folders_and_join_only_mixed_runs(spark, tmp):
    src, out = f"{tmp}/raw", f"{tmp}/out"
    for n in range(3):
        _write(f"{src}/claims/f{n}.csv", [_line(n)])
    run_csv_job(spark, f"{src}/claims", out, key_root=src, run_ts=_at(1), run_id="whole")
    store = Store(spark, out)
    filters, plan = _scan_filters(store.read("gold"))
    assert len(filters) == 1 and "run_id" in filters[0] and "whole" in filters[0] and "Join" not in plan
    run_csv_job(spark, f"{src}/claims", out, key_root=src, run_ts=_at(2), run_id="again")
    run_csv_job(spark, f"{src}/claims/f1.csv", out, key_root=src, run_ts=_at(3), run_id="one")
    filters, plan = _scan_filters(store.read("gold"))
    assert any("one" in f for f in filters) and any("again" in f for f in filters)
    assert not any("whole" in f for f in filters)                # superseded: never read
    assert {r.run_id for r in store.read("gold").select("run_id").distinct().collect()} == {"again", "one"}
    assert _ids(store, "gold") == ["C0", "C1", "C2"]


def test_a_file_with_most_rows_is_split_in_the_join_of_a_mixed_run(spark, tmp):
    rows = [claim(claim_id=f"h{i}") for i in range(4000)]
    hot = claims_df(spark, rows, "claims/hot.csv").withColumn("ingestion_timestamp", F.lit(_at(1)))
    few = claims_df(spark, [claim(claim_id="s")], "claims/small.csv").withColumn("ingestion_timestamp", F.lit(_at(1)))
    store = Store(spark, f"{tmp}/out")
    run_tiers(hot.unionByName(few), store.root, run_ts=_at(1), run_id="a")
    run_tiers(few, store.root, run_ts=_at(2), run_id="b")
    from claimsdq.operators.joins import guarded_join
    now = store.current().select("source_file", "run_id")
    # beyond the broadcast bound the rows of one file meet their entry in many tasks
    joined = guarded_join(store.table("gold"), now, ["source_file", "run_id"], "left_semi", 0)
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        per_task = joined.filter("source_file = 'claims/hot.csv'").groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)
    assert sum(r["count"] for r in per_task) == 4000 and max(r["count"] for r in per_task) < 2500
    assert store.read("gold").count() == 4001


def test_points_as_of_an_earlier_time(spark, tmp):
    src, out = f"{tmp}/raw", f"{tmp}/out"
    _write(f"{src}/claims/a.csv", [_line(1)])
    run_csv_job(spark, f"{src}/claims", out, key_root=src, run_ts=_at(1))
    _write(f"{src}/claims/a.csv", [_line(1), _line(2)])
    _write(f"{src}/claims/b.csv", [_line(3)])
    run_csv_job(spark, f"{src}/claims", out, key_root=src, run_ts=_at(3))
    store = Store(spark, out)

    def totals(as_of=None):
        return {r.source_file: r.value for r in store.points(as_of=as_of).filter("metric_name = 'TotalRecords'").collect()}
    assert totals() == {"claims/": 3.0, "claims/a.csv": 2.0, "claims/b.csv": 1.0}
    assert totals(_at(2)) == {"claims/": 1.0, "claims/a.csv": 1.0}
    assert totals(dt.datetime(2024, 11, 1, tzinfo=UTC)) == {}
    assert store.read("gold", as_of=_at(2)).count() == 1


def test_gold_is_written_in_few_files(spark, tmp):
    rows = [claim(claim_id=f"c{i}", service_date=dt.date(2024, 1 + i % 12, 1), submission_date=dt.date(2024, 12, 31)) for i in range(2400)]
    df = claims_df(spark, rows).withColumn("ingestion_timestamp", F.lit(_at(1))).repartition(40)
    run_tiers(df, f"{tmp}/out", run_ts=_at(1))
    assert _files(f"{tmp}/out/gold") == 12            # not tasks x months
    assert Store(spark, f"{tmp}/out").read("gold").count() == 2400


def test_retention_bounds_files_and_open_readers_keep_their_state(spark, tmp):
    out = f"{tmp}/out"
    store = Store(spark, out)

    def run(n, day):
        df = claims_df(spark, [claim(claim_id=f"{n}-{i}") for i in range(3)], f"claims/f{n % 4}.csv") \
            .withColumn("ingestion_timestamp", F.lit(_at(day)))
        run_tiers(df, out, run_ts=_at(day, n % 24), run_id=f"r{n:03d}")
    for n in range(12):
        run(n, 1)
    old_state = sorted(_ids(store, "gold"))
    reader = store.read("gold")                               # opened now, read later
    for n in range(12, 18):
        run(n, 2)
    store.write("gold", "dead", store.read_run("gold", "r017"))   # a run that never publishes
    before = _files(out)
    gone = store.retain(_at(2))                               # readers since 2 December see these runs on
    assert gone and _files(out) < before
    assert {p.rsplit("run_id=", 1)[1] for p in gone} == {f"r{n:03d}" for n in range(8)}
    assert sorted(r.claim_id for r in reader.select("claim_id").collect()) == old_state
    assert store.read("gold").count() == 12 and store.table("gold").filter("run_id = 'dead'").count() == 3
    assert sorted(r.claim_id for r in store.read("gold", as_of=_at(2)).collect()) == old_state
    now = _ids(store, "gold")
    store.retain(dt.datetime.now(UTC) + dt.timedelta(days=1))      # no reader is left, and no writer
    assert store.table("gold").filter("run_id = 'dead'").count() == 0 and _ids(store, "gold") == now
    assert store.manifest().count() == 4 and len(os.listdir(f"{out}/manifest")) == 1


def test_packing_many_small_runs(spark, tmp):
    src, out = f"{tmp}/raw", f"{tmp}/out"
    store = Store(spark, out)
    for n in range(6):
        _write(f"{src}/claims/f{n}.csv", [_line(n), _line(50 + n, npi="bad")])
        run_csv_job(spark, f"{src}/claims/f{n}.csv", out, key_root=src, run_ts=_at(1, n))
    kinds = ("gold", "silver", "quarantine", "metrics/files", "metrics/points", "metrics/json", "metrics/moments")

    def state():
        return [sorted(str(r) for r in store.read(k).drop("run_id").collect()) for k in kinds], \
            sorted((r.source_file, r.modified) for r in store.current().collect())
    was = state()
    with pytest.raises(ValueError):
        store.pack(_at(1))
    run_id = store.pack(_at(2))
    assert state() == was and {r.run_id for r in store.current().collect()} == {run_id}
    store.retain(dt.datetime.now(UTC) + dt.timedelta(days=1))
    assert state() == was and store.pack(_at(3)) is None
    assert _files(f"{out}/gold") <= 2 and _files(f"{out}/metrics/points") <= 2
    assert os.listdir(f"{out}/gold") == [f"run_id={run_id}"]


def test_file_status_follows_versions(spark, tmp):
    src, out = f"{tmp}/raw", f"{tmp}/out"
    store, path = Store(spark, out), f"{src}/claims/a.csv"
    bad, good = [_line(1), _line(2, npi="x")], [_line(1), _line(2)]
    _write(f"{src}/claims/fine.csv", [_line(9)])

    def step(day, lines, act):
        _write(path, lines)
        os.utime(path, (1_700_000_000 + day, 1_700_000_000 + day))
        run_csv_job(spark, f"{src}/claims", out, key_root=src, run_ts=_at(day), run_id=f"v{day}")
        if act:
            rows = store.read("gold").drop("run_id")
            return quarantine_files(rows, store.read("metrics/files").drop("run_id"), store, f"q{day}", at=_at(day, 6))["quarantined_count"]

    assert step(1, bad, True) == 1 and [r.source_file for r in quarantined(store).collect()] == ["claims/a.csv"]
    assert step(2, good, True) == 0 and quarantined(store).count() == 0          # corrected: active again
    assert step(3, bad, True) == 1 and quarantined(store).count() == 1           # replaced and failing: taken again
    rows = store.read("gold").drop("run_id")
    assert quarantine_files(rows, store.read("metrics/files").drop("run_id"), store, "more", at=_at(3, 7))["quarantined_count"] == 0
    spans = [(r.version, r.status, r.since.day, r.until and r.until.day) for r in
             status_intervals(store).filter("source_file = 'claims/a.csv'").orderBy("since", "status").collect()]
    assert [s[1] for s in spans] == ["Active", "Quarantined", "Active", "Active", "Quarantined"]
    assert len({s[0] for s in spans}) == 3
    # the prefix runs again without a change: the same versions, so nothing is taken twice
    run_csv_job(spark, f"{src}/claims", out, key_root=src, run_ts=_at(4), run_id="v4")
    assert quarantine_files(rows, store.read("metrics/files").drop("run_id"), store, "q4", at=_at(4, 6))["quarantined_count"] == 0
    hours = [(d, h) for d in (1, 2, 3) for h in (1, 12)] + [(30, 0)]
    asked = spark.createDataFrame([("claims/a.csv", _at(d, h)) for d, h in hours] + [("claims/a.csv", dt.datetime(2024, 11, 1, tzinfo=UTC)),
                                  ("claims/none.csv", _at(1))], "source_file string, at timestamp")
    got = {(r.source_file, r.at.astimezone(UTC)): r.status for r in status_as_of(store, asked).collect()}
    want = ["Active", "Quarantined", "Active", "Active", "Active", "Quarantined", "Quarantined"]
    assert [got["claims/a.csv", _at(d, h)] for d, h in hours] == want
    assert got["claims/a.csv", dt.datetime(2024, 11, 1, tzinfo=UTC)] is None and got["claims/none.csv", _at(1)] is None


def _bad_store(spark, tmp):
    rows = claims_df(spark, [claim(claim_id=f"b{i}", provider_npi="x") for i in range(4)], "claims/bad.csv") \
        .withColumn("ingestion_timestamp", F.lit(_at(1)))
    store = Store(spark, f"{tmp}/out")
    return store, rows, run_tiers(rows, store.root, run_ts=_at(1)).file_metrics


def test_a_request_is_carried_out_once(spark, tmp, monkeypatch):
    store, rows, metrics = _bad_store(spark, tmp)
    kind = "request_id string, action string"
    asked = spark.createDataFrame([("1", "quarantine_data"), ("1", "quarantine_data"), ("2", "nonsense"), (None, "restart_etl")], kind)

    # the run dies after the copy and the records, before the ledger
    whole = Store.write
    def dies(self, name, *a):
        if name == "ledger":
            raise RuntimeError("lost")
        return whole(self, name, *a)
    monkeypatch.setattr(Store, "write", dies)
    with pytest.raises(RuntimeError):
        remediate(asked, rows, metrics, store, _at(2), run_id="x")
    monkeypatch.undo()
    assert audit_log(store).count() == 0
    out = {r.request_id: r for r in remediate(asked, rows, metrics, store, _at(2), run_id="x").collect()}
    assert json.loads(out["1"].result) == {"status": "success", "quarantined_count": 1, "quarantined_rows": 4}
    assert spark.read.parquet(f"{store.root}/quarantined_files").count() == 4     # the retry copied them, once
    assert set(out) == {"1", "2", None} and out["2"].status_code == 400

    acted = []
    act = RM.quarantine_files
    monkeypatch.setattr(RM, "quarantine_files", lambda *a, **k: (acted.append(1), act(*a, **k))[1])
    again = remediate(asked.filter("request_id IS NOT NULL"), rows, metrics, store, _at(3), run_id="y").collect()
    assert not acted and {(r.request_id, r.timestamp) for r in again} == {("1", "2024-12-02T00:00:00"), ("2", "2024-12-02T00:00:00")}
    more = spark.createDataFrame([("1", "quarantine_data"), ("3", "quarantine_data")], kind)
    both = {r.request_id: json.loads(r.result)["quarantined_count"] for r in remediate(more, rows, metrics, store, _at(4)).collect()}
    assert acted == [1] and both == {"1": 1, "3": 0}
    assert sorted(str(r.request_id) for r in audit_log(store).collect()) == ["1", "2", "3", "None"]


def test_remediate_pack_and_retain_commands(spark, tmp, capsys):
    src, out = f"{tmp}/raw", f"{tmp}/out"
    _write(f"{src}/claims/bad.csv", [_line(1, npi="x"), _line(2)])
    for _ in range(2):
        run_csv_job(spark, f"{src}/claims", out, key_root=src)
    args = ["remediate", "--output", out, "--request-id", "r1", "--action", "quarantine_data"]
    for _ in range(2):
        assert main(args) == 0
        assert json.loads(capsys.readouterr().out.splitlines()[-1]) == [{"routed_action": "quarantine_data", "status_code": 200, "count": 1}]
    assert spark.read.parquet(f"{out}/quarantined_files").count() == 2
    _write(f"{tmp}/asked/r.json", [], header='{"request_id": "r2", "action": "quarantine_data"}')
    assert main(["remediate", "--output", out, "--requests", f"{tmp}/asked", "--input", f"{src}/claims", "--key-root", src]) == 0
    assert main(["pack", "--output", out]) == 0 and main(["retain", "--output", out, "--keep-days", "-1"]) == 0
    assert json.loads(capsys.readouterr().out.splitlines()[-1])["removed"] > 0
    with pytest.raises(SystemExit):
        main(["remediate", "--output", out])


def test_merged_moments_equal_one_pass_with_a_large_common_part(spark):
    r = random.Random(4)
    for offset in (0.0, 1e9):
        rows = [(f"f{r.randint(0, 40)}", r.choice("abc"), offset + r.random() * 50) for _ in range(5000)] + [("lone", "z", offset)]
        df = spark.createDataFrame(rows, "source_file string, cpt_code string, claim_amount double").repartition(7)
        got = {x.cpt_code: x for x in merged_stats(file_moments(df)).collect()}
        for x in amount_stats(df).collect():
            g = got[x.cpt_code]
            values = [v for _, c, v in rows if c == x.cpt_code]
            exact = sum(v - offset for v in values) / len(values)
            assert g["count"] == x["count"] and abs(g.avg_amount - offset - exact) < 1e-6
            if x.stddev_amount is None:
                assert g.stddev_amount is None
                continue
            sd = (sum((v - offset - exact) ** 2 for v in values) / (len(values) - 1)) ** 0.5
            z = [abs((v - x.avg_amount) / x.stddev_amount - (v - g.avg_amount) / g.stddev_amount) for v in values]
            assert abs(g.stddev_amount - sd) < 1e-6 and (offset or max(z) < 1e-9)
    assert merged_stats(file_moments(df.limit(0))).count() == 0
