"""S1-S5 (CSV scan), K1-K6 sinks, H1-H3, W1 arrivals, clock and time zone."""

import datetime as dt
import json
import math
import os

import pytest
from pyspark.sql import functions as F

from claimsdq.operators.alarms import ACTION_ROUTES
from claimsdq.operators.timeseries import metric_latest
from claimsdq.plans.batch import run_csv_job, run_tiers
from claimsdq.plans.job import main
from claimsdq.plans.remediate import quarantine_files, quarantined, remediate
from claimsdq.plans.store import Store
from claimsdq.session import checkpoint_dir, cluster_conf
from claimsdq.sources.claims import CLAIMS_SCHEMA, conform_to_schema, list_claim_files, read_claims_csv
from claimsdq.streaming.file_ingest import ingest_arrivals, start_file_ingest
from claimsdq.streaming.metric_stream import hourly_now
from conftest import claim, claims_df

UTC = dt.timezone.utc
HEADER = ("claim_id,member_id,provider_id,provider_npi,cpt_code,icd10_code,claim_amount,service_date,"
          "submission_date,claim_status,denial_reason,patient_dob,patient_zip,patient_gender")


def _line(i, amount="120.5", npi="1234567890", cpt="99213", svc="2024-06-01", sub="2024-06-05",
          status="PAID", zip_="12345", gender="F", member=None):
    member = f"MBR{i:06d}" if member is None else member
    return (f"C{i},{member},PRV00001,{npi},{cpt},I10,{amount},{svc},{sub},{status},,1980-01-01,"
            f"{zip_},{gender}")


def _write(path, lines, header=HEADER):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(header + "\n" + "\n".join(lines) + "\n")


def test_csv_permissive_and_positional(spark, tmp):
    p = f"{tmp}/claims/payer_claims_a.csv"
    lines = [
        _line(1),
        _line(2, svc="2024-13-45"),            # bad date -> NULL, not flagged
        _line(3, amount="abc"),                # bad amount -> NULL -> MISSING_AMOUNT
        'C4,"",PRV1,1234567890,99213,I10,5.0,2024-06-01,2024-06-02,PAID,,1980-01-01,12345,M',  # quoted empty
        "C5,MBR5,PRV1",                         # short row
        _line(6, amount="NaN"),
    ]
    _write(p, lines, header="a,b,c,d,e,f,g,h,i,j,k,l,m,n")  # unrelated header names
    df = read_claims_csv(spark, f"{tmp}/claims", key_root=tmp)
    rows = {r.claim_id: r for r in df.collect()}
    assert len(rows) == 6
    assert rows["C2"].service_date is None
    assert rows["C3"].claim_amount is None
    assert rows["C4"].member_id is None
    assert rows["C5"].provider_npi is None and rows["C5"].claim_amount is None
    assert math.isnan(rows["C6"].claim_amount)
    assert rows["C1"].source_file == "claims/payer_claims_a.csv"
    assert df.schema["claim_amount"].dataType == CLAIMS_SCHEMA["claim_amount"].dataType


def test_csv_corrupt_record_column(spark, tmp):
    p = f"{tmp}/c/x.csv"
    _write(p, [_line(1), _line(2, amount="zz")])
    df = read_claims_csv(spark, p, corrupt_column="_corrupt_record")
    # all columns are read: with CSV column pruning a field that is not
    # selected is not parsed, so it cannot make its row corrupt
    bad = df.filter(F.col("_corrupt_record").isNotNull()).collect()
    assert [r.claim_id for r in bad] == ["C2"]


def _make_files(root, n_files=3, rows=40):
    for f in range(n_files):
        lines = []
        for i in range(rows):
            k = f * 1000 + i
            if i == 0:
                lines.append(_line(k, member=""))            # MISSING_MEMBER_ID
            elif i == 1:
                lines.append(_line(k, npi="12345"))           # INVALID_NPI
            elif i == 2:
                lines.append(_line(k, amount="5000000"))      # EXCESSIVE
            elif i == 3:
                lines.append(_line(k, amount="5000"))         # spike, outlier in a group of 40
            else:
                lines.append(_line(k, amount="100"))
        _write(f"{root}/claims/payer_claims_2024010{f + 1}.csv", lines)


def _at(day, hour=0):
    return dt.datetime(2024, 12, day, hour, tzinfo=UTC)


def _staged(spark):
    """Names of what lies staged under the checkpoint folder."""
    root = checkpoint_dir(spark).removeprefix("file:") + "/staged"
    return set(os.listdir(root)) if os.path.isdir(root) else set()


def _ids(store, kind):
    return sorted(r.claim_id for r in store.read(kind).select("claim_id").collect())


def test_batch_job_writes_tiers_and_metrics(spark, tmp):
    src, out = f"{tmp}/raw", f"{tmp}/processed"
    _make_files(src)
    staged = _staged(spark)
    res = run_csv_job(spark, f"{src}/claims", out, key_root=src, run_ts=_at(1))
    assert res.counts == {"total_records": 120, "gold_records": 108, "silver_records": 9, "quarantine_records": 3,
                          "total_anomalies": 12}
    assert res.file_metrics.count() == 3 and _staged(spark) == staged
    store = Store(spark, out)
    assert tuple(len(_ids(store, t)) for t in ("gold", "silver", "quarantine")) == (108, 9, 3)
    # gold prunes on year and month
    g = store.read("gold").filter("year = 2024 AND month = 6")
    plan = g._jdf.queryExecution().executedPlan().toString()
    assert "year" in plan.split("PartitionFilters")[1].split("]")[0]
    assert g.count() == 108
    pts = store.points()
    assert {r.source_file for r in pts.select("source_file").distinct().collect()} == \
        {"claims/", *[f"claims/payer_claims_2024010{n}.csv" for n in (1, 2, 3)]}
    latest = {r.source_file: r.latest_value for r in metric_latest(pts.filter("metric_name = 'GoldRecords'")).collect()}
    assert latest["claims/"] == 108.0
    js = [json.loads(r.metrics_json) for r in store.read("metrics/json").collect()]
    assert sorted(j["total_records"] for j in js) == [40, 40, 40]
    assert all(j["timestamp"] == "2024-12-01T00:00:00" and abs(j["data_quality_score"] + j["anomaly_rate"] - 100) < 1e-9
               for j in js)


def test_rerun_leaves_no_stale_row_in_any_tier(spark, tmp):
    src, out = f"{tmp}/raw", f"{tmp}/processed"
    a, b = f"{src}/claims/a.csv", f"{src}/claims/b.csv"
    _write(a, [_line(1), _line(2, npi="bad"), _line(3, npi="bad")])
    _write(b, [_line(4)])
    run_csv_job(spark, f"{src}/claims", out, key_root=src, run_ts=_at(1))
    store = Store(spark, out)
    assert _ids(store, "gold") == ["C1", "C4"] and _ids(store, "silver") == ["C2", "C3"]
    # a claim mended, one moved to another month, one gone; run alone, then in the prefix
    _write(a, [_line(1, svc="2024-03-01", sub="2024-03-02"), _line(2)])
    run_csv_job(spark, a, out, key_root=src, run_ts=_at(2))
    for _ in range(2):
        assert _ids(store, "gold") == ["C1", "C2", "C4"] and _ids(store, "silver") == []
        assert [r.month for r in store.read("gold").filter("claim_id = 'C1'").collect()] == [3]
        totals = {r.source_file: r.value for r in store.points().filter("metric_name = 'TotalRecords'").collect()
                  if r.source_file != "claims/"}
        assert totals == {"claims/a.csv": 2.0, "claims/b.csv": 1.0}
        run_csv_job(spark, f"{src}/claims", out, key_root=src, run_ts=_at(3))
    # a file that is empty now loses all its rows
    _write(a, [])
    run_csv_job(spark, a, out, key_root=src, run_ts=_at(4))
    assert _ids(store, "gold") == ["C4"]
    assert store.points().filter("source_file = 'claims/a.csv'").count() == 0


def test_unfinished_run_is_not_seen_and_a_retry_replaces_it(spark, tmp, monkeypatch):
    src, out = f"{tmp}/raw", f"{tmp}/processed"
    _write(f"{src}/claims/a.csv", [_line(1), _line(2, npi="bad")])
    run_csv_job(spark, f"{src}/claims", out, key_root=src, run_ts=_at(1))
    _write(f"{src}/claims/a.csv", [_line(1), _line(2), _line(3)])
    staged = _staged(spark)
    with monkeypatch.context() as m:
        m.setattr(Store, "publish", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            run_csv_job(spark, f"{src}/claims", out, key_root=src, run_ts=_at(2), run_id="again")
    assert _staged(spark) == staged
    store = Store(spark, out)
    assert _ids(store, "gold") == ["C1"] and _ids(store, "silver") == ["C2"]
    for _ in range(2):
        run_csv_job(spark, f"{src}/claims", out, key_root=src, run_ts=_at(2), run_id="again")
        assert _ids(store, "gold") == ["C1", "C2", "C3"] and _ids(store, "silver") == []


def test_file_count_does_not_follow_the_source_files(spark, tmp):
    def files(n):
        src, out = f"{tmp}/raw{n}", f"{tmp}/out{n}"
        for f in range(n):
            _write(f"{src}/claims/f{f}.csv", [_line(f * 10 + i) for i in range(3)])
        run_csv_job(spark, f"{src}/claims", out, key_root=src, run_ts=_at(1))
        return sum(x.endswith(".parquet") for _, _, names in os.walk(f"{out}/gold") for x in names)
    assert files(120) <= 2 * spark.sparkContext.defaultParallelism


def test_clock_is_the_day_of_the_run(spark, tmp):
    today = dt.datetime.now(UTC).date()
    day = lambda n: str(today + dt.timedelta(days=n))
    _write(f"{tmp}/raw/claims/a.csv", [_line(1, svc=day(-1), sub=day(0)), _line(2, svc=day(2), sub=day(3))])
    args = ["--input", f"{tmp}/raw/claims", "--key-root", f"{tmp}/raw"]
    assert main(["batch", "--output", f"{tmp}/out", *args]) == 0
    store = Store(spark, f"{tmp}/out")
    assert _ids(store, "gold") == ["C1"]
    assert [r.dq_issues for r in store.read("silver").collect()] == ["FUTURE_SERVICE_DATE;"]
    assert main(["batch", "--output", f"{tmp}/out2", "--as-of", day(5), *args]) == 0
    assert _ids(Store(spark, f"{tmp}/out2"), "gold") == ["C1", "C2"]


def test_instants_do_not_depend_on_the_session_zone(spark, tmp):
    src = f"{tmp}/raw"
    path = f"{src}/claims/a.csv"
    _write(path, [_line(i) for i in range(4)])
    when = dt.datetime(2024, 7, 1, 12, 30, tzinfo=UTC)
    os.utime(path, (when.timestamp(), when.timestamp()))
    old = spark.conf.get("spark.sql.session.timeZone")
    seen = set()
    try:
        for zone in ("America/New_York", "UTC", "Asia/Kolkata"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            name = zone.replace("/", "-")
            run_csv_job(spark, f"{src}/claims", f"{tmp}/b-{name}", key_root=src, run_ts=when)
            start_file_ingest(spark, f"{src}/claims", f"{tmp}/s-{name}", f"{tmp}/c-{name}", key_root=src).awaitTermination()
            for root in (f"{tmp}/b-{name}", f"{tmp}/s-{name}"):
                store = Store(spark, root)
                gold = store.read("gold").select(F.unix_seconds("ingestion_timestamp").alias("t")).distinct().collect()
                ts = store.points().select(F.col("ts").cast("string").alias("t")).distinct().collect()
                seen.add((tuple(r.t for r in gold), tuple(r.t for r in ts)))
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert seen == {((int(when.timestamp()),), ("2024-07-01 12:30:00",))}


def test_file_stream_scope_nested_files_and_old_times(spark, tmp):
    src, out = f"{tmp}/raw", f"{tmp}/processed"
    _make_files(src, n_files=2)
    start_file_ingest(spark, f"{src}/claims", out, f"{tmp}/ckpt/w1", key_root=src,
                      max_files_per_trigger=1).awaitTermination()
    store = Store(spark, out)
    assert len(_ids(store, "gold")) == 72 and len(_ids(store, "quarantine")) == 2
    # new files: one deeper, one with a time long past, one that is no claim file
    _write(f"{src}/claims/2024/deep.csv", [_line(9000 + i, amount="100") for i in range(5)])
    _write(f"{src}/claims/old.csv", [_line(9100)])
    os.utime(f"{src}/claims/old.csv", (1_000_000_000, 1_000_000_000))
    _write(f"{src}/claims/notes.txt", ["ignored"])
    start_file_ingest(spark, f"{src}/claims", out, f"{tmp}/ckpt/w1", key_root=src).awaitTermination()
    assert len(_ids(store, "gold")) == 78
    assert {r.source_file for r in store.current().collect()} >= {"claims/2024/deep.csv", "claims/old.csv"}


def test_two_streams_share_a_root(spark, tmp):
    out = f"{tmp}/processed"
    for n in (1, 2):
        _write(f"{tmp}/raw{n}/claims/f{n}.csv", [_line(n * 100 + i) for i in range(3)])
        start_file_ingest(spark, f"{tmp}/raw{n}/claims", out, f"{tmp}/ckpt/w{n}", key_root=f"{tmp}/raw{n}").awaitTermination()
    store = Store(spark, out)
    assert len(_ids(store, "gold")) == 6
    assert {r.source_file for r in store.points(folders=False).collect()} == {"claims/f1.csv", "claims/f2.csv"}
    assert store.manifest().select("run").distinct().count() == 2


def test_compacting_the_manifest_changes_no_reader(spark, tmp):
    src, out = f"{tmp}/raw", f"{tmp}/processed"
    for n in range(4):
        _write(f"{src}/claims/f{n % 3}.csv", [_line(n)])
        run_csv_job(spark, f"{src}/claims/f{n % 3}.csv", out, key_root=src, run_ts=_at(1 + n))
    store = Store(spark, out)
    before = sorted(map(tuple, store.current().collect())), _ids(store, "gold")
    assert store.compact_manifest() == 4 and len(os.listdir(f"{out}/manifest")) == 1
    assert (sorted(map(tuple, store.current().collect())), _ids(store, "gold")) == before
    assert store.compact_manifest() == 0
    assert ingest_arrivals(spark, f"{src}/claims", out, key_root=src) == []


def test_arrivals_see_new_nested_and_uploaded_again_files(spark, tmp):
    src, out = f"{tmp}/raw", f"{tmp}/processed"
    for n in range(5):
        _write(f"{src}/claims/{'x/y/' * (n % 2)}f{n}.csv", [_line(n * 100 + i) for i in range(2)])
    os.utime(f"{src}/claims/f0.csv", (1_000_000_000, 1_000_000_000))
    runs = ingest_arrivals(spark, f"{src}/claims", out, key_root=src, max_files=2)
    store = Store(spark, out)
    assert len(runs) == 3 and len(_ids(store, "gold")) == 10
    assert ingest_arrivals(spark, f"{src}/claims", out, key_root=src) == []
    # the same name again, with other content and a later time
    _write(f"{src}/claims/f0.csv", [_line(0), _line(7, npi="bad")])
    os.utime(f"{src}/claims/f0.csv", (1_100_000_000, 1_100_000_000))
    assert len(ingest_arrivals(spark, f"{src}/claims", out, key_root=src)) == 1
    assert len(_ids(store, "gold")) == 9 and _ids(store, "silver") == ["C7"]
    # a file without rows is noted and not read again and again
    _write(f"{src}/claims/empty.csv", [])
    assert len(ingest_arrivals(spark, f"{src}/claims", out, key_root=src)) == 1
    assert ingest_arrivals(spark, f"{src}/claims", out, key_root=src) == []
    assert list_claim_files(spark, f"{src}/claims", src).count() == 6


def test_date_folders_are_pruned(spark, tmp):
    src, out = f"{tmp}/raw", f"{tmp}/processed"
    for n in range(3):
        _write(f"{src}/claims/f{n}.csv", [_line(n)])
        run_csv_job(spark, f"{src}/claims/f{n}.csv", out, key_root=src, run_ts=_at(1 + n))
    pts = Store(spark, out).points(dt.datetime(2024, 12, 2), dt.datetime(2024, 12, 3))
    plan = pts._jdf.queryExecution().executedPlan().toString()
    assert "date" in plan.split("PartitionFilters")[1].split("]")[0]
    assert {r.source_file for r in pts.collect()} == {"claims/f1.csv", "claims/"}


def test_metric_range_query_prunes_date_folders(spark):
    from claimsdq.plans.queries import q_metric_range
    from conftest import SF_SMALL
    plan = q_metric_range(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "date" in plan.split("PartitionFilters")[1].split("]")[0]


def test_remediation_acts_once_and_leaves_records(spark, tmp):
    good = claims_df(spark, [claim(claim_id=f"g{i}") for i in range(5)], "claims/good.csv")
    bad = claims_df(spark, [claim(claim_id=f"b{i}", provider_npi="x" if i else "1234567890") for i in range(4)],
                    "claims/bad.csv")
    rows = good.unionByName(bad).withColumn("ingestion_timestamp", F.lit(_at(1)))
    store = Store(spark, f"{tmp}/out")
    metrics = run_tiers(rows, store.root, run_ts=_at(1)).file_metrics
    assert quarantine_files(rows, metrics, store, "r1") == {"status": "success", "quarantined_count": 1, "quarantined_rows": 4}
    assert quarantine_files(rows, metrics, store, "r2")["quarantined_count"] == 0
    assert [r.source_file for r in quarantined(store).collect()] == ["claims/bad.csv"]
    assert spark.read.parquet(f"{store.root}/quarantined_files").count() == 4
    s = store.read_run("file_status", "r1").first()
    assert (s.status, s.rows, s.quarantine_key) == ("Quarantined", 4, "quarantine/r1/claims/bad.csv")
    # by prefix: every file under it that is not there yet
    assert quarantine_files(rows, metrics, store, "r3", prefix="claims/")["quarantined_rows"] == 5
    assert run_tiers(rows, store.root, run_ts=_at(2)).counts["total_records"] == 9    # originals are kept

    names = [n for n, _ in ACTION_ROUTES] + ["trigger", "", None]
    req = spark.createDataFrame([(str(i), n) for i, n in enumerate(names)], "request_id string, action string")
    for _ in range(2):       # a retry of the run replaces its records
        out = {r.request_id: r for r in remediate(req, rows, metrics, store, _at(3), run_id="act").collect()}
        assert len(out) == 9
    assert [out[str(i)].status_code for i in range(9)] == [200] * 6 + [400] * 3
    assert json.loads(out["0"].result) == {"status": "success", "quarantined_count": 0, "quarantined_rows": 0}
    assert json.loads(out["6"].result) == {"status": "error", "message": "Unknown action: trigger"}
    assert {(r.timestamp, r.environment) for r in out.values()} == {("2024-12-03T00:00:00", "dev")}
    assert os.path.isdir(f"{store.root}/remediation/run_id=act/routed_action=restart_job")


def test_metric_stream_command(spark, tmp):
    src, out = f"{tmp}/raw", f"{tmp}/processed"
    for n in range(4):
        _write(f"{src}/claims/f{n}.csv", [_line(n)])
        run_csv_job(spark, f"{src}/claims/f{n}.csv", out, key_root=src, run_ts=_at(1, 3 * n))
    assert main(["metrics-stream", "--output", out, "--checkpoint", f"{tmp}/ck"]) == 0
    got = hourly_now(spark, f"{out}/metrics/hourly").filter("metric_name = 'TotalRecords'").collect()
    assert sorted(r.period_start.hour for r in got) == [0, 3, 6, 9] and all(r.sample_count == 1 for r in got)


def test_commands_need_their_paths(spark):
    for args in (["batch", "--output", "x"], ["stream", "--input", "i", "--output", "x"], ["metrics-stream", "--output", "x"]):
        with pytest.raises(SystemExit):
            main(args)


def test_all_match_job_reads_by_header_name(spark, tmp):
    p = f"{tmp}/raw/claims/a.csv"
    os.makedirs(os.path.dirname(p))
    with open(p, "w") as f:      # another column order, some columns missing
        f.write("claim_amount,claim_id,provider_npi,service_date,submission_date\n")
        f.write("12.5,C1,1234567890,2024-06-01,2024-06-02\nabc,C2,1234567890,bad,2024-06-02\n")
    assert main(["batch", "--input", f"{tmp}/raw/claims", "--output", f"{tmp}/out", "--key-root", f"{tmp}/raw",
                 "--mode", "all_match"]) == 0
    got = {r.claim_id: (r.claim_amount, r.service_date, r.dq_issues) for r in Store(spark, f"{tmp}/out").read("silver").collect()}
    assert got["C1"][:2] == (12.5, dt.date(2024, 6, 1)) and "MISSING_MEMBER_ID" in got["C1"][2]
    assert got["C2"][:2] == (None, None) and "MISSING_AMOUNT" in got["C2"][2]


def test_conform_to_schema_coerces(spark):
    raw = spark.createDataFrame(
        [("C1", "2024-06-01", "2024-06-05", "12.5", 1234567890),
         ("C2", "not a date", "2024-06-05", "abc", None)],
        "claim_id string, service_date string, submission_date string, claim_amount string, provider_npi long")
    df = conform_to_schema(raw)
    assert [f.dataType for f in df.schema.fields[:14]] == [f.dataType for f in CLAIMS_SCHEMA.fields]
    rows = {r.claim_id: r for r in df.collect()}
    assert rows["C1"].service_date == dt.date(2024, 6, 1) and rows["C1"].claim_amount == 12.5
    assert rows["C1"].provider_npi == "1234567890"
    assert rows["C2"].service_date is None and rows["C2"].claim_amount is None
    assert rows["C2"].member_id is None


def test_cluster_conf_sizes():
    small, big = cluster_conf(10 << 30), cluster_conf(1000 << 40)
    assert small["spark.sql.shuffle.partitions"] == "200"
    assert big["spark.sql.shuffle.partitions"] == str(1000 << 9)
    assert big["spark.sql.adaptive.skewJoin.enabled"] == "true"
