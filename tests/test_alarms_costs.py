"""L1-L7, C1-C5, T1-T10, M4-M8, X1, W2 on hand-written inputs."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimsdq.operators import alarms as AL
from claimsdq.operators import costs as CO
from claimsdq.operators import metrics as ME
from claimsdq.operators import timeseries as TS
from claimsdq.plans.fixtures import P as DEFAULT
from claimsdq.streaming.metric_stream import start_hourly_buckets

PT_SCHEMA = "namespace string, metric_name string, source_file string, ts timestamp_ntz, value double, unit string"
NS = DEFAULT.dq_namespace


def _pts(spark, metric, values, start=dt.datetime(2024, 1, 1), dim="claims/"):
    rows = [(NS, metric, dim, start + dt.timedelta(hours=h), float(v), "Count")
            for h, v in values if v is not None]
    return spark.createDataFrame(rows, PT_SCHEMA)


def _def(spark, *defs):
    return AL.alarm_definitions(spark, defs=list(defs))


def test_consecutive_periods_and_gaps(spark):
    d = _def(spark, {x.metric_name: x for x in AL.alarm_defs(DEFAULT)}["DataQualityScore"])
    # breaches at 0, 1, 2, 4, 6, 7; hour 3 has no data (not breaching), 5 is fine:
    # ALARM at 1, 2 and 7; hour 4 is not, since its previous period is missing
    vals = [(0, 80), (1, 70), (2, 80), (4, 84), (5, 90), (6, 20), (7, 30)]
    pts = _pts(spark, "DataQualityScore", vals)
    al = AL.alarm_periods(pts, d)
    hours = sorted(r.period_start.hour for r in al.collect())
    assert hours == [1, 2, 7]
    tr = sorted(r.period_start.hour for r in AL.alarm_transitions(pts, d).collect())
    assert tr == [1, 7]


def test_three_period_alarm(spark):
    d = AL.AlarmDef("x", NS, "M", "claims/", "Maximum", "GreaterThanOrEqualToThreshold", 5.0, 3, 3600, None, None)
    d = _def(spark, d)
    vals = [(0, 5), (1, 6), (2, 7), (3, 1), (4, 9), (5, 9), (6, 9), (7, 9)]
    al = AL.alarm_periods(_pts(spark, "M", vals), d)
    assert sorted(r.period_start.hour for r in al.collect()) == [2, 6, 7]


def test_anomaly_sum_alarm_and_events(spark):
    p = DEFAULT.with_(anomaly_threshold=100.0)
    d = _def(spark, {x.metric_name: x for x in AL.alarm_defs(p)}["AnomalyCount"])
    # two points in the same hour sum over the threshold
    rows = [(NS, "AnomalyCount", "claims/", dt.datetime(2024, 1, 1, 5, m), v, "Count")
            for m, v in [(0, 60.0), (30, 50.0)]]
    rows += [(NS, "AnomalyCount", "claims/", dt.datetime(2024, 1, 1, 6, 0), 100.0, "Count")]
    pts = spark.createDataFrame(rows, PT_SCHEMA)
    al = AL.alarm_periods(pts, d)
    got = [(r.period_start.hour, r.value) for r in al.collect()]
    assert got == [(5, 110.0)]
    ev = AL.alarm_events(pts, AL.alarm_definitions(spark, p)).first()
    assert ev.event_type == "anomaly_spike" and ev.action == "handle_anomaly_spike"
    assert ev.timestamp == dt.datetime(2024, 1, 1, 6, 0)
    assert ev.reason == "Threshold Crossed: 1 consecutive period(s) were greater than the threshold (100.0)."


def test_action_routing_f5(spark):
    req = spark.createDataFrame(
        [("1", "quarantine_data"), ("2", "handle_anomaly_spike"), ("3", "restart_glue_job"),
         ("4", "restart_etl"), ("5", "handle_cost_spike"), ("6", "cost_spike"),
         ("7", "trigger_glue"), ("8", "")], "request_id string, action string")
    out = {r.request_id: r for r in AL.action_routing(req).collect()}
    assert [out[str(i)].routed_action for i in range(1, 7)] == [
        "quarantine_data", "quarantine_data", "restart_job", "restart_job",
        "cost_spike_detected", "cost_spike_detected"]
    assert all(out[str(i)].status_code == 200 for i in range(1, 7))
    assert out["7"].status_code == 400 and out["7"].error == "Unknown action: trigger_glue"
    assert out["8"].status_code == 400 and out["8"].error == "Unknown action: "


RESP_SCHEMA = T.StructType([
    T.StructField("period_start", T.DateType()), T.StructField("total", T.DoubleType()),
    T.StructField("groups", T.ArrayType(T.StructType([
        T.StructField("service", T.StringType()), T.StructField("amount", T.DoubleType())])))])


def _resp(spark):
    return spark.createDataFrame([
        (dt.date(2024, 1, 1), 3.0, [("Compute", 2.5), ("Storage", 0.5)]),
        (dt.date(2024, 1, 2), None, [("Compute", 1.0), ("Functions", 0.25)]),   # Total absent
        (dt.date(2024, 1, 3), 1.0, []),                                    # no groups
        (dt.date(2024, 1, 4), 2.0, None),                                  # exactly the threshold
    ], RESP_SCHEMA)


def test_cost_rollup(spark):
    r = _resp(spark)
    by = sorted((x.period_start.day, x.service, x.amount) for x in CO.cost_by_service(r).collect())
    assert by == [(1, "Compute", 2.5), (1, "Storage", 0.5), (2, "Compute", 1.0), (2, "Functions", 0.25)]
    daily = {x.period_start.day: x for x in CO.cost_daily(r).collect()}
    assert daily[2].total_cost == 0.0 and daily[2].service_sum == 1.25
    assert daily[3].n_services == 0 and daily[4].service_sum == 0.0
    y = CO.cost_yesterday(r, dt.date(2024, 1, 3)).collect()
    assert [x.period_start.day for x in y] == [2]
    st = {x.period_start.day: x for x in CO.cost_status(r, DEFAULT).collect()}
    assert st[1].status == "high" and st[1].service_breakdown == {"Compute": 2.5, "Storage": 0.5}
    assert st[1].breakdown_text == "Compute=2.50000000;Storage=0.50000000"
    assert st[4].status == "normal" and st[4].service_breakdown is None  # strict >
    pts = CO.cost_metric_points(r, DEFAULT)
    assert pts.filter("metric_name = 'DailyCost'").count() == 4
    assert pts.filter("metric_name = 'ServiceCost'").count() == 4


def test_cost_summary_fallback(spark):
    empty = spark.createDataFrame([], "namespace string, metric_name string, dimension string, "
                                      "ts timestamp_ntz, value double, unit string")
    s = TS.cost_summary(empty, DEFAULT).first()
    assert s.current_daily_cost == 0.02 and s.avg_daily_cost == 0.02
    assert abs(s.projected_monthly - 0.6) < 1e-12 and s.budget_status == "Within budget"


def test_latest_file_and_bands(spark):
    t0 = dt.datetime(2024, 1, 30, 10)
    rows = []
    for f, ts, total, gold, silver, anom in [("claims/payer_claims_a.csv", t0, 100, 90, 8, 10),
                                             ("claims/payer_claims_b.csv", t0 + dt.timedelta(hours=2), 50, 40, 6, 10),
                                             ("claims/", t0 + dt.timedelta(hours=3), 150, 130, 14, 20)]:
        for m, v in [("TotalRecords", total), ("GoldRecords", gold), ("SilverRecords", silver),
                     ("AnomalyCount", anom)]:
            rows.append((NS, m, f, ts, float(v), "Count"))
    pts = spark.createDataFrame(rows, PT_SCHEMA)
    s = TS.latest_file_summary(pts, DEFAULT).first()
    assert s.source_file == "claims/payer_claims_b.csv"
    assert (s.total_records, s.gold_records, s.data_quality_issues, s.total_anomalies) == (50, 40, 6, 10)
    assert s.dq_score == 80.0
    bands = {r.score: r.band for r in TS.score_bands(
        spark.createDataFrame([(79.99,), (80.0,), (94.99,), (95.0,)], "score double"), DEFAULT, "score").collect()}
    assert bands == {79.99: "below_80", 80.0: "80_to_95", 94.99: "80_to_95", 95.0: "95_and_above"}
    rec = TS.metric_recent(pts, 1).filter("metric_name = 'TotalRecords'").count()
    assert rec == 3


def test_metrics_invariants_and_empty(spark):
    tiers = spark.createDataFrame([("claims/a.csv", "gold"), ("claims/a.csv", "silver"),
                                   ("claims/a.csv", "quarantine"), ("b.csv", "gold")],
                                  "source_file string, tier string")
    m = {r.source_file: r for r in ME.dq_metrics(tiers, ["source_file"]).collect()}
    a = m["claims/a.csv"]
    assert a.total_anomalies == 2 and abs(a.data_quality_score + a.anomaly_rate - 100.0) < 1e-12
    folder = {r.source_file: r.total_records for r in
              ME.rollup_by_folder(ME.dq_metrics(tiers, ["source_file"]), []).collect()}
    assert folder == {"claims/": 3, "b.csv": 1}
    empty = ME.dq_metrics(tiers.limit(0)).first()
    assert empty.total_records == 0 and empty.data_quality_score == 0.0 and empty.anomaly_rate == 0.0


def test_top_issues_and_nulls(spark):
    failed = spark.createDataFrame([("f", "A;B;"), ("f", "A;"), ("f", "C;B;A;"), ("g", "Z;")],
                                   "source_file string, dq_issues string")
    top = [(r.issue, r.occurrences) for r in ME.top_issues(failed, 2).collect()]
    assert top == [("A", 3), ("B", 2)]
    per = {(r.source_file, r.rank): r.issue for r in ME.top_issues(failed, 2, by=["source_file"]).collect()}
    assert per == {("f", 1): "A", ("f", 2): "B", ("g", 1): "Z"}
    df = spark.createDataFrame([(1, None), (2, "x"), (None, None)], "a int, b string")
    nr = {r.column_name: (r.null_rate, r.exceeds_threshold) for r in ME.null_rates(df, ["a", "b"]).collect()}
    assert nr["a"][1] and abs(nr["b"][0] - 2 / 3) < 1e-12


def test_metric_stream_matches_batch(spark, tmp):
    vals = [(h, h % 5) for h in range(0, 30)]
    pts = _pts(spark, "AnomalyCount", vals).unionByName(
        _pts(spark, "AnomalyCount", [(h, 1) for h in range(0, 30)], start=dt.datetime(2024, 1, 1, 0, 30)))
    pts.write.parquet(f"{tmp}/points")
    q = start_hourly_buckets(spark, f"{tmp}/points", f"{tmp}/out", f"{tmp}/ckpt", delay="1 hour",
                             schema=pts.schema)
    q.awaitTermination(120)
    got = spark.read.parquet(f"{tmp}/out")
    batch = TS.metric_buckets(pts, 3600)
    # append mode emits windows whose end is at or before the watermark
    # (max ts 05:30 - 1 hour = 04:30), so the 04:00 window stays open
    closed = batch.filter(F.col("period_start") < F.lit("2024-01-02 04:00:00").cast("timestamp_ntz"))
    a = sorted((r.period_start, r.sum, r.sample_count) for r in got.collect())
    b = sorted((r.period_start, r.sum, r.sample_count) for r in closed.collect())
    assert a == b and len(a) >= 25


@pytest.mark.parametrize("seconds", [300, 3600, 86400])
def test_bucket_alignment(spark, seconds):
    pts = _pts(spark, "M", [(0, 1), (1, 2), (25, 3)], start=dt.datetime(2024, 1, 1, 0, 7))
    b = TS.metric_buckets(pts, seconds).collect()
    for r in b:
        epoch = (r.period_start - dt.datetime(1970, 1, 1)).total_seconds()
        assert epoch % seconds == 0


@pytest.mark.parametrize("seed,n", [(1, 1), (2, 2), (3, 3), (4, 2)])
def test_alarm_votes_match_brute_force(spark, seed, n):
    import random
    rnd = random.Random(seed)
    hours = [h for h in range(72) if rnd.random() > 0.15]           # some hours missing
    vals = [(h, rnd.choice([50.0, 90.0, 95.0])) for h in hours]      # < 85 breaches
    d = AL.AlarmDef("a", NS, "S", "claims/", "Average", "LessThanThreshold", 85.0, n, 3600, None, None)
    d, pts = _def(spark, d), _pts(spark, "S", vals)
    al = AL.alarm_periods(pts, d)
    got = sorted(r.period_start.hour + 24 * (r.period_start.day - 1) for r in al.collect())
    breach = {h for h, v in vals if v < 85.0}
    want = sorted(h for h in breach if all(h - k in breach for k in range(n)))
    assert got == want
    tr = sorted(r.period_start.hour + 24 * (r.period_start.day - 1)
                for r in AL.alarm_transitions(pts, d).collect())
    assert tr == [h for h in want if h - 1 not in set(want)]


def test_alarms_of_all_kinds_in_one_pass(spark):
    """Different statistics, periods and lengths together give what each gives alone."""
    import random
    rnd = random.Random(8)
    defs = [AL.AlarmDef(f"{st}-{cmp}-{n}-{sec}", NS, m, "claims/", st, cmp, th, n, sec, "e", "a")
            for st in ("Sum", "Average", "Maximum", "Minimum", "SampleCount")
            for cmp in ("GreaterThanThreshold", "LessThanOrEqualToThreshold")
            for m, th, n, sec in (("M", 3.0, 1, 3600), ("N", 2.0, 2, 7200))]
    rows = [(NS, m, dim, dt.datetime(2024, 1, 1) + dt.timedelta(minutes=rnd.randint(0, 3000)),
             float(rnd.randint(0, 5)), "Count") for m in "MNO" for dim in ("claims/", "other/") for _ in range(60)]
    pts = spark.createDataFrame(rows, PT_SCHEMA)
    stat = {"Sum": sum, "Average": lambda v: sum(v) / len(v), "Maximum": max, "Minimum": min, "SampleCount": len}
    want, began = set(), set()
    for d in defs:
        groups = {}
        for _, m, dim, ts, v, _ in rows:
            if m == d.metric_name and dim == "claims/":
                p = int((ts - dt.datetime(1970, 1, 1)).total_seconds()) // d.period_seconds
                groups.setdefault(p, []).append(v)
        hit = {p for p, v in groups.items() if (stat[d.statistic](v) > d.threshold
                                                if d.comparison.startswith("Greater") else stat[d.statistic](v) <= d.threshold)}
        alarm = {p for p in hit if all(p - k in hit for k in range(d.periods))}
        want |= {(d.alarm_name, p) for p in alarm}
        began |= {(d.alarm_name, p) for p in alarm if p - 1 not in alarm}
    seconds = {d.alarm_name: d.period_seconds for d in defs}

    def found(df):
        return {(r.alarm_name, int((r.period_start - dt.datetime(1970, 1, 1)).total_seconds()) // seconds[r.alarm_name])
                for r in df.collect()}
    table = _def(spark, *defs)
    assert found(AL.alarm_periods(pts, table)) == want
    assert found(AL.alarm_transitions(pts, table)) == began
    assert AL.alarm_events(pts, table).count() == len(began)
    plan = AL.alarm_events(pts, table)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") <= 2


def test_last_hour_maximum_is_taken(spark):
    t0 = dt.datetime(2024, 1, 30, 10)
    rows = [(NS, "TotalRecords", "claims/payer_claims_a.csv", t0 + dt.timedelta(minutes=m), v, "Count")
            for m, v in ((-90, 99.0), (5, 7.0), (20, 12.0), (40, 3.0))]
    s = TS.latest_file_summary(spark.createDataFrame(rows, PT_SCHEMA), DEFAULT).first()
    assert s.total_records == 12


def test_parse_cost_answers(spark):
    one = ('{"ResultsByTime":[{"TimePeriod":{"Start":"2024-01-01","End":"2024-01-02"},'
           '"Total":{"UnblendedCost":{"Amount":"3.5","Unit":"USD"}},"Groups":['
           '{"Keys":["B"],"Metrics":{"UnblendedCost":{"Amount":"1.0"}}},{"Keys":["A"],"Metrics":{"UnblendedCost":{"Amount":"x"}}},'
           '{"Keys":["B"],"Metrics":{"UnblendedCost":{"Amount":"2.25"}}}]},'
           '{"TimePeriod":{"Start":"2024-01-02"},"Groups":[]}]}')
    df = spark.createDataFrame([(1, one), (2, "{}"), (3, '{"ResultsByTime":[]}'), (4, None), (5, "not json")],
                               "id int, response string")
    got = sorted(((r.id, r.period_start, r.total, [tuple(g) for g in r.groups])
                  for r in CO.parse_responses(df, keep=("id",)).collect()), key=lambda r: (r[0], str(r[1])))
    assert got == [(1, dt.date(2024, 1, 1), 3.5, [("A", None), ("B", 2.25)]), (1, dt.date(2024, 1, 2), None, []),
                   (2, None, None, []), (3, None, None, []), (4, None, None, []), (5, None, None, [])]
    daily = {(r.period_start, r.total_cost) for r in CO.cost_daily(CO.parse_responses(df)).collect()}
    assert (dt.date(2024, 1, 2), 0.0) in daily and (dt.date(2024, 1, 1), 3.5) in daily


def test_cost_spike_event_shape(spark):
    import json
    e = CO.cost_spike_events(_resp(spark), dt.datetime(2024, 1, 5, 6, 7, 8), DEFAULT).collect()
    assert len(e) == 1 and e[0].detail_type == "Cost Spike Detected"
    assert json.loads(e[0].detail_json) == {
        "current_cost": 3.0, "threshold": 2.0, "service_breakdown": {"Compute": 2.5, "Storage": 0.5},
        "date": "2024-01-01", "timestamp": "2024-01-05T06:07:08"}
