"""

Each callable takes ``(spark, sf_dir)`` and returns a DataFrame over the whole
driver tables (claims come from ``events`` through fixture F1, costs from
``orders`` x ``customer`` through fixture F4).  Computed doubles are rounded
to 6 digits so the DuckDB oracle can compare them across engines.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce
from typing import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from claimsdq.functions.columns import folder_prefix
from claimsdq.functions.rules import RULES
from claimsdq.operators import alarms as AL
from claimsdq.operators import costs as CO
from claimsdq.operators import metrics as ME
from claimsdq.operators import remediation as RE
from claimsdq.operators import timeseries as TS
from claimsdq.operators.anomaly import amount_stats, score_claims
from claimsdq.operators.moments import file_moments, merged_stats
from claimsdq.operators.tiers import gold_tier, quarantine_tier, silver_tier, tier_counts
from claimsdq.operators.validate import ALL_MATCH, FIRST_MATCH, rule_hits, with_issues
from claimsdq.plans import fixtures as FX
from claimsdq.plans.batch import run_csv_job, run_tiers
from claimsdq.plans.fixtures import P, P_F3, load_claims
from claimsdq.plans.remediate import audit_log, quarantine_files, remediate, status_as_of
from claimsdq.plans.rollups import LEVELS, Rollups
from claimsdq.plans.store import Store, in_range
from claimsdq.session import checkpoint_dir, copy_file, staging_path
from claimsdq.sources.claims import (CLAIM_COLUMNS, list_claim_files, read_claims_csv, read_claims_untyped,
                                     read_table)
from claimsdq.streaming.alarm_stream import alarm_events_of, start_alarms
from claimsdq.streaming.arrival_events import start_event_ingest
from claimsdq.streaming.file_ingest import ingest_arrivals, start_file_ingest
from claimsdq.streaming.metric_stream import hourly_now, start_published_hours

R = 6
# Cost amounts are cents / 1e6: 8 digits keep them exact (6 would cut at
# half-cent ties, which two engines may round apart).
RC = 8


def _r(c: str | Column, name: str | None = None, digits: int = R) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    return F.round(col, digits).alias(name or (c if isinstance(c, str) else None))


def _rc(c: str) -> Column:
    return _r(c, digits=RC)


# ---------------------------------------------------------------- builders

def claims(spark: SparkSession, sf: str) -> DataFrame:
    return load_claims(spark, sf)


def flagged(spark: SparkSession, sf: str, mode: str = FIRST_MATCH) -> DataFrame:
    return with_issues(claims(spark, sf), P, mode)


def tiered(spark: SparkSession, sf: str) -> DataFrame:
    return score_claims(flagged(spark, sf), P)


_tables: dict[tuple, str] = {}


def written_once(spark: SparkSession, sf: str, name: str, write: Callable[[str], None]) -> str:
    """A folder that ``write`` filled, once per application and input: queries
    over the same written table share it instead of writing it again."""
    key = (spark.sparkContext.applicationId, checkpoint_dir(spark), sf, name)
    if key not in _tables:
        path = staging_path(spark, name)
        write(path)
        _tables[key] = path
    return _tables[key]


def points_table(spark: SparkSession, sf: str) -> DataFrame:
    """F3 as the read side finds it: file-level hourly points, in date folders."""
    def write(path: str) -> None:
        wide = ME.hourly_file_metrics(tiered(spark, sf))
        ME.to_points(wide, P.dq_namespace, ["source_file", "ts"]).withColumn("date", F.to_date("ts")) \
            .repartition("date").write.partitionBy("date").parquet(path)
    return spark.read.parquet(written_once(spark, sf, "points", write))


def points(spark: SparkSession, sf: str, level: str = "all", start=None, end=None) -> DataFrame:
    files = in_range(points_table(spark, sf), start, end).drop("date")
    if level == "file":
        return files
    folders = ME.folder_points(files)
    return folders if level == "folder" else files.unionByName(folders)


def file_metrics(spark: SparkSession, sf: str) -> DataFrame:
    return ME.dq_metrics(tiered(spark, sf), ["source_file"])


def cost_resp(spark: SparkSession, sf: str) -> DataFrame:
    return FX.cost_responses(read_table(spark, sf, "orders"), read_table(spark, sf, "customer"))


def _point_cols(df: DataFrame, dim: str = "source_file") -> DataFrame:
    return df.select("namespace", "metric_name", dim, "ts", _r("value"), "unit")


# ---------------------------------------------------------------- scans, rules

def q_claims_scan(spark, sf):
    return claims(spark, sf)


def q_ingest_metadata(spark, sf):
    return claims(spark, sf).select("claim_id", "source_file",
                                    folder_prefix(F.col("source_file")).alias("folder"))


def _rule_query(code: str) -> Callable:
    def q(spark, sf):
        return rule_hits(claims(spark, sf), code, P)
    q.__name__ = f"q_rule_{code.lower()}"
    return q


#: Query names of the rules whose own name is longer than need be.
_SHORT = {"MISSING_MEMBER_ID": "missing_member", "FUTURE_SERVICE_DATE": "future_service"}
RULE_QUERIES = {f"rule_{_SHORT.get(r.code, r.code.lower())}": r.code for r in RULES}


def q_dq_issues_first_match(spark, sf):
    return flagged(spark, sf).select("claim_id", "dq_issues")


def q_dq_issues_all_match(spark, sf):
    return flagged(spark, sf, ALL_MATCH).select("claim_id", "dq_issues")


def q_dq_clean(spark, sf):
    return flagged(spark, sf).filter(~F.col("has_dq_issues")).select(*CLAIM_COLUMNS, "source_file")


def q_dq_failed(spark, sf):
    return flagged(spark, sf).filter(F.col("has_dq_issues")) \
        .select("claim_id", "dq_issues", "has_dq_issues", "source_file")


# ---------------------------------------------------------------- outliers, tiers

def q_amount_stats_by_code(spark, sf):
    clean = flagged(spark, sf).filter(~F.col("has_dq_issues"))
    return amount_stats(clean).select("cpt_code", _r("avg_amount"), _r("stddev_amount"), "count")


def _clean_scored(spark, sf) -> DataFrame:
    return tiered(spark, sf).filter(F.col("tier") != "silver")


def q_claims_with_stats(spark, sf):
    return _clean_scored(spark, sf).select("claim_id", "cpt_code", "claim_amount", _r("avg_amount"),
                                           _r("stddev_amount"), "count")


def q_z_scores(spark, sf):
    return _clean_scored(spark, sf).select("claim_id", "cpt_code", "claim_amount", _r("z_score"))


def q_outlier_flags(spark, sf):
    return _clean_scored(spark, sf).select("claim_id", "cpt_code", "is_statistical_outlier")


def q_gold_tier(spark, sf):
    return gold_tier(tiered(spark, sf))


def q_silver_tier(spark, sf):
    # silver needs the rules only, no stats
    failed = flagged(spark, sf).filter("has_dq_issues").withColumn("tier", F.lit("silver"))
    return silver_tier(failed)


def q_quarantine_tier(spark, sf):
    q = quarantine_tier(tiered(spark, sf), details_digits=4)
    return q.select("claim_id", "member_id", "provider_id", "cpt_code", "claim_amount", "service_date",
                    _r("z_score"), _r("avg_amount"), _r("stddev_amount"), "anomaly_type",
                    "anomaly_details", "source_file")


def q_tier_counts(spark, sf):
    return tier_counts(tiered(spark, sf))


def q_tiers_per_file_run(spark, sf):
    """Tier counts when every file is its own run (one run per arriving file,
    as the stream does): z-score stats keyed by (source_file, cpt_code)."""
    per_file = P.with_(stats_keys=("source_file", "cpt_code"))
    t = score_claims(flagged(spark, sf), per_file)
    return ME.dq_metrics(t, ["source_file"]).select(
        "source_file", *_WIDE, _r("data_quality_score"), _r("anomaly_rate"))


# ---------------------------------------------------------------- metrics

_WIDE = ["total_records", "gold_records", "silver_records", "quarantine_records", "total_anomalies"]


def q_dq_metrics(spark, sf):
    return ME.dq_metrics(tiered(spark, sf)).select(*_WIDE, _r("data_quality_score"), _r("anomaly_rate"))


def q_dq_metrics_clean_based(spark, sf):
    m = ME.clean_based_metrics(flagged(spark, sf, ALL_MATCH))
    return m.select("source_file", "raw_records", "clean_records", "anomaly_records",
                    _r("data_quality_score"), _r("anomaly_rate"))


def q_metric_points_by_file(spark, sf):
    return _point_cols(points(spark, sf, "file"))


def q_metric_points_by_folder(spark, sf):
    return _point_cols(points(spark, sf, "folder"))


def q_top_issues(spark, sf):
    failed = flagged(spark, sf, ALL_MATCH).filter(F.col("has_dq_issues"))
    return ME.top_issues(failed, 5, by=["source_file"])


def q_overall_summary(spark, sf):
    s = ME.overall_summary(ME.clean_based_metrics(flagged(spark, sf, ALL_MATCH)))
    return s.select("total_clean", "total_anomalies", "total_raw", _r("data_quality_score"),
                    _r("anomaly_rate"))


def q_null_rates(spark, sf):
    n = ME.null_rates(claims(spark, sf), CLAIM_COLUMNS, P)
    return n.select("column_name", _r("null_rate"), "exceeds_threshold")


def q_metrics_json(spark, sf):
    return ME.metrics_json(file_metrics(spark, sf), digits=4)


def q_sample_failures(spark, sf):
    # O2 comes from the local checker: its failures follow the all-match rules
    f = flagged(spark, sf, ALL_MATCH).filter(F.col("has_dq_issues"))
    return f.select("claim_id", "claim_amount", "provider_npi", "service_date", "dq_issues") \
        .orderBy("claim_id").limit(5)


def q_union_failures(spark, sf):
    """Rule failures and outliers in one review table.  Both come from the
    same tiered claims, so one filtered pass replaces a union of two scans."""
    t = tiered(spark, sf).filter(F.col("tier").isin("silver", "quarantine"))
    silver = F.col("tier") == "silver"
    return t.select("claim_id", "source_file",
                    F.when(silver, F.lit("DQ_FAILURE")).otherwise(F.lit("STATISTICAL_OUTLIER"))
                    .alias("reason_type"),
                    F.when(silver, F.col("dq_issues")).otherwise(F.lit("STATISTICAL_OUTLIER"))
                    .alias("details"))


# ---------------------------------------------------------------- time series

def q_metric_range(spark, sf):
    pts = points(spark, sf, "folder", P.as_of_ts - dt.timedelta(hours=168), P.as_of_ts)
    return _point_cols(TS.metric_range(pts, P.dq_namespace, "DataQualityScore", P.folder, 168, P.as_of_ts))


def q_metric_hourly(spark, sf):
    b = TS.metric_buckets(points(spark, sf), 3600)
    return b.select(*TS.SERIES, "period_start", _r("average"), _r("sum"), _r("maximum"), _r("minimum"),
                    "sample_count")


def q_metric_daily(spark, sf):
    b = TS.metric_buckets(points(spark, sf), 86400)
    return b.select(*TS.SERIES, "period_start", _r("average"), _r("sum"), _r("maximum"), _r("minimum"),
                    "sample_count")


def q_metric_latest(spark, sf):
    return TS.metric_latest(points(spark, sf)).select(*TS.SERIES, "latest_ts", _r("latest_value"))


def q_metric_recent(spark, sf):
    return TS.metric_recent(points(spark, sf), 3).select(*TS.SERIES, "ts", _r("value"), "recency")


def q_metric_dimensions(spark, sf):
    # per-file dimensions only: the folder roll-up would be filtered out
    return TS.metric_dimensions(points(spark, sf, "file"), contains="payer_claims")


def q_latest_file_summary(spark, sf):
    pts = points(spark, sf, "file", P.as_of_ts - dt.timedelta(days=7), P.as_of_ts)
    s = TS.latest_file_summary(pts, P, contains="payer_claims")
    return s.select("source_file", "total_anomalies", "data_quality_issues", "total_records",
                    "gold_records", _r("dq_score"))


def q_score_bands(spark, sf):
    m = file_metrics(spark, sf).select("source_file", F.col("data_quality_score").alias("dq_score"))
    b = TS.score_bands(m, P)
    return b.select("source_file", _r("dq_score"), _r("delta_vs_target"), "meets_target", "band")


def q_cost_summary(spark, sf):
    pts = CO.cost_metric_points(cost_resp(spark, sf), P)
    s = TS.cost_summary(pts, P)
    return s.select(_rc("current_daily_cost"), _rc("avg_daily_cost"), _rc("projected_monthly"),
                    "days_with_data", _rc("delta_vs_avg"), "budget_status")


# ---------------------------------------------------------------- alarms

def _alarm_out(df: DataFrame) -> DataFrame:
    return df.select("alarm_name", "period_start", _rc("value"), "state")


def _defs(spark, metric: str | None = None) -> DataFrame:
    return AL.alarm_definitions(spark, defs=[d for d in AL.alarm_defs(P_F3) if metric in (None, d.metric_name)])


def _cost_points(spark, sf) -> DataFrame:
    return CO.cost_metric_points(cost_resp(spark, sf), P).withColumnRenamed("dimension", "source_file")


def _alarm_points(spark, sf) -> DataFrame:
    """Every series that an alarm watches, in one table."""
    return points(spark, sf, "folder").unionByName(_cost_points(spark, sf))


def q_alarm_anomaly(spark, sf):
    return _alarm_out(AL.alarm_periods(points(spark, sf, "folder"), _defs(spark, "AnomalyCount")))


def q_alarm_score(spark, sf):
    return _alarm_out(AL.alarm_periods(points(spark, sf, "folder"), _defs(spark, "DataQualityScore")))


def q_alarm_cost(spark, sf):
    return _alarm_out(AL.alarm_periods(_cost_points(spark, sf), _defs(spark, "DailyCost")))


def q_alarm_transitions(spark, sf):
    return _alarm_out(AL.alarm_transitions(_alarm_points(spark, sf), _defs(spark)))


def _events(spark, sf) -> DataFrame:
    return AL.alarm_events(_alarm_points(spark, sf), _defs(spark))


def q_alarm_events(spark, sf):
    return _events(spark, sf).select("event_type", "alarm_name", "state", "reason", "timestamp",
                                     "action", _rc("value"))


def _requests(spark, sf) -> DataFrame:
    """Action requests from ``events``: one per event, over the six known names,
    an unknown one, an empty one and none at all."""
    names = F.array(*[F.lit(n) for n, _ in AL.ACTION_ROUTES], F.lit("drop_tables"), F.lit(""), F.lit(None))
    return read_table(spark, sf, "events").select(
        F.concat(F.lit("R"), F.col("event_id").cast("string")).alias("request_id"),
        F.get(names, F.pmod("event_id", F.lit(9)).cast("int")).alias("action"))


def q_action_routing(spark, sf):
    e = _events(spark, sf)
    req = e.select(F.concat(F.col("alarm_name"), F.lit("@"),
                            F.date_format(F.col("timestamp"), "yyyyMMddHH")).alias("request_id"),
                   "action")
    return AL.action_routing(req.unionByName(_requests(spark, sf)))


# ---------------------------------------------------------------- costs

def _parsed(spark, sf) -> DataFrame:
    """F4's nested answers, parsed; the answer's own day stands in for a period
    that is not there."""
    answers = FX.cost_json(read_table(spark, sf, "orders"), read_table(spark, sf, "customer"))
    p = CO.parse_responses(answers.withColumnRenamed("period_start", "day"), keep=("day",))
    return p.withColumn("period_start", F.coalesce("period_start", "day"))


def q_cost_parse(spark, sf):
    groups = F.array_join(F.transform("groups", lambda g: F.concat(
        g["service"], F.lit("="), F.format_string("%.8f", g["amount"]))), ";")
    return _parsed(spark, sf).select("day", "period_start", _rc("total"), groups.alias("groups_text"))


def q_cost_by_service(spark, sf):
    return CO.cost_by_service(cost_resp(spark, sf)).select("period_start", "service", _rc("amount"))


def q_cost_daily(spark, sf):
    d = CO.cost_daily(_parsed(spark, sf))
    return d.select("period_start", _rc("total_cost"), _rc("service_sum"), "n_services")


def q_cost_yesterday(spark, sf):
    y = CO.cost_yesterday(cost_resp(spark, sf), P.need("cost_as_of"))
    return CO.cost_by_service(y).select("period_start", "service", _rc("amount"))


def q_cost_metric_points(spark, sf):
    p = CO.cost_metric_points(cost_resp(spark, sf), P)
    return p.select("namespace", "metric_name", "dimension", "ts", _rc("value"), "unit")


def q_cost_status(spark, sf):
    s = CO.cost_status(cost_resp(spark, sf), P)
    return s.select("period_start", _rc("total_cost"), "threshold", "status", "breakdown_text")


def q_cost_spike_events(spark, sf):
    e = CO.cost_spike_events(cost_resp(spark, sf), P.need("as_of_ts"), P)
    breakdown = F.array_join(F.transform(F.array_sort(F.map_entries("detail.service_breakdown")), lambda g: F.concat(
        g["key"], F.lit("="), F.format_string("%.8f", g["value"]))), ";")
    return e.select("detail_type", _rc("detail.current_cost").alias("current_cost"),
                    F.col("detail.threshold").alias("threshold"), breakdown.alias("service_breakdown"),
                    F.col("detail.date").alias("date"), F.col("detail.timestamp").alias("timestamp"))


# ---------------------------------------------------------------- remediation

def file_metrics_table(spark: SparkSession, sf: str) -> DataFrame:
    """The per-file metrics as a run writes them: remediation starts from these,
    not from another pass over the claims."""
    return spark.read.parquet(written_once(
        spark, sf, "file-metrics", lambda path: file_metrics(spark, sf).write.parquet(path)))


def _flagged_files(spark, sf) -> DataFrame:
    return RE.flagged_files(file_metrics_table(spark, sf), P)


def q_quarantine_by_file(spark, sf):
    return RE.quarantine_by_file(claims(spark, sf), _flagged_files(spark, sf), P) \
        .select("claim_id", "source_file")


def q_retain_by_file(spark, sf):
    return RE.retain_by_file(claims(spark, sf), _flagged_files(spark, sf), P) \
        .select("claim_id", "source_file")


def _file_status(spark, sf) -> DataFrame:
    rows = file_metrics_table(spark, sf).select("source_file", F.col("total_records").alias("rows"))
    return RE.file_status(rows, _flagged_files(spark, sf), P)


def q_file_status(spark, sf):
    return _file_status(spark, sf)


def q_quarantine_summary(spark, sf):
    return RE.quarantine_summary(_file_status(spark, sf))


def q_quarantine_sink(spark, sf):
    """What lies in quarantine after the score-based action, the same action
    again (which finds nothing new), and the action for one prefix."""
    store = Store(spark, staging_path(spark, "remediation"))
    c, m = claims(spark, sf), file_metrics_table(spark, sf)
    quarantine_files(c, m, store, "run1", P)
    quarantine_files(c, m, store, "run2", P)
    quarantine_files(c, m, store, "run3", P, prefix="claims/payer_claims_2024010")
    rows = spark.read.parquet(f"{store.root}/quarantined_files")
    return rows.select("claim_id", "source_file", "run_id")


def q_remediation_audit(spark, sf):
    """The audit log after the same requests came twice, the second time doubled:
    each was carried out once."""
    store = Store(spark, staging_path(spark, "remediation"))
    at = P.need("as_of_ts").replace(tzinfo=dt.timezone.utc)
    asked = _requests(spark, sf)
    for run, requests in (("audit", asked), ("again", asked.unionByName(asked))):
        remediate(requests, claims(spark, sf), file_metrics_table(spark, sf), store, at, P, run_id=run)
    return audit_log(store).drop("run_id")


def versioned(spark: SparkSession, sf: str) -> Store:
    """F1's files in three versions (``after_rerun``), each followed half a day
    later by the score-based quarantine."""
    def write(path: str) -> None:
        store = Store(spark, path)
        for n, at, rows, files in rerun_steps(spark, sf):
            run_tiers(rows, path, P, run_ts=at, run_id=f"run{n}", files=files.withColumn("modified", F.lit(at)))
            now = store.read("metrics/files").drop("run_id")
            quarantine_files(rows, now, store, f"act{n}", P, at=at + dt.timedelta(hours=12))
    return Store(spark, written_once(spark, sf, "versioned", write))


def q_file_status_as_of(spark, sf):
    """The status of every file a quarter and three quarters into each day."""
    store = versioned(spark, sf)
    start = 1732924800                                # 30 November 2024
    times = F.explode(F.sequence(F.lit(start + 21600), F.lit(start + 21600 + 4 * 86400), F.lit(43200))).alias("s")
    asked = store.manifest().select("source_file").distinct().select("source_file", times) \
        .select("source_file", F.timestamp_seconds("s").alias("at"))
    out = status_as_of(store, asked)
    modified = F.timestamp_micros(F.col("version").cast("long")).cast("timestamp_ntz")
    return out.select("source_file", F.col("at").cast("timestamp_ntz").alias("at"), modified.alias("modified"), "status")


# ---------------------------------------------------------------- sinks, reruns, arrivals

def rerun_steps(spark: SparkSession, sf: str):
    """(n, time, claims, files) of three runs: F1 whole, one mended file alone,
    the mended prefix whole."""
    first = claims(spark, sf)
    mended = FX.corrected(first)
    alone = mended.filter("source_file = 'claims/payer_claims_20240103.csv'")
    for n, rows in enumerate((first, alone, mended)):
        at = dt.datetime(2024, 12, 1 + n, tzinfo=dt.timezone.utc)
        files = first if n != 1 else alone
        yield n, at, rows.withColumn("ingestion_timestamp", F.lit(at)), files.select("source_file").distinct()


def after_rerun(spark: SparkSession, sf: str) -> Store:
    """A store after the three runs of ``rerun_steps``."""
    def write(path: str) -> None:
        for n, at, rows, files in rerun_steps(spark, sf):
            run_tiers(rows, path, P, run_ts=at, run_id=f"run{n}", files=files)
    return Store(spark, written_once(spark, sf, "after-rerun", write))


def q_gold_after_rerun(spark, sf):
    return after_rerun(spark, sf).read("gold").drop("ingestion_timestamp", "run_id")


def q_silver_after_rerun(spark, sf):
    return after_rerun(spark, sf).read("silver").drop("ingestion_timestamp", "run_id")


def q_quarantine_after_rerun(spark, sf):
    return after_rerun(spark, sf).read("quarantine").select(
        "claim_id", "cpt_code", "claim_amount", "service_date", _r("z_score"), "anomaly_type", "source_file")


def q_points_after_rerun(spark, sf):
    return _point_cols(after_rerun(spark, sf).points())


def q_points_as_of(spark, sf):
    """The points as they could be read after the first run, before the reruns."""
    return _point_cols(after_rerun(spark, sf).points(as_of=dt.datetime(2024, 12, 1, 12, tzinfo=dt.timezone.utc)))


def q_rollup_after_reruns(spark, sf):
    """Hour, day and 30-day rollups that followed the three runs one by one."""
    rollups = Rollups(after_rerun(spark, sf))
    rollups.apply_all()
    rows = [rollups.read(level).withColumn("level", F.lit(level)) for level in LEVELS]
    return reduce(DataFrame.unionByName, rows).select(
        "level", *TS.SERIES, "period_start", _r("sum"), "sample_count", _r("minimum"), _r("maximum"), _r("average"))


def q_z_scores_from_moments(spark, sf):
    """z-scores by moments kept per file and code and merged per code."""
    f = flagged(spark, sf)
    stats = merged_stats(file_moments(f.filter(~F.col("has_dq_issues"))))
    scored = score_claims(f, P, stats=stats).filter(F.col("tier") != "silver")
    return scored.select("claim_id", "cpt_code", "claim_amount", _r("z_score"))


def _as_csv(spark, sf, name: str, rows: Callable[[], DataFrame]) -> str:
    """F1 as CSV files with a header, one per day, under ``<root>/claims``."""
    def write(path: str) -> None:
        rows().repartition("day").write.partitionBy("day").option("header", "true").csv(f"{path}/claims")
    return written_once(spark, sf, name, write)


def _day_of() -> Column:
    return F.regexp_extract("source_file", "([0-9]{8})[.]csv$", 1).alias("day")


def _named(df: DataFrame) -> DataFrame:
    """The day folder's file under the name its day has in F1."""
    day = F.regexp_extract("source_file", "day=([0-9]{8})", 1)
    return df.withColumn("source_file", F.concat(F.lit("claims/payer_claims_"), day, F.lit(".csv")))


def f1_csv(spark: SparkSession, sf: str) -> str:
    return _as_csv(spark, sf, "f1-csv", lambda: claims(spark, sf).select(
        *FX.claim_fields_as_text(claims(spark, sf)), _day_of()))


def q_csv_scan(spark, sf):
    root = f1_csv(spark, sf)
    return _named(read_claims_csv(spark, f"{root}/claims", key_root=root)).drop("ingestion_timestamp")


def q_csv_untyped(spark, sf):
    """The same files as the local checker reads them, by header name."""
    root = f1_csv(spark, sf)
    return _named(read_claims_untyped(spark, f"{root}/claims", key_root=root)).drop("ingestion_timestamp")


def malformed_csv(spark: SparkSession, sf: str) -> str:
    """Files with bad dates, bad amounts and short rows."""
    n = F.substring("claim_id", 2, 10).cast("long")

    def lines() -> DataFrame:
        text = {c: F.coalesce(F.col(c), F.lit("")) for c in CLAIM_COLUMNS}
        text["service_date"] = F.when(n % 19 == 0, F.lit("2024-13-45")).otherwise(text["service_date"])
        text["claim_amount"] = F.when(n % 23 == 0, F.lit("abc")).otherwise(text["claim_amount"])
        whole, short = F.concat_ws(",", *text.values()), F.concat_ws(",", *[text[c] for c in CLAIM_COLUMNS[:3]])
        return claims(spark, sf).select(*FX.claim_fields_as_text(claims(spark, sf))) \
            .select(F.when(n % 31 == 0, short).otherwise(whole).alias("line"))

    return written_once(spark, sf, "f1-malformed", lambda path: lines().write.text(f"{path}/claims"))


def q_csv_malformed(spark, sf):
    """Each bad field is null and its row stays."""
    return read_claims_csv(spark, f"{malformed_csv(spark, sf)}/claims", header=False).select(*CLAIM_COLUMNS)


def q_stream_tiers(spark, sf):
    """F1's files through the arrival stream, each file its own run."""
    def write(path: str) -> None:
        root = f1_csv(spark, sf)
        q = start_file_ingest(spark, f"{root}/claims", path, f"{path}-stream", P, key_root=root, max_files_per_trigger=12)
        q.awaitTermination()
        if q.exception():
            raise q.exception()
    m = _named(Store(spark, written_once(spark, sf, "stream-tiers", write)).read("metrics/files"))
    return m.select("source_file", *_WIDE, _r("data_quality_score"), _r("anomaly_rate"))


def q_batch_csv_tiers(spark, sf):
    """F1's files through the batch job."""
    def write(path: str) -> None:
        root = f1_csv(spark, sf)
        run_csv_job(spark, f"{root}/claims", path, P, key_root=root, run_id="only")
    m = _named(Store(spark, written_once(spark, sf, "batch-tiers", write)).read("metrics/files"))
    return m.select("source_file", *_WIDE, _r("data_quality_score"), _r("anomaly_rate"))


def _reuploaded() -> Column:
    """Of F1's files, those that are uploaded again in their mended form."""
    return F.regexp_extract("source_file", "([0-9]{2})[.]csv$", 1).cast("int") % 3 == 0


def _upload_again(spark: SparkSession, sf: str, root: str) -> list[str]:
    """Put the mended rows of some days over the day's own file; the files' keys.
    The files are copied one by one under their old names, as an upload does."""
    fixed = FX.corrected(claims(spark, sf)).filter(_reuploaded())
    fresh = f"{root}/mended"
    fixed.select(*FX.claim_fields_as_text(fixed), _day_of()).repartition("day").write.partitionBy("day") \
        .option("header", "true").csv(fresh)
    files = {old: [r.path for r in list_claim_files(spark, f"{root}/{old}").select("path").collect()] for old in ("claims", "mended")}
    of_day = {p.rsplit("day=", 1)[1][:8]: p for p in files["claims"]}
    replaced = [(p, of_day[p.rsplit("day=", 1)[1][:8]]) for p in files["mended"]]
    for new, old in replaced:
        copy_file(spark, new, old)
    return [old.split(f"{root.rsplit('/', 1)[1]}/", 1)[1] for _, old in replaced]


def _stream(query) -> None:
    query.awaitTermination()
    if query.exception():
        raise query.exception()


def _raw_folder(spark: SparkSession, sf: str, name: str) -> str:
    """A folder of F1's CSV files of its own, to be written to."""
    root = staging_path(spark, name)
    rows = claims(spark, sf)
    rows.select(*FX.claim_fields_as_text(rows), _day_of()).repartition("day").write.partitionBy("day") \
        .option("header", "true").csv(f"{root}/claims")
    return root


def _by_file(spark: SparkSession, path: str) -> DataFrame:
    m = _named(Store(spark, path).read("metrics/files"))
    return m.select("source_file", *_WIDE, _r("data_quality_score"), _r("anomaly_rate"))


def q_arrivals_after_reupload(spark, sf):
    """F1's files by sweeps: all of them, then those uploaded again since."""
    def write(path: str) -> None:
        root = _raw_folder(spark, sf, "raw-swept")
        ingest_arrivals(spark, f"{root}/claims", path, P, key_root=root, max_files=12)
        _upload_again(spark, sf, root)
        ingest_arrivals(spark, f"{root}/claims", path, P, key_root=root)
    return _by_file(spark, written_once(spark, sf, "swept", write))


def q_arrivals_from_events(spark, sf):
    """F1's files by notices of created objects: each delivered twice, among
    notices of other objects; then the notices of those uploaded again."""
    def notices(keys: DataFrame, box: str, version: str, time: str) -> None:
        obj = F.struct(F.struct(F.lit("raw").alias("name")).alias("bucket"), F.struct(
            F.col("key"), F.lit(1).alias("size"), F.lit(version).alias("versionId")).alias("object"))
        record = F.struct(F.lit("ObjectCreated:Put").alias("eventName"), F.lit(time).alias("eventTime"), obj.alias("s3"))
        other = record.withField("eventName", F.lit("ObjectRemoved:Delete"))
        foreign = record.withField("s3.object.key", F.lit("claims/readme.txt"))
        keys.select(F.to_json(F.struct(F.array(record, other, foreign, record).alias("Records"))).alias("value")) \
            .write.mode("append").text(box)

    def write(path: str) -> None:
        root = _raw_folder(spark, sf, "raw-noticed")
        box = f"{root}/notices"

        def run() -> None:
            _stream(start_event_ingest(spark, box, path, f"{root}/stream", root, P, files_per_run=12))
        keys = list_claim_files(spark, f"{root}/claims", root).select(F.col("source_file").alias("key"))
        for _ in range(2):
            notices(keys, box, "v1", "2024-12-01T00:00:00.000Z")
        run()
        again = [(k,) for k in _upload_again(spark, sf, root)]
        notices(spark.createDataFrame(again, "key string"), box, "v2", "2024-12-02T00:00:00.000Z")
        run()
    return _by_file(spark, written_once(spark, sf, "noticed", write))


def q_csv_bad_records(spark, sf):
    """The records that a run over F1's malformed files kept: claim, number of
    fields, and whether the file has at the record's place what was kept."""
    def write(path: str) -> None:
        run_csv_job(spark, f"{malformed_csv(spark, sf)}/claims", path, P, key_root=malformed_csv(spark, sf), run_id="only",
                    rescue=True, only="*.txt", header=False)
    bad = Store(spark, written_once(spark, sf, "rescued", write)).read("bad_records")
    return bad.select("claim_id", "fields", (F.col("record") > 0).alias("placed"))


def q_metric_stream_hourly(spark, sf):
    """F3's points through a store and its metric stream: a run with other values
    that is superseded while the stream stands, one that never publishes, and the
    points themselves."""
    def write(path: str) -> None:
        pts, store = points_table(spark, sf), Store(spark, f"{path}-store")
        files = pts.select("source_file").distinct()

        def run(name: str, rows: DataFrame, day: int | None) -> None:
            store.write("metrics/points", name, rows)
            if day:
                store.publish(name, files, dt.datetime(2024, 12, day, tzinfo=dt.timezone.utc))
                _stream(start_published_hours(spark, store.root, path, f"{path}-stream"))
        later = F.expr("ts + INTERVAL 1 HOUR")
        run("first", pts.withColumns({"value": F.col("value") + 7, "ts": later, "date": F.to_date(later)}), 1)
        run("dead", pts.withColumn("value", F.col("value") * 3), None)
        run("second", pts, 2)
    b = hourly_now(spark, written_once(spark, sf, "stream-buckets", write))
    return b.select(*TS.SERIES, "period_start", _r("average"), _r("sum"), _r("maximum"), _r("minimum"), "sample_count")


def q_alarm_stream_events(spark, sf):
    """The batch evaluator's events, from the continuous one: the alarms' series as
    a stream, closed by a point far ahead that no alarm watches."""
    def write(path: str) -> None:
        pts = _alarm_points(spark, sf)
        pts.write.parquet(f"{path}-points/input")
        end = pts.agg(F.max("ts")).first()[0] + dt.timedelta(days=30)
        last = spark.createDataFrame([("none", "Heartbeat", "none", end, 0.0, "None")], pts.schema)
        last.write.mode("append").parquet(f"{path}-points/input")
        src = spark.readStream.schema(pts.schema).parquet(f"{path}-points/input")
        _stream(start_alarms(spark, src, AL.alarm_defs(P_F3), path, f"{path}-stream"))
    changes = spark.read.parquet(written_once(spark, sf, "alarm-changes", write) + "/changes")
    return alarm_events_of(changes).select("event_type", "alarm_name", "state", "reason", "timestamp", "action", _rc("value"))


# ---------------------------------------------------------------- catalog

def catalog() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    out: dict[str, Callable] = {
        "claims_scan": q_claims_scan,
        "ingest_metadata": q_ingest_metadata,
    }
    for key, code in RULE_QUERIES.items():
        out[key] = _rule_query(code)
    out.update({
        "dq_issues_first_match": q_dq_issues_first_match,
        "dq_issues_all_match": q_dq_issues_all_match,
        "dq_clean": q_dq_clean,
        "dq_failed": q_dq_failed,
        "amount_stats_by_code": q_amount_stats_by_code,
        "claims_with_stats": q_claims_with_stats,
        "z_scores": q_z_scores,
        "outlier_flags": q_outlier_flags,
        "gold_tier": q_gold_tier,
        "silver_tier": q_silver_tier,
        "quarantine_tier": q_quarantine_tier,
        "tier_counts": q_tier_counts,
        "tiers_per_file_run": q_tiers_per_file_run,
        "dq_metrics": q_dq_metrics,
        "dq_metrics_clean_based": q_dq_metrics_clean_based,
        "metric_points_by_file": q_metric_points_by_file,
        "metric_points_by_folder": q_metric_points_by_folder,
        "top_issues": q_top_issues,
        "overall_summary": q_overall_summary,
        "null_rates": q_null_rates,
        "metrics_json": q_metrics_json,
        "sample_failures": q_sample_failures,
        "union_failures": q_union_failures,
        "metric_range": q_metric_range,
        "metric_hourly": q_metric_hourly,
        "metric_daily": q_metric_daily,
        "metric_latest": q_metric_latest,
        "metric_recent": q_metric_recent,
        "metric_dimensions": q_metric_dimensions,
        "latest_file_summary": q_latest_file_summary,
        "score_bands": q_score_bands,
        "cost_summary": q_cost_summary,
        "alarm_anomaly": q_alarm_anomaly,
        "alarm_score": q_alarm_score,
        "alarm_cost": q_alarm_cost,
        "alarm_transitions": q_alarm_transitions,
        "alarm_events": q_alarm_events,
        "action_routing": q_action_routing,
        "cost_parse": q_cost_parse,
        "cost_spike_events": q_cost_spike_events,
        "cost_by_service": q_cost_by_service,
        "cost_daily": q_cost_daily,
        "cost_yesterday": q_cost_yesterday,
        "cost_metric_points": q_cost_metric_points,
        "cost_status": q_cost_status,
        "quarantine_by_file": q_quarantine_by_file,
        "retain_by_file": q_retain_by_file,
        "quarantine_summary": q_quarantine_summary,
        "file_status": q_file_status,
        "quarantine_sink": q_quarantine_sink,
        "remediation_audit": q_remediation_audit,
        "file_status_as_of": q_file_status_as_of,
        "gold_after_rerun": q_gold_after_rerun,
        "silver_after_rerun": q_silver_after_rerun,
        "quarantine_after_rerun": q_quarantine_after_rerun,
        "points_after_rerun": q_points_after_rerun,
        "csv_scan": q_csv_scan,
        "csv_untyped": q_csv_untyped,
        "csv_malformed": q_csv_malformed,
        "stream_tiers": q_stream_tiers,
        "batch_csv_tiers": q_batch_csv_tiers,
        "metric_stream_hourly": q_metric_stream_hourly,
        "points_as_of": q_points_as_of,
        "rollup_after_reruns": q_rollup_after_reruns,
        "z_scores_from_moments": q_z_scores_from_moments,
        "csv_bad_records": q_csv_bad_records,
        "arrivals_after_reupload": q_arrivals_after_reupload,
        "arrivals_from_events": q_arrivals_from_events,
        "alarm_stream_events": q_alarm_stream_events,
    })
    return out
