"""The batch job: ingest -> classify -> stage -> tiers -> metrics -> publish.

Plan at scale:

0. The input is listed first, and the run reads exactly the listed files and
   publishes the times of that listing.  A file that is replaced or added while
   the run goes on differs from what is published, so the next sweep takes it.
1. The CSV is parsed once: the classified claims (rules are one narrow
   projection) are staged as Parquet under the shared checkpoint folder,
   partitioned by the failed flag.  That cuts lineage (a lost executor re-reads
   staged Parquet, not the CSV), lets the stats pass read two columns of the
   clean partition only, and lets silver read only failures.
2. Per-code stats: partial + final aggregate, staged, size checked, broadcast
   (``score_claims``).  Claims are never shuffled for the z-score, so gold,
   quarantine and the metrics each re-scan the columns they need of the clean
   partition instead of caching it whole on executor disks.  The run also writes
   its files' moments per code, which later runs merge (``run_changed``): the
   stats of the whole prefix then cost no scan of the files that did not change.
3. Every output goes to folders of this run (``plans/store.py``): gold by year
   and month in files of the advisory size (one rebalancing exchange; hot months
   are split), whatever the number of input files.  Nothing is renamed or overwritten, and the manifest, written
   last, makes all of it visible at once.  A rerun of a file or prefix (H3)
   supersedes its rows in every tier.
4. What was staged is removed when the run ends.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimsdq.functions.columns import utc_ntz
from claimsdq.operators.anomaly import score_claims
from claimsdq.operators.moments import file_moments, merged_stats
from claimsdq.operators.metrics import dq_metrics, metrics_json, to_points
from claimsdq.operators.tiers import gold_tier, quarantine_tier, silver_tier
from claimsdq.operators.validate import ALL_MATCH, FIRST_MATCH, with_issues
from claimsdq.params import DEFAULT, DQParams
from claimsdq.plans.store import Store, new_run_id
from claimsdq.session import RunContext
from claimsdq.sources.claims import exact_path, list_claim_files, no_claims, read_claims_csv, read_claims_untyped
from claimsdq.sources.rescue import CORRUPT, bad_records


@dataclass
class BatchResult:
    run_id: str
    file_metrics: DataFrame      # wide metrics per source_file, read from what the run wrote
    counts: dict                 # overall counts of this run


def utc_now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc)


def aware(ts: dt.datetime) -> dt.datetime:
    """A timestamp with its zone; one without is UTC."""
    return ts if ts.tzinfo else ts.replace(tzinfo=dt.timezone.utc)


def run_tiers(claims: DataFrame, out_root: str, params: DQParams = DEFAULT, mode: str = FIRST_MATCH,
              run_ts: dt.datetime | None = None, run_id: str | None = None,
              files: DataFrame | None = None, stats_of: Store | None = None) -> BatchResult:
    """Classify, split and write the three tiers plus metrics for ``claims``
    (a DataFrame with the claim columns, ``source_file`` and
    ``ingestion_timestamp``), and publish them as one run.

    ``files`` (source_file, modified) are the files this run stands for; by
    default those that have rows.  Unset clock parameters come from ``run_ts``
    (default: now); ``run_id`` names a run that may be retried.  With ``stats_of``
    the claims are judged against that store's other files too, by their written
    moments.  Claims read with their raw records (``rescue``) leave those that did
    not parse in ``bad_records``, counted per file."""
    spark = claims.sparkSession
    run_ts = aware(run_ts or utc_now())
    params, run_id, store = params.at(run_ts), run_id or new_run_id(run_ts), Store(spark, out_root)
    with RunContext(spark) as ctx:
        staged = ctx.stage(with_issues(claims, params, mode), "classified", ("has_dq_issues",))
        failed = staged.filter(F.col("has_dq_issues")).withColumn("tier", F.lit("silver"))
        clean = staged.filter(~F.col("has_dq_issues"))
        moments = ctx.stage(file_moments(clean), "moments")
        store.write("metrics/moments", run_id, moments)
        stats = None
        if stats_of is not None:
            mine = (files if files is not None else staged).select("source_file").distinct()
            others = stats_of.read("metrics/moments", ctx=ctx).drop("run_id").join(mine, "source_file", "left_anti")
            stats = merged_stats(others.unionByName(moments), tuple(params.stats_keys))
        scored = score_claims(clean, params, ctx, stats)
        store.write("gold", run_id, gold_tier(scored))
        store.write("silver", run_id, silver_tier(failed))
        store.write("quarantine", run_id, quarantine_tier(scored))
        # each file's points are stamped with its ingestion time (the run's
        # timestamp in batch, the file's arrival time in the stream), in UTC
        cols, extra = ["source_file", "tier", "ingestion_timestamp"], [utc_ntz(F.max("ingestion_timestamp")).alias("ts")]
        if CORRUPT in staged.columns:
            store.write("bad_records", run_id, bad_records(staged, ctx))
            cols.append(CORRUPT)
            extra.append(F.count(CORRUPT).alias("bad_records"))
        per_file = dq_metrics(scored.select(*cols).unionByName(failed.select(*cols)), ["source_file"], extra)
        store.write("metrics/files", run_id, per_file)
        written = store.read_run("metrics/files", run_id)
        points = to_points(written, params.dq_namespace, ["source_file", "ts"])
        store.write("metrics/points", run_id, points.withColumn("date", F.to_date("ts")))
        store.write("metrics/json", run_id, metrics_json(written))
        store.publish(run_id, written.select("source_file") if files is None else files, run_ts)
    names = ("total_records", "gold_records", "silver_records", "quarantine_records", "total_anomalies")
    totals = written.agg(*[F.sum(c).alias(c) for c in names]).first()
    return BatchResult(run_id, written.drop("run_id"), {c: int(totals[c] or 0) for c in names})


def read_listed(spark: SparkSession, paths: list[str], mode: str = FIRST_MATCH, **options) -> DataFrame:
    """The claims of exactly these files (paths as listed)."""
    if not paths:
        return no_claims(spark)
    read = read_claims_untyped if mode == ALL_MATCH else read_claims_csv
    return read(spark, [exact_path(p) for p in paths], **options)


def run_csv_job(spark: SparkSession, input_path: str | list[str], out_root: str, params: DQParams = DEFAULT,
                key_root: str | None = None, run_ts: dt.datetime | None = None, run_id: str | None = None,
                mode: str = FIRST_MATCH, only: str | None = "*.csv", rescue: bool = False,
                changed_only: bool = False, header: bool = True) -> BatchResult:
    """The whole job for one file, a folder or a glob (S1-S3, K1-K5, H3).  Files
    without rows are part of the run too: their earlier rows go.  The all-match
    mode reads as the local checker does, by header name.

    ``rescue`` keeps the records that do not parse (S5).  ``changed_only`` reads
    only files that are new or were replaced since their newest run, and judges
    them against the whole prefix by the moments of the others.  The driver holds
    the listed paths, as Spark's own file index does."""
    run_ts = aware(run_ts or utc_now())
    store = Store(spark, out_root)
    with RunContext(spark) as ctx:
        listed = list_claim_files(spark, input_path, key_root, only).select("source_file", "path", "modified")
        if changed_only:
            listed = listed.join(store.current().select("source_file", "modified"), ["source_file", "modified"], "left_anti")
        files = ctx.stage(listed, "listing")
        paths = [r["path"] for r in files.select("path").collect()]
        options = {"key_root": key_root, "run_ts": run_ts}
        if mode != ALL_MATCH:
            options |= {"corrupt_column": CORRUPT if rescue else None, "header": header}
        claims = read_listed(spark, paths, mode, **options)
        return run_tiers(claims, out_root, params, mode, run_ts, run_id, files.select("source_file", "modified"),
                         store if changed_only else None)
