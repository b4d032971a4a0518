"""Remediation that acts: H1, H2, H3, the audit K6 and the request ledger L7.

``remediate`` carries out routed actions on a store.  Quarantining copies the
rows of the flagged files to ``quarantined_files/run_id=<run>/``, keeps the
originals, and stores the status of each file's *version* (its modification time
as published; files published without one have one version).  A version that has
the status already is passed over, so a rerun copies nothing twice; a file that
was replaced since is a new version: it is active again, and is quarantined again
if it still fails.

A request is carried out once.  Its id goes into the ledger, which a run writes
last; a run takes only requests that the ledger does not know.  A run that dies
before that left nothing that counts: its retry, under the same run id, does the
same copies over the same folders and writes the same records.  Every request,
known or not, leaves one audit record: timestamp, action, result, environment.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimsdq.operators.alarms import action_routing
from claimsdq.operators.remediation import files_under, flagged_files, quarantine_by_file, quarantine_path
from claimsdq.params import DEFAULT, DQParams
from claimsdq.plans.store import Store, new_run_id
from claimsdq.session import RunContext, path_exists

_AUDIT = ("request_id string, timestamp string, action string, routed_action string, result string, environment string, "
          "status_code long, run_id string")


def _version() -> Column:
    """A version's name: its modification time in microseconds since 1970."""
    return F.coalesce(F.unix_micros("modified").cast("string"), F.lit("unversioned"))


def versions(store: Store) -> DataFrame:
    """Each published file's current version: source_file, version."""
    return store.current().select("source_file", _version().alias("version"))


def quarantined(store: Store, but_run: str | None = None) -> DataFrame:
    """Files whose current version has the status already (``but_run``: not
    counting what that run itself stored, for its retry)."""
    marked = store.table("file_status").filter("status = 'Quarantined'")
    if but_run is not None:
        marked = marked.filter(F.col("run_id") != but_run)
    now = versions(store).select(F.col("source_file").alias("__f"), F.col("version").alias("__v"))
    marked = marked.join(now, F.col("source_file") == F.col("__f"), "left")
    # files that no run published are known by their name alone
    return marked.filter(F.col("__v").isNull() | (F.col("version") == F.col("__v"))).select("source_file").distinct()


def quarantine_files(claims: DataFrame, file_metrics: DataFrame, store: Store, run_id: str,
                     params: DQParams = DEFAULT, prefix: str | None = None, at: dt.datetime | None = None) -> dict:
    """H1 + H2: copy the flagged files' rows and store the status of their versions.

    With ``prefix`` every file under it is flagged (the reference's own scope),
    else the files with a score below the cut-off.  The files come from their
    metrics, so the claims are scanned once, for the copy."""
    flagged = flagged_files(file_metrics, params) if prefix is None else files_under(file_metrics, prefix)
    with RunContext(claims.sparkSession) as ctx:
        fresh = ctx.stage(flagged.join(quarantined(store, but_run=run_id), "source_file", "left_anti")
                          .join(versions(store), "source_file", "left").fillna("unversioned", ["version"]), "flagged")
        rows = quarantine_by_file(claims, fresh.select("source_file"), params, ctx)
        path = f"{store.root}/quarantined_files/run_id={run_id}"
        rows.write.mode("overwrite").parquet(path)
        status = file_metrics.join(fresh, "source_file").select(
            "source_file", F.col("total_records").alias("rows"), F.lit("Quarantined").alias("status"),
            quarantine_path(F.col("source_file"), run_id).alias("quarantine_key"), "version", F.lit(at).cast("timestamp").alias("at"))
        store.write("file_status", run_id, status)     # last: the status stands for a finished copy
        n = store.read_run("file_status", run_id).agg(F.count(F.lit(1)).alias("n"), F.sum("rows").alias("r")).first()
    return {"status": "success", "quarantined_count": n["n"], "quarantined_rows": n["r"] or 0}


def status_intervals(store: Store) -> DataFrame:
    """H2 over time: ``source_file, version, status, since, until`` (exclusive; null:
    still).  A version is Active from its first publication, Quarantined from the
    action that took it, and over when a newer version is published.  The window
    sees the versions of one file."""
    published = store.manifest().groupBy("source_file", _version().alias("version")).agg(F.min("run_ts").alias("since"))
    order = Window.partitionBy("source_file").orderBy("since", "version")
    spans = published.withColumn("until", F.lead("since").over(order))
    taken = store.table("file_status").filter("status = 'Quarantined'").groupBy("source_file", "version") \
        .agg(F.min("at").alias("taken"))
    spans = spans.join(taken, ["source_file", "version"], "left")
    active = F.struct(F.lit("Active").alias("status"), F.col("since").alias("since"),
                      F.coalesce(F.least("taken", "until"), F.col("until")).alias("until"))
    held = F.struct(F.lit("Quarantined").alias("status"), F.greatest("since", "taken").alias("since"), F.col("until").alias("until"))
    both = F.when(F.col("taken").isNull(), F.array(active)).otherwise(F.array(active, held))
    return spans.select("source_file", "version", F.inline(both)) \
        .filter(F.col("until").isNull() | (F.col("since") < F.col("until")))


def status_as_of(store: Store, asked: DataFrame) -> DataFrame:
    """``asked`` (source_file, at) with the version and status that held then;
    null before a file's first version."""
    spans = status_intervals(store).withColumnRenamed("source_file", "__f")
    held = (F.col("source_file") == F.col("__f")) & (F.col("at") >= F.col("since")) \
        & (F.col("until").isNull() | (F.col("at") < F.col("until")))
    return asked.join(spans, held, "left").drop("__f", "since", "until")


def audit_records(requests: DataFrame, results: dict[str, dict], run_ts: dt.datetime,
                  params: DQParams = DEFAULT) -> DataFrame:
    """K6: one record per request.  ``results``: the outcome by routed action
    (a handful); a request without a route records its error."""
    routed = action_routing(requests)
    text = F.lit(None).cast("string")
    for action, result in results.items():
        body = F.to_json(F.struct(*[F.lit(v).alias(k) for k, v in result.items()]))
        text = F.when(F.col("routed_action") == action, body).otherwise(text)
    error = F.to_json(F.struct(F.lit("error").alias("status"), F.col("error").alias("message")))
    return routed.select(
        "request_id", F.lit(run_ts.strftime("%Y-%m-%dT%H:%M:%S")).alias("timestamp"),
        F.coalesce("action", F.lit("")).alias("action"), F.coalesce("routed_action", F.lit("none")).alias("routed_action"),
        F.coalesce(text, error).alias("result"), F.lit(params.environment).alias("environment"), "status_code")


def log_remediation(records: DataFrame, root: str, run_id: str) -> None:
    """Append the records of one run as JSON, partitioned by the routed action; a
    retry of the run replaces its own."""
    records.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("routed_action") \
        .json(f"{root.rstrip('/')}/remediation/run_id={run_id}")


def audit_log(store: Store) -> DataFrame:
    """The audit records of finished runs."""
    if not path_exists(store.spark, f"{store.root}/remediation"):
        return store.spark.createDataFrame([], _AUDIT)
    finished = store.table("ledger").select("run_id").distinct()
    return store.spark.read.schema(_AUDIT).json(f"{store.root}/remediation").join(F.broadcast(finished), "run_id", "left_semi")


def new_requests(requests: DataFrame, store: Store, ctx: RunContext) -> DataFrame:
    """The requests that no finished run has carried out, each id once (of several
    with one id the least action stands); requests without an id are always new."""
    named = requests.filter("request_id IS NOT NULL").groupBy("request_id").agg(F.min("action").alias("action"))
    fresh = named.join(store.table("ledger").select("request_id"), "request_id", "left_anti")
    return ctx.stage(fresh.unionByName(requests.filter("request_id IS NULL").select("request_id", "action")), "requests")


def remediate(requests: DataFrame, claims: DataFrame, file_metrics: DataFrame, store: Store,
              run_ts: dt.datetime, params: DQParams = DEFAULT, run_id: str | None = None,
              prefix: str | None = None) -> DataFrame:
    """Route the requests, carry out what the new ones ask for (once per kind of
    action) and log one audit record each; the records of these requests.

    ``restart_job`` marks its files for H3: the caller runs the batch job over
    the prefix again.  ``cost_spike_detected`` only records, as the reference's
    does.  One run at a time writes to a ledger."""
    run_id = run_id or new_run_id(run_ts)
    spark = claims.sparkSession
    with RunContext(spark) as ctx:
        fresh = new_requests(requests, store, ctx)
        if not fresh.isEmpty():
            asked = {r["routed_action"] for r in action_routing(fresh).select("routed_action").distinct().collect()}
            results: dict[str, dict] = {}
            if "quarantine_data" in asked:
                results["quarantine_data"] = quarantine_files(claims, file_metrics, store, run_id, params, prefix, run_ts)
            if "restart_job" in asked:
                results["restart_job"] = {"status": "success", "reprocess": prefix or params.folder}
            if "cost_spike_detected" in asked:
                results["cost_spike_detected"] = {"status": "success", "message": "cost spike recorded"}
            log_remediation(audit_records(fresh, results, run_ts, params), store.root, run_id)
            store.write("ledger", run_id, action_routing(fresh).select("request_id", "routed_action").withColumn("at", F.lit(run_ts)))
    mine = requests.select("request_id").distinct()
    log = audit_log(store)
    return log.join(mine, "request_id", "left_semi").unionByName(
        log.filter(F.col("request_id").isNull() & (F.col("run_id") == run_id))).drop("run_id")
