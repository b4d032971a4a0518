"""Command-line entry for ``spark-submit``.

    spark-submit -m claimsdq.plans.job batch  --input s3a://raw/claims \\
        --key-root s3a://raw --output s3a://processed
    spark-submit -m claimsdq.plans.job arrivals --input s3a://raw/claims \\
        --key-root s3a://raw --output s3a://processed
    spark-submit -m claimsdq.plans.job stream --input s3a://raw/claims \\
        --key-root s3a://raw --output s3a://processed --checkpoint s3a://processed/_ckpt/w1
    spark-submit -m claimsdq.plans.job metrics-stream --output s3a://processed \\
        --checkpoint s3a://processed/_ckpt/w2
    spark-submit -m claimsdq.plans.job events --input s3a://notices --bucket raw \\
        --key-root s3a://raw --output s3a://processed --checkpoint s3a://processed/_ckpt/s4
    spark-submit -m claimsdq.plans.job remediate --output s3a://processed \\
        --request-id 7f3a --action quarantine_data [--prefix claims/2024/] [--input s3a://raw/claims --key-root s3a://raw]
    spark-submit -m claimsdq.plans.job pack --output s3a://processed
    spark-submit -m claimsdq.plans.job retain --output s3a://processed --keep-days 7
    spark-submit -m claimsdq.plans.job compact --output s3a://processed

The folder for staged tables comes from ``spark.checkpoint.dir``.  The clock is
the time of the run (of the batch, in a stream) unless ``--as-of`` says
otherwise, and the session works in UTC.
"""

from __future__ import annotations

import argparse
import datetime as dt
import json
import sys
from functools import reduce

from pyspark.sql import SparkSession

from claimsdq.operators.validate import ALL_MATCH, FIRST_MATCH
from claimsdq.params import DEFAULT
from claimsdq.plans.batch import run_csv_job, utc_now
from claimsdq.plans.store import Store
from claimsdq.session import apply_unset, checkpoint_dir, cluster_conf


def _params(a):
    p = DEFAULT
    if a.as_of:
        p = p.with_(as_of=dt.date.fromisoformat(a.as_of))
    if a.max_amount is not None:
        p = p.with_(max_claim_amount=a.max_amount)
    return p


def _input_bytes(spark: SparkSession, a) -> int:
    """The input volume: as given, else the size of the listed files."""
    if a.input_bytes or not a.input or a.command == "events":
        return a.input_bytes
    from pyspark.sql import functions as F

    from claimsdq.sources.claims import list_claim_files
    return list_claim_files(spark, a.input).agg(F.sum("bytes")).first()[0] or 0


def _remediate(spark: SparkSession, a, params) -> None:
    """Carry out requests on what the store holds; print their records.  A request
    that asks for a restart is told so: run ``batch`` over the prefix again."""
    from claimsdq.plans.remediate import remediate
    store = Store(spark, a.output)
    kind = "request_id string, action string"
    asked = spark.read.schema(kind).json(a.requests) if a.requests else spark.createDataFrame([(a.request_id, a.action)], kind)
    if a.input:
        from claimsdq.sources.claims import read_claims_csv
        claims = read_claims_csv(spark, a.input, key_root=a.key_root, run_ts=utc_now(), only="*.csv")
    else:
        gold, *others = [store.read(k).drop("run_id") for k in ("gold", "silver", "quarantine")]
        claims = reduce(lambda rows, more: rows.unionByName(more, allowMissingColumns=True), others, gold)
    records = remediate(asked, claims, store.read("metrics/files").drop("run_id"), store, utc_now(), params, a.run_id, a.prefix)
    counts = records.groupBy("routed_action", "status_code").count().collect()
    print(json.dumps([r.asDict() for r in sorted(counts, key=lambda r: r["routed_action"])]))


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="claimsdq")
    ap.add_argument("command", choices=["batch", "arrivals", "stream", "events", "metrics-stream", "remediate", "pack",
                                        "retain", "compact"])
    ap.add_argument("--input", default=None, help="file, folder or glob of claim CSVs")
    ap.add_argument("--output", required=True, help="root of gold/ silver/ quarantine/ metrics/ manifest/")
    ap.add_argument("--key-root", default=None, help="prefix stripped from file URIs (bucket root)")
    ap.add_argument("--run-id", default=None, help="name of a run that may be retried")
    ap.add_argument("--mode", choices=[FIRST_MATCH, ALL_MATCH], default=FIRST_MATCH)
    ap.add_argument("--as-of", default=None, help="date for the future-service rule (YYYY-MM-DD)")
    ap.add_argument("--max-amount", type=float, default=None)
    ap.add_argument("--checkpoint", default=None, help="stream checkpoint location")
    ap.add_argument("--max-files-per-trigger", type=int, default=None)
    ap.add_argument("--continuous", action="store_true", help="keep a stream running")
    ap.add_argument("--rescue", action="store_true", help="keep the records that do not parse")
    ap.add_argument("--changed-only", action="store_true", help="read new and replaced files only")
    ap.add_argument("--bucket", default=None, help="take notices of this bucket only")
    ap.add_argument("--requests", default=None, help="JSON lines of request_id, action")
    ap.add_argument("--request-id", default=None)
    ap.add_argument("--action", default=None)
    ap.add_argument("--prefix", default=None, help="act on every file under this prefix")
    ap.add_argument("--keep-days", type=float, default=7.0, help="age beyond which nothing reads superseded runs")
    ap.add_argument("--input-bytes", type=int, default=0, help="expected input volume, if listing is too slow")
    a = ap.parse_args(argv)
    if a.command in ("batch", "arrivals", "stream", "events") and not a.input:
        ap.error(f"{a.command} needs --input")
    if a.command in ("stream", "events", "metrics-stream") and not a.checkpoint:
        ap.error(f"{a.command} needs --checkpoint")
    if a.command == "events" and not a.key_root:
        ap.error("events needs --key-root")
    if a.command == "remediate" and not (a.requests or (a.request_id and a.action)):
        ap.error("remediate needs --requests, or --request-id and --action")

    spark = SparkSession.builder.appName("claimsdq").getOrCreate()
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    checkpoint_dir(spark)
    apply_unset(spark, cluster_conf(_input_bytes(spark, a)))
    params = _params(a)
    files = {"max_files_per_trigger": a.max_files_per_trigger} if a.max_files_per_trigger else {}
    if a.command == "batch":
        res = run_csv_job(spark, a.input, a.output, params, key_root=a.key_root, run_ts=utc_now(),
                          run_id=a.run_id, mode=a.mode, rescue=a.rescue, changed_only=a.changed_only)
        print(json.dumps({"run_id": res.run_id, **res.counts}))
    elif a.command == "arrivals":
        from claimsdq.streaming.file_ingest import ingest_arrivals
        limit = {"max_files": a.max_files_per_trigger} if a.max_files_per_trigger else {}
        print(json.dumps(ingest_arrivals(spark, a.input, a.output, params, key_root=a.key_root, **limit)))
    elif a.command == "stream":
        from claimsdq.streaming.file_ingest import start_file_ingest
        start_file_ingest(spark, a.input, a.output, a.checkpoint, params, key_root=a.key_root,
                          available_now=not a.continuous, **files).awaitTermination()
    elif a.command == "events":
        from claimsdq.streaming.arrival_events import start_event_ingest
        limit = {"files_per_run": a.max_files_per_trigger} if a.max_files_per_trigger else {}
        start_event_ingest(spark, a.input, a.output, a.checkpoint, a.key_root, params, a.bucket,
                           available_now=not a.continuous, **limit).awaitTermination()
    elif a.command == "remediate":
        _remediate(spark, a, params)
    elif a.command == "pack":
        print(json.dumps({"run_id": Store(spark, a.output).pack(utc_now())}))
    elif a.command == "retain":
        gone = Store(spark, a.output).retain(utc_now() - dt.timedelta(days=a.keep_days))
        print(json.dumps({"removed": len(gone)}))
    elif a.command == "compact":
        print(json.dumps({"batches": Store(spark, a.output).compact_manifest()}))
    else:
        from claimsdq.streaming.metric_stream import start_published_hours
        root = a.output.rstrip("/")
        start_published_hours(spark, root, f"{root}/metrics/hourly", a.checkpoint,
                             available_now=not a.continuous).awaitTermination()
    return 0


if __name__ == "__main__":
    sys.exit(main())
