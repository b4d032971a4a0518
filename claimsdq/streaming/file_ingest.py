"""Arrival-driven ingest of claim files.

Two ways to notice a file, one way to process it.  Every batch of files runs
the batch job with the z-score scope narrowed to ``(source_file, cpt_code)``,
so a file's outliers are judged against its own rows, as in a per-file run, and
is published as one run of the store.

* ``start_file_ingest``: a file stream over the folder and all folders in it.
  Its checkpoint records which files were consumed.  The run id is the stream's
  query id and the batch id, so a replayed batch overwrites itself and two
  streams never meet.  Files count as new by name, however old their time.
* ``ingest_arrivals``: a sweep that lists the folder and takes every (file,
  modification time) that no published run has.  It also sees files that were
  uploaded again under their name, which a file stream by its nature does not,
  so run it on a schedule beside the stream or alone.  A sweep lists once, writes
  the listing down and walks it; what is uploaded meanwhile has a time that no
  run published, so the next sweep takes it.

A third, without any listing, is fed by notices (``arrival_events``).  All bound
the files per batch and leave the rest for the next batch.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from claimsdq.params import DEFAULT, DQParams
from claimsdq.plans.batch import run_tiers, utc_now
from claimsdq.plans.store import Store
from claimsdq.session import RunContext
from claimsdq.sources.claims import CLAIMS_SCHEMA, exact_path, list_claim_files, no_claims, object_key

#: Bounds a batch's (file, code) groups, and so its broadcast stats.
FILES_PER_BATCH = 1000


def per_file_params(params: DQParams) -> DQParams:
    """Stats keyed by file first."""
    return params.with_(stats_keys=("source_file", *[k for k in params.stats_keys if k != "source_file"]))


def _with_metadata(df: DataFrame, key_root: str | None) -> DataFrame:
    return df.withColumn("source_file", object_key(F.col("_metadata.file_path"), key_root)) \
        .withColumn("ingestion_timestamp", F.col("_metadata.file_modification_time"))


def claims_file_stream(spark: SparkSession, input_dir: str, key_root: str | None = None,
                       max_files_per_trigger: int = FILES_PER_BATCH) -> DataFrame:
    reader = (spark.readStream.schema(CLAIMS_SCHEMA).option("header", "true").option("mode", "PERMISSIVE")
              .option("pathGlobFilter", "*.csv").option("recursiveFileLookup", "true")
              # a file older than the newest by more than this would be skipped: never
              .option("maxFileAge", "36500d").option("maxFilesPerTrigger", str(max_files_per_trigger)))
    return _with_metadata(reader.csv(input_dir), key_root)


def start_file_ingest(spark: SparkSession, input_dir: str, out_root: str, checkpoint_location: str,
                      params: DQParams = DEFAULT, key_root: str | None = None, available_now: bool = True,
                      max_files_per_trigger: int = FILES_PER_BATCH) -> StreamingQuery:
    per_file = per_file_params(params)
    query: list[StreamingQuery] = []

    def each_batch(batch: DataFrame, batch_id: int) -> None:
        name = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or query[0].id
        modified = F.max("ingestion_timestamp").alias("modified")
        run_tiers(batch, out_root, per_file, run_id=f"stream-{name}-{batch_id:012d}", run_ts=utc_now(),
                  files=batch.groupBy("source_file").agg(modified))

    w = (claims_file_stream(spark, input_dir, key_root, max_files_per_trigger).writeStream
         .foreachBatch(each_batch).option("checkpointLocation", checkpoint_location))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    query.append(w.start())
    return query[0]


def in_pages(rows: DataFrame, order: list[str], size: int) -> Iterator[list]:
    """A written table's rows in ``order`` (which must tell them apart), a bounded
    page at a time."""
    last = None
    while True:
        rest = rows
        if last is not None:
            rest = rows.filter(F.struct(*order) > F.struct(*[F.lit(last[c]).cast(rows.schema[c].dataType) for c in order]))
        page = rest.orderBy(*order).limit(size).collect()
        if not page:
            return
        yield page
        last = page[-1]


def ingest_files(spark: SparkSession, files: list[tuple], out_root: str, params: DQParams = DEFAULT,
                 key_root: str | None = None, run_ts: dt.datetime | None = None, run_id: str | None = None) -> str:
    """One run over exactly these (source_file, path, modified), each judged
    against its own rows; the run's id.  It publishes the given times, so a file
    replaced since then is still new to the next sweep."""
    claims = no_claims(spark)
    if files:
        claims = _with_metadata(spark.read.schema(CLAIMS_SCHEMA).option("header", "true").option("mode", "PERMISSIVE")
                                .csv([exact_path(path) for _, path, _ in files]), key_root)
    listed = spark.createDataFrame([(f, m) for f, _, m in files], "source_file string, modified timestamp")
    return run_tiers(claims, out_root, per_file_params(params), run_ts=run_ts, run_id=run_id, files=listed).run_id


def ingest_arrivals(spark: SparkSession, input_dir: str, out_root: str, params: DQParams = DEFAULT,
                    key_root: str | None = None, max_files: int = FILES_PER_BATCH,
                    run_ts: dt.datetime | None = None) -> list[str]:
    """Process every file that is new or was uploaded again; the run ids.  One
    listing and one look at the manifest a sweep; the driver holds the paths of
    one batch at a time."""
    store, runs = Store(spark, out_root), []
    with RunContext(spark) as ctx:
        done = store.manifest().select("source_file", "modified").distinct()
        listed = list_claim_files(spark, input_dir, key_root).select("source_file", "path", "modified")
        fresh = ctx.stage(listed.join(done, ["source_file", "modified"], "left_anti"), "arrivals")
        for page in in_pages(fresh, ["modified", "source_file"], max_files):
            runs.append(ingest_files(spark, [(r["source_file"], r["path"], r["modified"]) for r in page],
                                     out_root, params, key_root, run_ts))
    return runs
