"""S4 / W1 by notices: a stream of object-created records, no folder listing.

A notice names an object that was created: its key, its version and when.  The
stream reads the notice documents that a store sends (one JSON document a line,
with its records in an array), keeps created claim files, drops repeated
deliveries of one version (``dropDuplicatesWithinWatermark``) and hands each
micro-batch's keys, by their paths, to the batch job.

* Several versions of a key in one batch are one run: the object is read as it is
  now.
* A file's modification time is looked up by its path and published with the run.
  A notice for a (file, time) that some run published already makes no run, so a
  delivery later than the watermark, a replayed batch and a sweep beside this
  stream do no work twice.
* An object that is gone when its notice is handled makes no run.

Every notice leaves one row in the store's ``notices`` table with its outcome:
``run``, ``known`` or ``missing``, and ``superseded`` for a version that a later
one of its batch stands for.  Notices that come later than the watermark are
dropped by the stream; a sweep (``ingest_arrivals``) on a schedule finds their
files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from claimsdq.params import DEFAULT, DQParams
from claimsdq.plans.batch import utc_now
from claimsdq.plans.store import Store
from claimsdq.session import RunContext, file_times
from claimsdq.streaming.file_ingest import FILES_PER_BATCH, in_pages, ingest_files

# Format of a notice document (fixed names): Records[] with the event's name and
# time and the object's bucket, key, size and version.
_STRING = T.StringType()
NOTICES = T.StructType([T.StructField("Records", T.ArrayType(T.StructType([
    T.StructField("eventName", _STRING), T.StructField("eventTime", T.TimestampType()),
    T.StructField("s3", T.StructType([
        T.StructField("bucket", T.StructType([T.StructField("name", _STRING)])),
        T.StructField("object", T.StructType([
            T.StructField("key", _STRING), T.StructField("size", T.LongType()), T.StructField("versionId", _STRING),
            T.StructField("eTag", _STRING), T.StructField("sequencer", _STRING)]))]))])))])


def created_objects(notices: DataFrame, bucket: str | None = None, prefix: str = "claims/",
                    suffix: str = ".csv") -> DataFrame:
    """Notice documents to ``key, version, event_time`` of created claim files."""
    r = notices.select(F.explode("Records").alias("r")).select("r.*")
    obj = F.col("s3.object")
    # keys come URL-encoded in notices, blanks as "+"
    o = r.select("eventName", F.col("s3.bucket.name").alias("bucket"), F.url_decode(obj["key"]).alias("key"),
                 F.coalesce(obj["versionId"], obj["sequencer"], obj["eTag"], F.col("eventTime").cast("string")).alias("version"),
                 F.col("eventTime").alias("event_time"))
    kept = o.filter(F.col("eventName").startswith("ObjectCreated") & F.col("key").startswith(prefix) & F.col("key").endswith(suffix))
    return (kept if bucket is None else kept.filter(F.col("bucket") == bucket)).select("key", "version", "event_time")


def start_event_ingest(spark: SparkSession, notice_dir: str, out_root: str, checkpoint_location: str, key_root: str,
                       params: DQParams = DEFAULT, bucket: str | None = None, delay: str = "7 days",
                       available_now: bool = True, files_per_run: int = FILES_PER_BATCH,
                       max_files_per_trigger: int = 1000) -> StreamingQuery:
    """Start the stream.  ``key_root``: the folder or bucket URI under which the
    notices' keys lie.  The driver holds the paths of one run at a time."""
    query: list[StreamingQuery] = []

    def each_batch(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        name = session.sparkContext.getLocalProperty("sql.streaming.queryId") or query[0].id
        store = Store(session, out_root)
        with RunContext(session) as ctx:
            got = ctx.stage(batch, "notices")
            newest = ctx.stage(got.groupBy("key").agg(F.max(F.struct("event_time", "version")).alias("m"))
                               .select("key", "m.version"), "newest-notices")
            for n, page in enumerate(in_pages(newest, ["key"], files_per_run)):
                run = f"event-{name}-{batch_id:012d}-{n:06d}"
                found = handle_page(store, [(r["key"], r["version"]) for r in page], run, key_root, params)
                outcome = session.createDataFrame(found, "key string, version string, outcome string")
                late = got.join(outcome.select("key"), "key", "left_semi").join(outcome, ["key", "version"], "left") \
                    .select("key", "version", "event_time", F.coalesce("outcome", F.lit("superseded")).alias("outcome"))
                store.write("notices", run, late)

    notices = spark.readStream.schema(NOTICES).option("maxFileAge", "36500d").option("recursiveFileLookup", "true") \
        .option("maxFilesPerTrigger", str(max_files_per_trigger)).json(notice_dir)
    fresh = created_objects(notices, bucket).withWatermark("event_time", delay).dropDuplicatesWithinWatermark(["key", "version"])
    w = fresh.writeStream.foreachBatch(each_batch).option("checkpointLocation", checkpoint_location)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    query.append(w.start())
    return query[0]


def handle_page(store: Store, objects: list[tuple[str, str]], run_id: str, key_root: str,
                params: DQParams = DEFAULT) -> list[tuple[str, str, str]]:
    """Run the objects of a page that are there and new; (key, version, outcome)."""
    spark = store.spark
    paths = [f"{key_root.rstrip('/')}/{key}" for key, _ in objects]
    there = [(key, path, time) for (key, _), path, time in zip(objects, paths, file_times(spark, paths)) if time is not None]
    asked = spark.createDataFrame([(key, time) for key, _, time in there], "source_file string, modified timestamp")
    known = {r["source_file"] for r in asked.join(store.manifest(), ["source_file", "modified"], "left_semi").collect()}
    fresh = [f for f in there if f[0] not in known]
    if fresh:
        ingest_files(spark, fresh, store.root, params, key_root, run_ts=utc_now(), run_id=run_id)
    ran = {key for key, _, _ in fresh}
    return [(key, version, "run" if key in ran else "known" if key in known else "missing") for key, version in objects]
