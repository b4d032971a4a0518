"""Hourly buckets on streams of metric points.

``start_hourly_buckets`` is for any folder of point files: tumbling event-time
windows with a watermark, in append mode; a bucket is emitted once the watermark
passes its end and its state is dropped.

``start_published_hours`` follows a store.  Points count when their run is
published and only as long as no newer run of their file is, so it streams the
manifest, not the point files (which also hold the points of runs that died and
of attempts that were retried):

1. *Feed.*  Each micro-batch of manifest rows reads the points of its runs, sums
   them to one row per (file, run, metric, hour), and writes them under the
   batch's number.  A file without points leaves a row too: its earlier points go.
2. *State.*  A stateful operator keyed by file keeps the hours of each of its
   series as its newest run has them.  A newer run replaces them: its hours come
   out as buckets, and hours that only the older run had come out as deleted.  An
   older run that is fed later, or the same run again, changes nothing.

The changes are a table, one folder per batch, which a replayed batch overwrites.
``hourly_now`` reads the buckets that hold.  State is one entry per file, bounded
by the hours of one run of that file.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from claimsdq.functions.columns import hour_bucket
from claimsdq.plans.store import SCHEMAS, Store
from claimsdq.session import ship_package

SERIES = ("namespace", "metric_name", "source_file")


def hourly_buckets(points: DataFrame, period: str = "1 hour", delay: str = "2 hours") -> DataFrame:
    """Average, Sum, Maximum, Minimum and SampleCount per series and period."""
    p = points.withColumn("event_ts", F.col("ts").cast("timestamp"))
    return (p.withWatermark("event_ts", delay)
            .groupBy(F.window("event_ts", period).alias("w"), "namespace", "metric_name", "source_file")
            .agg(F.avg("value").alias("average"), F.sum("value").alias("sum"),
                 F.max("value").alias("maximum"), F.min("value").alias("minimum"),
                 F.count(F.lit(1)).alias("sample_count"))
            .select(F.col("w.start").cast("timestamp_ntz").alias("period_start"),
                    "namespace", "metric_name", "source_file",
                    "average", "sum", "maximum", "minimum", "sample_count"))


def start_hourly_buckets(spark: SparkSession, points_dir: str, out_dir: str, checkpoint_location: str,
                         delay: str = "2 hours", available_now: bool = True,
                         schema=SCHEMAS["metrics/points"]) -> StreamingQuery:
    """Buckets over a folder that gains point files; each point is fed once.  Not
    for a store's ``metrics/points``, which also holds points that do not count."""
    stream = spark.readStream.schema(schema).option("maxFileAge", "36500d").parquet(points_dir)
    w = (hourly_buckets(stream, delay=delay).writeStream.outputMode("append").format("parquet")
         .option("path", out_dir).option("checkpointLocation", checkpoint_location))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


# ------------------------------------------------------------- published runs

FEED = T.StructType([
    T.StructField("source_file", T.StringType()), T.StructField("run_ts", T.TimestampType()),
    T.StructField("run", T.StringType()), T.StructField("namespace", T.StringType()),
    T.StructField("metric_name", T.StringType()), T.StructField("period_start", T.StringType()),
    T.StructField("sum", T.DoubleType()), T.StructField("maximum", T.DoubleType()),
    T.StructField("minimum", T.DoubleType()), T.StructField("sample_count", T.LongType())])
CHANGES = T.StructType([*FEED.fields, T.StructField("deleted", T.BooleanType())])
_STATE = "run_ts long, run string, hours string"
_STAMP = "yyyy-MM-dd HH:mm:ss"


def published_hours(store: Store, manifest_rows: DataFrame) -> DataFrame:
    """The hours of the runs that manifest rows name, in the form of ``FEED``; a
    file without points has one row without a metric."""
    rows = manifest_rows.select("source_file", "run_ts", "run").distinct()
    points = store.table("metrics/points").withColumnRenamed("run_id", "run") \
        .withColumn("period_start", F.date_format(hour_bucket(F.col("ts")), _STAMP))
    # rows are few next to the points, and their runs prune the point folders
    runs = [r["run"] for r in rows.select("run").distinct().limit(1001).collect()]
    if len(runs) <= 1000:
        points = points.filter(F.col("run").isin(runs))
    hours = points.join(rows.select("source_file", "run").distinct(), ["source_file", "run"], "left_semi") \
        .groupBy("source_file", "run", "namespace", "metric_name", "period_start") \
        .agg(F.sum("value").alias("sum"), F.max("value").alias("maximum"), F.min("value").alias("minimum"),
             F.count(F.lit(1)).alias("sample_count"))
    return rows.join(hours, ["source_file", "run"], "left").select(*[f.name for f in FEED.fields])


def _update(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """One file: take the newest run among the rows, retract the one it supersedes."""
    rows = pd.concat(list(batches))
    rows["order"] = [(t.value // 1000, run) for t, run in zip(pd.to_datetime(rows["run_ts"]), rows["run"])]
    newest = max(rows["order"])
    at, run, hours = state.get if state.exists else (-1, "", "{}")
    if newest <= (at, run):
        return
    old = json.loads(hours)
    mine = rows[(rows["order"] == newest) & rows["metric_name"].notna()]
    new = {json.dumps([r.namespace, r.metric_name, r.period_start]): [r.sum, r.maximum, r.minimum, int(r.sample_count)]
           for r in mine.itertuples()}
    state.update((newest[0], newest[1], json.dumps(new)))
    out = [(*json.loads(k), *figures, False) for k, figures in new.items()]
    out += [(*json.loads(k), 0.0, 0.0, 0.0, 0, True) for k in old if k not in new]
    frame = pd.DataFrame(out, columns=["namespace", "metric_name", "period_start", "sum", "maximum", "minimum",
                                       "sample_count", "deleted"])
    frame.insert(0, "source_file", key[0])
    frame["run_ts"], frame["run"] = pd.Timestamp(newest[0], unit="us"), newest[1]
    if len(frame):
        yield frame[[f.name for f in CHANGES.fields]]


def start_published_hours(spark: SparkSession, root: str, out_dir: str, checkpoint_location: str,
                         available_now: bool = True) -> StreamingQuery:
    """Follow the store under ``root``: changes of its hourly buckets go to
    ``out_dir`` (read them by ``hourly_now``).  Two queries, the feed and the
    state; with ``available_now`` both end when all that is published is in."""
    store, out = Store(spark, root), out_dir.rstrip("/")
    ship_package(spark)

    def start(stream: DataFrame, each_batch, name: str, mode: str) -> StreamingQuery:
        w = stream.writeStream.outputMode(mode).foreachBatch(each_batch) \
            .option("checkpointLocation", f"{checkpoint_location.rstrip('/')}/{name}")
        return (w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")).start()

    def feed(batch: DataFrame, batch_id: int) -> None:
        s = batch.sparkSession
        published_hours(Store(s, store.root), batch).write.mode("overwrite").parquet(f"{out}/feed/batch={batch_id}")

    def changes(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/changes/batch={batch_id}")

    def files(schema: T.StructType, path: str, **options) -> DataFrame:
        return spark.readStream.schema(schema).options(maxFileAge="36500d", **options).parquet(path)

    first = start(files(SCHEMAS["manifest"], f"{store.root}/manifest"), feed, "feed", "append")
    if available_now:
        first.awaitTermination()
        if first.exception():
            raise first.exception()
    spark.createDataFrame([], FEED).write.mode("append").parquet(f"{out}/feed")     # the folder is there from the start
    state = files(FEED, f"{out}/feed", recursiveFileLookup="true").groupBy("source_file").applyInPandasWithState(
        _update, CHANGES, _STATE, "update", GroupStateTimeout.NoTimeout)
    return start(state, changes, "state", "update")


def hourly_now(spark: SparkSession, out_dir: str) -> DataFrame:
    """The buckets that hold: of each series and hour the last change, unless it
    was a deletion."""
    changes = spark.read.schema(CHANGES).option("recursiveFileLookup", "true").parquet(f"{out_dir.rstrip('/')}/changes")
    last = F.max_by(F.struct("sum", "maximum", "minimum", "sample_count", "deleted"), F.struct("run_ts", "run")).alias("b")
    return changes.groupBy(*SERIES, "period_start").agg(last).filter("NOT b.deleted").select(
        *SERIES, F.col("period_start").cast("timestamp_ntz").alias("period_start"),
        (F.col("b.sum") / F.col("b.sample_count")).alias("average"), "b.sum", "b.maximum", "b.minimum", "b.sample_count")
