"""Run-versioned output and the manifest that makes a run visible.

Layout under one root::

    gold/run_id=<run>/year=/month=/     silver/run_id=<run>/    quarantine/run_id=<run>/
    bad_records/run_id=<run>/           records that did not parse, where the run kept them
    metrics/files/run_id=<run>/         one row per file (wide metrics)
    metrics/points/run_id=<run>/date=/  file-level metric points
    metrics/json/run_id=<run>/          one JSON object per file
    metrics/moments/run_id=<run>/       per file and code: rows, mean and M2 of the clean amounts
    file_status/run_id=<run>/           files that an action put into quarantine, with their version
    notices/run_id=<run>/               handled notices of created objects and their outcome
    ledger/run_id=<run>/                requests that were carried out
    manifest/batch=<run>/               (source_file, modified, run_ts, run), written last

A run writes only into its own folders and nothing is renamed or replaced.  Its
rows become visible at once, when its manifest appears; a run that dies before
leaves nothing to see, and a retried run overwrites its own folders.  Readers
take, per file, the rows of the newest run that lists it.  A file that was
fixed therefore has no row left of its earlier content in any tier, and a
metric point per file exists once, whether the file came alone or in a prefix.

A reader takes its snapshot when it asks for a table: the runs that then hold a
current file (or, with ``as_of``, held one at that time).  It reads the folders
of these runs only, and filters rows only in runs of which some file has a newer
one.  ``retain`` removes what no reader of the last ``horizon`` can have in its
snapshot, ``pack`` puts many small runs into one.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimsdq.operators.joins import guarded_join
from claimsdq.operators.metrics import folder_points
from claimsdq.params import DEFAULT
from claimsdq.session import RunContext, list_folders, modified_before, path_exists, remove_path
from claimsdq.sources.claims import CLAIMS_SCHEMA


_TYPES = {"string": T.StringType(), "int": T.IntegerType(), "long": T.LongType(), "double": T.DoubleType(),
          "date": T.DateType(), "timestamp": T.TimestampType(), "timestamp_ntz": T.TimestampNTZType()}


def _schema(*fields: tuple[str, str]) -> T.StructType:
    return T.StructType([T.StructField(n, _TYPES[t]) for n, t in fields])


_META = (("ingestion_timestamp", "timestamp"), ("source_file", "string"))
_CLAIM = {f.name: f.dataType.simpleString() for f in CLAIMS_SCHEMA.fields}
SCHEMAS = {
    "gold": _schema(("cpt_code", "string"), *[(n, t) for n, t in _CLAIM.items() if n != "cpt_code"], *_META,
                    ("year", "int"), ("month", "int"), ("run_id", "string")),
    "silver": _schema(*[(n, _CLAIM[n]) for n in ("claim_id", "member_id", "provider_id", "cpt_code", "claim_amount",
                                                 "service_date")], ("dq_issues", "string"), *_META,
                      ("run_id", "string")),
    "quarantine": _schema(*[(n, _CLAIM[n]) for n in ("claim_id", "member_id", "provider_id", "cpt_code",
                                                     "claim_amount", "service_date")],
                          ("z_score", "double"), ("avg_amount", "double"), ("stddev_amount", "double"),
                          ("anomaly_type", "string"), ("anomaly_details", "string"), *_META, ("run_id", "string")),
    "metrics/files": _schema(("source_file", "string"), ("ts", "timestamp_ntz"), ("total_records", "long"),
                             ("gold_records", "long"), ("silver_records", "long"), ("quarantine_records", "long"),
                             ("total_anomalies", "long"), ("data_quality_score", "double"),
                             ("anomaly_rate", "double"), ("bad_records", "long"), ("run_id", "string")),
    "metrics/points": _schema(("namespace", "string"), ("metric_name", "string"), ("source_file", "string"),
                              ("ts", "timestamp_ntz"), ("value", "double"), ("unit", "string"), ("date", "date"),
                              ("run_id", "string")),
    "metrics/json": _schema(("source_file", "string"), ("metrics_json", "string"), ("run_id", "string")),
    "metrics/moments": _schema(("source_file", "string"), ("cpt_code", "string"), ("n", "long"), ("mean", "double"),
                               ("m2", "double"), ("run_id", "string")),
    "bad_records": _schema(("source_file", "string"), ("record", "long"), ("raw", "string"), ("claim_id", "string"),
                           ("fields", "int"), ("run_id", "string")),
    "file_status": _schema(("source_file", "string"), ("rows", "long"), ("status", "string"),
                           ("quarantine_key", "string"), ("version", "string"), ("at", "timestamp"),
                           ("run_id", "string")),
    "notices": _schema(("key", "string"), ("version", "string"), ("event_time", "timestamp"), ("outcome", "string"),
                       ("run_id", "string")),
    "ledger": _schema(("request_id", "string"), ("routed_action", "string"), ("at", "timestamp"), ("run_id", "string")),
    "manifest": _schema(("source_file", "string"), ("modified", "timestamp"), ("run_ts", "timestamp"),
                        ("run", "string"), ("batch", "string")),
}
PARTITIONS = {"gold": ("year", "month"), "metrics/points": ("date",)}
#: Tables whose rows belong to the file they name, by that file's newest run.
FILE_TABLES = ("gold", "silver", "quarantine", "bad_records", "metrics/files", "metrics/points", "metrics/json",
               "metrics/moments")
#: Snapshots of more runs than this are read by a join alone, without pruning
#: folders (``pack`` keeps stores far below it).
MAX_LISTED_RUNS = 10_000


def new_run_id(run_ts: dt.datetime) -> str:
    utc = run_ts.astimezone(dt.timezone.utc)
    return f"{utc:%Y%m%dT%H%M%S%f}-{uuid.uuid4().hex[:8]}"


class Store:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    # ------------------------------------------------------------------ write

    def write(self, kind: str, run_id: str, df: DataFrame) -> None:
        """Write one kind of a run's output; a retry overwrites it."""
        folder = "batch" if kind == "manifest" else "run_id"
        cols = [f.name for f in SCHEMAS[kind].fields if f.name != folder]
        have = {c: df.schema[c].dataType for c in df.columns}
        want = {f.name: f.dataType for f in SCHEMAS[kind].fields}
        out = df.select(*[(F.col(c).cast(want[c]) if c in have else F.lit(None).cast(want[c])).alias(c) for c in cols])
        fmt = "json" if kind == "metrics/json" else "parquet"
        if kind == "gold":
            # a few files of the advisory size a month, hot months split, however many tasks the scan has
            out = out.hint("rebalance", *PARTITIONS["gold"])
        # the run's folder is replaced as a whole, whatever the session's overwrite mode
        out.write.mode("overwrite").option("partitionOverwriteMode", "static") \
            .partitionBy(*PARTITIONS.get(kind, ())).format(fmt).save(f"{self.root}/{kind}/{folder}={run_id}")

    def publish(self, run_id: str, files: DataFrame, run_ts: dt.datetime) -> None:
        """Make the run visible: one small file, the last that the run writes.
        ``files``: source_file and, where known, modified."""
        modified = F.col("modified") if "modified" in files.columns else F.lit(None)
        self.write("manifest", run_id, files.select("source_file", modified.cast("timestamp").alias("modified"))
                   .distinct().withColumns({"run_ts": F.lit(run_ts), "run": F.lit(run_id)}).coalesce(1))

    def compact_manifest(self, horizon: dt.datetime | None = None) -> int:
        """Put the manifest's rows into one batch and remove the batches they came
        from; how many went.  Of each file the newest run is kept, and with
        ``horizon`` all that snapshots from then on need.  Runs may publish
        meanwhile: only batches listed before the read are removed, and readers
        that see both the new batch and old ones find the same newest runs."""
        old = [p for p in list_folders(self.spark, f"{self.root}/manifest") if "/batch=" in p]
        kept = self.needed(horizon) if horizon else self.current().withColumnRenamed("run_id", "run")
        if len(old) < 2 and (not old or kept.count() == self.manifest().count()):
            return 0
        self.write("manifest", f"compact-{uuid.uuid4().hex}", kept.repartition(max(1, len(old) // 10_000)))
        for path in old:
            remove_path(self.spark, path)
        return len(old)

    def needed(self, horizon: dt.datetime) -> DataFrame:
        """The manifest rows of runs that are some file's newest at any time from
        ``horizon`` on: those since then, and each file's last one before."""
        rows = self.manifest().select("source_file", "modified", "run_ts", "run").distinct()
        since = rows.filter(F.col("run_ts") > F.lit(horizon))
        before = self.current(horizon).select("source_file", "modified", "run_ts", F.col("run_id").alias("run"))
        return since.unionByName(before)

    def retain(self, horizon: dt.datetime) -> list[str]:
        """Remove the folders of runs that no snapshot taken since ``horizon`` can
        hold: superseded for every file before it, or never published and not
        written to since.  The manifest forgets them too.  Choose a horizon
        earlier than the start of the oldest reader and of the oldest run that
        may still publish."""
        def runs(rows: DataFrame) -> set[str]:
            return {r["run"] for r in rows.select("run").distinct().collect()}

        listed, keep = runs(self.manifest()), runs(self.needed(horizon))
        stale, gone = horizon.timestamp() * 1000, []
        for kind in FILE_TABLES:
            for path in list_folders(self.spark, f"{self.root}/{kind}"):
                run = path.rsplit("run_id=", 1)[-1]
                if "run_id=" in path and run not in keep and (run in listed or modified_before(self.spark, path, stale)):
                    gone.append(path)
        self.compact_manifest(horizon)
        for path in gone:                    # after the manifest: no reader can learn of them any more
            remove_path(self.spark, path)
        return gone

    def pack(self, run_ts: dt.datetime, min_runs: int = 2) -> str | None:
        """Put the current rows of all files into one run, in files of the advisory
        size, and publish it at ``run_ts``, which must be later than the newest
        run; its run id, or None where fewer than ``min_runs`` runs are live."""
        now = self.current()
        found = now.agg(F.countDistinct("run_id").alias("n"), F.bool_or(F.col("run_ts") >= F.lit(run_ts)).alias("late")).first()
        if found["n"] < min_runs:
            return None
        if found["late"]:
            raise ValueError("the packing run must be later than the runs it packs")
        run_id = "pack-" + new_run_id(run_ts)
        with RunContext(self.spark) as ctx:
            for kind in FILE_TABLES:
                rows = self.read(kind, ctx=ctx).drop("run_id")
                self.write(kind, run_id, rows if kind == "gold" else rows.hint("rebalance"))
            files = ctx.stage(now.select("source_file", "modified"), "packed")
            self.publish(run_id, files, run_ts)
        return run_id

    # ------------------------------------------------------------------- read

    def table(self, kind: str) -> DataFrame:
        """All rows of a kind, of every run; empty before the first."""
        path = f"{self.root}/{kind}"
        if not path_exists(self.spark, path):
            return self.spark.createDataFrame([], SCHEMAS[kind])
        fmt = "json" if kind == "metrics/json" else "parquet"
        return self.spark.read.schema(SCHEMAS[kind]).format(fmt).load(path)

    def manifest(self) -> DataFrame:
        return self.table("manifest")

    def current(self, as_of: dt.datetime | None = None) -> DataFrame:
        """Per file, the newest run that lists it (at ``as_of``): source_file,
        run_id, modified, run_ts."""
        rows = self.manifest()
        if as_of is not None:
            rows = rows.filter(F.col("run_ts") <= F.lit(as_of))
        newest = F.max(F.struct("run_ts", "run", "modified")).alias("m")
        return rows.groupBy("source_file").agg(newest) \
            .select("source_file", F.col("m.run").alias("run_id"), "m.modified", "m.run_ts")

    def live_runs(self, as_of: dt.datetime | None = None) -> DataFrame:
        """Runs that hold a current file: run_id, whole (each of its files is current)."""
        now = self.current(as_of).select("source_file", F.col("run_id").alias("newest"))
        listed = self.manifest().select("source_file", F.col("run").alias("run_id")).distinct()
        mine = F.col("newest").eqNullSafe(F.col("run_id"))
        return listed.join(now, "source_file", "left").groupBy("run_id") \
            .agg(F.bool_or(mine).alias("live"), F.bool_and(mine).alias("whole")).filter("live").drop("live")

    def read(self, kind: str, as_of: dt.datetime | None = None, ctx: RunContext | None = None) -> DataFrame:
        """The rows of every file's newest run (at ``as_of``).

        The snapshot is taken here: the folders of live runs are a partition
        filter, and only runs of which some file has a newer run are joined with
        the files they still stand for, by a size-checked broadcast or salted."""
        table = self.table(kind)
        runs = self.live_runs(as_of).orderBy("run_id").limit(MAX_LISTED_RUNS + 1).collect()
        now = self.current(as_of).select("source_file", "run_id")
        keys = ["source_file", "run_id"]
        if len(runs) > MAX_LISTED_RUNS:
            return guarded_join(table, now, keys, "left_semi", DEFAULT.broadcast_max_rows, ctx=ctx)
        whole, mixed = ([r["run_id"] for r in runs if r["whole"] is w] for w in (True, False))
        rows = table.filter(F.col("run_id").isin(whole)) if whole else table.filter(F.lit(False))
        if mixed:
            part = F.col("run_id").isin(mixed)
            rows = rows.unionByName(guarded_join(table.filter(part), now.filter(part), keys, "left_semi",
                                                 DEFAULT.broadcast_max_rows, ctx=ctx))
        return rows

    def read_run(self, kind: str, run_id: str) -> DataFrame:
        return self.table(kind).filter(F.col("run_id") == run_id)

    def points(self, start: dt.datetime | None = None, end: dt.datetime | None = None,
               folders: bool = True, as_of: dt.datetime | None = None) -> DataFrame:
        """Metric points of ``[start, end)``: per file, and per folder rolled up
        from them.  The range prunes the date folders; ``as_of`` reads what was
        published by then."""
        files = in_range(self.read("metrics/points", as_of), start, end).drop("run_id", "date")
        return files.unionByName(folder_points(files)) if folders else files


def in_range(points: DataFrame, start: dt.datetime | None, end: dt.datetime | None) -> DataFrame:
    """The points of ``[start, end)``, by their date folder and their time."""
    for value, day, time in ((start, F.col("date").__ge__, F.col("ts").__ge__),
                             (end, F.col("date").__le__, F.col("ts").__lt__)):
        if value is not None:
            points = points.filter(day(F.lit(value.date()))) \
                .filter(time(F.lit(value.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp_ntz")))
    return points
