"""T2 / T8, incremental: metric rollups per hour, day and 30 days that follow a
store's runs.

A rollup row holds mergeable partials of one series (namespace, metric, folder)
and period: sum, number of points, least and greatest value.  Hours fold into days
and days into periods of 30 days, so a read of 30 days is a few rows per series.

When a run is published, ``apply`` changes only the rows that it touches.  Its
points are added, and those of the runs that it supersedes, file by file, are
taken back: sums and counts by subtraction, least and greatest values (which
cannot be subtracted) anew from the level below, for the touched periods alone.
The rewritten rows are appended under the run's epoch, and the epoch counts when
its entry in ``applied`` is there, which is written last.  A retry overwrites its
epoch.  Readers take each row's last epoch; a row without points is no row.

One process at a time applies runs.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimsdq.functions.columns import folder_prefix
from claimsdq.operators.alarms import epoch_period
from claimsdq.plans.store import Store
from claimsdq.session import RunContext, path_exists

#: Levels from fine to coarse, with their length in seconds.
LEVELS = {"hour": 3600, "day": 86400, "30 days": 30 * 86400}
SERIES = ["namespace", "metric_name", "source_file"]
KEY = [*SERIES, "period_start"]
PARTIALS = ["sum", "sample_count", "minimum", "maximum"]
_ROW = "namespace string, metric_name string, source_file string, period_start timestamp_ntz, sum double, " \
       "sample_count long, minimum double, maximum double, epoch long"
_APPLIED = "run string, run_ts timestamp, epoch long"


def _period(ts: Column, level: str) -> Column:
    return epoch_period(ts, F.lit(LEVELS[level]))


def partials(points: DataFrame, level: str = "hour") -> DataFrame:
    """The partials of points (with ``value``) of each folder's series."""
    rows = points.withColumn("source_file", folder_prefix(F.col("source_file"))) \
        .withColumn("period_start", _period(F.col("ts"), level))
    return rows.groupBy(*KEY).agg(F.sum("value").alias("sum"), F.count("value").alias("sample_count"),
                                  F.min("value").alias("minimum"), F.max("value").alias("maximum"))


class Rollups:
    def __init__(self, store: Store):
        self.store, self.spark, self.root = store, store.spark, f"{store.root}/rollups"

    def _table(self, name: str, schema: str) -> DataFrame:
        path = f"{self.root}/{name.replace(' ', '-')}"
        if not path_exists(self.spark, path):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(path)

    def _write(self, name: str, epoch: int, rows: DataFrame) -> None:
        rows.write.mode("overwrite").option("partitionOverwriteMode", "static") \
            .parquet(f"{self.root}/{name.replace(' ', '-')}/epoch={epoch}")

    def applied(self) -> DataFrame:
        """The runs that the rollups hold: run, run_ts, epoch."""
        return self._table("applied", _APPLIED)

    def read(self, level: str) -> DataFrame:
        """The rows of a level: ``KEY``, ``PARTIALS`` and the average."""
        last = self.applied().agg(F.coalesce(F.max("epoch"), F.lit(-1))).first()[0]
        rows = self._table(level, _ROW).filter(F.col("epoch") <= last)
        newest = rows.groupBy(*KEY).agg(F.max_by(F.struct(*PARTIALS), "epoch").alias("p")).select(*KEY, "p.*")
        return newest.filter("sample_count > 0").withColumn("average", F.col("sum") / F.col("sample_count"))

    def pending(self) -> list[str]:
        """Published runs that are not applied, in the order of their publication."""
        runs = self.store.manifest().groupBy("run").agg(F.min("run_ts").alias("run_ts"))
        fresh = runs.join(self.applied().select("run"), "run", "left_anti").orderBy("run_ts", "run")
        return [r["run"] for r in fresh.collect()]

    def apply_all(self) -> list[str]:
        runs = self.pending()
        for run in runs:
            self.apply(run)
        return runs

    def _versions(self, run: str) -> DataFrame:
        """Per file of the run: the newest run that the rollups hold (null: none)
        and, of all files, the one that they hold afterwards."""
        listed = self.store.manifest().select("source_file", "run", "run_ts").distinct()
        before = listed.join(F.broadcast(self.applied().select("run")), "run", "left_semi") \
            .groupBy("source_file").agg(F.max(F.struct("run_ts", "run")).alias("old"))
        mine = listed.filter(F.col("run") == run).groupBy("source_file").agg(F.max(F.struct("run_ts", "run")).alias("new"))
        both = before.join(mine, "source_file", "full")
        newer = F.col("new").isNotNull() & (F.col("old").isNull() | (F.col("new") > F.col("old")))
        return both.select("source_file", F.col("old.run").alias("old"),
                           F.when(newer, F.col("new.run")).otherwise(F.col("old.run")).alias("now"), newer.alias("changed"))

    def _points(self, files: DataFrame, version: str) -> DataFrame:
        """The points of each file's version."""
        points = self.store.table("metrics/points").withColumnRenamed("source_file", "__f")
        runs = [r[0] for r in files.select(version).distinct().limit(1001).collect() if r[0] is not None]
        if len(runs) <= 1000:
            points = points.filter(F.col("run_id").isin(runs))
        which = files.select(F.col("source_file").alias("file"), F.col(version).alias("v"))
        return points.join(which, (F.col("__f") == F.col("file")) & (F.col("run_id") == F.col("v")), "left_semi") \
            .withColumnRenamed("__f", "source_file")

    def apply(self, run: str) -> int:
        """Bring a published run into all levels; its epoch."""
        done = self.applied().filter(F.col("run") == run).first()
        if done:
            return done["epoch"]
        epoch = self.applied().agg(F.coalesce(F.max("epoch"), F.lit(-1))).first()[0] + 1
        with RunContext(self.spark) as ctx:
            versions = ctx.stage(self._versions(run), "versions")
            changed = versions.filter("changed")
            hour = partials(self._points(changed, "now"))
            gone = partials(self._points(changed.filter("old IS NOT NULL"), "old"))
            delta = ctx.stage(hour.select(*KEY, "sum", "sample_count").unionByName(
                gone.select(*KEY, (-F.col("sum")).alias("sum"), (-F.col("sample_count")).alias("sample_count")))
                .groupBy(*KEY).agg(F.sum("sum").alias("sum"), F.sum("sample_count").alias("sample_count")), "delta")
            # extremes of the touched hours: from the points that hold now, by their date folders
            days = [r[0] for r in delta.select(F.to_date("period_start")).distinct().limit(1001).collect()]
            below = self._points(versions, "now")
            if len(days) <= 1000:
                below = below.filter(F.col("date").isin(days))
            below = partials(below)
            for level in LEVELS:
                up = delta.withColumn("period_start", _period(F.col("period_start"), level)).groupBy(*KEY) \
                    .agg(F.sum("sum").alias("sum"), F.sum("sample_count").alias("sample_count"))
                touched = up.select(*KEY)
                kept = self.read(level).join(touched, KEY, "left_semi").select(*KEY, "sum", "sample_count")
                sums = up.unionByName(kept).groupBy(*KEY).agg(F.sum("sum").alias("sum"), F.sum("sample_count").alias("sample_count"))
                ends = below.withColumn("period_start", _period(F.col("period_start"), level)).join(touched, KEY, "left_semi") \
                    .groupBy(*KEY).agg(F.min("minimum").alias("minimum"), F.max("maximum").alias("maximum"))
                rows = ctx.stage(sums.join(ends, KEY, "left").select(*KEY, *PARTIALS), "rollup")
                self._write(level, epoch, rows)
                # what the next level takes its extremes from: this level's rows as they are now
                others = self.read(level).join(rows.select(*KEY), KEY, "left_anti").select(*KEY, *PARTIALS)
                below = others.unionByName(rows.filter("sample_count > 0"))
            at = self.store.manifest().filter(F.col("run") == run).agg(F.min("run_ts").alias("run_ts"))
            self._write("applied", epoch, at.select(F.lit(run).alias("run"), "run_ts"))
        return epoch


def full_pass(points: DataFrame) -> DataFrame:
    """All levels from all points, for comparison: ``level``, ``KEY``, ``PARTIALS``."""
    return reduce(DataFrame.unionByName, [partials(points, level).withColumn("level", F.lit(level)) for level in LEVELS])
