"""File-level remediation as data jobs: J2, H1, H2, K6.

The reference copies every object under a prefix to a quarantine folder and
tags the originals.  Here a *flagged file set* drives a semi join (rows to
quarantine), an anti join (rows to keep), a per-folder summary and a per-file
status.  The set is either every file under a prefix, or the files whose
gold-based quality score is below a cut-off.  It grows with the number of
files, so it goes through ``guarded_join``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimsdq.functions.columns import folder_prefix
from claimsdq.operators.joins import guarded_join
from claimsdq.params import DEFAULT, DQParams
from claimsdq.session import RunContext


def flagged_files(file_metrics: DataFrame, params: DQParams = DEFAULT) -> DataFrame:
    """Files to quarantine: score below ``quarantine_score_below``."""
    return file_metrics.filter(F.col("data_quality_score") < params.quarantine_score_below) \
        .select("source_file").distinct()


def files_under(file_metrics: DataFrame, prefix: str) -> DataFrame:
    """Files to quarantine: every one under a prefix."""
    return file_metrics.filter(F.col("source_file").startswith(prefix)).select("source_file").distinct()


def quarantine_by_file(claims: DataFrame, flagged: DataFrame, params: DQParams = DEFAULT,
                       ctx: RunContext | None = None) -> DataFrame:
    """J2 (semi): the rows of flagged files."""
    return guarded_join(claims, flagged, ["source_file"], "left_semi", params.broadcast_max_rows,
                        max_bytes=params.broadcast_max_bytes, ctx=ctx)


def retain_by_file(claims: DataFrame, flagged: DataFrame, params: DQParams = DEFAULT,
                   ctx: RunContext | None = None) -> DataFrame:
    """J2 (anti): the rows of files that are not flagged."""
    return guarded_join(claims, flagged, ["source_file"], "left_anti", params.broadcast_max_rows,
                        max_bytes=params.broadcast_max_bytes, ctx=ctx)


def quarantine_path(source_file: Column, run_label: str) -> Column:
    """``quarantine/<run>/<original key>`` (the reference's layout)."""
    return F.concat(F.lit(f"quarantine/{run_label}/"), source_file)


def file_status(file_rows: DataFrame, flagged: DataFrame, params: DQParams = DEFAULT,
                run_label: str = "run", ctx: RunContext | None = None) -> DataFrame:
    """H2: one row per source file, ``Quarantined`` or ``Active``, with the
    quarantine path and row count.  ``file_rows`` is (source_file, rows)."""
    marked = flagged.select("source_file", F.lit(True).alias("_flag"))
    j = guarded_join(file_rows, marked, ["source_file"], "left", params.broadcast_max_rows,
                     max_bytes=params.broadcast_max_bytes, ctx=ctx)
    q = F.coalesce(F.col("_flag"), F.lit(False))
    return j.select("source_file", "rows",
                    F.when(q, F.lit("Quarantined")).otherwise(F.lit("Active")).alias("status"),
                    F.when(q, quarantine_path(F.col("source_file"), run_label)).alias("quarantine_key"))


def rows_per_file(claims: DataFrame) -> DataFrame:
    return claims.groupBy("source_file").agg(F.count(F.lit(1)).alias("rows"))


def quarantine_summary(status: DataFrame) -> DataFrame:
    """H1: per folder, the number of quarantined files and rows (the file list
    itself is the per-file status table, not an array in one row)."""
    q = status.filter(F.col("status") == "Quarantined")
    return q.groupBy(folder_prefix(F.col("source_file")).alias("folder")).agg(
        F.count(F.lit(1)).alias("quarantined_count"),
        F.sum("rows").alias("quarantined_rows")).withColumn("status", F.lit("success"))
