"""Records that did not parse, kept with their place.

A claims CSV is read in PERMISSIVE mode, so a bad field is null and its row goes
on.  Read with a corrupt-record column, such a row also carries its raw text, and
the run keeps it in ``bad_records`` with its file and its number among the file's
records (the first one after the header is 1; blank lines do not count).

A large file is read in several splits, so the number is the row's place within
its split plus the records of the splits before it.  Both come from the rows as
they were scanned: each carries its split's start and a scan-order number.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimsdq.operators.joins import write_small
from claimsdq.session import RunContext

CORRUPT, SPLIT, PLACE = "_corrupt_record", "_split_start", "_scan_place"


def scan_places() -> dict[str, Column]:
    """Columns to add right at the scan."""
    return {SPLIT: F.col("_metadata.file_block_start"), PLACE: F.monotonically_increasing_id()}


def bad_records(rows: DataFrame, ctx: RunContext | None = None) -> DataFrame:
    """``source_file, record, raw, claim_id, fields`` of the rows with raw text.

    The table of splits has one row per file and split; its windows see the splits
    of one file."""
    splits = write_small(rows.groupBy("source_file", SPLIT).agg(F.count("*").alias("n"), F.min(PLACE).alias("first")),
                         "splits", ctx)
    before = Window.partitionBy("source_file").orderBy(SPLIT).rowsBetween(Window.unboundedPreceding, -1)
    starts = splits.select("source_file", SPLIT, "first", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    bad = rows.filter(F.col(CORRUPT).isNotNull()).select("source_file", SPLIT, PLACE, F.col(CORRUPT).alias("raw"), "claim_id")
    return bad.join(starts, ["source_file", SPLIT]).select(
        "source_file", (F.col("before") + F.col(PLACE) - F.col("first") + 1).alias("record"), "raw", "claim_id",
        F.size(F.split("raw", ",", -1)).alias("fields"))
