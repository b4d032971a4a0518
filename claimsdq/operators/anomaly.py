"""Grouped z-score outliers: G1 stats, J1 join back, A1 z, A2 flag.

Plan shape at scale: the stats are a partial + final hash aggregate (each map
task pre-aggregates its own rows, so a code holding a third of all claims
shuffles one row per task, not its rows).  The stats then go back to the
claims through ``guarded_join``: broadcast behind a row-count check, with a
shuffle join beyond it.  A window ``avg() over (partition by cpt_code)`` would
send every claim of a hot code to one task, so it is not used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimsdq.operators.joins import guarded_join
from claimsdq.params import DEFAULT, DQParams
from claimsdq.session import RunContext


def amount_stats(clean: DataFrame, keys=("cpt_code",)) -> DataFrame:
    """G1: per-group avg, sample stddev and row count of claim_amount."""
    return clean.groupBy(*keys).agg(
        F.avg("claim_amount").alias("avg_amount"),
        F.stddev_samp("claim_amount").alias("stddev_amount"),
        F.count(F.lit(1)).alias("count"),
    )


def z_score(amount: Column, avg: Column, sd: Column) -> Column:
    """A1: (x - avg) / sd when sd > 0, else 0 (one-row groups have sd NULL)."""
    return F.when(sd > 0, (amount - avg) / sd).otherwise(F.lit(0.0))


def score_claims(flagged: DataFrame, params: DQParams = DEFAULT,
                 ctx: RunContext | None = None, stats: DataFrame | None = None) -> DataFrame:
    """J1 + A1 + A2 + tier label over classified claims (``dq_issues`` present).

    Clean rows (empty ``dq_issues``) get avg_amount, stddev_amount, count,
    z_score and is_statistical_outlier; failed rows keep them NULL / false.
    ``tier`` is ``silver`` (rule failure), ``quarantine`` (outlier) or ``gold``.
    ``stats``: figures per group from elsewhere, such as merged moments; by default
    those of the clean rows themselves.
    """
    keys = list(params.stats_keys)
    is_clean = F.col("dq_issues") == ""
    if stats is None:
        stats = amount_stats(flagged.filter(is_clean).select(*keys, "claim_amount"), keys)
    joined = guarded_join(flagged, stats, keys, "left", params.broadcast_max_rows,
                          extra=lambda big: big["dq_issues"] == "",
                          max_bytes=params.broadcast_max_bytes, ctx=ctx)
    z = F.when(is_clean, z_score(F.col("claim_amount"), F.col("avg_amount"), F.col("stddev_amount")))
    out = joined.withColumn("z_score", z)
    out = out.withColumn("is_statistical_outlier",
                         F.coalesce(F.abs(F.col("z_score")) > params.z_threshold, F.lit(False)))
    return out.withColumn(
        "tier",
        F.when(~is_clean, F.lit("silver"))
        .when(F.col("is_statistical_outlier"), F.lit("quarantine"))
        .otherwise(F.lit("gold")),
    )


def detect_outliers(clean: DataFrame, params: DQParams = DEFAULT) -> DataFrame:
    """Clean rows with their group's stats, z-score and outlier flag."""
    flagged = clean.withColumn("dq_issues", F.lit(""))
    return score_claims(flagged, params).drop("dq_issues", "tier")
