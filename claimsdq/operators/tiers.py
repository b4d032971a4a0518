"""Tier projections A3, A4, P1, P2 and the classify-once entry point."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimsdq.operators.anomaly import score_claims
from claimsdq.operators.validate import FIRST_MATCH, with_issues
from claimsdq.params import DEFAULT, DQParams
from claimsdq.sources.claims import CLAIM_COLUMNS

SILVER_COLUMNS = ["claim_id", "member_id", "provider_id", "cpt_code", "claim_amount",
                  "service_date", "dq_issues", "ingestion_timestamp", "source_file"]


def classify(claims: DataFrame, params: DQParams = DEFAULT, mode: str = FIRST_MATCH) -> DataFrame:
    """Rules + outliers in one plan: every claim gets ``dq_issues`` and ``tier``."""
    return score_claims(with_issues(claims, params, mode), params)


def _present(df: DataFrame, cols: list[str]) -> list[str]:
    have = set(df.columns)
    return [c for c in cols if c in have]


def gold_tier(tiered: DataFrame) -> DataFrame:
    """A4 + P1: clean, not outlier; claim columns + metadata + year, month."""
    cols = _present(tiered, ["cpt_code"] + [c for c in CLAIM_COLUMNS if c != "cpt_code"]
                    + ["ingestion_timestamp", "source_file"])
    return (tiered.filter(F.col("tier") == "gold").select(*cols)
            .withColumn("year", F.year("service_date"))
            .withColumn("month", F.month("service_date")))


def silver_tier(tiered: DataFrame) -> DataFrame:
    """Rule failures, 9 columns."""
    return tiered.filter(F.col("tier") == "silver").select(*_present(tiered, SILVER_COLUMNS))


def anomaly_details(z: Column, avg: Column, sd: Column, digits: int | None = None) -> Column:
    """``Z-score: .. | Avg: .. | StdDev: ..`` (values as Spark casts them to text;
    ``digits`` rounds first, for comparisons across engines)."""
    if digits is not None:
        z, avg, sd = F.round(z, digits), F.round(avg, digits), F.round(sd, digits)
    return F.concat(F.lit("Z-score: "), z.cast("string"), F.lit(" | Avg: "), avg.cast("string"),
                    F.lit(" | StdDev: "), sd.cast("string"))


def quarantine_tier(tiered: DataFrame, details_digits: int | None = None) -> DataFrame:
    """A3: outliers with their stats, a constant type and a details string."""
    q = tiered.filter(F.col("tier") == "quarantine")
    cols = [F.col(c) for c in ["claim_id", "member_id", "provider_id", "cpt_code",
                               "claim_amount", "service_date", "z_score", "avg_amount",
                               "stddev_amount"]]
    cols += [F.lit("STATISTICAL_OUTLIER").alias("anomaly_type"),
             anomaly_details(F.col("z_score"), F.col("avg_amount"), F.col("stddev_amount"),
                             details_digits).alias("anomaly_details")]
    cols += [F.col(c) for c in _present(tiered, ["ingestion_timestamp", "source_file"])]
    return q.select(*cols)


def tier_counts(tiered: DataFrame) -> DataFrame:
    """M1: raw, clean, failed, outlier (and gold) counts in one aggregate."""
    t = F.col("tier")
    return tiered.agg(
        F.count(F.lit(1)).alias("raw_records"),
        F.count_if(t != "silver").alias("clean_records"),
        F.count_if(t == "silver").alias("failed_records"),
        F.count_if(t == "quarantine").alias("outlier_records"),
        F.count_if(t == "gold").alias("gold_records"),
    )
