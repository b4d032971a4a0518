"""Test inputs as views over the driver's tables (FIXTURES.md), their clock and
their corrected second version.  The query catalog and the tests use these; no
job does."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimsdq.operators.validate import with_issues
from claimsdq.params import DEFAULT
from claimsdq.sources.claims import CLAIM_COLUMNS, read_table

#: The fixtures' clock.
P = DEFAULT.with_(as_of=dt.date(2024, 12, 31), as_of_ts=dt.datetime(2024, 1, 31), cost_as_of=dt.date(2001, 8, 2))
#: Hourly anomaly counts stay small in the fixture, so the anomaly alarm is
#: evaluated at a threshold of 4 instead of 100.
P_F3 = P.with_(anomaly_threshold=4.0)

# Fixture F1: the claims view over the driver's `events` table.  This is test
# input, written as the Spark SQL text the fixture document gives, so that the
# DuckDB oracle builds the same rows.
_F1_SELECT = [
    "'C' || lpad(CAST(event_id AS STRING), 10, '0') AS claim_id",
    "CASE WHEN event_id % 101 = 0 THEN NULL ELSE 'MBR' || CAST(user_id AS STRING) END AS member_id",
    "'PRV' || CAST(event_id % 97 AS STRING) AS provider_id",
    "CASE WHEN event_id % 103 = 0 THEN NULL WHEN event_id % 107 = 0 THEN '12345' "
    "WHEN event_id % 211 = 0 THEN '0000000000' ELSE CAST(1000000000 + user_id AS STRING) END AS provider_npi",
    "CASE WHEN event_id % 109 = 0 THEN NULL WHEN event_id % 223 = 0 THEN 'INVALID' ELSE event_type END AS cpt_code",
    "CASE WHEN event_id % 113 = 0 THEN '' WHEN event_id % 127 = 0 THEN NULL ELSE 'I10' END AS icd10_code",
    "CASE WHEN event_id % 131 = 0 THEN NULL WHEN event_id % 137 = 0 THEN -value "
    "WHEN event_id % 139 = 0 THEN value + 200000 ELSE value END AS claim_amount",
    "CASE WHEN event_id % 149 = 0 THEN DATE '2099-01-01' WHEN event_id % 227 = 0 THEN NULL "
    "ELSE CAST(ts AS DATE) END AS service_date",
    "CASE WHEN event_id % 151 = 0 THEN date_add(CAST(ts AS DATE), 400) "
    "WHEN event_id % 157 = 0 THEN date_add(CAST(ts AS DATE), -5) "
    "ELSE date_add(CAST(ts AS DATE), CAST(1 + event_id % 30 AS INT)) END AS submission_date",
    "CASE WHEN event_id % 163 = 0 THEN 'VOID' WHEN event_id % 167 = 0 THEN NULL "
    "WHEN event_id % 20 < 3 THEN 'DENIED' WHEN event_id % 10 = 9 THEN 'PENDING' ELSE 'PAID' END AS claim_status",
    "CASE WHEN event_id % 20 < 3 THEN 'Duplicate claim' END AS denial_reason",
    "date_add(DATE '1960-01-01', CAST(user_id % 15000 AS INT)) AS patient_dob",
    "CASE WHEN event_id % 179 = 0 THEN '1234' WHEN event_id % 181 = 0 THEN '12345-6789' "
    "ELSE lpad(CAST(user_id AS STRING), 5, '0') END AS patient_zip",
    "CASE WHEN event_id % 173 = 0 THEN 'X' WHEN event_id % 3 = 0 THEN 'M' "
    "WHEN event_id % 3 = 1 THEN 'F' ELSE 'U' END AS patient_gender",
    "ts",
    "'claims/payer_claims_' || date_format(ts, 'yyyyMMdd') || '.csv' AS source_file",
]


def claims_from_events(events: DataFrame) -> DataFrame:
    """F1 claims (14 claim columns + ts + source_file), a narrow projection."""
    return events.selectExpr(*_F1_SELECT)


def load_claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    return claims_from_events(read_table(spark, sf_dir, "events"))


def corrected(claims: DataFrame) -> DataFrame:
    """F1 after its files were mended: short NPIs made good, every 29th claim's
    dates moved by 31 days (so into another month), and the file of 5 January
    left with its sound rows only."""
    moved = F.substring("claim_id", 2, 10).cast("long") % 29 == 0
    npi = F.when(F.col("provider_npi") == "12345", F.lit("1234567890")).otherwise(F.col("provider_npi"))
    for c in ("service_date", "submission_date"):
        claims = claims.withColumn(c, F.when(moved, F.date_add(c, 31)).otherwise(F.col(c)))
    flagged = with_issues(claims.withColumn("provider_npi", npi), P)
    return flagged.filter("source_file != 'claims/payer_claims_20240105.csv' OR dq_issues = ''") \
        .drop("dq_issues", "has_dq_issues")


def claim_fields_as_text(claims: DataFrame) -> list:
    """The 14 claim columns as the text a CSV file holds."""
    return [F.col(c).cast("string").alias(c) for c in CLAIM_COLUMNS]


def cost_responses(orders: DataFrame, customer: DataFrame) -> DataFrame:
    """Fixture F4: daily cost per market segment from orders x customer.

    One shuffle join on the customer key (the customer side grows with the
    data, so it is not hinted; AQE may still broadcast it at run time and
    splits a skewed customer's partition), then a partial + final aggregate to
    (day, segment) and a per-day list bounded by the number of segments."""
    o = orders.select("o_custkey", F.to_date("o_orderdate").alias("period_start"), "o_totalprice")
    c = customer.select(F.col("c_custkey").alias("o_custkey"), F.col("c_mktsegment").alias("service"))
    by_service = o.join(c, "o_custkey", "left").groupBy(
        "period_start", F.coalesce("service", F.lit("unknown")).alias("service")) \
        .agg((F.sum("o_totalprice") / F.lit(1e6)).alias("amount"))
    return by_service.groupBy("period_start").agg(
        F.sum("amount").alias("total"),
        F.array_sort(F.collect_list(F.struct("service", "amount"))).alias("groups"))


def cost_json(orders: DataFrame, customer: DataFrame) -> DataFrame:
    """F4 as the nested text a cost service answers, one response per day:
    amounts are text, every 7th day has no Total, every 11th no Groups, every
    13th no period at all, and a Total holds a tax that no group shows."""
    day = F.datediff("period_start", F.lit(dt.date(1992, 1, 1)))

    def amount(c):
        return F.struct(F.struct(F.format_string("%.8f", c).alias("Amount"), F.lit("USD").alias("Unit"))
                        .alias("UnblendedCost"))
    period = F.struct(F.col("period_start").cast("string").alias("Start"),
                      F.date_add("period_start", 1).cast("string").alias("End"))
    groups = F.transform("groups", lambda g: F.struct(F.array(g["service"]).alias("Keys"),
                                                      amount(g["amount"]).alias("Metrics")))
    result = F.struct(period.alias("TimePeriod"), F.when(day % 7 != 0, amount(F.col("total") + 0.125)).alias("Total"),
                      F.when(day % 11 != 0, groups).alias("Groups"))
    results = F.when(day % 13 != 0, F.array(result))
    return cost_responses(orders, customer).select(
        "period_start", F.to_json(F.struct(results.alias("ResultsByTime"))).alias("response"))
