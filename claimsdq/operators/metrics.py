"""Quality metrics: M1-M8, X1 and the JSON form K5.

Every metric is an aggregate over the tiered claims (partial + final hash
aggregate), never a driver-side dict; the long point form is an ``unpivot``
of the wide form, a narrow operator.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimsdq.functions.columns import folder_prefix, hour_bucket, ratio_pct
from claimsdq.functions.rules import issue_array
from claimsdq.params import DEFAULT, DQParams

# Metric names and units (fixed values, in the reference's order).
METRICS = (
    ("TotalRecords", "total_records", "Count"),
    ("GoldRecords", "gold_records", "Count"),
    ("SilverRecords", "silver_records", "Count"),
    ("QuarantineRecords", "quarantine_records", "Count"),
    ("AnomalyCount", "total_anomalies", "Count"),
    ("DataQualityScore", "data_quality_score", "Percent"),
    ("AnomalyRate", "anomaly_rate", "Percent"),
)

COUNT_COLUMNS = ("total_records", "gold_records", "silver_records", "quarantine_records")


def _tier_count_aggs() -> list[Column]:
    t = F.col("tier")
    return [
        F.count(F.lit(1)).alias("total_records"),
        F.count_if(t == "gold").alias("gold_records"),
        F.count_if(t == "silver").alias("silver_records"),
        F.count_if(t == "quarantine").alias("quarantine_records"),
    ]


def with_derived(counts: DataFrame) -> DataFrame:
    """M2 + M3: anomalies = silver + quarantine; score and rate in percent."""
    return (counts
            .withColumn("total_anomalies", F.col("silver_records") + F.col("quarantine_records"))
            .withColumn("data_quality_score", ratio_pct(F.col("gold_records"), F.col("total_records")))
            .withColumn("anomaly_rate", ratio_pct(F.col("total_anomalies"), F.col("total_records"))))


def dq_metrics(tiered: DataFrame, by: list[str] | tuple[str, ...] = (),
               extra: list[Column] | tuple[Column, ...] = ()) -> DataFrame:
    """M1-M3 (and M5's wide form when ``by`` is given): one row per group;
    ``extra`` aggregates ride along in the same pass."""
    aggs = _tier_count_aggs() + list(extra)
    counts = tiered.groupBy(*by).agg(*aggs) if by else tiered.agg(*aggs)
    return with_derived(counts)


def hourly_file_metrics(tiered: DataFrame, ts_col: str = "ts") -> DataFrame:
    """per source_file and hour of ``ts``: the wide metrics, ``ts`` = hour start."""
    return dq_metrics(tiered.withColumn("ts", hour_bucket(F.col(ts_col))), ["source_file", "ts"])


def to_points(wide: DataFrame, namespace: str | None, dims: list[str]) -> DataFrame:
    """M5: wide metrics -> ``(namespace, metric_name, <dims>, value, unit)``;
    without a ``namespace`` it is one of the dims."""
    vals = [F.col(c).cast("double").alias(name) for name, c, _ in METRICS]
    long = wide.select(*dims, *vals).unpivot(dims, [m[0] for m in METRICS], "metric_name", "value")
    unit = F.when(F.col("metric_name").isin("DataQualityScore", "AnomalyRate"), F.lit("Percent")) \
        .otherwise(F.lit("Count"))
    name = F.col("namespace") if namespace is None else F.lit(namespace).alias("namespace")
    rest = [d for d in dims if d != "namespace"]
    return long.select(name, "metric_name", *rest, "value", unit.alias("unit"))


def rollup_by_folder(wide: DataFrame, time_cols: list[str] = ("ts",)) -> DataFrame:
    """M6: counts summed by folder prefix of source_file, ratios recomputed."""
    time_cols = [c for c in time_cols if c in wide.columns]
    folder = wide.withColumn("source_file", folder_prefix(F.col("source_file")))
    counts = folder.groupBy("source_file", *time_cols).agg(
        *[F.sum(c).alias(c) for c in COUNT_COLUMNS])
    return with_derived(counts)


def folder_points(file_points: DataFrame) -> DataFrame:
    """M6 over written points: the file-level counts of each folder and time
    summed, the ratios recomputed from the sums."""
    sums = [F.sum(F.when(F.col("metric_name") == name, F.col("value"))).cast("long").alias(c)
            for name, c, _ in METRICS if c in COUNT_COLUMNS]
    wide = file_points.withColumn("source_file", folder_prefix(F.col("source_file"))) \
        .groupBy("namespace", "source_file", "ts").agg(*sums)
    return to_points(with_derived(wide), None, ["namespace", "source_file", "ts"])


def clean_based_metrics(flagged_all_match: DataFrame, by=("source_file",)) -> DataFrame:
    """M4: the local checker's per-file figures (all-match rules, no outlier step)."""
    has = F.col("has_dq_issues")
    counts = flagged_all_match.groupBy(*by).agg(
        F.count(F.lit(1)).alias("raw_records"),
        F.count_if(~has).alias("clean_records"),
        F.count_if(has).alias("anomaly_records"),
    )
    return (counts.withColumn("data_quality_score", ratio_pct(F.col("clean_records"), F.col("raw_records")))
            .withColumn("anomaly_rate", ratio_pct(F.col("anomaly_records"), F.col("raw_records"))))


def overall_summary(per_file: DataFrame) -> DataFrame:
    """M8: sums over the per-file figures, then score and rate recomputed."""
    s = per_file.agg(F.sum("clean_records").alias("total_clean"),
                     F.sum("anomaly_records").alias("total_anomalies"))
    s = s.withColumn("total_raw", F.col("total_clean") + F.col("total_anomalies"))
    return (s.withColumn("data_quality_score", ratio_pct(F.col("total_clean"), F.col("total_raw")))
            .withColumn("anomaly_rate", ratio_pct(F.col("total_anomalies"), F.col("total_raw"))))


def issue_counts(failed: DataFrame, by=()) -> DataFrame:
    """Occurrences of each issue code (``explode`` of the split issue string)."""
    codes = failed.select(*by, F.explode(issue_array(F.col("dq_issues"))).alias("issue"))
    return codes.groupBy(*by, "issue").agg(F.count(F.lit(1)).alias("occurrences"))


def top_issues(failed: DataFrame, k: int = 5, by=()) -> DataFrame:
    """M7 + O1: top ``k`` codes by count (ties by code), per group when ``by``.

    Per group the filter on ``row_number`` lets Spark insert a group limit
    before the shuffle, so at most ``k`` rows per group leave each task.
    """
    counts = issue_counts(failed, by)
    if not by:
        return counts.orderBy(F.desc("occurrences"), F.asc("issue")).limit(k)
    from pyspark.sql import Window
    w = Window.partitionBy(*by).orderBy(F.desc("occurrences"), F.asc("issue"))
    return counts.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def null_rates(claims: DataFrame, columns: list[str], params: DQParams = DEFAULT) -> DataFrame:
    """Per-column NULL rate in one pass, checked against ``max_null_rate``."""
    aggs = [F.avg(F.col(c).isNull().cast("double")).alias(c) for c in columns]
    wide = claims.agg(*aggs)
    long = wide.unpivot([], columns, "column_name", "null_rate")
    return long.withColumn("exceeds_threshold", F.col("null_rate") > F.lit(params.max_null_rate))


def metrics_json(wide: DataFrame, digits: int | None = None) -> DataFrame:
    """K5: one JSON object per row of the wide metrics."""
    fields = ["total_records", "gold_records", "silver_records", "quarantine_records",
              "total_anomalies", "data_quality_score", "anomaly_rate"]
    cols = []
    for f in fields:
        c = F.col(f)
        if digits is not None and f in ("data_quality_score", "anomaly_rate"):
            c = F.round(c, digits)
        cols.append(c.alias(f))
    if "ts" in wide.columns:
        cols.append(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("timestamp"))
    if "source_file" in wide.columns:
        cols.append(F.col("source_file"))
    keys = [c for c in ["source_file"] if c in wide.columns]
    return wide.select(*keys, F.to_json(F.struct(*cols)).alias("metrics_json"))
