"""Read side of the metric points: T1-T10.

Points are ``(namespace, metric_name, source_file, ts, value, unit)``; a
series is one ``(namespace, metric_name, source_file)``.  Every operator is a
filter, an aggregate keyed by series (and period), or a per-series top-k.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimsdq.functions.columns import period_bucket, ratio_pct, ts_lit
from claimsdq.params import DEFAULT, DQParams

SERIES = ["namespace", "metric_name", "source_file"]


def metric_range(points: DataFrame, namespace: str, metric_name: str, dimension: str | None,
                 hours: int, as_of_ts: dt.datetime) -> DataFrame:
    """T1 + O3: one metric (and dimension) over ``[as_of_ts - hours, as_of_ts)``,
    in time order.  Over a table with date folders, read it with the same range
    (``in_range``), which prunes them."""
    start = as_of_ts - dt.timedelta(hours=hours)
    cond = (F.col("namespace") == namespace) & (F.col("metric_name") == metric_name) \
        & (F.col("ts") >= ts_lit(start)) & (F.col("ts") < ts_lit(as_of_ts))
    if dimension is not None:
        cond = cond & (F.col("source_file") == dimension)
    return points.filter(cond).orderBy("ts")


def metric_buckets(points: DataFrame, period_seconds: int = 3600, series=SERIES) -> DataFrame:
    """Fixed periods per series with Average, Sum, Maximum, Minimum, SampleCount."""
    b = points.withColumn("period_start", period_bucket(F.col("ts"), period_seconds))
    return b.groupBy(*series, "period_start").agg(
        F.avg("value").alias("average"), F.sum("value").alias("sum"),
        F.max("value").alias("maximum"), F.min("value").alias("minimum"),
        F.count(F.lit(1)).alias("sample_count"))


def metric_latest(points: DataFrame, series=SERIES) -> DataFrame:
    """The latest value per series (``max_by``, one pass, no sort)."""
    return points.groupBy(*series).agg(F.max("ts").alias("latest_ts"),
                                       F.max_by("value", "ts").alias("latest_value"))


def metric_recent(points: DataFrame, k: int = 3, series=SERIES) -> DataFrame:
    """T4: the ``k`` most recent points per series."""
    w = Window.partitionBy(*series).orderBy(F.desc("ts"))
    return points.withColumn("recency", F.row_number().over(w)).filter(F.col("recency") <= k)


def is_file_dimension(dim: Column, contains: str | None = None) -> Column:
    """T5: a per-file dimension, not a folder roll-up; ``contains`` narrows it to
    names with that text."""
    file = ~dim.endswith("/")
    return file if contains is None else file & dim.contains(contains)


def metric_dimensions(points: DataFrame, files_only: bool = True, contains: str | None = None) -> DataFrame:
    """T5: distinct series, optionally only per-file dimensions."""
    p = points.filter(is_file_dimension(F.col("source_file"), contains)) if files_only else points
    return p.select(*SERIES).distinct()


def latest_file_summary(points: DataFrame, params: DQParams = DEFAULT, days: int = 7,
                        contains: str | None = None) -> DataFrame:
    """T6 + T7: the most recent file (by point time, ties by name) and its
    anomalies, silver, total and gold counts, each the Maximum of its last hour,
    with the gold-based score.

    The file is chosen by a global ``max`` over a struct, a one-row result,
    so joining it back is a broadcast of a proven single row.
    """
    end = params.need("as_of_ts")
    start = end - dt.timedelta(days=days)
    p = points.filter((F.col("namespace") == params.dq_namespace)
                      & is_file_dimension(F.col("source_file"), contains)
                      & (F.col("ts") >= ts_lit(start)) & (F.col("ts") < ts_lit(end)))
    latest = p.agg(F.max(F.struct("ts", "source_file")).alias("m")) \
        .select(F.col("m.source_file").alias("latest_file"))
    mine = p.join(F.broadcast(latest), p["source_file"] == latest["latest_file"], "left_semi")
    wanted = ["AnomalyCount", "SilverRecords", "TotalRecords", "GoldRecords"]
    hourly = metric_buckets(mine.filter(F.col("metric_name").isin(*wanted)), 3600, ["source_file", "metric_name"])
    per_metric = hourly.groupBy("source_file", "metric_name").agg(F.max_by("maximum", "period_start").alias("v"))

    def pick(name: str) -> Column:
        return F.coalesce(F.max(F.when(F.col("metric_name") == name, F.col("v"))), F.lit(0.0)) \
            .cast("long")

    s = per_metric.groupBy("source_file").agg(
        pick("AnomalyCount").alias("total_anomalies"),
        pick("SilverRecords").alias("data_quality_issues"),
        pick("TotalRecords").alias("total_records"),
        pick("GoldRecords").alias("gold_records"))
    return s.withColumn("dq_score", ratio_pct(F.col("gold_records"), F.col("total_records")))


def score_band(score, params: DQParams = DEFAULT) -> Column:
    """Below 80, 80 to 95, 95 and above (fixed band edges)."""
    return F.when(score < params.score_band_low, F.lit("below_80")) \
        .when(score < params.score_target, F.lit("80_to_95")).otherwise(F.lit("95_and_above"))


def score_bands(scores: DataFrame, params: DQParams = DEFAULT, score_col: str = "dq_score") -> DataFrame:
    """T9 + T10: delta against the target and the band of each score."""
    s = F.col(score_col)
    return (scores.withColumn("delta_vs_target", s - F.lit(params.score_target))
            .withColumn("meets_target", s >= F.lit(params.score_target))
            .withColumn("band", score_band(s, params)))


def cost_summary(cost_points: DataFrame, params: DQParams = DEFAULT, days: int = 7) -> DataFrame:
    """T8 + T9: over daily DailyCost maxima of the last ``days`` days: latest,
    average, latest x 30, the delta to the average and the budget label.
    With no points the latest falls back to a fixed daily estimate."""
    end = dt.datetime.combine(params.need("cost_as_of"), dt.time())
    start = end - dt.timedelta(days=days)
    daily = metric_buckets(
        cost_points.filter((F.col("metric_name") == "DailyCost")
                           & (F.col("ts") >= ts_lit(start)) & (F.col("ts") < ts_lit(end))),
        86400, series=["metric_name"])
    s = daily.agg(F.max_by("maximum", "period_start").alias("latest"),
                  F.avg("maximum").alias("avg_daily"),
                  F.count(F.lit(1)).alias("days_with_data"))
    current = F.coalesce(F.col("latest"), F.lit(params.fallback_daily_cost))
    s = s.select(current.alias("current_daily_cost"),
                 F.coalesce(F.col("avg_daily"), current).alias("avg_daily_cost"),
                 (current * 30).alias("projected_monthly"), "days_with_data")
    return (s.withColumn("delta_vs_avg", F.col("current_daily_cost") - F.col("avg_daily_cost"))
            .withColumn("budget_status",
                        F.when(F.col("projected_monthly") < params.monthly_budget, F.lit("Within budget"))
                        .otherwise(F.lit("Over budget"))))
