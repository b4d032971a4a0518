"""Threshold alarms over metric points.

An alarm reduces its metric to one statistic per fixed period, compares it
with a threshold and is in ALARM at period t when the last ``periods`` periods
up to t all breach; a period without data does not breach.

The "N consecutive periods" test is an aggregate, not a window over a dense
spine: every breaching period ``b`` votes for ``b, b+1, .., b+N-1`` (an
``explode`` of N offsets) and t is in ALARM when it gets N votes.  A missing
period casts no vote, which is exactly "missing counts as not breaching", and
the work is keyed by (alarm, period), so no series has to sit in one task.
State changes to ALARM come from the same votes: those for the N periods before
t tell whether t - 1 was in ALARM too.  All alarms are evaluated together, in
one pass over the points (no self join, no union of one plan per alarm).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimsdq.params import DEFAULT, DQParams

_WORDS = {
    "GreaterThanThreshold": "greater than", "GreaterThanOrEqualToThreshold": "greater than or equal to",
    "LessThanThreshold": "less than", "LessThanOrEqualToThreshold": "less than or equal to",
}


@dataclass(frozen=True)
class AlarmDef:
    alarm_name: str
    namespace: str
    metric_name: str
    dimension: str | None
    statistic: str
    comparison: str
    threshold: float
    periods: int
    period_seconds: int
    event_type: str | None
    action: str | None


def alarm_defs(params: DQParams = DEFAULT) -> list[AlarmDef]:
    """The three alarm definitions (fixed values: metric, statistic,
    comparison, periods, period, event type and action).  The anomaly and
    score alarms watch the folder-level series ``params.folder``."""
    p = params
    return [
        AlarmDef(f"{p.project}-anomaly-spike", p.dq_namespace, "AnomalyCount", p.folder, "Sum",
                 "GreaterThanThreshold", p.anomaly_threshold, 1, p.period_seconds,
                 "anomaly_spike", "handle_anomaly_spike"),
        AlarmDef(f"{p.project}-dq-score-low", p.dq_namespace, "DataQualityScore", p.folder, "Average",
                 "LessThanThreshold", p.score_threshold, p.score_periods, p.period_seconds, None, None),
        AlarmDef(f"{p.project}-daily-cost-spike", p.cost_namespace, "DailyCost", None, "Maximum",
                 "GreaterThanThreshold", p.cost_threshold, 1, p.period_seconds, "cost_spike",
                 "handle_cost_spike"),
    ]


ALARM_SCHEMA = T.StructType([
    T.StructField("alarm_name", T.StringType()), T.StructField("namespace", T.StringType()),
    T.StructField("metric_name", T.StringType()), T.StructField("dimension", T.StringType()),
    T.StructField("statistic", T.StringType()), T.StructField("comparison", T.StringType()),
    T.StructField("threshold", T.DoubleType()), T.StructField("periods", T.IntegerType()),
    T.StructField("period_seconds", T.IntegerType()), T.StructField("event_type", T.StringType()),
    T.StructField("action", T.StringType()),
])


def alarm_definitions(spark: SparkSession, params: DQParams = DEFAULT,
                      defs: list[AlarmDef] | None = None) -> DataFrame:
    """Definitions as a (configuration-sized) DataFrame for joins."""
    rows = [tuple(d.__dict__.values()) for d in (alarm_defs(params) if defs is None else defs)]
    return spark.createDataFrame(rows, ALARM_SCHEMA)


def epoch_period(ts: Column, seconds: Column) -> Column:
    """Start of the period of ``seconds`` that holds ``ts`` (epoch aligned)."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    whole = F.timestamp_diff("SECOND", epoch, ts)
    return F.timestamp_add("SECOND", whole - F.pmod(whole, seconds.cast("long")), epoch)


def statistic_value() -> Column:
    """The one of the five statistics that the row's alarm asks for."""
    return F.coalesce(*[F.when(F.col("statistic") == s, F.col(s))
                        for s in ("Sum", "Average", "Maximum", "Minimum", "SampleCount")])


def breaches() -> Column:
    """Whether the row's value breaches its alarm's threshold."""
    value, threshold, comparison = F.col("value"), F.col("threshold"), F.col("comparison")
    breach = F.when(comparison == "GreaterThanThreshold", value > threshold) \
        .when(comparison == "GreaterThanOrEqualToThreshold", value >= threshold) \
        .when(comparison == "LessThanThreshold", value < threshold) \
        .when(comparison == "LessThanOrEqualToThreshold", value <= threshold)
    return F.coalesce(breach, F.lit(False))


def alarm_reason() -> Column:
    """The text of a state change to ALARM."""
    words = F.coalesce(*[F.when(F.col("comparison") == c, F.lit(w)) for c, w in _WORDS.items()])
    return F.concat(F.lit("Threshold Crossed: "), F.col("periods").cast("string"),
                    F.lit(" consecutive period(s) were "), words, F.lit(" the threshold ("),
                    F.col("threshold").cast("string"), F.lit(")."))


def period_values(points: DataFrame, definitions: DataFrame) -> DataFrame:
    """Per alarm and period: the alarm's statistic and whether it breaches.

    One pass serves every alarm: the definitions (a few rows of configuration)
    are broadcast to the points, all five statistics come from one aggregate
    and each alarm takes its own."""
    d = definitions.select(*[F.col(c).alias(f"d_{c}") for c in definitions.columns])
    mine = (F.col("namespace") == F.col("d_namespace")) & (F.col("metric_name") == F.col("d_metric_name")) \
        & (F.col("d_dimension").isNull() | (F.col("source_file") == F.col("d_dimension")))
    p = points.join(F.broadcast(d), mine)
    keys = ["alarm_name", "statistic", "comparison", "threshold", "periods", "period_seconds", "event_type", "action"]
    v = p.groupBy(*[F.col(f"d_{k}").alias(k) for k in keys],
                  epoch_period(F.col("ts"), F.col("d_period_seconds")).alias("period_start")).agg(
        F.sum("value").alias("Sum"), F.avg("value").alias("Average"), F.max("value").alias("Maximum"),
        F.min("value").alias("Minimum"), F.count("value").cast("double").alias("SampleCount"))
    return v.withColumn("value", statistic_value()).withColumn("breaching", breaches()) \
        .select(*keys, "period_start", "value", "breaching")


def _marks(points: DataFrame, definitions: DataFrame) -> DataFrame:
    """Per alarm and period: how many of the last N periods breach (``now``), and
    how many of the N before the last one (``before``).

    Each breaching period b votes for b .. b + N: for ``now`` at offsets 0 to
    N - 1, for ``before`` at offsets 1 to N.  One aggregate keyed by (alarm,
    period) then answers both "in ALARM?" and "in ALARM one period earlier?"."""
    b = period_values(points, definitions).filter("breaching")
    votes = b.select("*", F.explode(F.sequence(F.lit(0), F.greatest("periods", F.lit(1)))).alias("k"))
    at = F.timestamp_add("SECOND", F.col("k") * F.col("period_seconds"), F.col("period_start"))
    n = F.greatest("periods", F.lit(1))
    info = ["statistic", "comparison", "threshold", "periods", "period_seconds", "event_type", "action"]
    return votes.withColumn("at", at).groupBy("alarm_name", *info, F.col("at").alias("period_start")).agg(
        F.count_if(F.col("k") < n).alias("now"), F.count_if(F.col("k") > 0).alias("before"),
        F.max(F.when(F.col("k") == 0, F.col("value"))).alias("value")) \
        .filter(F.col("now") == n).withColumn("began", F.col("before") < n).withColumn("state", F.lit("ALARM"))


_STATE = ["alarm_name", "period_start", "value", "state"]


def alarm_periods(points: DataFrame, definitions: DataFrame) -> DataFrame:
    """L1-L4: the periods in ALARM, with the period's own statistic.  A period
    without data casts no vote, so it counts as not breaching."""
    return _marks(points, definitions).select(*_STATE)


def alarm_transitions(points: DataFrame, definitions: DataFrame) -> DataFrame:
    """ALARM periods whose previous period was not in ALARM."""
    return _marks(points, definitions).filter("began").select(*_STATE)


def alarm_events(points: DataFrame, definitions: DataFrame) -> DataFrame:
    """State-change events shaped for the orchestrator.  Only alarms that
    have an event target (a definition with an action) are evaluated."""
    j = _marks(points, definitions.filter(F.col("action").isNotNull())).filter("began")
    return j.select(
        F.col("event_type"), F.col("alarm_name"), F.col("state"), alarm_reason().alias("reason"),
        F.timestamp_add("SECOND", F.col("period_seconds"), F.col("period_start")).alias("timestamp"),
        F.col("action"), F.col("value"))


# Orchestrator routing (fixed values: the six known action names and the
# remediation each one runs).
ACTION_ROUTES = (
    ("quarantine_data", "quarantine_data"),
    ("handle_anomaly_spike", "quarantine_data"),
    ("restart_glue_job", "restart_job"),
    ("restart_etl", "restart_job"),
    ("handle_cost_spike", "cost_spike_detected"),
    ("cost_spike", "cost_spike_detected"),
)


def route_action(action: Column) -> Column:
    chain = None
    for name, target in ACTION_ROUTES:
        cond = action == name
        chain = F.when(cond, F.lit(target)) if chain is None else chain.when(cond, F.lit(target))
    return chain


def action_routing(requests: DataFrame) -> DataFrame:
    """Route each request's action; unknown or empty gives 400 and an error."""
    routed = route_action(F.coalesce(F.col("action"), F.lit("")))
    return (requests.withColumn("routed_action", routed)
            .withColumn("status_code", F.when(F.col("routed_action").isNotNull(), F.lit(200))
                        .otherwise(F.lit(400)))
            .withColumn("error", F.when(F.col("routed_action").isNull(),
                                        F.concat(F.lit("Unknown action: "),
                                                 F.coalesce(F.col("action"), F.lit(""))))))
