"""Cost rollup C1-C5.

A cost response is one row per period: ``period_start`` (date), ``total``
(nullable double, the response's Total) and ``groups`` (array of
``struct<service, amount>``, one entry per service).  The array is bounded by
the number of services, so exploding it is cheap and never gathers data.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimsdq.params import DEFAULT, DQParams


# The nested answer of a cost service: amounts are text (fixed values: names).
_AMOUNT = "struct<UnblendedCost:struct<Amount:string,Unit:string>>"
RESPONSE_SCHEMA = ("struct<ResultsByTime:array<struct<TimePeriod:struct<Start:string,End:string>,"
                   f"Total:{_AMOUNT},Groups:array<struct<Keys:array<string>,Metrics:{_AMOUNT}>>>>>")


def parse_responses(responses: DataFrame, column: str = "response", keep: tuple[str, ...] = ()) -> DataFrame:
    """Nested cost answers to one row per answer and period: ``period_start``,
    ``total`` (null when absent) and ``groups`` (service, amount; one entry per
    service, the last one given).  An answer without periods gives one row with
    a null period, no total and no groups.  A bad amount is null."""
    parsed = responses.select(*keep, F.from_json(column, RESPONSE_SCHEMA).alias("a"))
    period = parsed.select(*keep, F.explode_outer("a.ResultsByTime").alias("p"))

    def amount(c):
        return c["UnblendedCost"]["Amount"].try_cast("double")

    given = F.coalesce(F.col("p.Groups"), F.array().cast(f"array<struct<Keys:array<string>,Metrics:{_AMOUNT}>>"))
    pairs = F.transform(given, lambda g: F.struct(F.get(g["Keys"], F.lit(0)).alias("service"),
                                                  amount(g["Metrics"]).alias("amount")))
    last = F.filter(pairs, lambda g, i: ~F.exists(F.slice(pairs, i + 2, F.size(pairs)),
                                                  lambda later: later["service"] == g["service"]))
    return period.select(*keep, F.try_to_date(F.col("p.TimePeriod.Start")).alias("period_start"),
                         amount(F.col("p.Total")).alias("total"), F.array_sort(last).alias("groups"))


def cost_by_service(resp: DataFrame) -> DataFrame:
    """One row per (period, service)."""
    return resp.select("period_start", F.explode("groups").alias("g")) \
        .select("period_start", F.col("g.service").alias("service"), F.col("g.amount").alias("amount"))


def cost_daily(resp: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """The daily total as the reference reads it (Total, 0 when absent),
    next to the sum of the service groups."""
    groups = F.coalesce(F.col("groups"),
                        F.array().cast("array<struct<service:string,amount:double>>"))
    groups_sum = F.aggregate(groups, F.lit(0.0), lambda acc, g: acc + g["amount"])
    return resp.select("period_start",
                       F.coalesce(F.col("total"), F.lit(0.0)).alias("total_cost"),
                       groups_sum.alias("service_sum"),
                       F.size(groups).alias("n_services"), *keep)


def cost_yesterday(resp: DataFrame, as_of: dt.date) -> DataFrame:
    """The half-open day ``[as_of - 1, as_of)``."""
    y = as_of - dt.timedelta(days=1)
    return resp.filter((F.col("period_start") >= F.lit(y)) & (F.col("period_start") < F.lit(as_of)))


def cost_metric_points(resp: DataFrame, params: DQParams = DEFAULT) -> DataFrame:
    """C4: DailyCost per period plus ServiceCost per (period, service);
    ``dimension`` holds the point's dimension value, unit is None.  One pass:
    each response row expands to its own points with a single ``explode``."""
    entry = "struct<metric_name:string,dimension:string,value:double>"
    daily = F.struct(F.lit("DailyCost").alias("metric_name"),
                     F.lit(f"Project={params.project},Environment={params.environment}").alias("dimension"),
                     F.coalesce(F.col("total"), F.lit(0.0)).alias("value"))
    services = F.transform(
        F.coalesce(F.col("groups"), F.array().cast("array<struct<service:string,amount:double>>")),
        lambda g: F.struct(F.lit("ServiceCost").alias("metric_name"),
                           F.concat(F.lit(f"Project={params.project},Service="), g["service"]).alias("dimension"),
                           g["amount"].alias("value")))
    pts = resp.select(F.col("period_start").cast("timestamp_ntz").alias("ts"),
                      F.explode(F.concat(F.array(daily).cast(f"array<{entry}>"),
                                         services.cast(f"array<{entry}>"))).alias("p"))
    return pts.select(F.lit(params.cost_namespace).alias("namespace"), F.col("p.metric_name"),
                      F.col("p.dimension"), "ts", F.col("p.value"), F.lit("None").alias("unit"))


def cost_status(resp: DataFrame, params: DQParams = DEFAULT) -> DataFrame:
    """Strict ``total > threshold`` gives ``high``; high days carry the
    service breakdown (as a map and as sorted ``service=amount`` text)."""
    d = cost_daily(resp, keep=("groups",))
    high = F.col("total_cost") > F.lit(params.cost_threshold)
    text = F.array_join(F.transform(
        F.array_sort(F.col("groups")),
        lambda g: F.concat(g["service"], F.lit("="), F.format_string("%.8f", g["amount"]))), ";")
    return d.select(
        "period_start", "total_cost", F.lit(params.cost_threshold).alias("threshold"),
        F.when(high, F.lit("high")).otherwise(F.lit("normal")).alias("status"),
        F.when(high, F.map_from_entries(F.col("groups"))).alias("service_breakdown"),
        F.when(high, text).alias("breakdown_text"))


def cost_spike_events(resp: DataFrame, run_ts: dt.datetime, params: DQParams = DEFAULT) -> DataFrame:
    """One event per day above the threshold, shaped as its receiver wants
    it: current_cost, threshold, service_breakdown, date, timestamp."""
    d = cost_daily(resp, keep=("groups",)).filter(F.col("total_cost") > F.lit(params.cost_threshold))
    breakdown = F.map_from_entries(F.filter("groups", lambda g: g["service"].isNotNull()))
    detail = F.struct(F.col("total_cost").alias("current_cost"), F.lit(params.cost_threshold).alias("threshold"),
                      breakdown.alias("service_breakdown"), F.date_format("period_start", "yyyy-MM-dd").alias("date"),
                      F.lit(run_ts.strftime("%Y-%m-%dT%H:%M:%S")).alias("timestamp"))
    return d.select("period_start", F.lit("Cost Spike Detected").alias("detail_type"),
                    detail.alias("detail"), F.to_json(detail).alias("detail_json"))
