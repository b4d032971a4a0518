"""L1-L6 on a stream: alarms that begin, and end, while points come in.

Two queries, as a stateful operator may not follow an aggregation:

* *Judging.*  Points meet the alarm definitions and are reduced to one statistic
  per (alarm, period) by a tumbling window in append mode, so a period is judged
  once, when the watermark has passed its end.  The windows of points that no
  alarm watches go on too, as a clock.
* *State.*  A stateful operator keyed by alarm counts breaching periods in a row
  and emits a state change when an alarm begins or ends.

A period without points never reaches the second query, yet it does not breach
and ends an alarm.  So after each judged period the operator sets an event-time
timer for the end of the next one: if the watermark gets there first, the period
was missing, the count starts anew and an alarm that was on ends at that time.

The first query takes the load (map-side aggregation, one row per alarm and
period leaves it); the second sees these rows only, and its state is a few
numbers per alarm.  Points later than the watermark are dropped, as a metrics
store rejects writes that are too old.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from claimsdq.operators.alarms import AlarmDef, alarm_definitions, alarm_reason, breaches, statistic_value
from claimsdq.session import ship_package

_KEYS = ["alarm_name", "statistic", "comparison", "threshold", "periods", "period_seconds", "event_type", "action"]
CHANGES = ("alarm_name string, state string, timestamp timestamp, value double, event_type string, action string, "
           "comparison string, threshold double, periods int")
#: periods in a row that breach, whether in ALARM, end of the last judged period (epoch seconds)
_STATE = ("run int, on boolean, judged long, event_type string, action string, comparison string, threshold double, "
          "periods int, period_seconds int")


def judged_periods(points: DataFrame, definitions: DataFrame, period_seconds: int, delay: str) -> DataFrame:
    """Per alarm and closed period: the alarm's statistic and whether it breaches."""
    d = definitions.filter(F.col("period_seconds") == period_seconds) \
        .select(*[F.col(c).alias(f"d_{c}") for c in definitions.columns])
    mine = (F.col("namespace") == F.col("d_namespace")) & (F.col("metric_name") == F.col("d_metric_name")) \
        & (F.col("d_dimension").isNull() | (F.col("source_file") == F.col("d_dimension")))
    p = points.withColumn("event_ts", F.col("ts").cast("timestamp")).withWatermark("event_ts", delay)
    # points of no alarm take part in the watermark only
    p = p.join(F.broadcast(d), mine, "left").withColumn("value", F.when(F.col("d_alarm_name").isNotNull(), F.col("value")))
    v = p.groupBy(F.window("event_ts", f"{period_seconds} seconds").alias("w"), *[F.col(f"d_{k}").alias(k) for k in _KEYS]) \
        .agg(F.sum("value").alias("Sum"), F.avg("value").alias("Average"), F.max("value").alias("Maximum"),
             F.min("value").alias("Minimum"), F.count("value").cast("double").alias("SampleCount"))
    v = v.withColumn("value", statistic_value())
    return v.withColumn("breaching", breaches()).select(*_KEYS, F.col("w.end").alias("closed"), "value", "breaching")


def _judge(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    names = ["event_type", "action", "comparison", "threshold", "periods", "period_seconds"]
    run, on, judged, *of = state.get if state.exists else (0, False, None, *[None] * len(names))
    out = []
    if key[0] is None:        # the clock; a filter would be pushed below the watermark and stop it
        return

    def change(to: str, at: int, value: float | None) -> None:
        event_type, action, comparison, threshold, periods, _ = of
        out.append((key[0], to, pd.Timestamp(at, unit="s"), value, event_type, action, comparison, threshold, periods))

    def missing(at: int) -> None:
        """The period that ends at ``at`` had no points."""
        nonlocal run, on, judged
        if on:
            change("OK", at, None)
        run, on, judged = 0, False, at

    if state.hasTimedOut:
        missing(judged + of[-1])
    else:
        rows = pd.concat(list(batches)).sort_values("closed")
        for r in rows.itertuples():
            of = [None if pd.isna(x) else x for x in (getattr(r, n) for n in names)]
            of[4:] = map(int, of[4:])
            end = int(r.closed.timestamp())
            if judged is not None and judged + of[5] < end:
                missing(judged + of[5])
            run, judged = (run + 1 if r.breaching else 0), end
            if run >= max(1, of[4]) and not on:
                on = True
                change("ALARM", end, float(r.value))
            elif on and not r.breaching:
                on = False
                change("OK", end, float(r.value))
    state.update((run, on, judged, *of))
    if on or run:
        # later than the end itself: at that watermark the period is judged, if it has points
        wait = (judged + of[-1]) * 1000 + 1
        state.setTimeoutTimestamp(max(wait, state.getCurrentWatermarkMs() + 1))
    yield pd.DataFrame(out, columns=["alarm_name", "state", "timestamp", "value", "event_type", "action", "comparison",
                                     "threshold", "periods"])


def start_alarms(spark: SparkSession, points: DataFrame, defs: list[AlarmDef], out_dir: str, checkpoint_location: str,
                 period_seconds: int = 3600, delay: str = "2 hours", available_now: bool = True) -> StreamingQuery:
    """Follow a stream of points (namespace, metric_name, source_file, ts, value):
    state changes of the alarms with this period go to ``<out_dir>/changes`` (start
    one pair of queries per period that the definitions have)."""
    out, checkpoint = out_dir.rstrip("/"), checkpoint_location.rstrip("/")
    ship_package(spark)

    def start(stream: DataFrame, name: str) -> StreamingQuery:
        w = stream.writeStream.outputMode("append").format("parquet").option("path", f"{out}/{name}") \
            .option("checkpointLocation", f"{checkpoint}/{name}")
        return (w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")).start()

    judged = judged_periods(points, alarm_definitions(spark, defs=defs), period_seconds, delay)
    first = start(judged, "judged")
    if available_now:
        first.awaitTermination()
        if first.exception():
            raise first.exception()
    spark.createDataFrame([], judged.schema).write.mode("append").parquet(f"{out}/judged")
    # all windows of one end leave the first query in one batch, which the file sink
    # makes visible at once: none comes later than the time they give
    closed = spark.readStream.schema(judged.schema).option("maxFileAge", "36500d").parquet(f"{out}/judged") \
        .withWatermark("closed", "0 seconds")
    return start(closed.groupBy("alarm_name").applyInPandasWithState(
        _judge, CHANGES, _STATE, "append", GroupStateTimeout.EventTimeTimeout), "changes")


def alarm_events_of(changes: DataFrame) -> DataFrame:
    """The events of alarms with a target that began, in the batch evaluator's form."""
    return changes.filter("state = 'ALARM' AND action IS NOT NULL").select(
        "event_type", "alarm_name", "state", alarm_reason().alias("reason"),
        F.col("timestamp").cast("timestamp_ntz").alias("timestamp"), "action", "value")
