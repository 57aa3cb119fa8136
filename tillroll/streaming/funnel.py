"""The search funnel (P5) over an event stream, with Structured Streaming.

The reference runs the funnel as a batch query over an append-only event table. The same computation runs
incrementally as two chained event-time aggregations: session step flags per (day window, session), then sums per day
window. A watermark bounds the state: a (day, session) row is final, and emitted once, when the watermark passes the
end of its day; the second aggregation adds finalised sessions only, so its append output equals the batch funnel for
every closed day. Calendar months are not fixed-length windows, so the monthly form stays a batch query (or a
`foreachBatch` merge of these daily rows).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.operators.funnel import SEARCH_STEPS, funnel_sums


def daily_funnel_stream(events: DataFrame, lateness: str = "1 hour", ts_col: str = "derived_tstamp",
                        session_col: str = "domain_sessionid", label_col: str = "se_label",
                        steps: dict[str, str] = SEARCH_STEPS) -> DataFrame:
    """Streaming DataFrame (append mode): event_date plus the funnel columns of `operators.funnel.search_funnel`."""
    # event time must be TIMESTAMP (parquet from the warehouse often carries TIMESTAMP_NTZ; the session is UTC)
    ev = events.withColumn(ts_col, F.col(ts_col).cast("timestamp")).withWatermark(ts_col, lateness)
    flags = [F.max(F.when(F.col(label_col) == lbl, 1).otherwise(0)).alias(name) for name, lbl in steps.items()]
    per_session = ev.groupBy(F.window(ts_col, "1 day").alias("day"), F.col(session_col)).agg(*flags)
    per_day = per_session.groupBy(F.window(F.window_time("day"), "1 day").alias("day")).agg(*funnel_sums(steps))
    return per_day.select(F.to_date(F.col("day.start")).alias("event_date"), *[c for c in per_day.columns
                                                                                 if c != "day"])


def start_daily_funnel(events: DataFrame, sink_path: str, checkpoint: str, fmt: str = "parquet",
                       trigger_seconds: int | None = None):
    """Run the stream into files with a checkpoint in the shared checkpoint folder (restartable after failure)."""
    w = daily_funnel_stream(events).writeStream.outputMode("append").format(fmt) \
        .option("path", sink_path).option("checkpointLocation", checkpoint)
    if trigger_seconds:
        w = w.trigger(processingTime=f"{trigger_seconds} seconds")
    return w.start()
