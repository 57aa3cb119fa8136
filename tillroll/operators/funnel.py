"""Label funnel over sessions.

Two aggregations: per (period, session) 0/1 step flags, then per period the session count and flag sums. Both are
`groupBy` with map-side partial aggregation, so a session or period holding a third of all events is combined inside
each map task before the shuffle and never lands whole in one task. The second level has one row per session in,
one row per period out.
"""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The reference's search-box steps, in funnel order (output column -> event label).
SEARCH_STEPS = {
    "focused": "input-focused",
    "typed": "input-changed",
    "saw_suggestions": "suggestions-revealed",
    "submitted_enter": "enter",
    "submitted_click": "click-search-icon",
    "clicked_view_all": "click-view-all",
}

# The reference's funnel columns and the step flags that each adds up.
SEARCH_COLUMNS = {
    "focused": ("focused",), "typed": ("typed",), "saw_suggestions": ("saw_suggestions",),
    "submitted": ("submitted_enter", "submitted_click"), "clicked_view_all": ("clicked_view_all",),
}

# Period start by calendar date (TZ-free for TIMESTAMP_NTZ; zoned timestamps use the session time zone).
PERIOD_UNITS = {"month": "MM", "day": "DD", "week": "week", "year": "year"}


def session_step_flags(events: DataFrame, steps: dict[str, str] = SEARCH_STEPS, period: str = "month",
                       ts_col: str = "derived_tstamp", session_col: str = "domain_sessionid",
                       label_col: str = "se_label") -> DataFrame:
    """One row per (event_date, session) with MAX(CASE label = step THEN 1 ELSE 0) per step."""
    day = F.to_date(F.col(ts_col))
    start = day if period == "day" else F.trunc(day, PERIOD_UNITS[period])
    ev = events.select(start.alias("event_date"),
                       F.col(session_col).alias("session_id"), F.col(label_col).alias("label"))
    flags = [F.max(F.when(F.col("label") == lbl, 1).otherwise(0)).alias(name) for name, lbl in steps.items()]
    return ev.groupBy("event_date", "session_id").agg(*flags)


def funnel_sums(steps: dict[str, str], columns: dict[str, tuple[str, ...]] | None = None) -> list[Column]:
    """The second level's aggregates: sessions, and per output column the sum of its step flags. Steps other than the
    search box's get a column each unless `columns` says otherwise."""
    if columns is None:
        columns = SEARCH_COLUMNS if steps == SEARCH_STEPS else {name: (name,) for name in steps}
    unknown = {f for flags in columns.values() for f in flags} - set(steps)
    if unknown:
        raise ValueError(f"funnel columns use unknown steps: {sorted(unknown)}")
    return [F.count(F.lit(1)).alias("total_sessions"),
            *[F.sum(reduce(add, map(F.col, flags))).cast("bigint").alias(f"sessions_{name}")
              for name, flags in columns.items()]]


def search_funnel(events: DataFrame, period: str = "month", steps: dict[str, str] = SEARCH_STEPS,
                  columns: dict[str, tuple[str, ...]] | None = None) -> DataFrame:
    """Sessions per period reaching each step (by default the search box's). `sessions_submitted` adds the two submit flags, so a session
    that used both ways counts twice, as in the reference; a session spanning two periods counts in each."""
    per_session = session_step_flags(events, steps, period)
    return per_session.groupBy("event_date").agg(*funnel_sums(steps, columns)).orderBy("event_date")
