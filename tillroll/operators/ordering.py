"""Gapless row numbers of a whole table, or of each of its groups, without a window over the raw rows.

The rows are sorted by range over all tasks and written with the number of their partition and their place in it. A second
pass counts the rows of each (group, partition), which is one row per partition and group border, and a running sum over
those few counts gives every partition its start. A group that holds a third of all rows lies in many partitions, and rows
that are equal in every sort column are told apart by their place in the input, so that they are split as well.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillroll.session import cut_lineage

#: Bits of a row's place within its partition in monotonically_increasing_id.
_PLACE_BITS = 33


def _free(df: DataFrame, name: str) -> str:
    while name in df.columns:
        name += "_"
    return name


def positions(df: DataFrame, order: list[Column | str], group: list[str] | None = None, name: str = "position",
              total: str | None = None) -> DataFrame:
    """`df` with `name`, the 0-based position (long) of each row in its group by `order`, and `total`, the group's rows.

    Runs a job: the sorted rows are checkpointed, so that a lost executor cannot give rows other numbers. `df` is read
    twice (the range sort samples it first): pass a table or a checkpointed frame. Null groups are a group; an empty table
    stays empty; equal rows get different positions in an unspecified order."""
    group = group or []
    tie, part, at, first, before, rows = (_free(df, c) for c in ("_tie", "_part", "_at", "_first", "_before", "_rows"))
    keys = [F.col(f"`{g}`").asc_nulls_first() for g in group] + [F.col(o) if isinstance(o, str) else o for o in order] + [F.col(tie)]
    tied = df.withColumn(tie, F.monotonically_increasing_id())
    placed = cut_lineage(tied.repartitionByRange(*keys).sortWithinPartitions(*keys).drop(tie).withColumns({
        part: F.spark_partition_id(), at: F.monotonically_increasing_id().bitwiseAND((1 << _PLACE_BITS) - 1)}))
    counts = placed.groupBy(*[F.col(f"`{g}`") for g in group], part).agg(F.count(F.lit(1)).alias(rows), F.min(at).alias(first))
    whole = Window.partitionBy(*[F.col(f"`{g}`") for g in group])
    running = whole.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.withColumn(before, F.coalesce(F.sum(rows).over(running), F.lit(0)))
    if total:
        starts = starts.withColumn(total, F.sum(rows).over(whole))
    renamed = {c: f"_start_{i}" for i, c in enumerate([*group, part])}
    starts = starts.withColumnsRenamed(renamed).drop(rows)
    found = placed[part] == starts[renamed[part]]
    for g in group:
        found = found & placed[f"`{g}`"].eqNullSafe(starts[renamed[g]])
    out = placed.join(starts, found)
    return out.select(*[F.col(f"`{c}`") for c in df.columns], (F.col(before) + F.col(at) - F.col(first)).alias(name),
                      *([F.col(total)] if total else []))
