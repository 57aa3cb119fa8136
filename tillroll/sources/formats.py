"""Column formats of partner reports (IO9, F32): how a column's dates are written is decided from all of its cells.

A cell such as 03/04/2024 can be read in two ways, and reading each cell by the first pattern that fits mixes both ways within
one column. Patterns that can be confused have the same *shape* (the same separators and widths: `M/d/yyyy` and `d/M/yyyy`). One
aggregate over the report counts, per column, shape and pattern, and per file if a column names it, how many cells the pattern
parses and on how many two patterns of the shape disagree. The pattern that parses most cells is taken for the whole
column; cells of that shape which it does not parse become null and are counted. Cells of other shapes and ISO dates cannot be
confused and are read as what they are. If no cell decides (two patterns parse equally many and give different days),
the column is undecided: a stated preference is taken or AmbiguousDatesError raised.

The aggregate has one row per file; what reaches the driver without a file column is one row per column and shape. With a
file column the decisions stay a table that is joined back, however many files there are.
"""

from __future__ import annotations

import itertools
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Date patterns beside the ISO form. Within a shape the first one is preferred if no cell decides.
DATE_PATTERNS = ("M/d/yyyy", "d/M/yyyy", "d MMM yyyy", "d-MMM-yyyy", "d.M.yyyy", "yyyyMMdd")
ISO = "ISO"


class AmbiguousDatesError(ValueError):
    pass


def shape(pattern: str) -> str:
    """What patterns that can parse the same cells have in common: separators, and the kind and width of what is between."""
    def kind(fields: str) -> str:
        if "MMM" in fields:
            return "name"
        return f"{len(fields)} digits" if len(set(fields)) > 1 else {4: "year"}.get(len(fields), "number")

    return "".join(kind(x) if x.isalpha() else x for x in re.findall(r"[A-Za-z]+|[^A-Za-z]+", pattern))


def shapes(patterns=DATE_PATTERNS) -> dict[str, list[str]]:
    """Patterns by shape, in the given order."""
    found: dict[str, list[str]] = {}
    for p in patterns:
        found.setdefault(shape(p), []).append(p)
    return found


def cell_text(column: str) -> Column:
    """The trimmed cell, null if nothing is written in it."""
    text = F.trim(F.col(f"`{column}`").cast("string"))
    return F.when(text != "", text)


def _iso(text: Column) -> Column:
    return text.try_cast("timestamp").cast("date")


def _parsed(text: Column, pattern: str) -> Column:
    return F.try_to_timestamp(text, F.lit(pattern)).cast("date")


def _scope(by: str | None) -> Column:
    return F.lit(None).cast("string") if by is None else F.col(f"`{by}`").cast("string")


def _second_best(counts: Column, best_at: Column) -> Column:
    """The largest of the other numbers than the one at the 1-based place `best_at`, 0 if there is none."""
    return F.coalesce(F.array_max(F.filter(counts, lambda n, k: k != best_at - 1)), F.lit(0).cast("long"))


def column_formats(df: DataFrame, columns, patterns=DATE_PATTERNS, by: str | None = None) -> DataFrame:
    """One row per file (`source`, null without `by`), column and shape: `pattern`, the one that parses most cells of the
    column (ties: the first given), `cells` that it parses, `rival_cells`, the most that another pattern of the shape parses,
    `conflicts`, the cells on which two of them disagree, `filled`, the column's non-empty cells, and `decided`."""
    groups = shapes(patterns)
    rows = df.select(_scope(by).alias("source"), *[cell_text(c).alias(f"c{i}") for i, c in enumerate(columns)])
    # every cell is parsed once per pattern; ISO cells count for no pattern
    parsed = rows.select("source", *[F.col(f"c{i}") for i in range(len(columns))], *[
        F.when(_iso(F.col(f"c{i}")).isNull(), _parsed(F.col(f"c{i}"), p)).alias(f"p{i}_{j}")
        for i in range(len(columns)) for j, p in enumerate(patterns)])
    at = {p: j for j, p in enumerate(patterns)}
    counts, structs = [], []
    for i, c in enumerate(columns):
        counts.append(F.count(f"c{i}").alias(f"n{i}"))
        for s, (name, members) in enumerate(groups.items()):
            fits = [F.count(f"p{i}_{at[p]}") for p in members]
            pairs = [F.count_if(F.col(f"p{i}_{at[a]}") != F.col(f"p{i}_{at[b]}")) for a, b in itertools.combinations(members, 2)]
            counts.append(F.array(*fits).alias(f"f{i}_{s}"))
            counts.append((sum(pairs[1:], pairs[0]) if pairs else F.lit(0)).cast("long").alias(f"x{i}_{s}"))
            fit = F.col(f"f{i}_{s}")
            best = F.array_max(fit)
            first = F.array_position(fit, best).cast("int")
            rival = _second_best(fit, first)
            structs.append(F.struct(
                F.lit(c).alias("column"), F.lit(name).alias("shape"), F.get(F.array(*map(F.lit, members)), first - 1).alias("pattern"),
                best.alias("cells"), rival.alias("rival_cells"), F.col(f"x{i}_{s}").alias("conflicts"), F.col(f"n{i}").alias("filled"),
                ((rival < best) | (F.col(f"x{i}_{s}") == 0)).alias("decided")))
    return parsed.groupBy("source").agg(*counts).select("source", F.explode(F.array(*structs)).alias("x")).select("source", "x.*")


def _refuse(undecided: DataFrame) -> None:
    found = undecided.where("not decided").select("source", "column", "pattern").orderBy("source", "column").limit(20).collect()
    if found:
        names = ", ".join(f"{r['column']}" + (f" of {r['source']}" if r["source"] is not None else "") for r in found)
        raise AmbiguousDatesError(f"no cell tells the order of day and month: {names}")


def read_dates(df: DataFrame, columns, patterns=DATE_PATTERNS, by: str | None = None, undecided: str = "first") -> DataFrame:
    """`df` with the text `columns` as dates, each read by its column's (and, with `by`, its file's) formats.

    Runs the counting job. `undecided="raise"` refuses a column that no cell decides, `"first"` takes the pattern that is given
    first. Empty cells and cells that fit no chosen pattern become null; an empty table stays empty."""
    if undecided not in ("first", "raise"):
        raise ValueError(f"undecided is 'first' or 'raise', not {undecided!r}")
    columns = list(columns)
    if not columns:
        return df
    chosen = column_formats(df, columns, patterns, by)
    groups = shapes(patterns)
    if by is None:
        rows = chosen.collect()  # one row per column and shape
        if undecided == "raise":
            _refuse(df.sparkSession.createDataFrame(rows, chosen.schema))
        picked = {(r["column"], r["shape"]): r["pattern"] for r in rows}
        return df.withColumns({c: F.coalesce(_iso(cell_text(c)), *[
            _parsed(cell_text(c), picked.get((c, s), members[0])) for s, members in groups.items()]) for c in columns})
    if undecided == "raise":
        _refuse(chosen)
    name = "_formats"
    while name in df.columns:
        name += "_"
    table = chosen.groupBy("source").agg(F.map_from_entries(F.collect_list(F.struct(
        F.concat_ws("|", "column", "shape"), "pattern"))).alias(name)).withColumnRenamed("source", f"{name}of")
    joined = df.join(table, df[f"`{by}`"].cast("string").eqNullSafe(table[f"{name}of"]), "left")

    def read(c: str) -> Column:
        forms = []
        for s, members in groups.items():
            used = F.get(F.array(F.element_at(name, F.lit(f"{c}|{s}"))), F.lit(0))
            whens = [F.when(used == p, _parsed(cell_text(c), p)) for p in members]
            forms.append(F.coalesce(*whens) if len(members) > 1 else _parsed(cell_text(c), members[0]))
        return F.coalesce(_iso(cell_text(c)), *forms)

    dates = joined.withColumns({c: read(c) for c in columns})
    return dates.select(*[F.col(f"`{c}`") for c in df.columns])


def lost_cells(before: DataFrame, after: DataFrame, columns) -> DataFrame:
    """column, filled and lost: the non-empty cells, and those that typing made null, of the same rows before and after. Two
    partial aggregates, joined on the column's name."""
    def filled(df: DataFrame, text: bool, name: str) -> DataFrame:
        counts = df.agg(*[F.count(cell_text(c) if text else F.col(f"`{c}`")).alias(f"c{i}") for i, c in enumerate(columns)])
        return counts.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"c{i}").alias(name))
                                                 for i, c in enumerate(columns)])).alias("x")).select("x.*")

    return filled(before, True, "filled").join(filled(after, False, "typed"), "column").select(
        "column", "filled", (F.col("filled") - F.col("typed")).alias("lost"))
