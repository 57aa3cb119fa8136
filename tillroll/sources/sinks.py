"""Report sinks (IO12-IO15).

The reference writes CSV files on a laptop and pastes frames into spreadsheet tabs. Here every sink is a distributed
`DataFrameWriter` call: a report is a directory (or table) named after the report.

A named report is replaced without a moment in which it is missing: every write goes to a folder of its own, and only after it
has succeeded a row naming that folder is appended to the report's list of versions, which Spark's committer makes visible
as one file. Readers take the last version of that list. A write that fails, or is still running, has no row there, so that
the report before it stays the report.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, TimestampNTZType, TimestampType

from tillroll.operators.ordering import positions
from tillroll.session import cut_lineage


#: Most rows of a report that is written as one file.
SINGLE_FILE_ROWS = 1_000_000


def write_csv(df: DataFrame, path: str, single_file: bool = False) -> None:
    """IO12: header CSV without an index column. `single_file` gathers a small hand-off report into one part after its
    (still parallel) last stage; one of more than SINGLE_FILE_ROWS rows is refused, as one task would write it."""
    if single_file and df.limit(SINGLE_FILE_ROWS + 1).count() > SINGLE_FILE_ROWS:
        raise ValueError(f"more than {SINGLE_FILE_ROWS} rows for a single file")
    out = df.repartition(1) if single_file else df
    out.write.mode("overwrite").option("header", True).csv(path)


def sheet_rows(df: DataFrame) -> DataFrame:
    """IO13: every cell as text, dates as yyyy-MM-dd, nulls as '' (the spreadsheet hand-off shape). The header is the
    DataFrame's column list; `sheet_lines` has it as a row, and the rows in order."""
    return df.select(*_cells(df))


def _cells(df: DataFrame) -> list:
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (DateType, TimestampType, TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd")
        cols.append(F.coalesce(c.cast("string"), F.lit("")).alias(f.name))
    return cols


def sheet_lines(df: DataFrame, order: list, line: str = "line") -> DataFrame:
    """IO13 + O5 (the hand-off of a sheet): the header as line 0, whose cells are the column names, then the rows by `order`
    as lines 1, 2, ..., every cell as in `sheet_rows`. Line numbers come from a range sort (operators.ordering), so that no task
    holds the sheet; the lines may be written in parallel and are put in order by their number. Runs the sorting job."""
    if line in df.columns:
        raise ValueError(f"the report has a column {line!r}; pass another name for the line numbers")
    placed = positions(cut_lineage(df), order, name=line)
    body = placed.select((F.col(line) + 1).alias(line), *_cells(df))
    header = df.sparkSession.range(1).select(F.lit(0).cast("long").alias(line), *[F.lit(c).alias(c) for c in df.columns])
    return header.unionByName(body)


#: A report's list of versions: one row per version that was written as a whole.
VERSIONS = "version long, folder string, format string"


def _home(base: str, name: str) -> str:
    return f"{base.rstrip('/')}/{name.replace(' ', '_')}"


def report_versions(spark: SparkSession, base: str, name: str) -> DataFrame:
    """The versions of a named report (none if it was never written)."""
    try:
        return spark.read.schema(VERSIONS).parquet(f"{_home(base, name)}/versions")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], VERSIONS)


def _last_version(spark: SparkSession, base: str, name: str):
    # the folder's name decides between two writers that took the same number
    return report_versions(spark, base, name).agg(F.max(F.struct("version", "folder", "format")).alias("v")).first()["v"]


def replace_report(df: DataFrame, base: str, name: str, fmt: str = "parquet") -> str:
    """IO14: replace the named report if it exists, create it otherwise; returns the folder of the new version. The report may be
    computed from its own last version. Earlier versions stay, readable
    by their folders in `report_versions`."""
    spark = df.sparkSession
    last = _last_version(spark, base, name)
    folder = f"data-{uuid.uuid4().hex}"
    df.write.format(fmt).option("header", True).save(f"{_home(base, name)}/{folder}")
    row = spark.createDataFrame([((last["version"] if last else 0) + 1, folder, fmt)], VERSIONS)
    row.coalesce(1).write.mode("append").parquet(f"{_home(base, name)}/versions")
    return f"{_home(base, name)}/{folder}"


def read_report(spark: SparkSession, base: str, name: str) -> DataFrame:
    """The named report as it was last written as a whole."""
    last = _last_version(spark, base, name)
    if last is None:
        raise FileNotFoundError(f"no report named {name!r} in {base}")
    return spark.read.format(last["format"]).option("header", True).load(f"{_home(base, name)}/{last['folder']}")


def replace_report_table(df: DataFrame, table: str) -> None:
    """IO14 against a catalog: create or replace the report table."""
    df.write.mode("overwrite").saveAsTable(table)


def preview(df: DataFrame, n: int = 5) -> DataFrame:
    """IO15/O8: the first rows of a report (a limit is the feature here)."""
    return df.limit(n)
