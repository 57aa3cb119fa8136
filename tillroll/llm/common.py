"""Shared helpers of the training-data operators: written intermediates, file access from tasks, Arrow text access."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

#: Bytes of text that one numpy pass works on inside a task; longer Arrow batches are cut into runs of rows.
BLOCK_BYTES = 4 << 20

#: Words of the text operators: runs of ASCII letters and digits and of all other characters from U+0080.
WORD_CLASS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new folder below the shared folder that the session names in spark.checkpoint.dir."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    if root.startswith("file:/") and not root.startswith("file://"):
        root = "file://" + root[len("file:"):]
    return f"{root}/llm/{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str) -> DataFrame:
    """Write `df` as a Parquet table in the shared folder and read it back: the lineage ends there, later readers prune
    columns, and the loss of an executor costs no recomputation. Runs one job."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def open_output(uri: str):
    """A writable stream for a URI of the shared folder, usable inside a task."""
    fs, path = _fs(uri)
    fs.create_dir(path.rsplit("/", 1)[0], recursive=True)
    return fs.open_output_stream(path, compression=None)


def open_input(uri: str):
    """A readable, seekable file for a URI of the shared folder, usable inside a task."""
    fs, path = _fs(uri)
    return fs.open_input_file(path)


def _fs(uri: str):
    from pyarrow import fs

    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri[len("file:"):]
    return fs.FileSystem.from_uri(uri)


def shuffle_partitions(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def range_bucket(df: DataFrame, column: str, buckets: int) -> tuple[Column, int]:
    """An expression numbering `buckets` ranges of an integer column that hold about equally many rows, and how many
    ranges there are. Only the bounds (at most one per range) reach the driver. Nulls are in range 0; equal values
    share a range. The expression is a binary search over the bounds."""
    bounds: list[int] = []
    if buckets > 1:
        probs = [i / buckets for i in range(1, buckets)]
        error = min(0.01, 1 / (8 * buckets))
        found = df.select(F.col(column).cast("double").alias("v")).where("v is not null").approxQuantile("v", probs, error)
        bounds = sorted({int(x) for x in found})
    if not bounds:
        return F.lit(0), 1
    steps, step = [], 1
    while step <= len(bounds):
        steps.append(step)
        step *= 2
    table = F.array(*[F.lit(b).cast("long") for b in bounds])
    value = F.col(column).cast("long")
    place = F.aggregate(
        F.array(*[F.lit(s) for s in reversed(steps)]), F.lit(0),
        lambda at, s: F.when((at + s <= len(bounds)) & (F.get(table, at + s - 1) <= value), at + s).otherwise(at))
    return F.coalesce(place, F.lit(0)), len(bounds) + 1


def utf8_column(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes as uint8, row offsets as int64) of an Arrow string or binary column without a copy; null rows are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offs, data = column.buffers()
    offsets = np.frombuffer(offs, np.int64 if wide else np.int32)[column.offset:column.offset + n + 1].astype(np.int64)
    body = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return body[offsets[0]:offsets[-1]], offsets - offsets[0]


def row_runs(offsets: np.ndarray, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Consecutive runs (first row, end row) of rows with at most `limit` bytes together; a longer row is a run alone."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


#: Byte -> lower-cased word byte, or 0 for a byte that separates words (WORD_CLASS, A-Z lower-cased first).
WORD_BYTES = np.zeros(256, np.uint8)
WORD_BYTES[0x30:0x3A] = np.arange(0x30, 0x3A)
WORD_BYTES[0x41:0x5B] = np.arange(0x61, 0x7B)
WORD_BYTES[0x61:0x7B] = np.arange(0x61, 0x7B)
WORD_BYTES[0x80:] = np.arange(0x80, 0x100)


def word_spans(body: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(mapped bytes, word starts, word ends, first word of each row plus the total) of concatenated texts; a word never
    crosses a row bound."""
    mapped = WORD_BYTES[body]
    inside = mapped != 0
    before = np.empty_like(inside)
    before[:1] = False
    before[1:] = inside[:-1]
    cuts = offsets[:-1][offsets[:-1] < len(body)]
    before[cuts] = False
    starts = np.flatnonzero(inside & ~before)
    after = np.empty_like(inside)
    after[-1:] = False
    after[:-1] = inside[1:]
    last = offsets[1:][offsets[1:] > 0] - 1
    after[last] = False
    ends = np.flatnonzero(inside & ~after) + 1
    return mapped, starts, ends, np.searchsorted(starts, offsets)


def text_rows(df: DataFrame, *columns: str) -> DataFrame:
    """Only the needed columns, so that columns of other names cannot clash with those an operator adds."""
    return df.select(*[F.col(f"`{c}`") for c in columns])


_RANDOM = np.random.default_rng(20240607)
#: A random 64-bit value for each byte, for polynomial hashes modulo 2^64, and another one for order-free sums.
BYTE_VALUES = _RANDOM.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
BYTE_SUMS = _RANDOM.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15 | 1
_POWERS: dict[str, np.ndarray] = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS["up"]) < n:
        size = 1 << int(n - 1).bit_length()
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            p = np.full(size, base, np.uint64)
            p[0] = 1
            _POWERS[name] = np.multiply.accumulate(p)
    return _POWERS["up"][:n], _POWERS["down"]


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser of 64-bit values."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def span_hashes(mapped: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte spans [start, end), equal for equal bytes wherever they stand. One prefix sum serves
    all spans: sum(value(byte) * base^i) over a span, divided by base^start modulo 2^64."""
    if len(starts) == 0:
        return np.zeros(0, np.uint64)
    up, down = _powers(len(mapped) + 1)
    total = np.zeros(len(mapped) + 1, np.uint64)
    np.cumsum(BYTE_VALUES[mapped] * up[:len(mapped)], out=total[1:])
    return mix64((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def span_sums(mapped: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A second 64-bit value of each span, independent of span_hashes."""
    total = np.zeros(len(mapped) + 1, np.uint64)
    np.cumsum(BYTE_SUMS[mapped], out=total[1:])
    return total[ends] - total[starts]
