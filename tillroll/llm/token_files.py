"""Operator 10: token ids in Simple-8b words, written to binary files in document order and read back.

A 64-bit word holds a selector in its top four bits and that selector's count of ids, each in the same number of bits,
from the low end. Ids of 30 bits and more fit no shared word: the escape selector stores one of them raw. Ids are coded
in blocks of BLOCK_IDS, every block starts a new word, and the file keeps each block's word offset, so that any block
can be decoded alone and a run of blocks with numpy, selector by selector.

File: MAGIC; words (unsigned 64-bit, little endian); block offsets in words (blocks + 1); per document: doc_id, whether
it is null, its number of ids; then a trailer of five integers (words, blocks, ids, documents, BLOCK_IDS) and MAGIC.

Defined results: a null or empty text has the end id alone; null doc_ids stand first; equal doc_ids and repeated rows are
documents of their own, ordered by text; an empty table gives an empty result; other columns are ignored."""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common as C
from . import tokens as T

MAGIC = b"S8BTOKN1"
BLOCK_IDS = 512
#: Fixed values: (ids in a word, bits of each) of the selectors, in order. The last is the escape for one wide id.
PACKINGS = ((60, 1), (30, 2), (20, 3), (15, 4), (12, 5), (10, 6), (8, 7), (7, 8), (6, 10), (5, 12), (4, 15), (3, 20),
            (2, 30), (1, 60))
COUNT = np.array([n for n, _ in PACKINGS], np.int64)
WIDTH = np.array([w for _, w in PACKINGS], np.uint64)
_BITS16 = np.array([int(i).bit_length() for i in range(1 << 16)], np.uint8)


def _bits(ids: np.ndarray) -> np.ndarray:
    high = ids >> np.uint32(16)
    return np.where(high > 0, _BITS16[high] + np.uint8(16), _BITS16[ids & np.uint32(0xFFFF)])


def encode_blocks(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(words, words of each block) of unsigned 32-bit ids; every block but the last holds BLOCK_IDS ids.

    The longest packing that fits is found for every position at once; then all blocks step through their words
    together."""
    n = len(ids)
    if n == 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    blocks, reach = -(-n // BLOCK_IDS), int(COUNT[0])
    padded = np.zeros((blocks, BLOCK_IDS + reach), np.uint32)  # ids past a block count as zeros
    full = np.zeros(blocks * BLOCK_IDS, np.uint32)
    full[:n] = ids
    padded[:, :BLOCK_IDS] = full.reshape(blocks, BLOCK_IDS)
    widest = _bits(padded)
    best = np.full((blocks, BLOCK_IDS), len(PACKINGS) - 1, np.uint8)
    span, length = widest.copy(), 1  # span[i]: most bits among the `length` ids from i
    for selector in range(len(PACKINGS) - 2, -1, -1):
        count, width = PACKINGS[selector]
        while length < count:
            step = min(length, count - length)
            span[:, :-step] = np.maximum(span[:, :-step], span[:, step:])
            length += step
        best[span[:, :BLOCK_IDS] <= width] = selector
    size = np.full(blocks, BLOCK_IDS, np.int64)
    size[-1] = n - (blocks - 1) * BLOCK_IDS
    at, lane = np.zeros(blocks, np.int64), np.arange(blocks)
    lanes, places, chosen = [], [], []
    while len(lane):
        s = best[lane, at[lane]]
        lanes.append(lane), places.append(at[lane]), chosen.append(s)
        at[lane] += COUNT[s]
        lane = lane[at[lane] < size[lane]]
    order = np.concatenate([np.full(len(x), i) for i, x in enumerate(lanes)])
    lanes, places, chosen = np.concatenate(lanes), np.concatenate(places), np.concatenate(chosen)
    per_block = np.bincount(lanes, minlength=blocks)
    target = (np.cumsum(per_block) - per_block)[lanes] + order
    words = np.zeros(len(lanes), np.uint64)
    for selector, (count, width) in enumerate(PACKINGS):
        pick = np.flatnonzero(chosen == selector)
        if len(pick):
            got = padded[lanes[pick][:, None], places[pick][:, None] + np.arange(count)].astype(np.uint64)
            packed = np.bitwise_or.reduce(got << (np.arange(count, dtype=np.uint64) * np.uint64(width)), axis=1)
            words[target[pick]] = packed | np.uint64(selector << 60)
    return words, per_block


def decode_blocks(words: np.ndarray, per_block: np.ndarray, ids: int) -> np.ndarray:
    """The ids of consecutive blocks; all but the last are full."""
    blocks = len(per_block)
    if blocks == 0:
        return np.zeros(0, np.uint32)
    selector = (words >> np.uint64(60)).astype(np.int64)
    if len(selector) and selector.max() >= len(PACKINGS):
        raise ValueError("a word has an unknown selector")
    count = COUNT[selector]
    before = np.cumsum(count) - count
    first = np.cumsum(per_block) - per_block
    row = np.repeat(np.arange(blocks), per_block)
    column = before - before[first][row]
    out = np.zeros((blocks, BLOCK_IDS + int(COUNT[0])), np.uint32)
    for s, (n, width) in enumerate(PACKINGS):
        pick = np.flatnonzero(selector == s)
        if len(pick):
            shifts = np.arange(n, dtype=np.uint64) * np.uint64(width)
            values = (words[pick][:, None] >> shifts) & np.uint64((1 << width) - 1)
            out[row[pick][:, None], column[pick][:, None] + np.arange(n)] = values.astype(np.uint32)
    return out[:, :BLOCK_IDS].reshape(-1)[:ids]


class FileWriter:
    """Writes one file; holds at most a batch of ids besides the index of its documents."""

    BATCH = BLOCK_IDS * 512

    def __init__(self, uri: str):
        self.uri, self.out = uri, C.open_output(uri)
        self.out.write(MAGIC)
        self.rest: list[np.ndarray] = []
        self.held, self.ids = 0, 0
        self.per_block: list[np.ndarray] = []
        self.doc_ids: list[int] = []
        self.nulls: list[bool] = []
        self.counts: list[int] = []

    def add_ids(self, ids: np.ndarray) -> None:
        self.rest.append(ids)
        self.held += len(ids)
        if self.held >= self.BATCH:
            self._flush(self.held // BLOCK_IDS * BLOCK_IDS)

    def end_document(self, doc_id: int | None, count: int) -> None:
        self.doc_ids.append(doc_id or 0), self.nulls.append(doc_id is None), self.counts.append(count)

    def _flush(self, n: int) -> None:
        every = np.concatenate(self.rest) if self.rest else np.zeros(0, np.uint32)
        words, per_block = encode_blocks(every[:n])
        self.out.write(words.astype("<u8").tobytes())
        self.per_block.append(per_block)
        self.rest, self.held, self.ids = [every[n:]], len(every) - n, self.ids + n

    def close(self) -> int:
        self._flush(self.held)
        per_block = np.concatenate(self.per_block)
        offsets = np.concatenate([[0], np.cumsum(per_block)])
        for part, kind in ((offsets, "<i8"), (self.doc_ids, "<i8"), (self.nulls, "<i8"), (self.counts, "<i8"),
                           ([offsets[-1], len(per_block), self.ids, len(self.counts), BLOCK_IDS], "<i8")):
            self.out.write(np.asarray(part, kind).tobytes())
        self.out.write(MAGIC)
        self.out.close()
        return self.ids


def read_file(uri: str, blocks_at_once: int = 512) -> Iterator[tuple[int | None, int, int, np.ndarray, bool]]:
    """(doc_id, its first id's place in the file, its number of ids, ids, last part) per document or part of one."""
    with C.open_input(uri) as f:
        size = f.size()
        tail = 8 * 5 + len(MAGIC)
        end = f.read_at(tail, size - tail)
        if end[-len(MAGIC):] != MAGIC or f.read_at(len(MAGIC), 0) != MAGIC:
            raise ValueError(f"{uri} is not a complete token file")
        n_words, n_blocks, n_ids, n_docs, block_ids = np.frombuffer(end[:40], "<i8").tolist()
        if block_ids != BLOCK_IDS:
            raise ValueError(f"{uri} has blocks of {block_ids} ids")
        at = len(MAGIC) + 8 * n_words
        index = np.frombuffer(f.read_at(8 * (n_blocks + 1 + 3 * n_docs), at), "<i8")
        offsets, doc_ids, nulls, counts = np.split(index, [n_blocks + 1, n_blocks + 1 + n_docs, n_blocks + 1 + 2 * n_docs])
        bounds = np.concatenate([[0], np.cumsum(counts)])
        doc = 0
        for b in range(0, n_blocks, blocks_at_once):
            e = min(n_blocks, b + blocks_at_once)
            words = np.frombuffer(f.read_at(8 * int(offsets[e] - offsets[b]), len(MAGIC) + 8 * int(offsets[b])), "<u8")
            low, high = b * BLOCK_IDS, min(n_ids, e * BLOCK_IDS)
            ids = decode_blocks(words, np.diff(offsets[b:e + 1]), high - low)
            while doc < n_docs and bounds[doc] < high:
                start, stop = int(bounds[doc]), int(bounds[doc + 1])
                part = ids[max(start, low) - low:min(stop, high) - low]
                yield None if nulls[doc] else int(doc_ids[doc]), start, stop - start, part, stop <= high
                if stop > high:
                    break
                doc += 1


def write_token_files(documents: DataFrame, folder: str, *, tokenizer: str, end_id: int = 2,
                      files: int | None = None) -> DataFrame:
    """Write the ids of every text, each followed by `end_id`, as files of ascending doc_id ranges under `folder` (a URI
    that all executors reach). Returns the manifest (bucket, file, documents, ids, first_id), one row per file: `first_id`
    is the place of a file's first id among the ids of all files. Runs the encoding once; the manifest is a written
    table, and a file that a lost task left behind is in no manifest."""
    spark = documents.sparkSession
    files = files or C.shuffle_partitions(spark)
    rows = C.text_rows(documents, "doc_id", "text")
    bucket, n = C.range_bucket(rows, "doc_id", files)
    placed = rows.withColumn("bucket", bucket.cast("int")).repartitionById(n, F.col("bucket"))
    placed = placed.sortWithinPartitions("bucket", F.col("doc_id").asc_nulls_first(), F.col("text").asc_nulls_first())

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, out, current, done = T.encoder(tokenizer), None, None, []
        end = np.array([end_id], np.uint32)

        def close():
            done.append((current, out.uri, len(out.counts), out.close()))

        for batch in batches:
            body, offsets = C.utf8_column(batch.column(1))
            ids, buckets, count = batch.column(0).to_pylist(), batch.column(2).to_pylist(), 0
            for row, last, part in coder.encode_rows(body, offsets):
                if buckets[row] != current:
                    if out is not None:
                        close()
                    current = buckets[row]
                    out = FileWriter(f"{folder}/{current:08d}-{uuid.uuid4().hex}.s8b")
                out.add_ids(part)
                count += len(part)
                if last:
                    out.add_ids(end)
                    out.end_document(ids[row], count + 1)
                    count = 0
        if out is not None:
            close()
        yield pa.RecordBatch.from_arrays(
            [pa.array([d[i] for d in done], t) for i, t in enumerate((pa.int32(), pa.string(), pa.int64(), pa.int64()))],
            names=["bucket", "file", "documents", "ids"])

    manifest = C.written(placed.mapInArrow(write, "bucket int, file string, documents long, ids long"), "token-files")
    # one row per file, so that one task numbers them all
    before = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    return manifest.withColumn("first_id", F.coalesce(F.sum("ids").over(before), F.lit(0)))


def read_token_files(manifest: DataFrame) -> DataFrame:
    """One row per document from the files: doc_id, start, n_tokens and ids_crc32 (as unsigned 32-bit little-endian)."""
    spark = manifest.sparkSession

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri, first in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                rows, crc = [], 0
                for doc_id, start, count, ids, last in read_file(uri):
                    crc = zlib.crc32(np.ascontiguousarray(ids, "<u4"), crc)
                    if last:
                        rows.append((doc_id, first + start, count, crc))
                        crc = 0
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.int64()) for i in range(4)],
                                                 names=["doc_id", "start", "n_tokens", "ids_crc32"])

    files = manifest.select("file", "first_id").repartition(C.shuffle_partitions(spark))
    return files.mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_files(documents: DataFrame, *, tokenizer: str | None = None, end_id: int = 2) -> DataFrame:
    """Write the files into the shared folder and read them back."""
    folder = C.scratch_path(documents.sparkSession, "token-files-data")
    return read_token_files(write_token_files(documents, folder, tokenizer=tokenizer or T.default_path(), end_id=end_id))
