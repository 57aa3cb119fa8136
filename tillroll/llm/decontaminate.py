"""Operator 6: benchmark decontamination by Wu-Manber multi-pattern search.

The patterns are the benchmark's windows of consecutive words, joined by single spaces; a text is brought to the same
form (lower-cased words, single spaces) block by block. Patterns are grouped by length, because the shortest pattern of
a group bounds its shifts. A group's shift table tells, from the BLOCK bytes at the end of the shortest pattern's place,
how far no pattern can end; where it says 0, the bucket of patterns with that suffix hash is compared directly, and a
match counts if it begins and ends at word bounds. Many positions, one in each stretch of text, step at once with numpy.

The tables are broadcast. Benchmarks whose patterns exceed TABLE_BYTES are searched in blocks of items, each in its own
pass over the texts, and the passes' results are combined per document.

Defined results: null or empty texts have no words, are hit by nothing and are not contaminated; null or wordless items
have no window; repeated items count once per item_id (null item_ids have none); repeated documents each have a row; empty
tables give empty results or no hits; other columns are ignored."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructType

from . import common as C

#: Bytes of a shift table's block (one 64-bit load), and of the texts' stretches that step together.
BLOCK = 8
STRETCH = 512
#: Most slots of a shift table.
MOST_SLOTS = 1 << 22
#: Most bytes of item texts whose patterns are broadcast at once.
TABLE_BYTES = 1 << 20
#: Text that is searched at a time.
PASS_BYTES = 1 << 19


def _words(text: str) -> list[bytes]:
    body = np.frombuffer(text.encode(), np.uint8)
    mapped, starts, ends, _ = C.word_spans(body, np.array([0, len(body)]))
    raw = mapped.tobytes()
    return [raw[a:b] for a, b in zip(starts.tolist(), ends.tolist())]


def item_windows(text: str | None, width: int) -> list[bytes]:
    """The windows of an item: `width` consecutive words, or all of fewer, joined by spaces."""
    words = _words(text or "")
    if not words:
        return []
    return [b" ".join(words[i:i + width]) for i in range(max(1, len(words) - width + 1))]


class Group:
    """The Wu-Manber tables of patterns of similar length; `least` is the length of the shortest. The shift table has
    several slots for each block that the patterns hold (up to MOST_SLOTS), so that blocks of other texts mostly find
    the longest shift."""

    def __init__(self, patterns: list[tuple[bytes, int]]):
        self.least = min(len(p) for p, _ in patterns)
        self.block = BLOCK if self.least >= 2 * BLOCK else 1 + self.least // 3
        longest = self.least - self.block + 1
        slots = min(MOST_SLOTS, max(1 << 10, 8 * longest * len(patterns)))
        self.drop = np.uint64(64 - (slots - 1).bit_length())
        slots = 1 << (64 - int(self.drop))
        self.shift = np.full(slots, longest, np.int32)
        heads = np.frombuffer(b"".join(p[:self.least] for p, _ in patterns), np.uint8)
        first = np.arange(len(patterns)) * self.least
        for end in range(self.block, self.least + 1):
            np.minimum.at(self.shift, self.hash(heads, first + end), self.least - end)
        # the bucket of a suffix hash: a run of patterns in the order of their hashes
        h = self.hash(heads, first + self.least)
        order = np.argsort(h, kind="stable")
        self.patterns = [patterns[i] for i in order]
        self.suffixes = h[order]

    def hash(self, text: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The table slot of the block of bytes before each end."""
        if self.block == 8:
            x = np.ndarray(len(text) - 7, "<u8", text, strides=(1,))[ends - 8]
        else:
            x = np.zeros(len(ends), np.uint64)
            for k in range(self.block):
                x = x * np.uint64(257) + text[ends - self.block + k]
        x = (x ^ (x >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15)
        return (x >> self.drop).astype(np.int64)

    def bucket(self, slot: int) -> list[tuple[bytes, int]]:
        a, b = np.searchsorted(self.suffixes, [slot, slot + 1])
        return self.patterns[a:b]


class Searcher:
    """All windows of some items; a window's number stands for the items that have it."""

    def __init__(self, items: list[tuple[int, str]], width: int):
        owners: dict[bytes, set[int]] = {}
        for item, text in items:
            for window in item_windows(text, width):
                owners.setdefault(window, set()).add(item)
        windows = sorted(owners)
        self.items = [sorted(owners[w]) for w in windows]
        self.words = np.array([w.count(b" ") + 1 for w in windows], np.int64)
        by_size: dict[int, list[tuple[bytes, int]]] = {}
        for number, w in enumerate(windows):
            by_size.setdefault(len(w).bit_length() if len(w) < 32 else 6, []).append((w, number))
        self.groups = [Group(p) for _, p in sorted(by_size.items())]

    def find(self, text: np.ndarray) -> list[tuple[int, int]]:
        """(first byte, window number) of each occurrence in a normalised text, whose words are enclosed by spaces."""
        found: list[tuple[int, int]] = []
        raw = text.tobytes()
        for g in self.groups:
            if len(text) < max(g.least, 8):
                text = np.concatenate([text, np.zeros(max(g.least, 8) - len(text), np.uint8)])
            at = np.arange(g.least, len(text) + 1, STRETCH)  # ends of the shortest pattern's place
            stop = np.minimum(at + STRETCH, len(text) + 1)
            while len(at):
                slot = g.hash(text, at)
                shift = g.shift[slot]
                hit = np.flatnonzero(shift == 0)
                for end, b in zip(at[hit].tolist(), slot[hit].tolist()):
                    begin = end - g.least
                    if begin and raw[begin - 1] not in b" \0":
                        continue
                    for pattern, number in g.bucket(b):
                        if raw.startswith(pattern, begin) and raw[begin + len(pattern)] == 0x20:
                            found.append((begin, number))
                at = at + np.maximum(shift, 1)
                on = at < stop
                at, stop = at[on], stop[on]
        return found


def normalised(body: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, first byte of each row in it, words of each row): the words of every row, each followed by one space, and a
    zero byte after each row, which no pattern has."""
    mapped, starts, ends, first = C.word_spans(body, offsets)
    rows = len(offsets) - 1
    length = ends - starts
    row = np.repeat(np.arange(rows), np.diff(first))
    place = np.cumsum(length + 1) - (length + 1) + row  # a space after each word, a zero after each row before
    out = np.zeros(int((length + 1).sum()) + rows, np.uint8)
    keep = np.flatnonzero(mapped) if len(mapped) else np.zeros(0, np.int64)
    out[np.arange(len(keep)) + np.repeat(place - (np.cumsum(length) - length), length)] = mapped[keep]
    out[place + length] = 0x20
    size = np.bincount(row, weights=length + 1, minlength=rows).astype(np.int64) + 1 if rows else np.zeros(0, np.int64)
    return out, np.cumsum(size) - size, np.diff(first)


def _hits(searcher: Searcher, body: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, list, list]:
    """Per row: number of words, merged hit spans [(first word, end word)], sorted items."""
    text, begin, words = normalised(body, offsets)
    rows = len(words)
    spans: list[list] = [[] for _ in range(rows)]
    items: list[set] = [set() for _ in range(rows)]
    found = searcher.find(text)
    if found:
        at = np.array([f[0] for f in found], np.int64)
        row = np.searchsorted(begin, at, "right") - 1
        spaces = np.flatnonzero(text == 0x20)
        word = np.searchsorted(spaces, at) - np.searchsorted(spaces, begin[row])
        for (_, number), r, w in zip(found, row.tolist(), word.tolist()):
            spans[r].append((w, w + int(searcher.words[number])))
            items[r].update(searcher.items[number])
    return words, [_merged(s) for s in spans], [sorted(i) for i in items]


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def item_blocks(benchmark: DataFrame, width: int) -> Iterator[list[tuple[int, str]]]:
    """The items in blocks of about TABLE_BYTES of text, streamed through the driver; a longer item is cut into parts that
    overlap by a window less one word."""
    rows = C.text_rows(benchmark, "item_id", "text").where("item_id is not null and text is not null").distinct()
    block, held = [], 0
    for r in rows.orderBy("item_id", "text").toLocalIterator():
        parts = [r["text"]]
        if len(r["text"]) > TABLE_BYTES:
            words = _words(r["text"])
            step = max(width, TABLE_BYTES // 16)
            parts = [b" ".join(words[i:i + step + width - 1]).decode() for i in range(0, max(1, len(words) - width + 1), step)]
        for part in parts:
            if block and held + len(part) > TABLE_BYTES:
                yield block
                block, held = [], 0
            block.append((r["item_id"], part))
            held += len(part)
    if block:
        yield block


def _row_id(documents: DataFrame) -> tuple[DataFrame, str]:
    name = "row_number"
    while name in documents.columns:
        name += "_"
    return C.written(documents.withColumn(name, F.monotonically_increasing_id()), "texts"), name


def _search(documents: DataFrame, searcher, *columns: str) -> DataFrame:
    """`columns` of the documents and each text's n_words, merged spans of hit words and items."""
    rows = documents.select("text", *[F.col(f"`{c}`") for c in columns])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())]))
        for batch in batches:
            body, offsets = C.utf8_column(batch.column(0))
            for a, b in C.row_runs(offsets, PASS_BYTES):
                words, spans, items = _hits(searcher.value, body[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a])
                yield pa.RecordBatch.from_arrays(
                    [*[c.slice(a, b - a) for c in batch.columns[1:]], pa.array(words, pa.int64()),
                     pa.array([[{"a": x, "b": y} for x, y in s] for s in spans], kind),
                     pa.array(items, pa.list_(pa.int64()))], names=[*columns, "n_words", "spans", "items"])

    span = ArrayType(StructType().add("a", LongType()).add("b", LongType()))
    schema = rows.drop("text").schema.add("n_words", LongType()).add("spans", span).add("items", ArrayType(LongType()))
    return rows.mapInArrow(search, schema)


def _search_all(documents: DataFrame, blocks: Iterator[list[tuple[int, str]]], width: int, row: str) -> DataFrame:
    """_search for each block of items, united per row: `row` (unique), n_words, spans, items."""
    sc, parts = documents.sparkSession.sparkContext, None
    for block in blocks:
        part = C.written(_search(documents, sc.broadcast(Searcher(block, width)), row), "hits")
        parts = part if parts is None else parts.unionByName(part)
    merged = F.aggregate("spans", F.array().cast("array<struct<a:long,b:long>>"), lambda out, s: F.when(
        (F.size(out) > 0) & (F.element_at(out, -1)["b"] >= s["a"]),
        F.concat(F.slice(out, 1, F.size(out) - 1), F.array(F.struct(
            F.element_at(out, -1)["a"].alias("a"), F.greatest(F.element_at(out, -1)["b"], s["b"]).alias("b"))))
    ).otherwise(F.concat(out, F.array(s))))
    return parts.groupBy(row).agg(
        F.max("n_words").alias("n_words"), F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items")).withColumn("spans", merged)


def _n_hit():
    return F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["b"] - s["a"])


def report(documents: DataFrame, benchmark: DataFrame, *, width: int = 13, share: int = 20) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated (n_hit * share >= n_words, and
    n_hit > 0)."""
    rows = C.text_rows(documents, "doc_id", "text")
    blocks = item_blocks(benchmark, width)
    first, second = next(blocks, []), next(blocks, None)
    if second is None:
        found = _search(rows, rows.sparkSession.sparkContext.broadcast(Searcher(first, width)), "doc_id")
    else:
        rows, row = _row_id(rows)
        found = rows.select("doc_id", row).join(_search_all(rows, chain([first, second], blocks), width, row), row)
    names = F.array_join(F.array_sort(F.transform("items", lambda i: i.cast("string"))), ",")
    return found.select("doc_id", "n_words", _n_hit().alias("n_hit"), F.size("items").cast("long").alias("n_items"),
                        F.sha2(names.cast("binary"), 256).alias("items_sha256")).withColumn(
        "contaminated", (F.col("n_hit") > 0) & (F.col("n_hit") * share >= F.col("n_words")))


def uncontaminated(documents: DataFrame, benchmark: DataFrame, *, width: int = 13, share: int = 20) -> DataFrame:
    """The documents, with all their columns, that the benchmark does not contaminate."""
    blocks = item_blocks(benchmark, width)
    first, second = next(blocks, []), next(blocks, None)
    if second is not None:
        rows, row = _row_id(documents)
        found = _search_all(rows, chain([first, second], blocks), width, row)
        clean = found.where((_n_hit() == 0) | (_n_hit() * share < F.col("n_words")))
        return rows.join(clean.select(row), row, "left_semi").drop(row)
    searcher = documents.sparkSession.sparkContext.broadcast(Searcher(first, width))
    at = documents.columns.index("text")

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            body, offsets = C.utf8_column(batch.column(at))
            for a, b in C.row_runs(offsets, PASS_BYTES):
                words, spans, _ = _hits(searcher.value, body[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a])
                hit = np.array([sum(y - x for x, y in s) for s in spans], np.int64)
                yield batch.slice(a, b - a).filter(pa.array((hit == 0) | (hit * share < words)))

    return documents.mapInArrow(keep, documents.schema)
