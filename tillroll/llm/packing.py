"""Operator 2: best-fit packing of tokenised documents into sequences, improved by swap-based local search.

Documents become pieces of at most `capacity` tokens. Pieces of a whole capacity fill a sequence alone. The others are
dealt evenly over groups of bounded size; each group is packed by best fit decreasing and then improved: documents are
moved, exchanged one for one or two for one between underfull bins whenever the sum of squared fills grows, until bins
run empty or nothing improves. The emptiest bins of all groups are opened again and packed together in a second round,
so that a group's last, half-empty bin does not cost a sequence.

Defined results: a null or empty text is the end id alone; repeated rows and equal doc_ids are documents of their own;
an empty table gives an empty result; other columns are ignored."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C
from . import tokens as T

#: Pieces of a group, on the average: what one task packs at once. The search of a group whose sizes leave all bins underfull
#: grows with the square of it.
GROUP_PIECES = 5_000
#: The emptiest bins of each group that are packed again with those of other groups.
REOPENED_BINS = 8
#: Groups whose reopened bins meet in one task of the second round.
REOPENED_GROUPS = 200


class Bins:
    """Bins of a capacity, indexed by free space: a bit set of the free spaces in use makes best fit one shift."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.items: list[list[int]] = []
        self.free: list[int] = []
        self.by_free: list[set[int]] = [set() for _ in range(capacity + 1)]
        self.used = 0

    def hide(self, b: int) -> None:
        same = self.by_free[self.free[b]]
        same.discard(b)
        if not same:
            self.used &= ~(1 << self.free[b])

    def show(self, b: int) -> None:
        self.by_free[self.free[b]].add(b)
        self.used |= 1 << self.free[b]

    def _set_free(self, b: int, free: int) -> None:
        self.hide(b)
        self.free[b] = free
        self.show(b)

    def new(self) -> int:
        self.items.append([])
        self.free.append(self.capacity)
        self.show(len(self.items) - 1)
        return len(self.items) - 1

    def tightest(self, size: int) -> int | None:
        """A bin with the least free space that holds `size` more."""
        fits = self.used >> size
        return min(self.by_free[size + (fits & -fits).bit_length() - 1]) if fits else None

    def put(self, b: int, item: int, size: int) -> None:
        self.items[b].append(item)
        self._set_free(b, self.free[b] - size)

    def take(self, b: int, item: int, size: int) -> None:
        self.items[b].remove(item)
        self._set_free(b, self.free[b] + size)

    def drop(self, b: int) -> None:
        self.hide(b)
        self.items[b] = []


def _best_fit(sizes: list[int], capacity: int) -> Bins:
    bins = Bins(capacity)
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        b = bins.tightest(sizes[i])
        bins.put(bins.new() if b is None else b, i, sizes[i])
    return bins


class Partners:
    """The items of all underfull bins by their bin's free space and their size. `sizes_at[f]` is a bit set of the sizes in
    bins with f free, `reach[f]` one of the sizes that can be put in for one of these."""

    def __init__(self, bins: Bins, sizes: list[int]):
        self.bins, self.sizes = bins, sizes
        self.owners: dict[int, dict[int, dict[int, int]]] = {}
        self.sizes_at: dict[int, int] = {}
        self.reach: dict[int, int] = {}
        for b, items in enumerate(bins.items):
            if items:
                self.show(b)

    def show(self, b: int) -> None:
        f = self.bins.free[b]
        if f and self.bins.items[b]:
            at = self.owners.setdefault(f, {})
            for i in self.bins.items[b]:
                at.setdefault(self.sizes[i], {})[b] = i
                self.sizes_at[f] = self.sizes_at.get(f, 0) | 1 << self.sizes[i]
            self.reach.pop(f, None)

    def hide(self, b: int) -> None:
        f = self.bins.free[b]
        if f and self.bins.items[b]:
            at = self.owners[f]
            for size in {self.sizes[i] for i in self.bins.items[b]}:
                del at[size][b]
                if not at[size]:
                    del at[size]
                    self.sizes_at[f] &= ~(1 << size)
            self.reach.pop(f, None)
            if not at:
                del self.owners[f], self.sizes_at[f]

    def _reach(self, f: int) -> int:
        if f not in self.reach:
            found, width = self.sizes_at[f] << 1, 1
            while width < f:
                step = min(width, f - width)
                found |= found << step
                width += step
            self.reach[f] = found
        return self.reach[f]

    def best(self, gives: list[int], room: int) -> tuple[int, int, int] | None:
        """(bin, its item, size to give for it) in the fullest bin that one of the sizes `gives` can make fuller, with the
        largest gain there, from a bin with `room` free."""
        mask = sum(1 << s for s in gives)
        for f in sorted(self.owners):
            if mask & self._reach(f):
                # squared fills grow if the bin that gets fuller ends fuller than the other one was before
                gain, back = max(0, f - room), 0
                for given in gives:  # the smallest size that `given` may replace in a bin with f free gains most
                    low = max(given - f, 0)
                    backs = self.sizes_at[f] >> low
                    size = low + (backs & -backs).bit_length() - 1
                    if backs and (given - size > gain or given - size == gain and back and size < back):
                        gain, back = given - size, size
                if back:
                    b = min(self.owners[f][back])
                    return b, self.owners[f][back][b], back + gain
        return None


def _improve(bins: Bins, sizes: list[int], least: int) -> None:
    """Local search on the sum of squared fills: underfull bins, the emptiest first, give items to fuller ones where they
    fit, or exchange one or two of them for a smaller one, which makes the other bin fuller. Every underfull bin gives, to
    any other. It ends when `least` bins remain or no bin improves."""
    partners, changed = Partners(bins, sizes), True
    left = sum(1 for x in bins.items if x)
    while changed and left > least:
        changed = False
        for poor in sorted((b for b, x in enumerate(bins.items) if x and bins.free[b]), key=lambda b: (-bins.free[b], b)):
            while bins.items[poor] and bins.free[poor] and (
                    _give(bins, sizes, poor, partners) or _exchange(bins, sizes, poor, partners)):
                changed = True
            if not bins.items[poor]:
                bins.drop(poor)
                left -= 1
                if left <= least:
                    return


def _give(bins: Bins, sizes: list[int], poor: int, partners: Partners) -> bool:
    """Move items of `poor` into bins that are at least as full."""
    changed = False
    for item in sorted(bins.items[poor], key=lambda i: -sizes[i]):
        free = bins.free[poor]
        bins.hide(poor)  # not into itself
        to = bins.tightest(sizes[item])
        bins.show(poor)
        if to is not None and bins.free[to] <= free:
            partners.hide(poor)
            partners.hide(to)
            bins.take(poor, item, sizes[item])
            bins.put(to, item, sizes[item])
            partners.show(poor)
            partners.show(to)
            changed = True
    return changed


def _gives(own: list[int], sizes: list[int]) -> dict[int, tuple[int, ...]]:
    """The sizes of one or two of the items, each with items of that size: one where one has it."""
    by_size: dict[int, list[int]] = {}
    for i in own:
        by_size.setdefault(sizes[i], []).append(i)
    kinds = sorted(by_size)
    pairs = {a + b: (by_size[a][0], by_size[b][0]) for x, a in enumerate(kinds) for b in kinds[x + 1:]}
    pairs |= {2 * a: (by_size[a][0], by_size[a][1]) for a in kinds if len(by_size[a]) > 1}
    return pairs | {a: (by_size[a][0],) for a in kinds}


def _exchange(bins: Bins, sizes: list[int], poor: int, partners: Partners) -> bool:
    """The best exchange of one or two items of `poor` for one of a bin that this fills further, if there is one."""
    gives = _gives(bins.items[poor], sizes)
    partners.hide(poor)
    found = partners.best(list(gives), bins.free[poor])
    if found is None:
        partners.show(poor)
        return False
    rich, back, given = found
    partners.hide(rich)
    bins.take(rich, back, sizes[back])
    for i in gives[given]:
        bins.take(poor, i, sizes[i])
    for i in gives[given]:
        bins.put(rich, i, sizes[i])
    bins.put(poor, back, sizes[back])
    partners.show(rich)
    partners.show(poor)
    return True


def pack_group(sizes: list[int], capacity: int) -> list[list[int]]:
    """Bins (lists of item numbers) for items of at most `capacity` each."""
    bins = _best_fit(sizes, capacity)
    _improve(bins, sizes, -(-sum(sizes) // capacity))
    return [sorted(x) for x in bins.items if x]


def tokenized_pieces(documents: DataFrame, *, tokenizer: str, capacity: int = 4096, end_id: int = 1) -> DataFrame:
    """One row per piece: rid (unique per piece), doc_id, piece, start, length, ids_crc32."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, end = T.encoder(tokenizer), np.array([end_id], np.uint32)
        for batch in batches:
            body, offsets = C.utf8_column(batch.column(1))
            ids, rows = batch.column(0).to_pylist(), []
            held, piece = np.zeros(0, np.uint32), 0
            for row, last, part in coder.encode_rows(body, offsets):
                held = np.concatenate([held, part, end] if last else [held, part])
                while len(held) > capacity or last and len(held):
                    out, held = held[:capacity], held[capacity:]
                    rows.append((ids[row], piece, piece * capacity, len(out),
                                 zlib.crc32(np.ascontiguousarray(out, "<u4"))))
                    piece += 1
                if last:
                    piece = 0
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)],
                                             names=["doc_id", "piece", "start", "length", "ids_crc32"])

    pieces = C.text_rows(documents, "doc_id", "text").mapInArrow(
        cut, "doc_id long, piece int, start long, length long, ids_crc32 long")
    return C.written(pieces.withColumn("rid", F.monotonically_increasing_id()), "pieces")


PACKED = "rid long, doc_id long, piece int, start long, length long, ids_crc32 long, bin long, offset long"


def _placed(rows: pd.DataFrame, bins: list[list[int]]) -> pd.DataFrame:
    order = [i for b in bins for i in b]
    out = rows.iloc[order].copy()
    out["bin"] = [n for n, b in enumerate(bins) for _ in b]
    out["offset"] = out.groupby("bin")["length"].cumsum() - out["length"]
    return out


def pack(pieces: DataFrame, *, capacity: int = 4096) -> DataFrame:
    """Add sequence_id and offset to pieces (rid unique; length from 1 to capacity)."""
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    full = pieces.where(F.col("length") == capacity).select(
        *columns, (F.col("rid") * 4).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    part = pieces.where(F.col("length") < capacity)
    groups = max(1, -(-part.count() // GROUP_PIECES))
    part = part.withColumn("group", F.pmod(F.xxhash64("rid"), F.lit(groups)).cast("int"))

    def first(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("rid").reset_index(drop=True)
        bins = pack_group(rows["length"].tolist(), capacity)
        fill = [sum(rows["length"].to_numpy()[b]) for b in bins]
        poor = {n for n in sorted(range(len(bins)), key=lambda n: (fill[n], n))[:REOPENED_BINS] if fill[n] < capacity}
        if groups == 1:
            poor = set()
        bins = [b for n, b in enumerate(bins) if n not in poor] + [bins[n] for n in sorted(poor)]
        out = _placed(rows, bins)
        out["open"] = out["bin"] >= len(bins) - len(poor)
        return out

    def second(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("rid").reset_index(drop=True)
        return _placed(rows, pack_group(rows["length"].tolist(), capacity))

    one = C.written(part.groupBy("group").applyInPandas(first, f"group int, {PACKED}, open boolean"), "packed")
    again = one.where("open").withColumn("group", (F.col("group") / REOPENED_GROUPS).cast("int")).drop("open", "bin", "offset")
    two = again.groupBy("group").applyInPandas(second, f"group int, {PACKED}")
    number = (F.col("group").cast("long") * GROUP_PIECES * 2 + F.col("bin")) * 4

    def numbered(df: DataFrame, kind: int) -> DataFrame:
        return df.select(*columns, (number + kind).alias("sequence_id"), "offset")

    return full.unionByName(numbered(one.where("not open"), 1)).unionByName(numbered(two, 2))


def packed_documents(documents: DataFrame, *, tokenizer: str | None = None, capacity: int = 4096,
                     end_id: int = 1) -> DataFrame:
    return pack(tokenized_pieces(documents, tokenizer=tokenizer or T.default_path(), capacity=capacity, end_id=end_id),
                capacity=capacity)
