"""Operator 7: shards by k-d tree partitioning under the law `bytes`.

Rows of equal text weigh together as one point; its dimensions are the size of its text and the ranks of its language and
source among the distinct values, by whole values. The tree splits the heaviest leaf's points at the distributed weighted
median of the dimension in which they are spread widest, measured against that dimension's spread over all points, until every
leaf has its target weight. With a number of shards that is no power of two a split is uneven in proportion.

The median comes from histograms: each job counts the weight in BINS intervals of every open leaf's range and the next job
looks into the interval that holds the median, so that the driver sees BINS sums a leaf and no rows. Points of equal
coordinate are told apart by a hash of their text.

Points too heavy to be cut around (over POINT_SHARE of a shard; few, by their weight) are dealt to shards before the tree is
built, the heaviest first, each to the shard with most room. One that fits beside the heavier ones stays whole. One that fits
nowhere is split by hashed doc_id over the shards with most room: all of a text's rows stay in one shard unless no
shard has room for them. The tree's leaves then have what room the heavy points left as their targets, so that shards stay near
equal.

Defined results: null texts have size 1 and the coordinates of the empty text; null languages and sources sort first; null
doc_ids and repeated rows are rows of their own; an empty table gives an empty result; other columns are ignored."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.ordering import positions
from . import common as C

#: Intervals of a histogram.
BINS = 1 << 10
#: A point heavier than this share of a shard's target is dealt before the tree is built.
POINT_SHARE = 1 / 100
#: Steps in which a point that fits in no shard is split.
PARTS = 1 << 20
#: Rows that one task numbers within a shard, on the average.
SLOT_ROWS = 20_000
DIMENSIONS = ("by_size", "by_lang", "by_source")
#: Bits of a coordinate's value and of the hash that tells equal values apart.
VALUE_BITS, TIE_BITS = 40, 22


def _coordinate(value, tie):
    return F.shiftleft(F.least(value, F.lit((1 << VALUE_BITS) - 1)), TIE_BITS).bitwiseOR(tie)


def _ranked(rows: DataFrame, column: str) -> DataFrame:
    """`rows` with `<column>_rank`, the place of the column's value among its distinct ones (null first)."""
    values = C.written(rows.select(column).distinct(), f"values-{column}")
    ranks = positions(values, [F.col(column).asc_nulls_first()], name=f"{column}_rank").withColumnRenamed(column, "value")
    return rows.join(ranks, rows[column].eqNullSafe(ranks["value"]), "left").drop("value")


def deal_heavy(weights: list[int], room: list[float]) -> list[list[tuple[float, int]]]:
    """For each weight, in the given order, its parts as (share, shard): one part where a shard has room for the whole, else
    the room of the shards with most of it. `room` is reduced by what is dealt."""
    dealt = []
    for weight in weights:
        parts, left = [], float(weight)
        while True:
            shard = max(range(len(room)), key=lambda i: (room[i], -i))
            take = left if room[shard] >= left or len(parts) >= len(room) - 1 else max(room[shard], 0.0)
            if take <= 0:  # no room anywhere: rounding left a rest
                take = left
            parts.append((take / weight, shard))
            room[shard] -= take
            left -= take
            if left <= 0:
                break
        dealt.append(parts)
    return dealt


def _leaf(splits: dict[int, tuple]):
    """The number of a point's leaf: node n has the children 2n + 1 and 2n + 2."""
    def walk(node: int):
        if node not in splits:
            return F.lit(node)
        dimension, cut = splits[node]
        return F.when(F.col(dimension) < F.lit(cut), walk(2 * node + 1)).otherwise(walk(2 * node + 2))
    return walk(0)


def kd_splits(points: DataFrame, room: list[float]) -> tuple[dict[int, tuple[str, int]], dict[int, int]]:
    """(node -> (dimension, cut); leaf node -> shard) over points with a `weight` and the coordinates DIMENSIONS. `room` is the
    weight that each shard shall get."""
    splits: dict[int, tuple[str, int]] = {}
    open_leaves = {0: (0, len(room))}  # leaf -> its first shard and the one after its last
    spread: dict[str, int] = {}
    while any(b - a > 1 for a, b in open_leaves.values()):
        placed = points.withColumn("leaf", _leaf(splits))
        stats = [F.sum("weight").alias("weight")]
        for d in DIMENSIONS:
            stats += [F.min(d).alias(f"{d}_low"), F.max(d).alias(f"{d}_high")]
        found = {r["leaf"]: r for r in placed.groupBy("leaf").agg(*stats).collect()}
        ranges = {}
        for leaf, (a, b) in open_leaves.items():
            if b - a < 2:
                continue
            r = found.get(leaf)
            if r is None:  # an empty leaf splits anywhere
                splits[leaf] = (DIMENSIONS[0], 0)
                continue
            width = {d: (r[f"{d}_high"] >> TIE_BITS) - (r[f"{d}_low"] >> TIE_BITS) for d in DIMENSIONS}
            spread = spread or {d: max(1, w) for d, w in width.items()}
            d = min(DIMENSIONS, key=lambda d: (-width[d] / spread[d], DIMENSIONS.index(d)))
            lower, whole = sum(room[a:(a + b) // 2]), sum(room[a:b])
            share = lower / whole if whole > 0 else 0.5
            ranges[leaf] = [d, r[f"{d}_low"], r[f"{d}_high"] + 1, r["weight"] * share, 0, r["weight"]]
        widest = {leaf: r[0] for leaf, r in ranges.items()}
        splits |= {leaf: (widest[leaf], cut) for leaf, cut in (_weighted_quantiles(placed, ranges) if ranges else {}).items()}
        nxt = {}
        for leaf, (a, b) in open_leaves.items():
            m = (a + b) // 2
            nxt |= {leaf: (a, b)} if b - a < 2 else {2 * leaf + 1: (a, m), 2 * leaf + 2: (m, b)}
        open_leaves = nxt
    return splits, {leaf: a for leaf, (a, _) in open_leaves.items()}


def _weighted_quantiles(placed: DataFrame, ranges: dict[int, list]) -> dict[int, int]:
    """For each leaf the coordinate where the weight below comes nearest to what is wanted. ranges: leaf -> [dimension, low, high,
    wanted weight, weight below low, weight of the leaf]."""
    cuts: dict[int, int] = {}
    while len(cuts) < len(ranges):
        todo = {k: v for k, v in ranges.items() if k not in cuts}
        bins = None
        for leaf, (dimension, low, high, *_) in todo.items():
            shift = max(0, (high - low - 1).bit_length() - (BINS.bit_length() - 1))
            inside = (F.col("leaf") == leaf) & (F.col(dimension) >= low) & (F.col(dimension) < high)
            one = F.when(inside, F.shiftright(F.col(dimension) - F.lit(low), shift))
            bins = one if bins is None else F.coalesce(bins, one)
        sums: dict[int, dict[int, int]] = {k: {} for k in todo}
        for r in placed.select("leaf", "weight", bins.alias("bin")).where("bin is not null").groupBy("leaf", "bin").agg(
                F.sum("weight").alias("weight")).collect():
            if r["leaf"] in sums:
                sums[r["leaf"]][r["bin"]] = r["weight"]
        for leaf, (dimension, low, high, wanted, below, weight) in todo.items():
            shift = max(0, (high - low - 1).bit_length() - (BINS.bit_length() - 1))
            for b in sorted(sums[leaf]):
                w = sums[leaf][b]
                if below + w >= wanted or b == max(sums[leaf]):
                    a, z = low + (b << shift), min(high, low + ((b + 1) << shift))
                    break
                below += w
            if shift == 0 or w <= weight / 5000:  # one coordinate, or too light to matter: cut at its nearer end
                cuts[leaf] = min((abs(wanted - below), a), (abs(below + w - wanted), z))[1]
            else:
                ranges[leaf] = [dimension, a, z, wanted, below, weight]
    return cuts


def sharded(documents: DataFrame, *, shards: int = 8) -> DataFrame:
    """One row per document: doc_id, size, text_crc32, law ('bytes'), shard, slot and grown_shard (null under this law)."""
    raw = F.coalesce("text", F.lit(""))
    rows = C.text_rows(documents, "doc_id", "text", "lang", "source").select(
        "doc_id", "lang", "source", (F.octet_length(raw) + 1).cast("long").alias("size"),
        F.crc32(raw.cast("binary")).alias("text_crc32"), F.xxhash64(raw).alias("hash"),
        F.monotonically_increasing_id().alias("row"))
    rows = C.written(rows, "sizes")
    total, count = rows.agg(F.sum("size"), F.count("*")).first()
    text = ["hash", "text_crc32", "size"]
    rows = _ranked(_ranked(rows, "lang"), "source")
    points = C.written(rows.groupBy(*text).agg(F.sum("size").alias("weight"), F.min("lang_rank").alias("lang"),
                                               F.min("source_rank").alias("source")), "points")
    room = [(total or 0) / shards] * shards
    # at most shards / POINT_SHARE texts are this heavy, so they may be collected and broadcast
    heavy = points.where(F.col("weight") > room[0] * POINT_SHARE).select(*text, "weight").collect()
    heavy.sort(key=lambda r: (-r["weight"], r["hash"]))
    known: list[tuple] = []
    for r, parts in zip(heavy, deal_heavy([r["weight"] for r in heavy], room)):
        below, cuts = 0.0, []
        for share, shard in parts:
            below += share
            cuts.append((int(below * PARTS) if len(cuts) < len(parts) - 1 else PARTS, shard))
        known.append((r["hash"], r["text_crc32"], r["size"], cuts))
    dealt = documents.sparkSession.createDataFrame(known, "hash long, text_crc32 long, size long, cuts array<struct<upto:int,shard:int>>")
    light = points.join(F.broadcast(dealt), text, "left_anti")
    tie = F.xxhash64(*text).bitwiseAND((1 << TIE_BITS) - 1)
    light = C.written(light.select(*text, "weight", _coordinate(F.col("size"), tie).alias("by_size"), _coordinate(
        F.col("lang"), tie).alias("by_lang"), _coordinate(F.col("source"), tie).alias("by_source")), "light-points")
    splits, number = kd_splits(light, [max(0.0, x) for x in room])
    by_tree = F.element_at(F.create_map(*[F.lit(x) for pair in number.items() for x in pair]), _leaf(splits))
    rows = rows.select("doc_id", *text, "row").join(F.broadcast(dealt), text, "left")
    part = F.pmod(F.xxhash64("doc_id", "row"), F.lit(PARTS))
    by_hand = F.get(F.filter("cuts", lambda c: part < c["upto"]), F.lit(0))["shard"]
    kept = ["doc_id", "size", "text_crc32", "row", "shard"]
    # rows of heavy texts don't take part in the shuffle by text
    rows = rows.where("cuts is not null").withColumn("shard", by_hand).select(*kept).unionByName(
        rows.where("cuts is null").join(light.select(*text, by_tree.alias("shard")), text).select(*kept))
    placed = C.written(rows.withColumn(
        "bucket", F.pmod(F.xxhash64("row"), F.lit(max(1, -(-count // (shards * SLOT_ROWS)))))), "placed")
    counts = placed.groupBy("shard", "bucket").count()
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("shard", "bucket", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("start"))
    within = F.row_number().over(Window.partitionBy("shard", "bucket").orderBy("row"))
    return placed.withColumn("nth", within).join(starts, ["shard", "bucket"]).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("start") + F.col("nth") - 1).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
