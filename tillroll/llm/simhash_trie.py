"""Operator 13: SimHash near duplicates by a self-join of a binary trie over the fingerprints.

A bit of a text's 64-bit fingerprint is 1 if it is set in over half the hashes (XXH64, seed 42) of the text's word shingles.
Distinct fingerprints are the leaves of a binary trie; a node is a prefix. The self-join starts with the pair (root, root) and
goes down both nodes of a pair together: (0, 0) and (1, 1) add no differing bit, (0, 1) and (1, 0) one, and a pair whose prefixes
differ in more than BUDGET bits is dropped with all that is below. Pairs of leaves are the links.

The upper part of the trie is tables: a node with more than LEAF_SIZE fingerprints is split by further bits, after those
that all its fingerprints share, until none is left (a group of similar fingerprints goes deeper), and the pairs of nodes are joined with their children level by level, pruned
in the same way. What is left are pairs of small nodes, dealt over all tasks; each task goes on bit by bit with numpy over
both nodes' sorted fingerprints, in pieces of bounded size. Distinct fingerprints have at most 1 + 64 + 2016 partners within two bits,
so that a large group of near copies cannot make all pairs. A task hands on, instead of its links, one edge per fingerprint
to the smallest one that its links connect; connected components of these edges are those of all links.

Copies are one fingerprint from the start. Nothing but loop conditions reaches the driver.

Defined results: a text without words (null, empty, white space) has fingerprint 0 and is linked like any other; a text with
fewer words than a shingle has the hash of all its words; component_id is the smallest doc_id of the component, null if all
are null; repeated rows and null doc_ids are rows of their own; an empty table gives an empty result; other columns are
ignored."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common as C
from .components import connected_components

SHINGLE, SEED, BITS, BUDGET = 3, 42, 64, 2
#: Most fingerprints below a node that one task takes whole, and least number of bits by which a larger one is split.
LEAF_SIZE, STRIDE = 4096, 3
#: Node pairs that a task goes down together; more wait on a stack.
FRONTIER = 1 << 18
#: Hashes whose bits are counted in one numpy pass.
COUNTED = 1 << 14

_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


# ---------------------------------------------------------------- fingerprints

def simhash(text: bytes, shingle: int = SHINGLE) -> int:
    """The fingerprint of one whole text. bytes.split cuts at runs of space and \\x09-\\x0D."""
    words = text.translate(_LOWER).split()
    if not words:
        return 0
    line = b" ".join(words)
    ends, at = [], -1
    for w in words:
        at += len(w) + 1
        ends.append(at)
    shingles = max(1, len(words) - shingle + 1)
    starts = [0] + [e + 1 for e in ends[:shingles - 1]]
    stops = ends[shingle - 1:] if len(words) >= shingle else ends[-1:]
    digest = xxhash.xxh64_intdigest
    counts = np.zeros(BITS, np.int64)
    for i in range(0, shingles, COUNTED):
        hashes = np.array([digest(line[a:b], SEED) for a, b in zip(starts[i:i + COUNTED], stops[i:i + COUNTED])], ">u8")
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > shingles).tobytes(), "big")


def fingerprinted(documents: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """doc_id and fp, the fingerprint as a signed long, of each document."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.empty(batch.num_rows, np.uint64)
            for i, text in enumerate(batch.column(1)):
                body = text.as_buffer()
                found[i] = simhash(body.to_pybytes() if body is not None else b"", shingle)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64), pa.int64())], names=["doc_id", "fp"])

    rows = C.text_rows(documents, "doc_id", "text")
    kind = documents.schema["doc_id"].dataType.simpleString()
    return rows.withColumn("text", F.encode(F.coalesce("text", F.lit("")), "UTF-8")).mapInArrow(read, f"doc_id {kind}, fp long")


# ---------------------------------------------------------------- the upper part of the trie, as tables

def prefix(value: Column, depth: Column) -> Column:
    """The first `depth` bits of a 64-bit value, the others 0."""
    return F.when(depth <= 0, F.lit(0).cast("long")).otherwise(value.bitwiseAND(_high(depth)))


def _high(depth: Column) -> Column:
    """A mask of the first `depth` bits, for depths from 1 to 64."""
    return F.call_function("shiftleft", F.lit(-1).cast("long"), (F.lit(BITS) - depth).cast("int"))


def upper_trie(prints: DataFrame, leaf_size: int = LEAF_SIZE, stride: int = STRIDE) -> tuple[DataFrame, DataFrame]:
    """(trie nodes: node, depth, parent, parent_depth and leaf; fingerprints with the node of their leaf) of distinct `fp`. A node
    is named by its prefix, padded with zeros, and its depth."""
    n = prints.count()
    nodes = prints.sparkSession.createDataFrame([(0, 0, None, None, n <= leaf_size)],
                                                "node long, depth int, parent long, parent_depth int, leaf boolean")
    if n <= leaf_size:
        return nodes, prints.select("fp", F.lit(0).cast("long").alias("node"))
    first = min(BITS, max(stride, math.ceil(math.log2(n / leaf_size))))
    open_ = prints.select("fp", F.lit(0).cast("long").alias("parent"), F.lit(0).alias("parent_depth"), F.lit(first).alias("depth"))
    placed: DataFrame | None = None
    while True:
        at = open_.withColumn("node", prefix(F.col("fp"), F.col("depth")))
        sizes = C.written(at.groupBy("node", "depth").agg(
            F.first("parent").alias("parent"), F.first("parent_depth").alias("parent_depth"), F.count("*").alias("n"),
            F.bit_or("fp").bitwiseXOR(F.bit_and("fp")).alias("vary")), "trie-nodes")
        sizes = sizes.withColumn("leaf", (F.col("n") <= leaf_size) | (F.col("depth") >= BITS))
        here = at.select("fp", "node", "depth").join(sizes.select("node", "depth", "n", "vary", "leaf"), ["node", "depth"])
        here = C.written(here, "trie-prints")
        nodes = nodes.unionByName(sizes.select(*nodes.columns))
        done = here.where("leaf").select("fp", "node")
        placed = done if placed is None else placed.unionByName(done)
        rest = here.where("not leaf")
        if rest.isEmpty():
            return nodes, placed
        shared = F.lit(BITS) - F.length(F.bin("vary"))  # bits that all below the node have in common: a path without branches
        step = F.greatest(F.lit(stride), F.ceil(F.log2(F.col("n") / leaf_size)).cast("int"))
        open_ = rest.select("fp", F.col("node").alias("parent"), F.col("depth").alias("parent_depth"),
                            F.least(F.lit(BITS), shared + step).alias("depth"))


def _differing(a: Column, b: Column, depth: Column) -> Column:
    return F.when(depth <= 0, F.lit(0)).otherwise(F.bit_count(a.bitwiseXOR(b).bitwiseAND(_high(depth))))


def leaf_pairs(nodes: DataFrame, budget: int = BUDGET) -> DataFrame:
    """(a, b) of leaves whose prefixes differ in at most `budget` of the bits that both have, a <= b."""
    nodes = C.written(nodes, "trie")
    root = nodes.where("depth = 0").select(F.col("node").alias("a"), F.col("depth").alias("a_depth"), F.col("leaf").alias("a_leaf"))
    pairs = root.select("*", F.col("a").alias("b"), F.col("a_depth").alias("b_depth"), F.col("a_leaf").alias("b_leaf"))
    below = nodes.where("depth > 0")
    found: DataFrame | None = None
    while True:
        pairs = C.written(pairs, "trie-pairs")
        done = pairs.where("a_leaf and b_leaf").select("a", "b")
        found = done if found is None else found.unionByName(done)
        pairs = pairs.where("not (a_leaf and b_leaf)")
        if pairs.isEmpty():
            return found
        for side in ("a", "b"):
            child = below.select(F.col("parent").alias("_p"), F.col("parent_depth").alias("_d"), F.col("node").alias("_n"),
                                 F.col("depth").alias("_nd"), F.col("leaf").alias("_l"))
            node, depth, leaf = F.col(side), F.col(f"{side}_depth"), F.col(f"{side}_leaf")
            other = "b" if side == "a" else "a"
            kept = [other, f"{other}_depth", f"{other}_leaf"]
            same = ["twin"] if side == "b" else []
            if side == "a":  # whether a pair is that of a node with itself, before either side is replaced
                pairs = pairs.withColumn("twin", (F.col("a") == F.col("b")) & (F.col("a_depth") == F.col("b_depth")))
                same = ["twin"]
            down = pairs.where(~leaf).join(child, (node == F.col("_p")) & (depth == F.col("_d"))).select(
                F.col("_n").alias(side), F.col("_nd").alias(f"{side}_depth"), F.col("_l").alias(f"{side}_leaf"), *kept, *same)
            pairs = pairs.where(leaf).select(side, f"{side}_depth", f"{side}_leaf", *kept, *same).unionByName(down)
        pairs = pairs.where(~F.col("twin") | (F.col("a") <= F.col("b"))).where(
            _differing(F.col("a"), F.col("b"), F.least("a_depth", "b_depth")) <= budget).drop("twin")


# ---------------------------------------------------------------- the lower part, bit by bit within a task

def _boundary(values: np.ndarray, low: np.ndarray, high: np.ndarray, bit: int) -> np.ndarray:
    """For ranges [low, high) of sorted values that agree above `bit`, where the values with that bit start."""
    one = np.uint64(1) << np.uint64(bit)
    first = values[low]
    edge = (first & ~((one << np.uint64(1)) - np.uint64(1)) if bit < BITS - 1 else np.zeros_like(first)) | one
    return np.clip(np.searchsorted(values, edge), low, high)


def trie_links(left: np.ndarray, right: np.ndarray, budget: int = BUDGET, twin: bool = False) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index arrays of all pairs of the sorted, distinct uint64 fingerprints `left` and `right` that differ in at most `budget` bits;
    of a set with itself (`twin`) each pair once."""
    if not len(left) or not len(right):
        return
    stack = [(BITS - 1, *(np.array([x], np.int64) for x in (0, len(left), 0, len(right), 0)))]
    while stack:
        bit, al, ah, bl, bh, err = stack.pop()
        if len(al) > FRONTIER:
            half = len(al) // 2
            stack.append((bit, al[half:], ah[half:], bl[half:], bh[half:], err[half:]))
            al, ah, bl, bh, err = al[:half], ah[:half], bl[:half], bh[:half], err[:half]
            stack.append((bit, al, ah, bl, bh, err))
            continue
        single = (ah - al == 1) & (bh - bl == 1)  # two leaves: the bits below are compared at once
        if single.any():
            i, j = al[single], bl[single]
            near = np.bitwise_count(left[i] ^ right[j]) <= budget
            if twin:
                near &= i < j
            yield i[near], j[near]
            go = ~single
            al, ah, bl, bh, err = al[go], ah[go], bl[go], bh[go], err[go]
        if not len(al) or bit < 0:
            continue
        am, bm = _boundary(left, al, ah, bit), _boundary(right, bl, bh, bit)
        down = []
        for x, y, more in (((al, am), (bl, bm), 0), ((am, ah), (bm, bh), 0), ((al, am), (bm, bh), 1), ((am, ah), (bl, bm), 1)):
            ok = (x[1] > x[0]) & (y[1] > y[0]) & (err + more <= budget)
            if twin and more:
                ok &= x[0] <= y[0]  # the mirrored pair is gone down too
            down.append((x[0][ok], x[1][ok], y[0][ok], y[1][ok], err[ok] + more))
        stack.append((bit - 1, *(np.concatenate(c) for c in zip(*down))))


def star_edges(links: Iterator[tuple[np.ndarray, np.ndarray]], n: int) -> np.ndarray:
    """For n nodes, the smallest node that the links connect each with. Links are taken in piece by piece, and only the
    labels stay."""
    label = np.arange(n)
    for i, j in links:
        while len(i):
            a, b = label[i], label[j]
            open_ = a != b
            if not open_.any():
                break
            i, j, a, b = i[open_], j[open_], a[open_], b[open_]
            low, high = np.minimum(a, b), np.maximum(a, b)
            np.minimum.at(label, high, low)
            while True:
                up = label[label]
                if (up == label).all():
                    break
                label = up
    return label


def _joined(budget: int):
    def join(found: pd.DataFrame) -> pd.DataFrame:
        sides = {r.side: np.sort(np.asarray(r.prints, np.int64).view(np.uint64)) for r in found.itertuples()}
        left = sides[0]
        twin = 1 not in sides
        right = left if twin else sides[1]
        if twin:
            every, links = left, trie_links(left, left, budget, True)
        else:
            every, n = np.concatenate([left, right]), len(left)
            links = ((i, j + n) for i, j in trie_links(left, right, budget))
        label = star_edges(links, len(every))
        at = np.flatnonzero(label != np.arange(len(every)))
        ids = every.view(np.int64)
        return pd.DataFrame({"u": ids[at], "v": ids[label[at]]})
    return join


def linked(prints: DataFrame, budget: int = BUDGET, leaf_size: int = LEAF_SIZE, stride: int = STRIDE) -> DataFrame:
    """Edges (u, v) of distinct fingerprints `fp`, whose connected components are those of all pairs within `budget` bits."""
    nodes, placed = upper_trie(prints, leaf_size, stride)
    pairs = leaf_pairs(nodes, budget)
    packs = C.written(placed.groupBy("node").agg(F.collect_list("fp").alias("prints")), "trie-leaves")
    # a pair has the fingerprints of both leaves, a pair of a leaf with itself those of one
    sides = F.when(F.col("a") == F.col("b"), F.array(F.struct(F.lit(0).alias("side"), F.col("a").alias("node")))).otherwise(
        F.array(F.struct(F.lit(0).alias("side"), F.col("a").alias("node")), F.struct(F.lit(1).alias("side"), F.col("b").alias("node"))))
    dealt = pairs.select("a", "b", F.explode(sides).alias("s")).select("a", "b", "s.side", "s.node").join(packs, "node")
    return dealt.select("a", "b", "side", "prints").groupBy("a", "b").applyInPandas(_joined(budget), "u long, v long")


def near_duplicates(documents: DataFrame, *, shingle: int = SHINGLE, budget: int = BUDGET, leaf_size: int = LEAF_SIZE,
                    stride: int = STRIDE) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hexadecimal digits) and component_id, the smallest doc_id of the documents
    that links of at most `budget` differing bits connect it with."""
    rows = C.written(fingerprinted(documents, shingle), "simhash")
    prints = C.written(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-prints")
    edges = C.written(linked(prints.select("fp"), budget, leaf_size, stride), "simhash-edges")
    joined = connected_components(edges, "u", "v")
    member = C.written(prints.join(joined, prints["fp"] == joined["node"], "left").select(
        "fp", "least", F.coalesce("component", "fp").alias("component")), "simhash-members")
    named = member.groupBy("component").agg(F.min("least").alias("component_id"))
    of = C.written(member.join(named, "component").select("fp", "component_id"), "simhash-components")
    return rows.join(of, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
