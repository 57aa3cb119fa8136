"""Operator 3: n-gram Jaccard self join by MinHash banding, verified on full n-gram sets.

1. Every whole text gets its set of word n-grams (as 64-bit hashes), a 128-bit key of that set and one hash per band of
   its MinHash signature. Texts of equal sets are one class with the smallest doc_id as its representative; copies are
   counted by a partial aggregate and go no further.
2. The representatives are shuffled on (band, band hash). A bucket of several classes links each to its smallest one;
   the connected components of these links hold every candidate pair.
3. The full n-gram sets of the classes in such components are shuffled once, by component. A component is split into
   blocks of bounded n-grams and every pair of blocks is verified by one task, so that a component of very many near
   copies is spread over many tasks. A task counts each class's similar classes and returns, besides these counts, only
   a forest of links; it never returns the pairs.
4. The components of the verified links are the near-duplicate classes.

The bands and rows are chosen so that a pair at the threshold shares a bucket with at least the target probability;
pairs of a candidate component are verified whether or not they share one, so the recall is higher still.

Defined results: words are lower-cased as in common.WORD_CLASS; a text of fewer than n words, but not none, has one
n-gram of all its words; a text without words (null counts as empty) is in one class with its exact copies only and
similar to no other; repeated rows and equal doc_ids are documents of their own; a null doc_id is never a representative unless its class has no
other; an empty table gives an empty result; other columns are ignored."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, LongType

from . import common as C
from .components import connected_components

#: n-grams of a block of classes, and classes of it, on the average; a task verifies two blocks.
BLOCK_GRAMS = 400_000
BLOCK_CLASSES = 400
#: Text that is hashed at a time.
PASS_BYTES = 1 << 18


def choose_bands(threshold: float, recall: float = 0.9995, hashes: int = 160) -> tuple[int, int]:
    """(bands, rows): of all choices within `hashes` that find a pair at the threshold with probability `recall`, the one
    with most rows, which has fewest candidates below the threshold."""
    for rows in range(hashes, 0, -1):
        hit = threshold ** rows
        bands = 1 if hit >= 1 else math.ceil(math.log(1 - recall) / math.log1p(-hit))
        if rows * bands <= hashes:
            return bands, rows
    raise ValueError("no banding reaches this recall within the number of hashes")


def gram_sets(body: np.ndarray, offsets: np.ndarray, n: int) -> list[np.ndarray]:
    """The sorted distinct n-gram hashes of each text."""
    mapped, starts, ends, first = C.word_spans(body, offsets)
    words = C.span_hashes(mapped, starts, ends)
    if len(words) >= n:
        grams = np.zeros(len(words) - n + 1, np.uint64)
        for k in range(n):
            grams += words[k:len(words) - n + 1 + k] * np.uint64(pow(0xD1342543DE82EF95, k + 1, 1 << 64))
        grams = C.mix64(grams)
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        if b - a >= n:
            out.append(np.unique(grams[a:b - n + 1]))
        elif b > a:
            factors = np.array([pow(0xD1342543DE82EF95, k + 1, 1 << 64) for k in range(b - a)], np.uint64)
            out.append(C.mix64((words[a:b] * factors).sum(keepdims=True) + np.uint64(b - a)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def _multipliers(count: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(11)
    return (rng.integers(0, 1 << 31, count, dtype=np.uint32) * np.uint32(2) + np.uint32(1),
            rng.integers(0, 1 << 32, count, dtype=np.uint32))


def band_hashes(sets: list[np.ndarray], bands: int, rows: int) -> np.ndarray:
    """One 64-bit hash per set and band (len(sets), bands); rows of empty sets are 0."""
    out = np.zeros((len(sets), bands), np.uint64)
    full = [i for i, s in enumerate(sets) if len(s)]
    if not full:
        return out
    flat = np.concatenate([sets[i] for i in full])
    low, high = flat.astype(np.uint32), (flat >> np.uint64(32)).astype(np.uint32)
    lengths = np.array([len(sets[i]) for i in full])
    cuts = np.cumsum(lengths) - lengths
    factors, adds = _multipliers(bands * rows)
    for b in range(bands):
        h = np.full(len(full), b + 1, np.uint64)
        for r in range(b * rows, (b + 1) * rows):
            least = np.minimum.reduceat((low ^ adds[r]) * factors[r] + high, cuts)
            h = C.mix64(h * np.uint64(0x9E3779B97F4A7C15) + least)
        out[full, b] = h
    return out


def _sets_of(column: pa.Array, n: int) -> Iterator[tuple[int, list[np.ndarray]]]:
    body, offsets = C.utf8_column(column)
    for a, b in C.row_runs(offsets, PASS_BYTES):
        yield a, gram_sets(body[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a], n)


def set_key(grams: np.ndarray) -> bytes:
    return hashlib.blake2b(grams.astype("<u8").tobytes(), digest_size=16).digest()


def wordless_key(text: pa.Scalar) -> bytes:
    """The key of a text without words, which only its exact copies share."""
    body = text.as_buffer()
    return hashlib.blake2b(b"" if body is None else body, digest_size=16, person=b"wordless").digest()


def signatures(documents: DataFrame, n: int, bands: int, rows: int, *columns: str) -> DataFrame:
    """doc_id, further columns of the documents, key of the n-gram set, its size, and its band hashes."""
    source = C.text_rows(documents, "text", "doc_id", *columns)
    names = ["doc_id", *columns, "key", "grams", "bands"]

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, sets in _sets_of(batch.column(0), n):
                hashes = band_hashes(sets, bands, rows).astype(np.int64)
                flat = pa.array(hashes.reshape(-1))
                yield pa.RecordBatch.from_arrays(
                    [*[c.slice(a, len(sets)) for c in batch.columns[1:]], pa.array(
                        [set_key(s) if len(s) else wordless_key(batch.column(0)[a + i]) for i, s in enumerate(sets)], pa.binary()),
                     pa.array([len(s) for s in sets], pa.int32()),
                     pa.ListArray.from_arrays(pa.array(np.arange(len(sets) + 1) * bands, pa.int32()), flat)],
                    names=names)

    schema = source.drop("text").schema.add("key", BinaryType()).add("grams", IntegerType()).add(
        "bands", ArrayType(LongType()))
    return source.mapInArrow(sign, schema)


def verify_blocks(left: pd.DataFrame, right: pd.DataFrame | None, threshold: float) -> tuple[np.ndarray, np.ndarray, list]:
    """Verify all pairs of classes of `left` (right None), or of a class of `left` and one of `right`, on their full
    n-gram sets. Returns, for the classes of both in order, the number of similar classes, that of documents in them, and
    the links of a spanning forest as (class, class)."""
    rows = left if right is None else pd.concat([left, right], ignore_index=True)
    sets = [np.frombuffer(g, "<u8") for g in rows["set"]]
    size = np.array([len(s) for s in sets])
    m, cut = len(rows), len(left)
    shared = np.zeros((m, m) if right is None else (cut, m - cut), np.float32)
    # columns: n-grams that at least two classes have, in passes of bounded width
    flat, owner = np.concatenate(sets), np.repeat(np.arange(m), size)
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    begins = np.concatenate([[True], flat[1:] != flat[:-1]])
    number = np.cumsum(begins) - 1
    several = np.bincount(number)[number] > 1
    owner, number = owner[several], number[several]
    number = np.cumsum(np.concatenate([[True], number[1:] != number[:-1]])) - 1 if len(number) else number
    width = max(256, (8 << 20) // (4 * m))
    for low in range(0, int(number[-1]) + 1 if len(number) else 0, width):
        a, b = np.searchsorted(number, [low, low + width])
        x = np.zeros((m, min(width, int(number[b - 1]) - low + 1)), np.float32)
        x[owner[a:b], number[a:b] - low] = 1
        shared += x @ x.T if right is None else x[:cut] @ x[cut:].T
    union = (size[:, None] + size[None, :] if right is None else size[:cut, None] + size[None, cut:]) - shared
    similar = shared >= threshold * union - 1e-6
    if right is None:
        np.fill_diagonal(similar, False)
    copies = rows["copies"].to_numpy(np.int64)
    if right is None:
        links, documents = similar.sum(1), similar @ copies
    else:
        links = np.concatenate([similar.sum(1), similar.sum(0)])
        documents = np.concatenate([similar @ copies[cut:], similar.T @ copies[:cut]])
    return links, documents, _forest(similar, 0 if right is None else cut, m)


def _forest(similar: np.ndarray, shift: int, m: int) -> list[tuple[int, int]]:
    seen, out = np.zeros(m, bool), []
    for root in range(m):
        if seen[root]:
            continue
        seen[root], todo = True, [root]
        while todo:
            x = todo.pop()
            near = np.zeros(m, bool)
            if not shift:
                near = similar[x].copy()
            elif x < shift:
                near[shift:] = similar[x]
            else:
                near[:shift] = similar[:, x - shift]
            new = np.flatnonzero(near & ~seen)
            seen[new] = True
            out += [(x, int(y)) for y in new]
            todo += new.tolist()
    return out


def similarity_classes(documents: DataFrame, *, n: int = 5, threshold: float = 0.8, recall: float = 0.9995) -> DataFrame:
    """One row per document: doc_id; class_id, the smallest doc_id of the documents that links connect it with;
    copy_id, the smallest doc_id with the same n-gram set; n_links, the number of other documents with similarity of at
    least `threshold` (copies and others); n_similar_classes, the number of other n-gram sets among them."""
    signed, full = _classes(documents, n, threshold, recall)
    return signed.select("doc_id", "key").join(full, "key").select(
        "doc_id", "class_id", "copy_id", "n_links", "n_similar_classes")


def _classes(documents: DataFrame, n: int, threshold: float, recall: float, *columns: str) -> tuple[DataFrame, DataFrame]:
    """(doc_id, further columns and key of the set per document; what is known of each class of equal sets)."""
    bands, rows = choose_bands(threshold, recall)
    signed = C.written(signatures(documents, n, bands, rows, *columns), "signatures")
    classes = C.written(signed.groupBy("key").agg(
        F.min("doc_id").alias("copy_id"), F.count("*").alias("copies"), F.first("grams").alias("grams"),
        F.min("bands").alias("bands")).withColumn("class", F.monotonically_increasing_id()), "classes")
    entries = classes.where("grams > 0").select("class", F.explode("bands").alias("bucket"))
    buckets = entries.groupBy("bucket").agg(F.min("class").alias("least"), F.count("*").alias("n")).where("n > 1")
    buckets = C.written(buckets, "buckets")  # so that the entries of a hot bucket can be split in the join
    links = entries.join(buckets, "bucket").where("class <> least").select("class", "least")
    candidates = C.written(connected_components(links, "class", "least"), "candidates")
    # the n-gram sets of candidate classes, each read from one document of the class
    chosen = candidates.join(classes, candidates["node"] == classes["class"]).select(
        "key", "class", "copy_id", "copies", "grams", "component")
    load = chosen.groupBy("component").agg(F.sum("grams").alias("all_grams"), F.count("*").alias("members"))
    load = load.select("component", F.greatest(F.ceil(F.col("all_grams") / BLOCK_GRAMS),
                                               F.ceil(F.col("members") / BLOCK_CLASSES)).cast("int").alias("blocks"))
    load = C.written(load, "blocks")
    members = C.written(chosen.join(load, "component").withColumn(
        "block", F.pmod(F.xxhash64("class"), F.col("blocks")).cast("int")), "members")
    # every class is in `blocks` pairs of blocks, including that of its own block with itself
    dealt = _with_sets(documents, members, n).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.select("component", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
                         "block", "class", "copies", "set")

    def verify(key: tuple, found: pd.DataFrame) -> pd.DataFrame:
        found = found.drop_duplicates("class").sort_values("class")
        _, i, j = key
        left = found[found["block"] == i].reset_index(drop=True)
        right = None if i == j else found[found["block"] == j].reset_index(drop=True)
        if right is not None and (left.empty or right.empty):
            return pd.DataFrame({"class": [], "links": [], "documents": [], "to": []}).astype("Int64")
        every = left if right is None else pd.concat([left, right], ignore_index=True)
        links, docs, forest = verify_blocks(left, right, threshold)
        ids = every["class"].to_numpy()
        counts = pd.DataFrame({"class": ids, "links": links, "documents": docs, "to": None})[links > 0]
        pairs = pd.DataFrame({"class": [ids[a] for a, _ in forest], "links": 0, "documents": 0,
                              "to": [ids[b] for _, b in forest]})
        return pd.concat([counts.astype("Int64"), pairs.astype("Int64")], ignore_index=True)

    verified = C.written(dealt.groupBy("component", "i", "j").applyInPandas(
        verify, "class long, links long, documents long, to long"), "verified")
    counts = verified.groupBy("class").agg(F.sum("links").alias("links"), F.sum("documents").alias("documents"))
    joined = connected_components(verified.where("to is not null").select("class", "to"), "class", "to")
    # a component is named after its smallest doc_id
    member = joined.join(classes.select("class", "copy_id"), joined["node"] == F.col("class"))
    named = member.groupBy("component").agg(F.min("copy_id").alias("class_id"))
    groups = member.join(named, "component").select("class", F.col("component").alias("group"), "class_id")
    full = classes.select("key", "class", "copy_id", "copies").join(groups, "class", "left").join(counts, "class", "left")
    full = C.written(full.select(
        "key", F.coalesce("group", "class").alias("group"), "copy_id", F.coalesce("class_id", "copy_id").alias("class_id"),
        (F.col("copies") - 1 + F.coalesce("documents", F.lit(0))).alias("n_links"),
        F.coalesce("links", F.lit(0)).alias("n_similar_classes")), "similarity")
    return signed, full


def _with_sets(documents: DataFrame, members: DataFrame, n: int) -> DataFrame:
    """`members` with the n-gram set of each class, as bytes, in the column `set`. Only documents that stand for a class
    in `members` are shuffled; the key of a text's set finds its class, also where doc_ids repeat or are null."""

    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, sets in _sets_of(batch.column(0), n):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([set_key(s) for s in sets], pa.binary()),
                     pa.array([s.astype("<u8").tobytes() for s in sets], pa.binary())], names=["key", "set"])

    rows = C.text_rows(documents, "doc_id", "text")
    named = rows.where("doc_id is not null").join(
        members.where("copy_id is not null").select(F.col("copy_id").alias("doc_id")).distinct(), "doc_id", "left_semi")
    nameless = rows.where("doc_id is null").join(  # only if a candidate class has no doc_id at all
        members.where("copy_id is null").limit(1).select("blocks"), F.lit(True), "left_semi")
    sets = named.select("text").unionByName(nameless.select("text")).mapInArrow(expand, "key binary, set binary")
    return members.join(sets.groupBy("key").agg(F.first("set").alias("set")), "key")


def one_per_group(documents: DataFrame, *, n: int = 5, threshold: float = 0.8, recall: float = 0.9995) -> DataFrame:
    """The documents, with all their columns, without near duplicates: of each similarity class the row with the smallest
    doc_id stays (nulls last; of equal doc_ids one)."""
    mark = "row_mark"
    while mark in documents.columns:
        mark += "_"
    marked = documents.withColumn(mark, F.md5(F.concat_ws(
        "|", F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), F.coalesce("text", F.lit(""))).cast("binary")))
    signed, full = _classes(marked, n, threshold, recall, mark)
    rows = signed.select("doc_id", "key", F.col(mark).alias("mark")).join(full.select("key", "group"), "key")
    best = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "mark"))
    kept = rows.groupBy("group").agg(best.alias("b")).select(F.col("b.mark").alias(mark))
    return marked.join(kept, mark, "left_semi").dropDuplicates([mark]).drop(mark)
