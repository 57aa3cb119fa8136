"""Operator 12: divergence audit of sources by count-level bitmaps.

Every language keeps the terms of at least MIN_DOCUMENTS of its documents, numbered from the most frequent on. A (language,
source) group stores, for each count, which terms occur that often, as bitsets of 64 consecutive term numbers: rows (language,
word of 64 terms, source, count, bits). For two sources of a language a join on the word ANDs the bitsets of every two counts,
and the bits that are left, summed by popcount, are the joint cells: how many terms have the one count here and the other
there. The divergence of a term depends on its two counts only, so a pair's value is the sum of cells times f. Cells with a
count of 0 are never stored: they are complements of the others by the sources' own level sizes and the number of terms.

Terms in order of frequency make neighbours alike, so that a word of rare terms has few counts, and no word has more than 64 per
source: the join makes at most 64 x 64 rows per pair and word. Cells are summed before they are shuffled. Term counts come from
one pass over the texts that counts within each block of rows first. All numbers are integers; products are decimals.

Defined results: null text, language and source are empty strings; a group without kept terms (or without any) has a row per
other source, with the value of its smoothed p; a language with a single source has no `pair` rows; without kept terms (V = 0)
values are 0 and there are no `term` rows; each row counts as a document, repeated ones and those without doc_id too; an empty
table gives an empty result; other columns are ignored."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.ordering import positions
from . import common as C

#: Documents of its language that a kept term occurs in; total of the smoothed p; ranks of the `term` part.
MIN_DOCUMENTS, TOTAL, TERM_RANKS = 3, 1_000_000_000, 200
#: Terms of one bitset.
WORD = 64

_EXACT = "decimal(38,0)"


def _letters(body: np.ndarray) -> np.ndarray:
    """Text bytes in which digits separate words as other signs do."""
    return np.where((body >= 0x30) & (body <= 0x39), np.uint8(0x20), body)


def _count_block(body: np.ndarray, offsets: np.ndarray, groups: np.ndarray) -> tuple[np.ndarray, list[bytes], np.ndarray, np.ndarray]:
    """(group, term, occurrences, documents) for each distinct (group, term) of a block of rows with their group numbers."""
    mapped, starts, ends, _ = C.word_spans(_letters(body), offsets)
    if not len(starts):
        return np.zeros(0, np.int64), [], np.zeros(0, np.int64), np.zeros(0, np.int64)
    row = np.searchsorted(offsets, starts, "right") - 1
    first, second = C.span_hashes(mapped, starts, ends), C.span_sums(mapped, starts, ends)
    order = np.argsort(first, kind="stable")  # by term, rows ascending within it
    if ((first[order][1:] == first[order][:-1]) & (second[order][1:] != second[order][:-1])).any():
        order = np.lexsort((row, second, first))
    first, second, row_of = first[order], second[order], row[order]
    new_term = np.r_[True, (first[1:] != first[:-1]) | (second[1:] != second[:-1])]
    new_pair = np.flatnonzero(new_term | np.r_[True, row_of[1:] != row_of[:-1]])
    term = (np.cumsum(new_term) - 1)[new_pair]
    n = np.diff(np.r_[new_pair, len(order)])
    group = groups[row_of[new_pair]]
    sorted_pairs = np.lexsort((group, term))
    term, group, n = term[sorted_pairs], group[sorted_pairs], n[sorted_pairs]
    cut = np.flatnonzero(np.r_[True, (term[1:] != term[:-1]) | (group[1:] != group[:-1])])
    sums, documents = np.add.reduceat(n, cut), np.diff(np.r_[cut, len(n)])
    text = mapped.tobytes()
    spans = order[np.flatnonzero(new_term)]
    terms = [text[a:b] for a, b in zip(starts[spans].tolist(), ends[spans].tolist())]
    return group[cut], [terms[t] for t in term[cut].tolist()], sums, documents


def term_counts(documents: DataFrame) -> DataFrame:
    """lang, source, term, n (occurrences) and docs (documents) of every group and term."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            body, offsets = C.utf8_column(batch.column("text"))
            names, numbers = {}, np.empty(batch.num_rows, np.int64)
            for i, pair in enumerate(zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist())):
                numbers[i] = names.setdefault(pair, len(names))
            langs, sources = (pa.array([p[k] for p in names], pa.string()) for k in (0, 1))
            for i, j in C.row_runs(offsets):
                group, terms, n, docs = _count_block(body[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i], numbers[i:j])
                if len(terms):
                    yield pa.RecordBatch.from_arrays(
                        [langs.take(pa.array(group)), sources.take(pa.array(group)), pa.array(terms, pa.binary()).cast(pa.string()),
                         pa.array(n, pa.int64()), pa.array(docs, pa.int64())], names=["lang", "source", "term", "n", "docs"])

    parts = _named(documents).mapInArrow(count, "lang string, source string, term string, n long, docs long")
    return parts.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def _named(documents: DataFrame) -> DataFrame:
    return C.text_rows(documents, "text", "lang", "source").select(
        *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("text", "lang", "source")])


def share(count: Column, size: Column, terms: Column) -> Column:
    """p: 1 + floor(TOTAL * (count + 1) / (N + V)), exactly."""
    scaled = F.call_function("div", (count + 1).cast("decimal(20,0)") * F.lit(TOTAL).cast("decimal(18,0)"), (size + terms).cast(_EXACT))
    return scaled + 1


def divergence(p: Column, q: Column) -> Column:
    """f: floor((p - q)^2 / q); p and q are at most 1 + TOTAL, so that the square is a long."""
    return F.call_function("div", (p - q) * (p - q), q)


def levels(counts: DataFrame) -> DataFrame:
    """Count-level bitmaps: lang, source, n, word and bits of rows with the term number `id` and the count n."""
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("id") % WORD).cast("int"))
    return counts.groupBy("lang", "source", "n", F.floor(F.col("id") / WORD).alias("word")).agg(F.bit_or(bit).alias("bits"))


def joint_cells(bitmaps: DataFrame) -> DataFrame:
    """lang, a, b (sources, a < b), na, nb, cells: the number of terms with these counts, both over 0."""
    left = bitmaps.select("lang", "word", F.col("source").alias("a"), F.col("n").alias("na"), F.col("bits").alias("abits"))
    right = bitmaps.select("lang", "word", F.col("source").alias("b"), F.col("n").alias("nb"), F.col("bits").alias("bbits"))
    both = left.join(right, ["lang", "word"]).where("a < b").select(
        "lang", "a", "b", "na", "nb", F.bit_count(F.col("abits").bitwiseAND(F.col("bbits"))).alias("k")).where("k > 0")
    return both.groupBy("lang", "a", "b", "na", "nb").agg(F.sum("k").alias("cells"))


def _pair_values(bitmaps: DataFrame, groups: DataFrame) -> DataFrame:
    """lang, source, item, value for all ordered pairs of sources.

    With m(x) terms at count x of the one source and k(x, y) joint cells, summing over all terms, zeros included, is
      sum k(x, y) [f(x, y) - f(x, 0) - f(0, y) + f(0, 0)] + sum m(x) [f(x, 0) - f(0, 0)] + sum m(y) [f(0, y) - f(0, 0)]
      + V f(0, 0)."""
    here = groups.select("lang", F.col("source").alias("a"), F.col("size").alias("a_size"), F.col("terms").alias("terms"))
    there = groups.select("lang", F.col("source").alias("b"), F.col("size").alias("b_size"))
    zero = F.lit(0)

    def at(side: str, count: Column) -> Column:
        return share(count, F.col(f"{side}_size"), F.col("terms"))

    def weighted(number: Column, value: Column) -> Column:
        return F.sum(number.cast("decimal(19,0)") * value.cast("decimal(19,0)"))

    cells = C.written(joint_cells(bitmaps), "joint-cells")
    both = cells.join(here, ["lang", "a"]).join(there, ["lang", "b"]).withColumns({
        "pa": at("a", F.col("na")), "pb": at("b", F.col("nb")), "za": at("a", zero), "zb": at("b", zero)})

    def excess(p: str, q: str, zp: str, zq: str) -> Column:
        return (divergence(F.col(p), F.col(q)) - divergence(F.col(p), F.col(zq)) - divergence(F.col(zp), F.col(q))
                + divergence(F.col(zp), F.col(zq)))

    summed = both.groupBy("lang", "a", "b").agg(weighted(F.col("cells"), excess("pa", "pb", "za", "zb")).alias("ab"),
                                                weighted(F.col("cells"), excess("pb", "pa", "zb", "za")).alias("ba"))
    joint = summed.select("lang", F.col("a").alias("source"), F.col("b").alias("item"), F.col("ab").alias("v")).unionByName(
        summed.select("lang", F.col("b").alias("source"), F.col("a").alias("item"), F.col("ba").alias("v")))
    sizes = bitmaps.groupBy("lang", F.col("source").alias("a"), F.col("n").alias("na")).agg(F.sum(F.bit_count("bits")).alias("m"))
    # each group's levels against every other source's zero, as the source itself and as the item
    alone = sizes.join(here, ["lang", "a"]).join(there, "lang").where("a <> b").withColumns({
        "pa": at("a", F.col("na")), "za": at("a", zero), "zb": at("b", zero)})
    own = divergence(F.col("pa"), F.col("zb")) - divergence(F.col("za"), F.col("zb"))
    other = divergence(F.col("zb"), F.col("pa")) - divergence(F.col("zb"), F.col("za"))
    single = alone.groupBy("lang", "a", "b").agg(weighted(F.col("m"), own).alias("x"), weighted(F.col("m"), other).alias("y"))
    single = single.select("lang", F.col("a").alias("source"), F.col("b").alias("item"), F.col("x").alias("v")).unionByName(
        single.select("lang", F.col("b").alias("source"), F.col("a").alias("item"), F.col("y").alias("v")))
    empty = here.join(there, "lang").where("a <> b").select(
        "lang", F.col("a").alias("source"), F.col("b").alias("item"),
        F.when(F.col("terms") == 0, F.lit(0).cast(_EXACT)).otherwise(
            F.col("terms").cast("decimal(19,0)") * divergence(at("a", zero), at("b", zero)).cast("decimal(19,0)")).alias("v"))
    every = joint.unionByName(single).unionByName(empty)
    return every.groupBy("lang", "source", "item").agg(F.sum("v").cast("long").alias("value"))


def audited(documents: DataFrame, *, min_documents: int = MIN_DOCUMENTS, ranks: int = TERM_RANKS) -> DataFrame:
    """lang, source, part, item, value, rank: for each (language, source) group the divergence from every other source of its
    language (`pair`, all ranks) and its terms that stand out most against the language (`term`, up to `ranks`)."""
    counted = C.written(term_counts(documents), "term-counts")
    kept = counted.groupBy("lang", "term").agg(F.sum("n").alias("lang_n"), F.sum("docs").alias("docs")).where(
        F.col("docs") >= min_documents).drop("docs")
    kept = C.written(kept, "kept-terms")
    kept = positions(kept, [F.col("lang_n").desc(), "term"], ["lang"], name="id", total="terms")
    kept = C.written(kept, "term-ids")
    counts = C.written(counted.join(kept, ["lang", "term"]).select("lang", "source", "term", "id", "n", "lang_n", "terms"), "group-counts")
    langs = kept.groupBy("lang").agg(F.sum("lang_n").alias("lang_size"), F.first("terms").alias("terms"))
    sizes = counts.groupBy("lang", "source").agg(F.sum("n").alias("size"))
    groups = _named(documents).select("lang", "source").distinct().join(sizes, ["lang", "source"], "left").join(
        langs, "lang", "left").fillna(0, ["size", "lang_size", "terms"])
    groups = C.written(groups, "groups")
    pairs = _pair_values(C.written(levels(counts), "count-levels"), groups)
    some = counts.join(groups.select("lang", "source", "size", "lang_size"), ["lang", "source"]).withColumns({
        "p": share(F.col("n"), F.col("size"), F.col("terms")), "q": share(F.col("lang_n"), F.col("lang_size"), F.col("terms"))})
    some = some.where("p > q").select("lang", "source", F.col("term").alias("item"), divergence(F.col("p"), F.col("q")).alias("value"))
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    rank = F.row_number().over(order)
    terms = some.withColumn("rank", rank).where(F.col("rank") <= ranks)
    return pairs.withColumn("rank", rank).select("lang", "source", F.lit("pair").alias("part"), "item", "value", "rank").unionByName(
        terms.select("lang", "source", F.lit("term").alias("part"), "item", "value", "rank"))
