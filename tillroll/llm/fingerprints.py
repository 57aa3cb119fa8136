"""Operator 4: document fingerprints as homomorphic multiset hashes, with DataFrame functions only.

A text is the multiset of its paragraphs: its lines, cut again after sentence ends so that long lines count in pieces. A
paragraph is hashed to a wide vector and the vectors are summed lane by lane modulo 2^32. The sum does not depend on the
order, equal multisets have equal sums, and paragraphs are inserted or deleted by adding or subtracting their vectors
(`added`, `removed`). The lanes: the number of paragraphs; DENSE lanes to which every paragraph adds; and STRATA x BUCKETS
lanes to one of which a paragraph adds, in stratum s with probability 2^-(s+1). These hold, beside the sum, the number of
paragraphs that were added, copies included.

`likeness` is the share of paragraphs in common, copies included. Buckets whose sums differ hold paragraphs that the texts don't
share, about as many as their numbers differ by. Their numbers are added up from the coarsest stratum to the finest one that isn't
saturated, and scaled up by the share of paragraphs in these strata. A paragraph that makes up much of a text by its copies
cannot be scaled, as it is in one stratum only: differences of more than HEAVY of all paragraphs count as they are, in
whatever stratum.

Defined results: a null text is empty; an empty text has no paragraph; likeness of two empty texts is 1; a lone document is its own
next one; documents are ordered by doc_id (nulls first), equal doc_ids by hash of their text; repeated rows are documents
of their own; an empty table gives an empty result; other columns are ignored."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import common as C

DENSE, STRATA, BUCKETS = 8, 9, 16
MODULUS = 1 << 32
#: Where a text is cut: line breaks, white space after a sentence end, and sentence ends that no space follows.
PARAGRAPH_ENDS = r"[\r\n]+|(?<=[.!?])\s+|(?<=[\u3002\uff01\uff1f])"
#: Ranges of documents per shuffle partition: several, so that the partitions come out even.
RANGES = 8
#: Differing buckets from which a stratum counts as saturated.
SATURATED = 13
#: Share of both texts' paragraphs from which a bucket's difference counts as it is.
HEAVY = 1 / 64
#: Bits of a sparse lane's sum; its number of paragraphs is above them.
SUM_BITS = 32


def paragraph_hashes(text: Column) -> Column:
    """64-bit hashes of a text's paragraphs."""
    return F.transform(F.filter(F.split(F.coalesce(text, F.lit("")), PARAGRAPH_ENDS), lambda p: p != ""),
                       lambda p: F.xxhash64(p))


def _number(lane: Column) -> Column:
    return F.shiftright(lane, SUM_BITS)


def _sum(lane: Column) -> Column:
    return lane.bitwiseAND(MODULUS - 1)


def _pack(number: Column, total: Column) -> Column:
    return F.shiftleft(number, SUM_BITS).bitwiseOR(total.bitwiseAND(MODULUS - 1))


def lanes(hashes: Column) -> Column:
    """The fingerprint of a multiset of paragraph hashes as an array of 1 + DENSE + STRATA * BUCKETS numbers."""
    def low(h: Column, seed: int) -> Column:
        return F.xxhash64(h, F.lit(seed)).bitwiseAND(MODULUS - 1)

    def summed(seed: int) -> Column:
        return F.aggregate(hashes, F.lit(0).cast("long"), lambda a, h: (a + low(h, seed)) % MODULUS)

    def stratum(bits: int, value: int) -> Column:
        return F.filter(hashes, lambda h: h.bitwiseAND(bits) == value)

    dense = [summed(seed) for seed in range(DENSE)]
    # stratum s: the lowest set bit of the hash is bit s, or a higher one for the last stratum
    strata = F.array(*[stratum((2 << s) - 1, 1 << s) for s in range(STRATA - 1)], stratum((1 << (STRATA - 1)) - 1, 0))
    sparse = F.flatten(F.transform(strata, lambda part: F.transform(
        F.array(*[F.lit(b) for b in range(BUCKETS)]),
        lambda b: F.aggregate(part, F.lit(0).cast("long"), lambda a, h: F.when(
            F.shiftright(h, 20).bitwiseAND(BUCKETS - 1) == b, _pack(_number(a) + 1, _sum(a) + low(h, DENSE) + 1)).otherwise(a)))))
    return F.concat(F.array(F.size(hashes).cast("long"), *dense), sparse)


def _lane_by_lane(a: Column, b: Column, sign: int) -> Column:
    head, tail = (F.lit(1), F.lit(DENSE + 1)), (F.lit(DENSE + 2), F.lit(STRATA * BUCKETS))
    dense = F.zip_with(F.slice(a, *head), F.slice(b, *head), lambda x, y: F.pmod(x + sign * y, F.lit(MODULUS)))
    sparse = F.zip_with(F.slice(a, *tail), F.slice(b, *tail), lambda x, y: _pack(
        _number(x) + sign * _number(y), F.pmod(_sum(x) + sign * _sum(y), F.lit(MODULUS))))
    return F.concat(dense, sparse)


def added(a: Column, b: Column) -> Column:
    """The fingerprint of the paragraphs of both."""
    return _lane_by_lane(a, b, 1)


def removed(a: Column, b: Column) -> Column:
    """The fingerprint of a's paragraphs without b's."""
    return _lane_by_lane(a, b, -1)


def as_text(a: Column) -> Column:
    """A fingerprint as text: the number of paragraphs, the dense lanes, and the other lanes that aren't 0 with their
    numbers, in hexadecimal."""
    dense = F.array_join(F.transform(F.slice(a, 2, DENSE), lambda x: F.lpad(F.lower(F.hex(x)), 8, "0")), "")
    sparse = F.filter(F.transform(F.slice(a, DENSE + 2, STRATA * BUCKETS), lambda x, i: F.when(
        x != 0, F.concat(F.lower(F.hex(i)), F.lit("="), F.lower(F.hex(x))))), lambda x: x.isNotNull())
    return F.concat_ws(":", F.get(a, F.lit(0)).cast("string"), dense, F.array_join(sparse, ","))


def _let(value: Column, body) -> Column:
    """`body(value)` with the value computed once per row: a lambda variable is not expanded where it is used."""
    return F.transform(F.array(value), body)[0]


def likeness(a: Column, b: Column) -> Column:
    """0 to 1: the estimated share of the paragraphs of two fingerprints, copies included, that both have."""
    both = F.get(a, F.lit(0)) + F.get(b, F.lit(0))
    much = F.greatest(both * HEAVY, F.lit(2.0))
    # per bucket the paragraphs not shared: at least one, or one of each text if the numbers are equal
    differ = F.zip_with(F.slice(a, DENSE + 2, STRATA * BUCKETS), F.slice(b, DENSE + 2, STRATA * BUCKETS), lambda x, y: F.when(
        x != y, F.greatest(F.abs(_number(x) - _number(y)), F.when(_number(x) == _number(y), F.lit(2)).otherwise(F.lit(1)))).otherwise(0))

    def unmixed(part: Column) -> Column:
        """(differing buckets, paragraphs) of a stratum without the heavy ones, corrected for paragraphs that hide each other in
        a bucket (linear counting)."""
        return _let(F.aggregate(part, F.struct(F.lit(0).alias("buckets"), F.lit(0.0).alias("n")), lambda st, x: F.struct(
            (st["buckets"] + (x > 0).cast("int")).alias("buckets"), (st["n"] + x).alias("n"))), lambda c: _let(
                -F.log(F.greatest(F.lit(0.01), 1.0 - c["buckets"] / BUCKETS)), lambda load: F.struct(
                    c["buckets"].alias("buckets"), (c["n"] * (1.0 + 0.13 * load + 0.05 * load * load)).alias("n"))))

    def total(d: Column, much: Column) -> Column:
        heavy = F.aggregate(d, F.lit(0.0), lambda n, x: F.when(x > much, n + x).otherwise(n))
        strata = F.transform(F.array(*[F.lit(s) for s in reversed(range(STRATA))]), lambda s: unmixed(F.transform(
            F.slice(d, s * BUCKETS + 1, BUCKETS), lambda x: F.when(x > much, 0).otherwise(x))))
        # from the coarsest stratum to the finest unsaturated one: (sum, weight, still unsaturated)
        walk = F.aggregate(
            strata, F.struct(F.lit(0.0).alias("n"), F.lit(float(1 << STRATA)).alias("w"), F.lit(True).alias("on")),
            lambda st, c: F.when(st["on"] & (c["buckets"] < SATURATED), F.struct(
                (st["n"] + c["n"]).alias("n"), (st["w"] / 2).alias("w"), F.lit(True).alias("on")))
            .otherwise(F.struct(st["n"].alias("n"), st["w"].alias("w"), F.lit(False).alias("on"))),
            lambda st: F.when(st["on"], st["n"]).otherwise(st["n"] * st["w"]))
        return walk + heavy

    estimate = _let(differ, lambda d: _let(much, lambda m: total(d, m)))
    estimate = F.greatest(estimate, F.abs(F.get(a, F.lit(0)) - F.get(b, F.lit(0))))
    share = F.greatest(F.lit(0.0), F.least(F.lit(1.0), 1.0 - estimate / both))
    return F.when(F.slice(a, 1, DENSE + 1) == F.slice(b, 1, DENSE + 1), F.lit(1.0)).when(both == 0, F.lit(1.0)).otherwise(share)


def with_next(documents: DataFrame) -> DataFrame:
    """doc_id, text (null: empty), bucket, place columns, and whether the row only stands in for the next bucket's first.

    Ascending order is cut into ranges of doc_id of about equal rows. The first row of each range is also sent, marked, to the
    range before (that of the first range to the last), so that every row finds the next one inside its own range: one
    shuffle, no window over all rows. The driver sees one row per range."""
    rows = C.text_rows(documents, "doc_id", "text").withColumn("text", F.coalesce("text", F.lit("")))
    bucket, n = C.range_bucket(rows, "doc_id", RANGES * C.shuffle_partitions(documents.sparkSession))
    rows = rows.withColumn("bucket", bucket)
    least = rows.groupBy("bucket").agg(F.min(F.struct(F.col("doc_id").isNotNull().alias("known"), "doc_id")).alias("f"))
    firsts = {r["bucket"]: r["f"]["doc_id"] for r in least.collect()}
    order = sorted(firsts)
    first, before = [None] * n, [0] * n
    for i, b in enumerate(order):
        first[b], before[b] = firsts[b], order[i - 1]
    heads = F.array(*[F.lit(x).cast("long") for x in first])
    leads = F.array(*[F.lit(x) for x in before])
    here = F.struct(F.col("bucket").alias("bucket"), F.lit(False).alias("stand_in"))
    there = F.struct(F.get(leads, F.col("bucket")).alias("bucket"), F.lit(True).alias("stand_in"))
    to = F.when(F.col("doc_id").eqNullSafe(F.get(heads, F.col("bucket"))), F.array(here, there)).otherwise(F.array(here))
    return rows.withColumn("to", F.explode(to)).select(
        "doc_id", "text", F.xxhash64("text").alias("tie"), F.col("to.bucket").alias("bucket"), F.col("to.stand_in").alias("stand_in"))


def fingerprints(documents: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next. The edited text is
    the text with its last floor(n_chars / 2) code points replaced by as many of the next document's first ones."""
    order = Window.partitionBy("bucket").orderBy("stand_in", F.col("doc_id").asc_nulls_first(), "tie")
    chars = F.char_length("text")
    half = F.floor(chars / 2).cast("int")
    rows = with_next(documents).withColumn("next", F.lead("text").over(order))
    rows = rows.withColumn("edited", F.when(F.col("stand_in"), F.lit("")).otherwise(F.concat(
        F.substring("text", F.lit(1), chars - half), F.substring("next", F.lit(1), half))))
    rows = rows.select(
        "doc_id", "tie", "bucket", "stand_in", chars.cast("long").alias("n_chars"),
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        paragraph_hashes(F.col("text")).alias("hashes"), paragraph_hashes(F.col("edited")).alias("edited_hashes"))
    rows = rows.select("doc_id", "tie", "bucket", "stand_in", "n_chars", "edited_sha256",
                       lanes(F.col("hashes")).alias("lanes"), lanes(F.col("edited_hashes")).alias("edited_lanes"))
    rows = rows.withColumn("next_lanes", F.lead("lanes").over(order)).where("not stand_in")
    return rows.select("doc_id", "n_chars", "edited_sha256", as_text(F.col("lanes")).alias("fingerprint"),
                       as_text(F.col("edited_lanes")).alias("edited_fingerprint"),
                       likeness(F.col("lanes"), F.col("edited_lanes")).alias("near_edited"),
                       likeness(F.col("lanes"), F.col("next_lanes")).alias("near_next"))
