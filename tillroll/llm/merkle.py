"""Operator 11: a Merkle manifest of a dataset, with levels kept as concatenated hexadecimal strings.

The leaves of a group (a language) stand in ascending order of doc_id and are cut into aligned blocks of FANOUT ** DEPTH
positions. A block keeps each of its levels as one string of 64-character digests. SQL substrings of fixed width cut a
level into runs of FANOUT digests, whose hashes are the next level. What flanks a node in its run are its siblings. The top
of a block is one node of the next round, whose nodes are cut into blocks in the same way, until each group has one node,
its subroot; the subroots are the nodes of a last tree with the root. Paths come down from the root: a node's path is that
within its block followed by the path of its block.

Nothing is collected: a round is a shuffle by (group, block) with a fixed number of rows per block, a group of any size is
many blocks, and each round has 1 / FANOUT ** DEPTH of the rows of the one before. Positions come from a range sort
(operators.ordering), so that no window or task holds a whole group. Texts are read once and don't travel: a leaf's row has its
digest only.

Defined results: a null value is `-` in a leaf, so that a null and an empty text differ. Null doc_ids come first in their
language, rows of equal doc_id follow each other by their leaves; equal rows are leaves of their own. A null language is a
group before all others, the empty string another one. A lone leaf is its group's subroot and has no siblings there. An empty
table gives an empty result. Other columns are ignored."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.ordering import positions
from . import common as C

#: Hexadecimal digits of a digest.
WIDTH = 64
#: Children of a node, and levels that one block holds (256 leaves, a level of 16 KB).
FANOUT, DEPTH = 2, 8
#: The values of a leaf, in the order in which they are hashed.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Rows whose crc32 of the doc_id this number divides are tampered with in the audit.
TAMPERED = 7


def digest(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def leaf_hash(**values: Column) -> Column:
    """The digest of the given values of FIELDS: `-` for null, else UTF-8 bytes, colon, value."""
    parts = []
    for name in FIELDS:
        text = values[name].cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return digest(F.concat(*parts))


def _runs(level: Column, fanout: int) -> Column:
    """The next level: the digests of all runs of `fanout` digests, the last of which may be shorter."""
    size = WIDTH * fanout
    last = F.ceil(F.length(level) / size).cast("int") - 1
    return F.array_join(F.transform(F.sequence(F.lit(0), last), lambda i: digest(F.substring(level, i * size + 1, F.lit(size)))), "")


def _levels(bottom: Column, steps: Column, fanout: int) -> Column:
    """[bottom, its parents, ...]: `steps` levels above the bottom one."""
    climbs = F.when(steps > 0, F.sequence(F.lit(1), steps)).otherwise(F.array().cast("array<int>"))
    return F.aggregate(climbs, F.array(bottom), lambda found, _: F.concat(found, F.array(_runs(F.element_at(found, -1), fanout))))


def _flanks(levels: Column, steps: Column, at: Column, fanout: int, depth: int) -> Column:
    """For each of the `steps` levels the digests left and right of the node that stands above position `at`."""
    found = []
    for level in range(depth):
        node = F.floor(at / fanout ** level).cast("int")
        run = F.floor(node / fanout).cast("int") * fanout
        row = F.get(levels, F.lit(level))
        found.append(F.struct(F.substring(row, run * WIDTH + 1, (node - run) * WIDTH).alias("left"),
                              F.substring(row, (node + 1) * WIDTH + 1, (run + fanout - 1 - node) * WIDTH).alias("right")))
    return F.slice(F.array(*found), F.lit(1), steps)


def _same(left: DataFrame, right: DataFrame, pairs: list[tuple[str, str]]) -> Column:
    cond = F.lit(True)
    for a, b in pairs:
        cond = cond & left[a].eqNullSafe(right[b])
    return cond


def tree(nodes: DataFrame, group: list[str], payload: list[str], *, fanout: int = FANOUT,
         depth: int = DEPTH) -> tuple[DataFrame, DataFrame]:
    """(group, payload, hash and `path` of every node; group and `top`, the last node, of every group) of `nodes` with
    `position`, `total` (nodes of the group) and `hash`. A path has the digests left and right of the node and of those
    above it, level by level."""
    size = fanout ** depth
    rounds: list[DataFrame] = []
    tops: DataFrame | None = None
    carried = payload
    while True:
        member = F.struct((F.col("position") % size).cast("int").alias("at"), "hash", *carried)
        blocks = nodes.groupBy(*group, F.floor(F.col("position") / size).alias("block")).agg(
            F.first("total").alias("total"), F.array_sort(F.collect_list(member)).alias("members"))
        steps = sum(((F.col("total") > fanout ** level).cast("int") for level in range(depth)), F.lit(0))
        bottom = F.array_join(F.col("members.hash"), "")
        blocks = blocks.withColumn("steps", steps).withColumn("levels", _levels(bottom, F.col("steps"), fanout))
        blocks = C.written(blocks, "merkle-blocks")
        rounds.append(blocks)
        top = F.element_at("levels", -1)
        done = blocks.where(F.col("total") <= size).select(*group, top.alias("top"))
        tops = done if tops is None else tops.unionByName(done)
        rest = blocks.where(F.col("total") > size)
        if rest.isEmpty():
            break
        nodes = rest.select(*group, F.col("block").alias("position"), F.ceil(F.col("total") / size).alias("total"),
                            top.alias("hash"))
        carried = ["position"]
        nodes = nodes.withColumn("position", F.col("position").cast("long"))
    above: DataFrame | None = None  # group, block of the round below, path
    for i, blocks in reversed(list(enumerate(rounds))):
        if above is not None:
            names = {g: f"_above_{j}" for j, g in enumerate(group)}
            higher = above.select(*[F.col(g).alias(names[g]) for g in group], F.col("position").alias("_at"), F.col("path").alias("higher"))
            on = _same(blocks, higher, [("block", "_at"), *names.items()])
            blocks = blocks.join(higher, on, "left").drop("_at", *names.values())
        else:
            blocks = blocks.withColumn("higher", F.lit(None).cast("array<struct<left:string,right:string>>"))
        none = F.array().cast("array<struct<left:string,right:string>>")
        paths = F.transform("members", lambda m: F.struct(m.alias("m"), F.concat(
            _flanks(F.col("levels"), F.col("steps"), m["at"], fanout, depth), F.coalesce("higher", none)).alias("path")))
        found = blocks.select(*group, F.explode(paths).alias("x")).select(
            *group, F.col("x.m.hash").alias("hash"), *[F.col(f"x.m.{c}").alias(c) for c in (payload if i == 0 else ["position"])],
            F.col("x.path").alias("path"))
        above = found if i == 0 else C.written(found, "merkle-paths")
    return above, tops


def fold(start: Column, path: Column) -> Column:
    """The top that a node's digest and its siblings give."""
    return F.aggregate(path, start, lambda h, s: digest(F.concat(s["left"], h, s["right"])))


def siblings(path: Column) -> Column:
    return F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), "")


def manifest(documents: DataFrame, *, fanout: int = FANOUT, depth: int = DEPTH) -> DataFrame:
    """One row per document: doc_id, lang, leaf, changed (the leaf after tampering, or null), subroot, root, and `path`, the
    siblings up to the root."""
    rows = C.text_rows(documents, *FIELDS)
    values = {c: F.col(c) for c in FIELDS}
    more = values | {"n_chars": F.col("n_chars").cast("decimal(20,0)") + 1}
    tampered = (F.crc32(F.col("doc_id").cast("string").cast("binary")) % TAMPERED == 0) & F.col("n_chars").isNotNull()
    leaves = C.written(rows.select("lang", "doc_id", leaf_hash(**values).alias("hash"),
                                   F.when(tampered, leaf_hash(**more)).alias("changed")), "merkle-leaves")
    placed = positions(leaves, [F.col("doc_id").asc_nulls_first(), "hash"], ["lang"], total="total")
    paths, tops = tree(placed, ["lang"], ["doc_id", "changed"], fanout=fanout, depth=depth)
    tops = C.written(tops, "merkle-subroots")
    subroots = positions(tops.withColumnRenamed("top", "hash"), [F.col("lang").asc_nulls_first()], total="total")
    upper, root = tree(subroots, [], ["lang"], fanout=fanout, depth=depth)
    root = C.written(root, "merkle-root")  # one row, or none
    upper = C.written(upper.select(F.col("lang").alias("of"), F.col("hash").alias("subroot"), F.col("path").alias("upper")),
                      "merkle-upper")
    both = paths.join(upper, paths["lang"].eqNullSafe(upper["of"])).drop("of")
    return both.select("doc_id", "lang", F.col("hash").alias("leaf"), "changed", "subroot",
                       root.select("top").scalar().alias("root"), F.concat("path", "upper").alias("path"))


def audited(documents: DataFrame, *, fanout: int = FANOUT, depth: int = DEPTH) -> DataFrame:
    """One row per document: doc_id, leaf, subroot, root, proof_sha256 (of its siblings' digests), folded_root (from the tampered
    leaf, if there is one, and the siblings) and verified (whether that is the root)."""
    rows = manifest(documents, fanout=fanout, depth=depth)
    folded = fold(F.coalesce("changed", "leaf"), F.col("path"))
    rows = rows.select("doc_id", "leaf", "subroot", "root", digest(siblings(F.col("path"))).alias("proof_sha256"),
                       folded.alias("folded_root"))
    return rows.withColumn("verified", F.col("folded_root") == F.col("root"))
