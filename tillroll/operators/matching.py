"""Fuzzy name join: best right-hand name per left-hand name by token-set similarity >= threshold (J17, J23, O7, PF25).

No pair enumeration: every left name is scored only against right names that share a *prefix key* with it, and the
keys are chosen so that every pair able to reach the threshold shares one (an exact filter, not a heuristic cap):

1. Token path. If the shared tokens T are non-empty and one name's tokens are a subset of the other's, the score is
   100; the other token-driven terms reach t only if T holds at least alpha = rho / (1 + rho) of one name's weight
   (rho = (1 - u) / 2u, u = 1 - t/100; token weight = length + 1). Order tokens by global frequency, rarest first;
   a name's prefix is its shortest head whose remaining weight is below alpha of the whole. A pair with enough
   shared weight shares a token of one side's prefix. So there are two equi joins, left prefixes with all right tokens and
   all left tokens with right prefixes: a token that is in a third of the names, but in no name's prefix, joins nothing.
2. Character path. ratio(T+A, T+B) >= t bounds indel(A, B), and each insertion or deletion changes at most three
   of the name's token-padded bigrams, so the two bigram multisets overlap in at least beta = (1 - 3u) / (1 + u)
   of either one (0.64 at t = 90). With the same rare-first order, prefixes of length |G| - ceil(beta |G|) + k on
   both sides share at least k elements (the prefix-filtering lemma, for k up to the overlap). Names whose overlap
   must be two or more are joined on pairs of prefix bigrams (k = 2), shorter ones on single ones: bigrams are few
   and frequent, pairs of them are not.

Candidates must then reach one of the two bounds in full (shared token weight, or multiset overlap), computed with
array functions before any Python runs. A frequent token or bigram enters a name's prefix only when the name consists
mostly of frequent parts; what such a prefix joins contains the name or most of it. The filter is exact for
thresholds above 2/3 (the default is 90).

Up to 2/3 the bigram bound is void, and names that share one common word already match, so that an index on parts would
list nearly all pairs as rows. There, blocks of left names meet blocks of right names and a task bounds every pair's
score with a few array operations, by count filters: by the characters that both names have (the longest common
subsequence has no more) against their lengths, and by the shared tokens' length, which gives the token-driven terms
exactly. Each left name then scores right names in the order of this bound until none can beat or tie the best one. A task
returns at most one row per left name; the work is one cheap bound per pair of distinct names, spread over the pairs of
blocks. Thresholds of 0 and less are refused: all names match.

The remaining pairs are scored by an Arrow UDF, and the best match per left name is a `min_by` aggregate (score desc,
then name asc, the first best wins). All of this runs on distinct normalised names, so repeated names in the inputs
cost nothing.
"""

from __future__ import annotations

from collections import Counter, defaultdict

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillroll.functions.names import block_key, normalize_name
from tillroll.functions.similarity import token_set_ratio_udf, token_set_ratios
from tillroll.session import cut_lineage

#: Names of a block, on the average, where blocks are compared; a task holds a few numbers per pair of two blocks.
BLOCK_NAMES = 2_000
#: Right names that a left name scores at first; twice as many each time after.
FIRST_SCORED = 8


def has_prefix_filter(threshold: float) -> bool:
    """Whether names that reach the threshold must share a prefix key."""
    return 1.0 - 3.0 * (1.0 - threshold / 100.0) > 1e-6


def _bounds(threshold: float) -> tuple[float, float]:
    u = 1.0 - threshold / 100.0
    if not has_prefix_filter(threshold):
        raise ValueError("no filter on shared parts is complete for thresholds up to 66.7")
    if u <= 0:
        return 1.0, 1.0
    rho = (1.0 - u) / (2.0 * u)
    alpha = rho / (1.0 + rho)
    beta = (1.0 - 3.0 * u) / (1.0 + u)
    return alpha - 1e-9, beta - 1e-9


def _parts(names: DataFrame) -> DataFrame:
    """norm, its distinct tokens and its token-padded bigrams numbered by occurrence, so that arrays act as multisets."""
    toks = "array_distinct(split(norm, ' '))"
    bgs = "flatten(transform(toks, t -> transform(sequence(1, length(t) + 1), i -> substring(concat('^', t, '$'), i, 2))))"
    p = names.select("norm", F.expr(toks).alias("toks")).withColumn("raw", F.expr(bgs))
    return p.select("norm", "toks", F.expr("transform(raw, (x, i) -> concat(x, '#', cast(size(filter("
                                           "slice(raw, 1, i + 1), y -> y = x)) as string)))").alias("bgs"))


def _prefixed(left: DataFrame, right: DataFrame, alpha: float, beta: float) -> DataFrame:
    """Filter elements of both sides: kind 't' (tokens), 1 (prefix bigrams) or 2 (pairs of prefix bigrams); `pref` tells whether
    the element indexes its name, `k` how many shared bigrams the name's overlap allows to ask for (1 or 2).

    Rare-first order. Tokens: the shortest head whose remaining weight is below alpha of the name's weight. Bigrams: the
    first |G| - ceil(beta |G|) + k elements."""
    parts = _parts(left).withColumn("side", F.lit("L")).unionByName(_parts(right).withColumn("side", F.lit("R")))
    e = parts.select("side", "norm", F.explode(F.expr(
        "concat(transform(toks, x -> named_struct('kind', 't', 'key', x, 'w', length(x) + 1)), "
        "transform(bgs, x -> named_struct('kind', 'b', 'key', x, 'w', 1)))")).alias("e")).select("side", "norm", "e.*")
    freq = e.groupBy("kind", "key").agg(F.count(F.lit(1)).alias("df"))
    # a name's elements in rare-first order: at most its length
    listed = e.join(freq, ["kind", "key"]).groupBy("side", "norm").agg(
        F.sort_array(F.collect_list(F.when(F.col("kind") == "t", F.struct("df", "key", "w")))).alias("t"),
        F.sort_array(F.collect_list(F.when(F.col("kind") == "b", F.struct("df", "key")))).alias("b"))
    need = F.ceil(F.size("b") * F.lit(beta)).cast("int")
    k = F.greatest(F.lit(1), F.least(F.lit(2), need))
    tokens = F.expr(f"""transform(t, (x, i) -> named_struct('kind', 't', 'key', x.key, 'pref',
        aggregate(slice(t, 1, i), 0, (s, y) -> s + y.w) <= (1 - {alpha!r}) * aggregate(t, 0, (s, y) -> s + y.w)))""")
    singles = F.expr("transform(slice(b, 1, size(b) - need + 1), x -> named_struct('kind', '1', 'key', x.key, 'pref', true))")
    pairs = F.expr("""if(k = 2, flatten(transform(slice(b, 1, size(b) - need + 2), (x, i) -> transform(
        slice(b, i + 2, greatest(size(b) - need + 2 - i - 1, 0)),
        y -> named_struct('kind', '2', 'key', concat(x.key, ' ', y.key), 'pref', true)))),
        cast(array() as array<struct<kind: string, key: string, pref: boolean>>))""")
    # pairs are listed in rare-first order on both sides, so equal pairs have equal keys
    return listed.withColumn("need", need).withColumn("k", k).select(
        "side", "norm", "k", F.explode(F.concat(tokens, singles, pairs)).alias("x")).select("side", "norm", "k", "x.*")


def prefix_joins(elements: DataFrame) -> DataFrame:
    """(l, r) pairs, with repeats, that share a prefix element: prefix tokens of either side with all tokens of the other, and
    prefix bigrams (or pairs of them) with each other. Every join has prefix elements on at least one side."""
    def side(name: str, out: str) -> DataFrame:
        return elements.where(F.col("side") == name).select(F.col("norm").alias(out), "kind", "key", "pref", F.col("k").alias(f"{out}k"))

    left, right = side("L", "l"), side("R", "r")

    def tokens(of: DataFrame, out: str, prefix: bool) -> DataFrame:
        kept = of.where("kind = 't' AND pref") if prefix else of.where("kind = 't'")
        return kept.select(out, "key")

    by_left = tokens(left, "l", True).join(tokens(right, "r", False), "key").select("l", "r")
    by_right = tokens(left, "l", False).join(tokens(right, "r", True), "key").select("l", "r")
    bigrams = left.where("kind <> 't'").drop("pref").join(right.where("kind <> 't'").drop("pref"), ["kind", "key"]).where(
        F.least("lk", "rk") == F.col("kind").cast("int")).select("l", "r")
    return by_left.unionByName(by_right).unionByName(bigrams)


def candidate_pairs(left: DataFrame, right: DataFrame, threshold: float = 90) -> DataFrame:
    """Distinct (l, r) normalised-name pairs that can score >= threshold (a superset of them, see module doc)."""
    alpha, beta = _bounds(threshold)
    # the elements feed five join sides: they are written once
    pairs = prefix_joins(cut_lineage(_prefixed(left, right, alpha, beta))).distinct()
    lp = _parts(left).select(F.col("norm").alias("l"), F.col("toks").alias("lt"), F.col("bgs").alias("lb"))
    rp = _parts(right).select(F.col("norm").alias("r"), F.col("toks").alias("rt"), F.col("bgs").alias("rb"))
    weight = "aggregate({0}, 0, (s, x) -> s + length(x) + 1)"
    shared = weight.format("array_intersect(lt, rt)")
    bound = (F.expr(shared) >= alpha * F.least(F.expr(weight.format("lt")), F.expr(weight.format("rt")))) | (
        F.size(F.array_intersect("lb", "rb")) >= beta * F.greatest(F.size("lb"), F.size("rb")))
    return pairs.join(lp, "l").join(rp, "r").where(bound).select("l", "r")


def score_bounds(left: list[str], right: list[str]) -> np.ndarray:
    """An upper bound of the token-set score of each pair (left, right) of non-empty names."""

    def parts(names: list[str]) -> tuple[np.ndarray, dict[str, list], dict[str, list]]:
        lengths, tokens, letters = np.zeros(len(names)), defaultdict(list), defaultdict(list)
        for i, name in enumerate(names):
            words = set(name.split())
            for w in words:
                tokens[w].append(i)
            joined = " ".join(words)
            lengths[i] = len(joined)
            for c, n in Counter(joined).items():
                letters[c].append((i, n))
        return lengths, tokens, letters

    ll, lt, lc = parts(left)
    rl, rt, rc = parts(right)
    common = np.zeros((len(left), len(right)), np.float32)  # characters of both
    for c in lc.keys() & rc.keys():
        (i, n), (j, m) = np.array(lc[c]).T, np.array(rc[c]).T
        common[np.ix_(i, j)] += np.minimum(n[:, None], m[None, :])
    out = 200.0 * common / (ll[:, None] + rl[None, :])
    common[:] = 0  # from here the length of the shared tokens, each with a separator
    for w in lt.keys() & rt.keys():
        common[np.ix_(lt[w], rt[w])] += len(w) + 1
    i, j = np.nonzero(common)
    shared = common[i, j] - 1.0
    out[i, j] = np.maximum(out[i, j], 200.0 * shared / (shared + np.minimum(ll[i], rl[j])))
    return out


def best_in_blocks(left: list[str], right: list[str], threshold: float, allowed: np.ndarray | None = None) -> pd.DataFrame:
    """(l, r, score): the best right name of each left name that reaches the threshold, the first of equally good ones.
    `allowed` tells which pairs count."""
    right_order = sorted(range(len(right)), key=right.__getitem__)
    right = [right[j] for j in right_order]
    bound = score_bounds(left, right)
    if allowed is not None:
        bound[~allowed[:, right_order]] = -1.0
    best, at = np.full(len(left), float(threshold)), np.full(len(left), len(right))
    slack, count = 1e-4, FIRST_SCORED  # of the bounds, whose counts are single floats
    live = np.flatnonzero(bound.max(axis=1, initial=-1.0) >= best - slack)
    while len(live):
        count = min(count, len(right))
        tops = np.argpartition(-bound[live], count - 1, axis=1)[:, :count]
        row, col = np.repeat(live, count), tops.ravel()
        todo = bound[row, col] >= best[row] - slack
        row, col = row[todo], col[todo]
        scores = token_set_ratios([left[i] for i in row], [right[j] for j in col])
        bound[row, col] = -1.0
        order = np.lexsort((col, -scores, row))
        row, col, scores = row[order], col[order], scores[order]
        first = np.concatenate([[True], row[1:] != row[:-1]])
        row, col, scores = row[first], col[first], scores[first]
        better = (scores > best[row]) | (scores == best[row]) & (col < at[row])
        best[row[better]], at[row[better]] = scores[better], col[better]
        live = live[bound[live].max(axis=1) >= best[live] - slack]
        count *= 2
    hit = np.flatnonzero(at < len(right))
    return pd.DataFrame({"l": pd.Series([left[i] for i in hit], dtype=object),
                         "r": pd.Series([right[j] for j in at[hit]], dtype=object), "score": best[hit]})


def _scored_in_blocks(left: DataFrame, right: DataFrame, threshold: float, blocking: int | None) -> DataFrame:
    """(l, r, score): for each left name and block of right names the best one that reaches the threshold."""
    if threshold <= 0:
        raise ValueError("a threshold must be above 0")
    lefts, rights = (max(1, -(-names.count() // BLOCK_NAMES)) for names in (left, right))
    only = F.lit(None).cast("string")
    if blocking:  # a left name whose first characters begin some right name is compared with those only
        keys = right.select(block_key("norm", blocking).alias("only")).distinct()
        left = left.withColumn("key", block_key("norm", blocking)).join(keys, F.col("key") == F.col("only"), "left")
        only = F.col("only")

    def dealt(names: DataFrame, side: str, key, own: str, blocks: int, other: str, others: int) -> DataFrame:
        return names.select(F.lit(side).alias("side"), "norm", key.alias("key"),
                            F.pmod(F.xxhash64("norm"), F.lit(blocks)).cast("int").alias(own),
                            F.explode(F.sequence(F.lit(0), F.lit(others - 1))).alias(other))

    pairs = dealt(left, "L", only, "i", lefts, "j", rights).unionByName(
        dealt(right, "R", block_key("norm", blocking or 1), "j", rights, "i", lefts))

    def best(rows: pd.DataFrame) -> pd.DataFrame:
        mine, theirs = rows[rows["side"] == "L"], rows[rows["side"] == "R"]
        keys = mine["key"].to_numpy(object)
        free = mine["key"].isna().to_numpy()
        allowed = free[:, None] | (keys[:, None] == theirs["key"].to_numpy(object)[None, :]) if blocking else None
        return best_in_blocks(mine["norm"].tolist(), theirs["norm"].tolist(), threshold, allowed)

    return pairs.groupBy("i", "j").applyInPandas(best, "l string, r string, score double")


def best_matches(left_names: DataFrame, right_names: DataFrame, threshold: float = 90,
                 blocking: int | None = None) -> DataFrame:
    """(l, r, score): for each distinct non-empty left name the best right name with score >= threshold.

    `blocking=n` reproduces the first script's behaviour: a left name whose first n characters start some right
    name is only compared within that block; otherwise it is compared with all right names (found exactly through
    the same prefix keys)."""
    # The distinct name sets are small (bounded by the partners' and suppliers' name lists) and feed a dozen
    # branches; one reliable checkpoint in the shared checkpoint folder computes both once and cuts the lineage.
    both = cut_lineage(
        left_names.select(F.lit("L").alias("_side"), "norm")
        .unionByName(right_names.select(F.lit("R").alias("_side"), "norm"))
        .where(F.col("norm") != "").distinct())
    left = both.where(F.col("_side") == "L").select("norm")
    right = both.where(F.col("_side") == "R").select("norm")
    if not has_prefix_filter(threshold):
        return _best(_scored_in_blocks(left, right, threshold, blocking))
    cand = candidate_pairs(left, right, threshold)
    if blocking:
        rb = right.select(block_key("norm", blocking).alias("b")).distinct()
        lb = left.select("norm", block_key("norm", blocking).alias("lb")) \
            .join(rb, F.col("lb") == F.col("b"), "left").select(F.col("norm").alias("l"), "lb",
                                                                  F.col("b").isNotNull().alias("has_block"))
        cand = cand.join(lb, "l").where(~F.col("has_block") | (block_key("r", blocking) == F.col("lb"))) \
            .select("l", "r")
    return _best(cand.withColumn("score", token_set_ratio_udf("l", "r")).where(F.col("score") >= threshold))


def _best(scored: DataFrame) -> DataFrame:
    best = scored.groupBy("l").agg(F.min_by(F.struct("r", "score"), F.struct(-F.col("score"), F.col("r"))).alias("m"))
    return best.select("l", F.col("m.r").alias("r"), F.col("m.score").alias("score"))


def fuzzy_join(left: DataFrame, right: DataFrame, left_key: str, right_key: str, threshold: float = 90,
               blocking: int | None = None, how: str = "left") -> DataFrame:
    """Left rows with the columns of their best-matching right row (J17/J23): both sides normalised, matched on
    distinct names, then joined back by equi joins. Right names that normalise alike tie; the smallest original name
    wins, so each left row gets at most one right row."""
    ln = left.withColumn("_l_norm", normalize_name(left_key))
    rn = right.withColumn("_r_norm", normalize_name(right_key))
    m = best_matches(ln.select(F.col("_l_norm").alias("norm")), rn.select(F.col("_r_norm").alias("norm")),
                     threshold, blocking)
    first = Window.partitionBy("_r_norm").orderBy(F.col(right_key).asc_nulls_last())
    r1 = rn.withColumn("_rk", F.row_number().over(first)).where("_rk = 1").drop("_rk")
    out = ln.join(m, ln["_l_norm"] == m["l"], how).drop("l")
    out = out.join(r1, out["r"] == r1["_r_norm"], "left").drop("r", "_r_norm")
    return out.drop("_l_norm").withColumnRenamed("score", "match_score")


def fuzzy_match_table(left: DataFrame, right: DataFrame, left_key: str, right_key: str, threshold: float = 90,
                      blocking: int | None = None) -> DataFrame:
    """Distinct left names with their matched right name and score (the matcher's own output, rows-only check)."""
    ln = left.select(F.col(left_key).alias("left_name")).distinct().withColumn("norm", normalize_name("left_name"))
    rn = right.select(F.col(right_key).alias("right_name")).distinct().withColumn("norm", normalize_name("right_name"))
    m = best_matches(ln.select("norm"), rn.select("norm"), threshold, blocking)
    pick = rn.groupBy("norm").agg(F.min("right_name").alias("right_name"))
    out = ln.join(m, ln["norm"] == m["l"], "left").join(pick, m["r"] == pick["norm"], "left")
    return out.select("left_name", ln["norm"].alias("left_norm"), "right_name",
                      F.col("score").alias("match_score"))

