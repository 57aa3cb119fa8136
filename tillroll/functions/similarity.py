"""Token-set similarity, 0-100 (F24, X2), as an Arrow-batched pandas UDF over candidate pairs only.

Definition (the scorer's published one): T = shared tokens, A / B = tokens only in the first / second name, each
joined sorted with single spaces. If T is non-empty and A or B is empty the score is 100. Otherwise it is the best of
ratio(T+A, T+B), and, when T is non-empty, ratio(T, T+A) and ratio(T, T+B), where ratio(x, y) =
100 * (1 - indel(x, y) / (len x + len y)) and indel counts insertions and deletions. T+A and T+B share their first
part, so their indel distance is indel(A, B); the other two follow from lengths alone.

The longest common subsequences of a batch are found together, bit-parallel: a column of the usual table is 64 cells in one
word, in which a 0 marks where the length grows, and one addition with its carry moves all 64 at once. numpy does this
for all pairs of the batch at one position of the second strings per step; strings of more than 64 characters take several
words, with the carry handed on.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType


#: Bits of a word of the bit-parallel table, and pairs that one numpy pass handles.
WORD, BATCH = 64, 4096


def _codes(strings: list[str], width: int, fill: int) -> np.ndarray:
    """Code points, one row per string, padded with `fill`."""
    lengths = np.fromiter(map(len, strings), np.int64, len(strings))
    flat = np.frombuffer("".join(strings).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
    out = np.full((len(strings), width), fill, np.int64)
    out[np.arange(width) < lengths[:, None]] = flat
    return out


def _lcs_lengths(a: list[str], b: list[str]) -> np.ndarray:
    """LCS lengths of the pairs of a block; the strings of `a` lie along the bits."""
    words = max(1, -(-max(map(len, a)) // WORD))
    width = max(map(len, b))
    first, second = _codes(a, words * WORD, -1), _codes(b, width, -2)
    rows = np.full((len(a), words), np.uint64(0xFFFFFFFFFFFFFFFF))
    for j in range(width):
        live = np.flatnonzero(second[:, j] != -2)  # shorter strings are done
        equal = np.packbits(first[live] == second[live, j][:, None], axis=1, bitorder="little").view("<u8")
        carry = np.zeros(len(live), np.uint64)
        for w in range(words):
            v = rows[live, w]
            u = v & equal[:, w]
            added = v + u
            total = added + carry
            carry = ((added < v) | (total < added)).astype(np.uint64)
            rows[live, w] = total | (v & ~equal[:, w])
    return np.bitwise_count(~rows).sum(axis=1, dtype=np.int64)


def indel_distances(a: list[str], b: list[str]) -> np.ndarray:
    """len(a) + len(b) - 2 * LCS(a, b) of each pair. Pairs are taken in blocks of similar length, so that one long string
    doesn't widen the others' rows."""
    sizes = np.array([[len(x), len(y)] for x, y in zip(a, b)], np.int64).reshape(-1, 2)
    out = sizes.sum(axis=1)
    order = np.lexsort((sizes[:, 1], -(-sizes[:, 0] // WORD)))
    order = order[(sizes[order] > 0).all(axis=1)]
    words = -(-sizes[order, 0] // WORD)
    start = 0
    while start < len(order):
        most = max(1, BATCH // int(words[start]))
        stop = min(start + most, start + int(np.searchsorted(words[start:], words[start], "right")))
        block = order[start:stop]
        out[block] -= 2 * _lcs_lengths([a[i] for i in block], [b[i] for i in block])
        start = stop
    return out


def indel_distance(a: str, b: str) -> int:
    return int(indel_distances([a], [b])[0])


def _norm(dist: int, lensum: int) -> float:
    return 100.0 if lensum == 0 else 100.0 - 100.0 * dist / lensum


def token_set_ratios(left: list[str | None], right: list[str | None]) -> np.ndarray:
    """The scores of pairs of names."""
    out = np.zeros(len(left))
    at, firsts, seconds, lengths = [], [], [], []
    for i, (x, y) in enumerate(zip(left, right)):
        ta, tb = set((x or "").split()), set((y or "").split())
        if not ta or not tb:
            continue
        shared, only_a, only_b = ta & tb, ta - tb, tb - ta
        if shared and (not only_a or not only_b):
            out[i] = 100.0
            continue
        at.append(i)
        firsts.append(" ".join(sorted(only_a)))
        seconds.append(" ".join(sorted(only_b)))
        lengths.append(len(" ".join(sorted(shared))))
    for i, sa, sb, sect, dist in zip(at, firsts, seconds, lengths, indel_distances(firsts, seconds).tolist()):
        sep = 1 if sect else 0
        ab_len, ba_len = sect + sep + len(sa), sect + sep + len(sb)
        best = _norm(dist, ab_len + ba_len)
        if sect:
            best = max(best, _norm(sep + len(sa), sect + ab_len), _norm(sep + len(sb), sect + ba_len))
        out[i] = best
    return out


def token_set_ratio(s1: str | None, s2: str | None) -> float:
    return float(token_set_ratios([s1], [s2])[0])


@F.pandas_udf(DoubleType())
def _token_set_ratio_udf(left: pd.Series, right: pd.Series) -> pd.Series:
    return pd.Series(token_set_ratios(left.tolist(), right.tolist()), dtype="float64")


# Marked nondeterministic only to pin where it runs: otherwise Catalyst pushes the `score >= t` filter below the
# candidates' DISTINCT and into every union branch, scoring duplicate pairs.
token_set_ratio_udf = _token_set_ratio_udf.asNondeterministic()
