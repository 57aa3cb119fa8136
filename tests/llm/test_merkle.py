"""Operator 11 against trees built with plain lists."""

import hashlib
import zlib
from collections import defaultdict

import pytest

from tillroll.llm import merkle as M

from . import helpers as H


def sha(text):
    return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()


def leaf_of(doc_id, text, lang, source, n_chars):
    parts = []
    for v in (doc_id, source, lang, n_chars, text):
        parts.append("-" if v is None else f"{len(str(v).encode())}:{v}")
    return sha("".join(parts))


def climb(nodes, fanout):
    """(top, [list of (left, right) per node])."""
    paths = [[] for _ in nodes]
    above = list(range(len(nodes)))
    while len(nodes) > 1:
        for p, a in zip(paths, range(len(paths))):
            i = above[a]
            run = i - i % fanout
            p.append(("".join(nodes[run:i]), "".join(nodes[i + 1:run + fanout])))
        nodes = [sha("".join(nodes[i:i + fanout])) for i in range(0, len(nodes), fanout)]
        above = [a // fanout for a in above]
    return nodes[0], paths


def brute(rows, fanout=2):
    groups = defaultdict(list)
    for doc_id, text, lang, source, n_chars in rows:
        leaf = leaf_of(doc_id, text, lang, source, n_chars)
        changed = leaf
        if doc_id is not None and n_chars is not None and zlib.crc32(str(doc_id).encode()) % 7 == 0:
            changed = leaf_of(doc_id, text, lang, source, n_chars + 1)
        groups[lang].append((doc_id is not None, doc_id or 0, leaf, changed, doc_id))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    tops = {g: climb([m[2] for m in sorted(groups[g])], fanout) for g in order}
    root, upper = climb([tops[g][0] for g in order], fanout)
    out = []
    for g, high in zip(order, upper):
        for m, path in zip(sorted(groups[g]), tops[g][1]):
            fold = m[3]
            for left, right in path + high:
                fold = sha(left + fold + right)
            out.append((m[4], m[2], tops[g][0], root, sha("".join(a + b for a, b in path + high)), fold, fold == root))
    return sorted(out, key=str)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


COLUMNS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


@pytest.mark.parametrize("fanout,depth", [(2, 2), (3, 1)])
def test_many_rounds_and_fanouts(spark, fanout, depth):
    rows = [(i, f"text {i}", ("en", None, "", "ä", "Z")[min(i % 9, 4)] if i % 50 else f"l{i}", "s", i) for i in range(150)]
    got = M.audited(spark.createDataFrame(rows, H.DOCS), fanout=fanout, depth=depth)
    assert got.columns == COLUMNS
    assert rows_of(got) == brute(rows, fanout)


def test_odd_rows(spark):
    got = M.audited(H.odd_documents(spark))
    assert rows_of(got) == brute(H.odd_rows())


def test_one_row_and_none(spark):
    one = [(5, "only", None, "s", 1)]
    assert rows_of(M.audited(spark.createDataFrame(one, H.DOCS))) == brute(one)
    assert M.audited(H.empty_documents(spark)).collect() == []
