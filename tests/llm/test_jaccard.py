"""Operator 3 against all pairs of full n-gram sets."""

import random
from collections import defaultdict

import pytest

from tillroll.llm import components, jaccard_join as J

from . import helpers as H


def brute(rows):
    """doc row -> (class, copy, links, similar classes) by comparing all n-gram sets."""
    sets = defaultdict(list)
    for i, (doc_id, text) in enumerate(rows):
        sets[frozenset(H.grams(text)) or text or ""].append((doc_id is None, doc_id or 0, i))
    keys = list(sets)
    words = {k: k if isinstance(k, frozenset) else () for k in keys}
    near = {k: [] for k in keys}
    index = defaultdict(set)
    for n, k in enumerate(keys):
        for g in words[k]:
            index[g].add(n)
    for n, k in enumerate(keys):
        counts = defaultdict(int)
        for g in words[k]:
            for other in index[g]:
                counts[other] += 1
        near[k] = [keys[o] for o, c in counts.items() if o != n and c >= 0.8 * (len(k) + len(keys[o]) - c) - 1e-9]
    out, group = {}, {}
    for k in keys:
        if k not in group:
            todo, seen = [k], {k}
            while todo:
                for o in near[todo.pop()]:
                    if o not in seen:
                        seen.add(o)
                        todo.append(o)
            least = min(m[:2] for s in seen for m in sets[s])
            for s in seen:
                group[s] = None if least[0] else least[1]
    for k, members in sets.items():
        first = min(members)
        copy = None if first[0] else first[1]
        links = len(members) - 1 + sum(len(sets[o]) for o in near[k])
        for m in members:
            out[m[2]] = (group[k], copy, links, len(near[k]))
    return out


def check(df, rows):
    b = brute(rows)
    want = sorted(((rows[i][0], *b[i]) for i in range(len(rows))), key=str)
    assert sorted((tuple(r) for r in df.collect()), key=str) == want


def test_against_all_pairs(spark):
    docs = H.fixture_documents(spark, "/root/testdata/sf0.01")
    check(J.similarity_classes(docs), [(r["doc_id"], r["text"]) for r in docs.collect()])


@pytest.fixture(scope="module")
def copies():
    """A large group of near copies of one text, whose pairs lie on both sides of the threshold, and unrelated texts."""
    rng = random.Random(5)
    base = [f"w{i}" for i in range(160)]
    rows = []
    for i in range(260):
        w = list(base)
        for _ in range(rng.randint(0, 3)):
            w[rng.randrange(len(w))] = f"new{rng.randrange(40)}"
        rows.append((i, " ".join(w)))
    rows += [(1000 + i, " ".join(f"{i}x{j}" for j in range(30))) for i in range(40)]
    return rows


def test_a_large_group_in_blocks(spark, copies, monkeypatch):
    monkeypatch.setattr(J, "BLOCK_CLASSES", 40)
    df = spark.createDataFrame([(i, t, None, None, None) for i, t in copies], H.DOCS)
    check(J.similarity_classes(df), copies)


def test_one_per_group(spark, copies):
    rows = [(i, t, "en", None, 7) for i, t in copies] + [(i, t, "en", None, 7) for i, t in copies[:5]]
    df = spark.createDataFrame(rows, H.DOCS)
    kept = J.one_per_group(df)
    assert kept.columns == df.columns
    b = brute([(r[0], r[1]) for r in rows])
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted({b[i][0] for i in b})


def test_odd_and_empty_tables(spark):
    odd = H.odd_documents(spark)
    check(J.similarity_classes(odd), [(r[0], r[1]) for r in H.odd_rows()])
    kept = J.one_per_group(odd)
    assert kept.columns == odd.columns
    classes = {frozenset(H.grams(r[1])) or r[1] or "" for r in H.odd_rows()}
    assert len(kept.collect()) == len(classes) - 1  # two sets are near copies
    assert J.similarity_classes(H.empty_documents(spark)).count() == 0
    assert J.one_per_group(H.empty_documents(spark)).count() == 0


def test_texts_without_words_are_duplicates_of_equal_ones_only(spark):
    texts = ["!!! ???", "=== ---", "!!! ???", "", None, " ", "word", "=== --- "]
    df = spark.createDataFrame([(i, t, "en", None, 7) for i, t in enumerate(texts)], H.DOCS)
    check(J.similarity_classes(df), list(enumerate(texts)))
    assert sorted(r["doc_id"] for r in J.one_per_group(df).collect()) == [0, 1, 3, 5, 6, 7]


def test_bands_reach_the_recall():
    for threshold in (0.5, 0.8, 0.95):
        bands, rows = J.choose_bands(threshold, 0.999, 400)
        assert 1 - (1 - threshold ** rows) ** bands >= 0.999 and bands * rows <= 400


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(1, 60)] + [(200, 200 + i) for i in range(1, 80)] + [(500, 499), (499, 500), (700, 700)]
    got = {r["node"]: r["component"] for r in components.connected_components(
        spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()}
    want = {i: 1 for i in range(1, 61)} | {200 + i: 200 for i in range(80)} | {499: 499, 500: 499}
    assert got == want
