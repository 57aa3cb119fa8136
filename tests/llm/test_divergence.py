"""Operator 12 against the definition, term by term, and its bitmap parts."""

import random
import re
from collections import Counter, defaultdict

from tillroll.llm import divergence as D

from . import helpers as H

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def brute(rows, ranks=200):
    docs, groups, kept = defaultdict(Counter), defaultdict(Counter), {}
    for _, text, lang, source, _ in rows:
        terms = TERM.findall((text or "").translate(H.LOWER))
        docs[lang or ""].update(set(terms))
        groups[(lang or "", source or "")].update(terms)
    for lang in docs:
        kept[lang] = [t for t, n in docs[lang].items() if n >= 3]
    totals = defaultdict(Counter)
    for (lang, _), c in groups.items():
        totals[lang].update(c)

    def shares(counts, lang):
        size = sum(counts[t] for t in kept[lang])
        return {t: 1 + 10 ** 9 * (counts[t] + 1) // (size + len(kept[lang])) for t in kept[lang]}

    p = {g: shares(c, g[0]) for g, c in groups.items()}
    q = {lang: shares(c, lang) for lang, c in totals.items()}
    out = []
    for lang, source in groups:
        a = p[lang, source]
        pairs = [(t, sum((a[w] - b[w]) ** 2 // b[w] for w in a)) for (other, t), b in p.items() if other == lang and t != source]
        terms = [(w, (a[w] - q[lang][w]) ** 2 // q[lang][w]) for w in a if groups[lang, source][w] and a[w] > q[lang][w]]
        for part, found, most in (("pair", pairs, None), ("term", terms, ranks)):
            order = sorted(found, key=lambda x: (-x[1], x[0].encode()))[:most]
            out += [(lang, source, part, item, value, i + 1) for i, (item, value) in enumerate(order)]
    return sorted(out)


def check(df, rows, **kw):
    got = D.audited(df, **kw)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert sorted(tuple(r) for r in got.collect()) == brute(rows, **kw)


def test_zipf_texts_with_a_hot_source_against_the_definition(spark):
    rng = random.Random(3)
    vocabulary = [f"{a}{b}é" if rng.random() < 0.1 else f"{a}{b}" for a in ("Al", "be", "ce", "do") for b in map(chr, range(97, 123))]
    weights = [1 / (i + 1) for i in range(len(vocabulary))]
    rows = []
    for i in range(400):
        source = "hot" if i % 3 == 0 else f"s{rng.randrange(6)}"
        words = rng.choices(vocabulary, weights, k=rng.randrange(0, 60))
        rows.append((i, " ".join(words) + rng.choice(["", " 42", "1rare" + chr(97 + i % 26)]), rng.choice(["en", "de", None]), source, 1))
    rows.append((999, "12 34", "en", "no terms", 1))
    rows.append((1000, "lonely words", "xx", "only source", 1))
    check(spark.createDataFrame(rows, H.DOCS), rows, ranks=7)


def test_odd_rows_and_empty_table(spark):
    check(H.odd_documents(spark), H.odd_rows())
    assert D.audited(H.empty_documents(spark)).collect() == []


def test_blocks_count_terms_per_group(monkeypatch):
    import numpy as np

    texts = [b"One two2TWO", b"", b"two one one", "Ä ä".encode()]
    body = np.frombuffer(b"".join(texts), np.uint8)
    offsets = np.cumsum([0, *map(len, texts)])
    group, terms, n, docs = D._count_block(body, offsets, np.array([0, 0, 0, 1]))
    assert sorted(zip(group.tolist(), terms, n.tolist(), docs.tolist())) == sorted([
        (0, b"one", 3, 2), (0, b"two", 3, 2), (1, "Ä".encode(), 1, 1), (1, "ä".encode(), 1, 1)])


def test_shares_of_huge_counts_stay_exact(spark):
    from pyspark.sql import functions as F

    n, size, v = 12_345_678_901_234_567, 98_765_432_109_876_543, 1234
    got = spark.range(1).select(D.share(F.lit(n), F.lit(size), F.lit(v)).alias("p")).first()["p"]
    assert got == 1 + 10 ** 9 * (n + 1) // (size + v)
