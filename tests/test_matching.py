"""Name normalisation, the token-set scorer, and exactness of the prefix-filtered fuzzy join against brute force."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillroll.functions import similarity
from tillroll.functions.names import normalize_name
from tillroll.functions.similarity import indel_distance, token_set_ratio
from tillroll.operators import matching


@pytest.mark.parametrize("a,b,expected", [
    ("kitten", "sitting", 5), ("", "abc", 3), ("abc", "abc", 0), ("old", "cold", 1), ("ab", "ba", 2),
])
def test_indel(a, b, expected):
    assert indel_distance(a, b) == expected


@pytest.mark.parametrize("a,b,expected", [
    ("blue anvil", "blue anvil", 100.0),
    ("blue anvil and", "blue anvil", 100.0),          # subset -> 100
    ("old gear", "cold gear", 100 - 100 * 1 / 17),    # T={gear}: ratio('gear old', 'gear cold')
    ("abc", "xyz", 0.0),
    ("", "abc", 0.0),
    ("a b c d e", "a b c d x", 100 - 100 * 2 / 18),   # T+A vs T+B differ by one letter each side
])
def test_token_set_ratio(a, b, expected):
    assert token_set_ratio(a, b) == pytest.approx(expected)


def test_token_set_ratio_length_terms():
    # T dominates a: ratio(T, T+A) = 100 * (1 - (1 + len(A)) / (2 len(T) + 1 + len(A)))
    a, b = "international games x", "international games qqqqqqqqqq"
    sect = len("games international")
    assert token_set_ratio(a, b) == pytest.approx(100 - 100 * 2 / (2 * sect + 2))


def test_normalize_name(spark):
    rows = [("Société Générale & Fils Ltd.",), ("SMALL RING & Co, GmbH",), ("Þór ehf",), (None,), ("Acme Sp. z o.o.",),
            ("  Big   Corp  ",), ("Straße AG",)]
    df = spark.createDataFrame(rows, "n string").select(normalize_name("n").alias("x"))
    assert [r["x"] for r in df.collect()] == ["societe generale and fils", "small ring and", "thor ehf", "", "acme",
                                              "big", "strasse"]


def _brute(left, right, t, blocking=None):
    out = {}
    for a in left:
        if not a:
            continue
        pool = right
        if blocking:
            same = [b for b in right if b[:blocking] == a[:blocking]]
            pool = same or right
        best = None
        pool = [b for b in sorted(pool) if b]
        for b, s in zip(pool, similarity.token_set_ratios([a] * len(pool), pool).tolist()):
            if best is None or s > best[1]:
                best = (b, s)
        if best and best[1] >= t:
            out[a] = best
    return out


WORDS = ["games", "studio", "interactive", "entertainment", "thunder", "thunders", "old", "cold", "gear", "gears",
         "red", "rod", "blue", "soft", "software", "media", "digital", "publishing", "north", "norths", "ab", "x"]


def _random_names(rnd, n):
    names = set()
    while len(names) < n:
        k = rnd.randint(1, 4)
        toks = [rnd.choice(WORDS) for _ in range(k)]
        if rnd.random() < 0.3:
            i = rnd.randrange(k)
            w = toks[i]
            p = rnd.randrange(len(w) + 1)
            toks[i] = w[:p] + rnd.choice("aeiorst") + w[p:]
        names.add(" ".join(toks))
    return sorted(names)


@pytest.mark.parametrize("threshold,blocking", [(90, None), (80, None), (67, None), (90, 3)])
def test_fuzzy_join_is_exact(spark, threshold, blocking):
    rnd = random.Random(threshold + (blocking or 0))
    left, right = _random_names(rnd, 120), _random_names(rnd, 150)
    ldf = spark.createDataFrame([(x,) for x in left], "norm string")
    rdf = spark.createDataFrame([(x,) for x in right], "norm string")
    got = {r["l"]: (r["r"], r["score"]) for r in matching.best_matches(ldf, rdf, threshold, blocking).collect()}
    want = _brute(left, right, threshold, blocking)
    assert got.keys() == want.keys()
    for k in want:
        assert got[k][0] == want[k][0] and got[k][1] == pytest.approx(want[k][1])


def test_candidates_avoid_all_pairs(spark):
    # 300 dissimilar names sharing one frequent token: the token is in no name's prefix, so no hot group forms
    rnd = random.Random(5)
    names = sorted({"games " + "".join(rnd.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(9))
                    for _ in range(300)})
    df = spark.createDataFrame([(x,) for x in names], "norm string")
    pref = matching._prefixed(df, df, *matching._bounds(90))
    assert pref.where("kind = 't' AND key = 'games' AND pref").count() == 0  # the hot token indexes no name
    assert matching.candidate_pairs(df, df, 90).count() < 0.01 * len(names) ** 2


def test_a_hot_token_joins_only_prefixes(spark):
    # every name has the token 'games'; only the one-word name has it in its prefix
    rnd = random.Random(5)
    names = sorted({"games " + "".join(rnd.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(9)) for _ in range(300)} | {"games"})
    df = spark.createDataFrame([(x,) for x in names], "norm string").checkpoint()
    elements = matching._prefixed(df, df, *matching._bounds(90)).where("kind = 't'").checkpoint()
    joined = matching.prefix_joins(elements)
    # 'games' with all names from either side, and each name with itself by its own word from either side
    assert joined.count() == 2 * len(names) + 2 * (len(names) - 1)
    plan = joined._jdf.queryExecution().optimizedPlan().toString()
    conditions = [line for line in plan.splitlines() if "Join Inner" in line]
    assert len(conditions) == 3 and not any(" OR " in c for c in conditions)


def test_bit_parallel_distances_equal_the_table():
    def table(a, b):
        prev = [0] * (len(b) + 1)
        for x in a:
            cur = [0]
            for j, y in enumerate(b, 1):
                cur.append(prev[j - 1] + 1 if x == y else max(prev[j], cur[j - 1]))
            prev = cur
        return len(a) + len(b) - 2 * prev[-1]

    rnd = random.Random(2)
    texts = ["".join(rnd.choice("abcä日🙂 ") for _ in range(n)) for n in [0, 1, 2, 63, 64, 65, 127, 128, 129, 200, *(rnd.randrange(40) for _ in range(60))]]
    pairs = [(a, b) for a in texts for b in texts]
    got = similarity.indel_distances([a for a, _ in pairs], [b for _, b in pairs]).tolist()
    assert got == [table(a, b) for a, b in pairs]
    assert similarity.indel_distances([], []).tolist() == []


def test_scores_of_a_batch_equal_single_scores():
    rnd = random.Random(4)
    names = _random_names(rnd, 60) + ["", "  "]
    left, right = [a for a in names for _ in names] + [None], names * len(names) + ["x"]
    assert similarity.token_set_ratios(left, right).tolist() == [token_set_ratio(a, b) for a, b in zip(left, right)]


def test_candidates_of_word_list_names(spark):
    # names of 2-3 words from a 400-word list: what reaches the scorer is a vanishing share of all pairs
    rnd = random.Random(9)
    words = ["".join(rnd.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rnd.randint(4, 9))) for _ in range(400)]
    shares = []
    for n in (400, 1600):
        left, right = ([" ".join(rnd.choice(words) for _ in range(rnd.randint(2, 3))) for _ in range(n)] for _ in range(2))
        dfs = [spark.createDataFrame([(x,) for x in sorted(set(v))], "norm string") for v in (left, right)]
        shares.append(matching.candidate_pairs(*dfs, 90).count() / n ** 2)
    assert shares[1] < 0.01 and shares[0] < 0.01


@pytest.mark.parametrize("threshold,blocking", [(66.6, None), (60, None), (50, None), (60, 3), (15, None)])
def test_low_thresholds_equal_brute_force(spark, monkeypatch, threshold, blocking):
    monkeypatch.setattr(matching, "BLOCK_NAMES", 40)  # several blocks of either side
    rnd = random.Random(int(threshold) + (blocking or 0))
    left, right = _random_names(rnd, 120) + ["x" * 300 + " games", "日本 ゲーム"], _random_names(rnd, 150) + ["日本", "qqqq"]
    ldf = spark.createDataFrame([(x,) for x in left], "norm string")
    rdf = spark.createDataFrame([(x,) for x in right], "norm string")
    got = {r["l"]: (r["r"], r["score"]) for r in matching.best_matches(ldf, rdf, threshold, blocking).collect()}
    assert got == _brute(sorted(left), sorted(right), threshold, blocking)
    none = matching.best_matches(ldf, rdf.limit(0), threshold, blocking)
    assert none.count() == 0


def test_score_bounds_hold():
    rnd = random.Random(8)
    names = _random_names(rnd, 80) + ["a", "b a", "aa a", "日本", "🙂 日本 x"]
    bounds = matching.score_bounds(names, names)
    scores = similarity.token_set_ratios([a for a in names for _ in names], names * len(names)).reshape(bounds.shape)
    assert (scores <= bounds + 1e-4).all()
    assert (bounds < 50).mean() > 0.2  # the counts rule pairs out


def test_few_pairs_are_scored(monkeypatch):
    rnd = random.Random(3)
    words = ["".join(rnd.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rnd.randint(4, 9))) for _ in range(400)]
    left, right = (sorted({" ".join(rnd.choice(words) for _ in range(rnd.randint(2, 3))) for _ in range(600)}) for _ in range(2))
    seen, plain = [], matching.token_set_ratios
    monkeypatch.setattr(matching, "token_set_ratios", lambda a, b: seen.append(len(a)) or plain(a, b))
    matching.best_in_blocks(left, right, 50)
    assert sum(seen) < 0.1 * len(left) * len(right)


@pytest.mark.parametrize("threshold", [0, -5])
def test_thresholds_that_all_names_reach_are_refused(spark, threshold):
    df = spark.createDataFrame([("xaybzcw",)], "norm string")
    with pytest.raises(ValueError):
        matching.best_matches(df, df, threshold)


def test_names_of_other_scripts(spark):
    rows = [("Газпром Игры",), ("Ελλάς Ώρα ΑΕ",), ("ＡＣＭＥ ｌｔｄ",), ("Ștefan Việt",), ("ACME™",), ("株式会社テスト",)]
    df = spark.createDataFrame(rows, "n string").select(normalize_name("n").alias("x"))
    assert [r["x"] for r in df.collect()] == ["gazprom igry", "ellas ora ae", "acme", "stefan viet", "acmetm", "株式会社tesuto"]


def test_accents_and_syllables(spark):
    import unicodedata

    rows = [("İstanbul",), (unicodedata.normalize("NFD", "Société Générale"),), ("한국 게임",), ("ゲームかぶしき",), ("हिन्दी & Co",),
            ("שָׁלוֹם",), (unicodedata.normalize("NFD", "Ștefan"),), ("ラーメン",)]
    df = spark.createDataFrame(rows, "n string").select(normalize_name("n").alias("x"))
    assert [r["x"] for r in df.collect()] == ["istanbul", "societe generale", "hangug geim", "gemukabushiki", "हिन्दी and", "שלום",
                                              "stefan", "ramen"]


def test_fuzzy_join_empty_and_ties(spark):
    left = spark.createDataFrame([("ACME Ltd",), ("Ltd.",), (None,)], "pub string")
    right = spark.createDataFrame([("acme", 1), ("ACME", 2), ("zzz", 3)], "supplier_name string, v int")
    out = {r["pub"]: r for r in matching.fuzzy_join(left, right, "pub", "supplier_name").collect()}
    assert out["ACME Ltd"]["supplier_name"] == "ACME" and out["ACME Ltd"]["match_score"] == 100.0
    assert out["Ltd."]["supplier_name"] is None and out[None]["supplier_name"] is None
