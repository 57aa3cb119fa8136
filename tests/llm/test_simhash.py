"""Operator 13: fingerprints and links against all pairs."""

import random

import numpy as np
import pytest
import xxhash

from tillroll.llm import simhash_trie as T

from . import helpers as H


def plain(text):
    """The fingerprint by its definition."""
    words, word = [], ""
    for ch in (text or "").translate(H.LOWER) + " ":
        if ch == " " or "\x09" <= ch <= "\x0d":
            if word:
                words.append(word)
            word = ""
        else:
            word += ch
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(fps):
    """fingerprint -> a name of its component, over all pairs."""
    fps = sorted(set(fps))
    name = {f: f for f in fps}
    values = np.array(fps, np.uint64)
    for i, f in enumerate(fps):
        for j in np.flatnonzero(np.bitwise_count(values ^ values[i]) <= 2):
            a, b = name[f], name[fps[j]]
            if a != b:
                name = {k: a if v == b else v for k, v in name.items()}
    return name


def brute(rows):
    fps = [plain(r[1]) for r in rows]
    name = components(fps)
    least = {}
    for r, f in zip(rows, fps):
        least.setdefault(name[f], []).append(r[0])
    least = {k: min((x for x in v if x is not None), default=None) for k, v in least.items()}
    return sorted(((r[0], f"{f:016x}", least[name[f]]) for r, f in zip(rows, fps)), key=str)


def test_odd_rows_and_empty_table(spark):
    got = T.near_duplicates(H.odd_documents(spark))
    assert got.columns == ["doc_id", "fingerprint", "component_id"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(H.odd_rows())
    assert T.near_duplicates(H.empty_documents(spark)).collect() == []


def test_fingerprints_are_cut_at_white_space_only():
    for text in ("A b c d", "x\x1cy z w\x85q", "one", "one Two", "a\x0bb\x0cc\rd\ne\tf", "  é É", "k " * 70_000):
        assert T.simhash(text.encode()) == plain(text), text[:20]


@pytest.fixture(scope="module")
def prints():
    """Clusters of near fingerprints, chains, random ones, and all within two bits of one, in a part."""
    rng = random.Random(11)
    out = {rng.getrandbits(64) for _ in range(500)}
    for _ in range(60):
        f = rng.getrandbits(64)
        for _ in range(rng.randrange(1, 6)):
            out.add(f)
            for _ in range(rng.randrange(1, 4)):
                f ^= 1 << rng.randrange(64)
    center = rng.getrandbits(64)
    out |= {center ^ (1 << a) ^ (1 << b) for a in range(0, 64, 3) for b in range(64)}
    return sorted(out | {0, 1, (1 << 64) - 1, 1 << 63})


def test_links_of_one_task_are_all_pairs(prints):
    v = np.array(prints, np.uint64)
    want = {(i, j) for i in range(len(v)) for j in np.flatnonzero(np.bitwise_count(v ^ v[i]) <= 2).tolist() if i < j}
    got = [(int(a), int(b)) for i, j in T.trie_links(v, v, 2, True) for a, b in zip(i, j)]
    assert len(got) == len(set(got)) and set(got) == want
    left, right = v[::2], v[1::2]
    found = {(int(left[a]), int(right[b])) for i, j in T.trie_links(left, right) for a, b in zip(i, j)}
    assert found == {(int(a), int(b)) for a in left for b in right[np.bitwise_count(right ^ a) <= 2]}


def test_small_frontiers_find_the_same(prints, monkeypatch):
    v = np.array(prints, np.uint64)
    every = sum(len(i) for i, _ in T.trie_links(v, v, 2, True))
    monkeypatch.setattr(T, "FRONTIER", 16)
    assert sum(len(i) for i, _ in T.trie_links(v, v, 2, True)) == every


@pytest.mark.parametrize("leaf_size,stride", [(4096, 3), (600, 6)])
def test_components_over_the_split_trie(spark, prints, leaf_size, stride):
    from tillroll.llm.components import connected_components

    signed = [(int(np.uint64(f).astype(np.int64)),) for f in prints]
    df = spark.createDataFrame(signed, "fp long")
    edges = T.C.written(T.linked(df, leaf_size=leaf_size, stride=stride), "test-edges")
    got = {r["node"] % (1 << 64): r["component"] for r in connected_components(edges, "u", "v").collect()}
    name = components(prints)
    assert {f for f in prints if f not in got} == {f for f in prints if list(name.values()).count(name[f]) == 1}
    groups = {}
    for f, c in got.items():
        groups.setdefault(c, set()).add(name[f])
    assert all(len(x) == 1 for x in groups.values()) and len(groups) == len({name[f] for f in got})
