"""Operators 4, 5 and 7 against plain versions and exact round trips; the pipeline against its operators."""

import base64
import gzip
import hashlib
import random
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tillroll.llm import fingerprints as FP
from tillroll.llm import queries, sharding, warc

from . import helpers as H


def plain_edits(rows):
    """(n_chars, sha256 of the edited text) per row in ascending doc_id order."""
    out = []
    for i, (_, text) in enumerate(rows):
        text, after = text or "", rows[(i + 1) % len(rows)][1] or ""
        half = len(text) // 2
        out.append((len(text), hashlib.sha256((text[:len(text) - half] + after[:half]).encode()).hexdigest()))
    return out


@pytest.mark.parametrize("partitions", [1, 4])
def test_fingerprints_of_documents(spark, sf001, partitions):
    docs = H.fixture_documents(spark, sf001).withColumn("bucket", F.lit("clash"))
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        got = sorted(FP.fingerprints(docs).collect(), key=lambda r: r["doc_id"])
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    rows = sorted((r["doc_id"], r["text"]) for r in docs.collect())
    assert [(r["n_chars"], r["edited_sha256"]) for r in got] == plain_edits(rows)
    prints = defaultdict(set)
    for r, (_, text) in zip(got, rows):
        prints[text].add(r["fingerprint"])
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
    assert all(len(p) == 1 for p in prints.values())
    assert sum(r["near_edited"] > r["near_next"] for r in got) > 0.8 * len(got)


def test_fingerprints_are_homomorphic(spark):
    a, b = "one line\ntwo lines. And a sentence!\nthree", "four\nfive"
    df = spark.createDataFrame([(a, b, "four\nthree\nAnd a sentence!\none line\ntwo lines.\nfive", "", None)],
                               "a string, b string, both string, none string, nil string")
    lanes = {c: FP.lanes(FP.paragraph_hashes(F.col(c))) for c in df.columns}
    r = df.select((FP.added(lanes["a"], lanes["b"]) == lanes["both"]).alias("add"),
                  (FP.removed(lanes["both"], lanes["b"]) == lanes["a"]).alias("remove"),
                  FP.likeness(lanes["a"], lanes["a"]).alias("same"), FP.likeness(lanes["a"], lanes["b"]).alias("other"),
                  FP.likeness(lanes["none"], lanes["nil"]).alias("empty"), FP.likeness(lanes["both"], lanes["a"]).alias("part"),
                  FP.as_text(lanes["none"]).alias("text")).first()
    assert r["add"] and r["remove"] and r["same"] == r["empty"] == 1 and r["other"] < 0.3 and 0.6 < r["part"] < 0.95
    assert r["text"].startswith("0:")


def test_likeness_counts_repeated_paragraphs(spark):
    """Against the exact overlap of the multisets, on texts with repeated lines, few and many lines, light and heavy ones."""
    rng = random.Random(7)
    lines = [f"line {i} of the collection" for i in range(3000)]
    texts = [(["p"] * 1000, ["q"] * 1000), (["p"] * 1000, ["p"] * 500 + ["q"] * 500), (["p"] * 9 + ["q"], ["p"] * 10), (["p"], ["q"]),
             (lines[:400] + ["p"] * 400, lines[:400] + ["q"] * 400), (lines[:300] * 5, lines[150:450] * 5), (lines[:900], lines[900:1800])]
    for _ in range(60):
        pool = rng.sample(lines, rng.choice([3, 20, 100, 500]))
        one = rng.choices(pool, [1 / (i + 1) for i in range(len(pool))], k=rng.choice([10, 100, 1000, 3000]))
        other = [x for x in one if rng.random() < rng.choice([0.3, 0.7, 1])] + rng.choices(lines, k=rng.choice([0, 5, len(one) // 2]))
        texts.append((one, other))
    df = spark.createDataFrame([(i, "\n".join(a), "\n".join(b)) for i, (a, b) in enumerate(texts)], "i int, a string, b string")
    hashes = FP.C.written(df.select("i", FP.paragraph_hashes(F.col("a")).alias("a"), FP.paragraph_hashes(F.col("b")).alias("b")), "test")
    lanes = FP.C.written(hashes.select("i", FP.lanes(F.col("a")).alias("a"), FP.lanes(F.col("b")).alias("b")), "test")
    got = {r["i"]: r["n"] for r in lanes.select("i", FP.likeness(F.col("a"), F.col("b")).alias("n")).collect()}
    off = []
    for i, (a, b) in enumerate(texts):
        x, y = Counter(a), Counter(b)
        off.append(abs(got[i] - 2 * sum((x & y).values()) / (len(a) + len(b))))
    assert max(off[:4]) < 0.01, off[:4]
    assert max(off) < 0.25 and sorted(off)[int(len(off) * 0.9)] < 0.1, sorted(off)[-12:]


def test_fingerprints_of_awkward_tables(spark):
    rows = [r for r in H.odd_rows() if r[0] is not None]
    odd = H.odd_documents(spark).where("doc_id is not null")
    got = Counter((r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in FP.fingerprints(odd).collect())
    order = sorted(((r[0], r[1]) for r in rows), key=lambda r: r[0])
    assert got == Counter((d, *e) for (d, _), e in zip(order, plain_edits(order)))
    assert FP.fingerprints(H.odd_documents(spark)).count() == len(H.odd_rows())
    assert FP.fingerprints(H.empty_documents(spark)).count() == 0
    one = spark.createDataFrame([(5, "abcd")], "doc_id long, text string")
    assert FP.fingerprints(one).first()["edited_sha256"] == hashlib.sha256(b"abab").hexdigest()
    plan = FP.fingerprints(odd)._jdf.queryExecution().optimizedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


PAGES = "page_id long, url string, html string"


def plain_records(rows, least=0):
    first = {}
    for page, _, html in rows:
        if page is not None and len((html or "").encode()) >= least:
            first[html or ""] = min(page, first.get(html or "", page))
    out = []
    for page, _, html in rows:
        raw = (html or "").encode()
        other = first.get(html or "") if len(raw) >= least else None
        revisit = other is not None and page != other
        out.append((page, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(),
                    "revisit" if revisit else "response", other if revisit else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("least", [0, 20])
def test_archives_round_trip(spark, sf001, monkeypatch, least):
    monkeypatch.setattr(warc, "CHUNK_BYTES", 1000)
    pages = spark.read.parquet(f"{sf001}/pages.parquet")
    rows = [(r["page_id"], r["url"], r["html"]) for r in pages.collect()]
    big = "<p>é\r\n\r\nWARC/1.1\r\n" * 4000
    rows += [(9001, "http://x/\r\nBad: 1 ü", big), (9002, None, big), (9003, "u", None), (9004, "u", ""), (9000, "u", big),
             (9005, "u", "short"), (9006, "u", "short"), (None, "u", "short"), (9006, "u", "short")]
    df = spark.createDataFrame(rows, PAGES).withColumn("sha1", F.lit("clash")).withColumn("n", F.lit(1))
    got = sorted((tuple(r) for r in warc.round_trip(df, revisit_bytes=least).collect()), key=str)
    assert got == plain_records(rows, least)


def test_archives_are_plain_warc_and_chunks_add_up(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "CHUNK_BYTES", 7)
    uri = f"file://{tmp_path}/a.warc.gz"
    out = warc.ArchiveWriter(uri, "2024-01-01T00:00:00Z")
    out.record(1, "http://a/b c", memoryview(b"0123456789abcdef"), None)
    out.record(2, None, memoryview(b"0123456789abcdef"), 1)
    out.close()
    text = gzip.open(f"{tmp_path}/a.warc.gz").read()
    assert text.startswith(b"WARC/1.1\r\nWARC-Type: response\r\n") and text.count(b"0123456789abcdef") == 1
    rows = list(warc.read_archive(uri))
    assert [(r[0], r[5], r[6], r[8]) for r in rows] == [
        (1, 0, b"0123456", False), (1, 1, b"789abcd", False), (1, 2, b"ef", True), (2, 0, b"", True)]
    sums = [base64.b32encode(hashlib.sha1(x).digest()).decode() for x in (b"0123456", b"0123456789abcd", b"0123456789abcdef")]
    assert [r[7] for r in rows] == [*sums, sums[-1]] and rows[3][3] == 1 and rows[0][1] == "http://a/b%20c"


def test_archives_of_an_empty_table(spark):
    assert warc.round_trip(spark.createDataFrame([], PAGES)).count() == 0


def check_shards(rows, texts, shards=8):
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in rows) == Counter(
        (d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t in texts)
    slots, weight = defaultdict(list), Counter()
    for r in rows:
        assert r["law"] == "bytes" and 0 <= r["shard"] < shards and r["grown_shard"] is None
        slots[r["shard"]].append(r["slot"])
        weight[r["shard"]] += r["size"]
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    return weight


def test_shards_are_near_equal_and_keep_copies(spark, monkeypatch):
    monkeypatch.setattr(sharding, "SLOT_ROWS", 30)
    docs = H.fixture_documents(spark, "/root/testdata/sf0.01")
    rows = sharding.sharded(docs).collect()
    texts = [(r["doc_id"], r["text"]) for r in docs.collect()]
    weight = check_shards(rows, texts)
    mean = sum(weight.values()) / 8
    assert all(abs(weight[s] - mean) < 0.05 * mean for s in range(8))
    by_id = {r["doc_id"]: r for r in rows}
    where = defaultdict(set)
    for d, t in texts:
        where[t].add(by_id[d]["shard"])
    assert all(len(s) == 1 for s in where.values())


def test_a_group_stays_whole_if_a_shard_has_room(spark):
    # groups of about 5, 30 and 60 % of a shard, and one of a third of all bytes, beside single texts
    texts = [("five " * 20, 40), ("thirty " * 20, 240), ("sixty " * 20, 480), ("third " * 20, 3000)]
    rows = [t for t, n in texts for _ in range(n)] + [f"single {i} " * 10 for i in range(4000)]
    docs = spark.createDataFrame([(i, t, f"l{i % 4}", f"s{i % 7}", None) for i, t in enumerate(rows)], H.DOCS)
    got = sharding.sharded(docs).collect()
    weight = check_shards(got, list(enumerate(rows)))
    mean = sum(weight.values()) / 8
    assert all(abs(weight[s] - mean) < 0.02 * mean for s in range(8))
    shard = {r["doc_id"]: r["shard"] for r in got}
    where = defaultdict(set)
    for i, t in enumerate(rows):
        where[t].add(shard[i])
    assert [len(where[t]) for t, _ in texts[:3]] == [1, 1, 1] and len(where[texts[3][0]]) > 1
    assert all(len(s) == 1 for t, s in where.items() if t != texts[3][0])


def test_heavy_groups_are_dealt_by_room():
    room = [10.0] * 4
    parts = sharding.deal_heavy([9, 9, 8, 6, 5, 3], room)
    assert [[s for _, s in p] for p in parts[:4]] == [[0], [1], [2], [3]]
    assert [len(p) for p in parts] == [1, 1, 1, 1, 2, 3]
    assert all(abs(sum(x for x, _ in p) - 1) < 1e-9 for p in parts) and abs(sum(room)) < 1e-9


def test_sources_count_by_their_whole_names(spark):
    def shards_of(name):
        rows = [(i, f"text {i:05d}", "en", name.format(i % 16), None) for i in range(3200)]
        got = {r["doc_id"]: r["shard"] for r in sharding.sharded(spark.createDataFrame(rows, H.DOCS)).collect()}
        return [frozenset(got[i] for i in range(s, 3200, 16)) for s in range(16)]

    short, long = shards_of("{:02d}"), shards_of("https://example.org/source-{:02d}")
    assert short == long and max(map(len, short)) <= 2  # two sources fill a shard: the cuts run between them


def test_a_text_with_a_third_of_all_bytes_is_split(spark):
    texts = [(i, "hot text " * 20 if i % 3 == 0 else f"text {i} " * (10 + i % 30)) for i in range(6000)]
    docs = spark.createDataFrame([(i, t, f"l{i % 4}", f"s{i % 7}", None) for i, t in texts], H.DOCS)
    weight = check_shards(sharding.sharded(docs).collect(), texts)
    mean = sum(weight.values()) / 8
    assert all(abs(weight[s] - mean) < 0.04 * mean for s in range(8))


def test_shards_of_awkward_tables(spark):
    odd = H.odd_documents(spark)
    check_shards(sharding.sharded(odd).collect(), [(r[0], r[1]) for r in H.odd_rows()])
    check_shards(sharding.sharded(odd, shards=3).collect(), [(r[0], r[1]) for r in H.odd_rows()], 3)
    assert sharding.sharded(H.empty_documents(spark)).count() == 0


def test_registered_queries_cover_the_operators():
    assert sorted(int(k[2:].split("_")[0]) for k in queries.queries()) == list(range(1, 14))


def test_pipeline_stages_take_effect(spark, sf001):
    docs = H.fixture_documents(spark, sf001)
    before, counts = docs, []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, before, sf001).persist()
        assert after.schema == docs.schema, name
        assert {r["doc_id"] for r in after.select("doc_id").collect()} <= {r["doc_id"] for r in before.select("doc_id").collect()}
        counts.append(after.count())
        before = after
    assert counts[0] <= docs.count() and counts[1] < counts[0] and counts[2] < counts[1] and counts[3] == counts[2]
    packed = corpus_pipeline.STAGES[-1][1](spark, before, sf001)
    assert {r["doc_id"] for r in packed.collect()} == {r["doc_id"] for r in before.collect()}


def test_pipeline_of_an_empty_table(spark, sf001):
    docs = H.empty_documents(spark)
    for _, stage in corpus_pipeline.STAGES[1:]:
        docs = stage(spark, docs, sf001)
        assert docs.count() == 0
