"""Operator 1: held-out accuracy, gradients, whole texts, awkward tables."""

import zlib

import numpy as np

from tillroll.llm import quality_cnn as Q

from . import helpers as H

SMALL = Q.FitLimits(per_label=200, epochs=25, batch=16)


def rows_of(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet")


def test_held_out_accuracy(spark):
    docs, labels = rows_of(spark, "/root/testdata/sf0.01")
    got = {r["doc_id"]: r for r in Q.classified(docs, labels, SMALL).collect()}
    assert len(got) == docs.count()
    known = {r["doc_id"]: r["quality"] for r in labels.collect()}
    held = [i for i in known if zlib.crc32(str(i).encode()) % 5 == 0]
    for i, r in got.items():
        assert r["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) and 0 <= r["score"] <= 1
        assert r["predicted"] == int(r["score"] >= 0.3)
    good, bad = ([got[i]["score"] for i in held if known[i] == k] for k in (1, 0))
    pairs = [(g > b) + 0.5 * (g == b) for g in good for b in bad]
    assert np.mean(pairs) > 0.9
    assert np.mean([s >= 0.3 for s in good]) > 0.95


def test_scores_do_not_depend_on_blocks(monkeypatch):
    net = Q.Network(3)
    rng = np.random.default_rng(0)
    texts = [bytes(rng.integers(32, 250, n, dtype=np.uint8)) for n in (0, 1, 3, 4, 15, 16, 17, 500, 3000)]
    body, offsets = np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)])
    whole = net.scores(body, offsets)
    monkeypatch.setattr(Q, "PASS_BYTES", 64)
    assert np.allclose(whole, net.scores(body, offsets), atol=1e-6)
    for i, t in enumerate(texts):  # a plain version: every chunk of the text alone
        padded = np.frombuffer(t + bytes(Q.CHUNK), np.uint8)
        best = np.zeros(Q.FILTERS)
        for at in range(0, len(t), Q.STRIDE):
            z = net.p["vectors"][padded[at:at + Q.CHUNK]].reshape(-1) @ net.p["filters"] + net.p["bias"]
            best = np.maximum(best, z)
        p = 1 / (1 + np.exp(-(best @ net.p["weights"] + net.p["offset"][0])))
        assert abs(p - whole[i]) < 1e-5


def test_gradients_match_differences():
    net = Q.Network(5)
    texts, labels = [b"some words here and there", b"%%%$$$ !!", b""], np.array([1, 0, 1], np.float32)

    def loss():
        body, offsets = np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)])
        s = net.scores(body, offsets)
        return -np.mean(labels * np.log(s) + (1 - labels) * np.log(1 - s))

    grads = net._gradients(texts, labels)
    for name, place in (("bias", 3), ("offset", 0), ("vectors", (ord("e"), 2))):
        old = net.p[name][place]
        net.p[name][place] = old + 1e-2
        up = loss()
        net.p[name][place] = old - 1e-2
        down = loss()
        net.p[name][place] = old
        assert abs((up - down) / 2e-2 - grads[name][place]) < 2e-3


def test_odd_and_empty_tables(spark):
    docs, labels = rows_of(spark, "/root/testdata/sf0.001")
    few = Q.FitLimits(per_label=20, epochs=2, batch=8)
    odd = H.odd_documents(spark)
    net = Q.fit(docs, labels, few)
    rows = Q.scored(odd, net).collect()
    assert len(rows) == len(H.odd_rows()) and all(0 <= r["score"] <= 1 for r in rows)
    assert len({round(r["score"], 6) for r in rows if r["doc_id"] == 4}) == 1
    none = labels.limit(0)
    assert {r["score"] for r in Q.classified(odd, none).collect()} == {0.5}
    kept = Q.accepted(odd, none)
    assert kept.columns == odd.columns and kept.count() == len(H.odd_rows())
    assert Q.classified(H.empty_documents(spark), none).count() == 0
    nulls = spark.createDataFrame([(None, 1, 0), (3, None, 0), (3, 1, 0), (3, 1, 0)], "doc_id long, quality int, toxic int")
    assert all(r["score"] > 0.9 for r in Q.classified(odd, nulls).collect())


def test_labels_without_usable_documents(spark):
    docs, labels = rows_of(spark, "/root/testdata/sf0.001")
    few = Q.FitLimits(per_label=3, epochs=2, batch=8)
    assert Q.classified(H.empty_documents(spark), labels, few).count() == 0
    # the labels with the smallest hashes belong to no document, or to texts beyond the limit
    shift = 10_000_000
    more = labels.unionByName(labels.select((labels["doc_id"] + shift).alias("doc_id"), *labels.columns[1:]))
    long = docs.limit(1).crossJoin(spark.range(shift, shift + 40)).selectExpr(
        "id as doc_id", "repeat('x', 70000) as text", "lang", "source", "n_chars")
    got = Q.fit(docs.unionByName(long), more, few)
    want = Q.fit(docs, labels, few)
    assert all((got.p[k] == want.p[k]).all() for k in ("vectors", "filters", "weights"))
    alone = docs.where("false").unionByName(long.limit(1).selectExpr("0L as doc_id", "text", "lang", "source", "n_chars"))
    one = spark.createDataFrame([(0, 1), (1, 0)], "doc_id long, quality int")
    assert Q.classified(alone, one, few).count() == 1


def test_pipeline_of_an_empty_table_with_labels(spark, sf001):
    import corpus_pipeline

    docs = H.empty_documents(spark)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf001)
        assert docs.count() == 0
