"""Operator 1: quality scores from a byte-level convolutional network in numpy.

Every byte has a learned vector. A filter looks at CHUNK bytes; chunks overlap and begin every STRIDE bytes, from a
text's first byte to its last. Each filter's largest response over all chunks of the whole text (at least 0) is one
feature, and a logistic layer combines the features into one probability. The network is fitted on the driver with a
bounded sample of labelled documents (FitLimits); the scores are computed in one pass over the documents, in tasks,
block by block, so that memory does not grow with a text.

Defined results: a null or empty text has no chunk, all its features are 0 and its score is that of the logistic bias;
labels that are null or belong to no document are ignored, of several labels of a doc_id the smallest holds; of several texts of a doc_id the
smallest is in the sample; without a usable text of both kinds every score is
the share of label 1 (0.5 without labels); repeated documents each get a row; an empty table gives an empty result;
other columns are ignored."""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C

STRIDE, CHUNK, VECTOR, FILTERS = 4, 16, 8, 32
GROUPS = CHUNK // STRIDE
#: Bytes of text that one pass of the network covers.
PASS_BYTES = 1 << 13
#: A document is predicted to have label 1 from this score on.
ACCEPT = 0.3


@dataclass(frozen=True)
class FitLimits:
    """Bounds of the sample that the network is fitted on: documents of each label, bytes of one document, bytes in all."""

    per_label: int = 2500
    document_bytes: int = 1 << 16
    total_bytes: int = 24 << 20
    epochs: int = 12
    batch: int = 32
    seed: int = 7


def _segments(offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, first byte, end byte) of the pieces of at most PASS_BYTES that texts are cut into; empty texts have none."""
    length = np.diff(offsets)
    pieces = -(-length // PASS_BYTES)
    row = np.repeat(np.arange(len(length)), pieces)
    nth = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    low = offsets[:-1][row] + nth * PASS_BYTES
    return row, low, np.minimum(low + PASS_BYTES, offsets[1:][row])


def _laid_out(body, offsets, row, low, high) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, first group, chunks) of segments laid out in whole strides; the bytes of a last chunk that reaches over its segment's end are the text's next ones, and zeros after the text."""
    chunks = -(-(high - low) // STRIDE)
    groups = chunks + GROUPS - 1
    first = np.cumsum(groups) - groups
    flat = np.zeros(int(groups.sum()) * STRIDE, np.uint8)
    end = offsets[1:][row]
    for a, z, at, g in zip(low.tolist(), end.tolist(), first.tolist(), groups.tolist()):
        part = body[a:min(z, a + g * STRIDE)]
        flat[at * STRIDE:at * STRIDE + len(part)] = part
    return flat, first, chunks


class Network:
    """vectors (256, VECTOR), filters (CHUNK * VECTOR, FILTERS), bias (FILTERS), weights (FILTERS), offset."""

    def __init__(self, seed: int):
        rng = np.random.default_rng(seed)
        self.p = {"vectors": rng.normal(0, 0.5, (256, VECTOR)), "filters": rng.normal(0, (CHUNK * VECTOR) ** -0.5,
                  (CHUNK * VECTOR, FILTERS)), "bias": np.zeros(FILTERS), "weights": rng.normal(0, 0.3, FILTERS),
                  "offset": np.zeros(1)}
        self.p = {k: v.astype(np.float32) for k, v in self.p.items()}

    def responses(self, flat: np.ndarray) -> np.ndarray:
        """The filters' responses at every group as if all bytes were one text."""
        a = self.p["vectors"][flat].reshape(-1, STRIDE * VECTOR)
        w = self.p["filters"].reshape(GROUPS, STRIDE * VECTOR, FILTERS)
        n = len(a) - GROUPS + 1
        z = a[:n] @ w[0]
        for g in range(1, GROUPS):
            z += a[g:g + n] @ w[g]
        return z

    def features(self, body: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        rows = len(offsets) - 1
        best = np.zeros((rows, FILTERS), np.float32)
        row, low, high = _segments(offsets)
        i = 0
        while i < len(row):
            j, held = i, 0
            while j < len(row) and (j == i or held + int(high[j] - low[j]) <= PASS_BYTES):
                held += int(high[j] - low[j])
                j += 1
            flat, first, chunks = _laid_out(body, offsets, row[i:j], low[i:j], high[i:j])
            z = self.responses(flat)
            bounds = np.empty(2 * (j - i), np.int64)
            bounds[0::2], bounds[1::2] = first, first + chunks
            z = np.concatenate([z, np.zeros((1, FILTERS), np.float32)])
            top = np.maximum.reduceat(z, bounds, axis=0)[0::2] + self.p["bias"]
            np.maximum.at(best, row[i:j], top)
            i = j
        return best

    def scores(self, body: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        x = self.features(body, offsets).astype(np.float64) @ self.p["weights"].astype(np.float64)
        return 1 / (1 + np.exp(-np.clip(x + float(self.p["offset"][0]), -40, 40)))

    def fit(self, texts: list[bytes], labels: np.ndarray, limits: FitLimits, prior: float) -> "Network":
        """Adam on the log loss of class-balanced batches; the gradient of a maximum goes to the chunk that has it.
        Afterwards the offset is moved from balanced classes to the share `prior` of label 1."""
        rng = np.random.default_rng(limits.seed)
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        v = {k: np.zeros_like(x) for k, x in self.p.items()}
        kinds = [np.flatnonzero(labels == k) for k in (0, 1)]
        half, step = limits.batch // 2, 0
        steps = limits.epochs * max(1, max(map(len, kinds)) // half)
        for step in range(1, steps + 1):
            pick = np.concatenate([rng.choice(k, half) for k in kinds])
            grads = self._gradients([texts[i] for i in pick], labels[pick])
            rate = 0.004 * min(1, step / 30) * (1 - 0.95 * step / steps)
            for k, g in grads.items():
                m[k] = 0.9 * m[k] + 0.1 * g
                v[k] = 0.999 * v[k] + 0.001 * g * g
                self.p[k] = (self.p[k] - rate * (m[k] / (1 - 0.9 ** step)) /
                             (np.sqrt(v[k] / (1 - 0.999 ** step)) + 1e-8)).astype(np.float32)
        self.p["offset"] = self.p["offset"] + np.float32(np.log(prior / (1 - prior)))
        return self

    def _gradients(self, texts: list[bytes], labels: np.ndarray) -> dict[str, np.ndarray]:
        p, n = self.p, len(texts)
        top = np.zeros((n, FILTERS), np.float32)
        at = np.zeros((n, FILTERS, CHUNK), np.uint8)
        live = np.zeros((n, FILTERS), bool)
        for i, t in enumerate(texts):
            if not t:
                continue
            body, offsets = np.frombuffer(t, np.uint8), np.array([0, len(t)])
            for low in range(0, len(t), PASS_BYTES):
                high = min(len(t), low + PASS_BYTES)
                flat, _, _ = _laid_out(body, offsets, np.array([0]), np.array([low]), np.array([high]))
                z = self.responses(flat)
                where = z.argmax(0)
                best = z[where, np.arange(FILTERS)] + p["bias"]
                up = best > top[i]
                top[i, up] = best[up]
                live[i] |= up
                at[i, up] = flat[(where[up] * STRIDE)[:, None] + np.arange(CHUNK)]
        score = 1 / (1 + np.exp(-(top @ p["weights"] + p["offset"])))
        d = ((score - labels) / n).astype(np.float32)
        d_top = d[:, None] * p["weights"] * live
        x = p["vectors"][at].reshape(n, FILTERS, CHUNK * VECTOR)
        d_x = d_top[:, :, None] * p["filters"].T[None]
        d_vec = np.zeros((256, VECTOR), np.float32)
        np.add.at(d_vec, at.reshape(-1), d_x.reshape(-1, VECTOR))
        return {"vectors": d_vec, "filters": np.einsum("nf,nfk->kf", d_top, x) + 1e-4 * p["filters"],
                "bias": d_top.sum(0), "weights": top.T @ d + 1e-4 * p["weights"], "offset": np.array([d.sum()], np.float32)}


def fit(documents: DataFrame, labels: DataFrame, limits: FitLimits = FitLimits()) -> Network:
    """Fit the network on labelled rows with crc32(doc_id as text) mod 5 other than 0. The sample: of each label the
    `per_label` documents of at most `document_bytes` with the smallest hashed doc_id, taken from both labels in turn up
    to `total_bytes`."""
    known = C.text_rows(labels, "doc_id", "quality").where("doc_id is not null and quality in (0, 1)")
    known = known.groupBy("doc_id").agg(F.min("quality").alias("quality")).where(~held_out("doc_id"))
    texts = C.text_rows(documents, "doc_id", "text")
    usable = F.coalesce(F.octet_length("text") <= limits.document_bytes, F.lit(False))
    present = texts.where("doc_id is not null").groupBy("doc_id").agg(F.max(usable).alias("usable"))
    known = C.written(known.join(present, "doc_id"), "labelled")
    shares = {r["quality"]: r["n"] for r in known.groupBy("quality").agg(F.count("*").alias("n")).collect()}
    share = shares.get(1, 0) / sum(shares.values()) if shares else 0.5
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    sample = None
    for k in (0, 1):
        one = known.where((F.col("quality") == k) & F.col("usable")).orderBy(*order).limit(limits.per_label)
        sample = one if sample is None else sample.unionByName(one)
    # the sample's size is a parameter, so it may be broadcast
    rows = texts.where(usable).join(F.broadcast(sample), "doc_id").select(
        "doc_id", "quality", F.col("text").cast("binary").alias("body"))
    rows = rows.groupBy("doc_id", "quality").agg(F.min("body").alias("body")).orderBy(*order)
    found: dict[int, list[bytes]] = {0: [], 1: []}
    for r in rows.collect():
        found[r["quality"]].append(bytes(r["body"]))
    bodies, kinds, held = [], [], 0
    for pair in itertools.zip_longest(found[0], found[1]):
        for k, body in enumerate(pair):
            if body is not None and held + len(body) <= limits.total_bytes:
                held += len(body)
                bodies.append(body)
                kinds.append(k)
    net = Network(limits.seed)
    if len(set(kinds)) < 2:
        net.p = {k: np.zeros_like(v) for k, v in net.p.items()}
        prior = min(max(share, 1e-6), 1 - 1e-6)
        net.p["offset"] = np.array([np.log(prior / (1 - prior))], np.float32)
        return net
    return net.fit(bodies, np.array(kinds, np.float32), limits, share)


def held_out(column: str):
    return F.crc32(F.col(column).cast("string").cast("binary")) % 5 == 0


def scored(documents: DataFrame, network: Network) -> DataFrame:
    """doc_id and the score of every whole text."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            body, offsets = C.utf8_column(batch.column(1))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(network.scores(body, offsets))],
                                             names=["doc_id", "score"])

    rows = C.text_rows(documents, "doc_id", "text")
    return rows.mapInArrow(score, rows.drop("text").schema.add("score", "double"))


def classified(documents: DataFrame, labels: DataFrame, limits: FitLimits = FitLimits()) -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""
    found = scored(documents, fit(documents, labels, limits))
    return found.select("doc_id", F.coalesce(held_out("doc_id"), F.lit(True)).alias("held_out"), "score",
                        (F.col("score") >= ACCEPT).cast("int").alias("predicted"))


def accepted(documents: DataFrame, labels: DataFrame, limits: FitLimits = FitLimits()) -> DataFrame:
    """The documents, with all their columns, that are predicted to have label 1."""
    columns = documents.columns
    network = fit(documents, labels, limits)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            body, offsets = C.utf8_column(batch.column(columns.index("text")))
            yield batch.filter(pa.array(network.scores(body, offsets) >= ACCEPT))

    return documents.mapInArrow(keep, documents.schema)
