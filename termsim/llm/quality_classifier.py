"""Quality classifier: logistic regression over hashed word n-grams, trained
with follow-the-regularised-leader (FTRL-proximal) updates.

A document's features are the hashed 1- and 2-grams of its tokens (runs of
letters, digits or signs) and the 1-, 2- and 3-grams of their shapes (class,
capitals, length). Weight of a feature in a document: ``count / total count``
times ``SCALE``, so a score is a sparse dot product that any length of text can
have.

Training takes a bounded sample of the labelled rows, ``SAMPLE`` rows with the
smallest id hashes (their ids and labels are the only thing that is broadcast).
The sample is dealt over ``shards`` by the hash, each shard runs FTRL over its
rows in hash order (one Python process, batch after batch), and the shards'
weights are averaged. What reaches the driver is one weight vector per shard
(``shards`` x ``2^bits`` floats, 16 MB by default, whatever the input).

Defined cases: NULL or empty text has no features and scores by the bias alone;
a NULL id is never used to learn; rows with a NULL label are not learnt from;
an id labelled or listed several times gives each of its rows; without any
labelled row every score is 0.5; further columns of ``docs`` are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termsim.llm.storage import id_remainder, smallest, table
from termsim.llm.words import (
    CHUNK_BYTES,
    chunks,
    gram_hashes,
    mix,
    text_buffers,
    token_shapes,
    token_spans,
    word_hashes,
)

#: Bound of the training sample, in rows.
SAMPLE = 20_000
BITS = 18
SHARDS = 16
SCALE = 64.0
EPOCHS = 2
# FTRL-proximal: learning rate alpha, its offset beta, L1 and L2 strength
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.02, 0.05


def _grams(hashes: np.ndarray, tokens_of: np.ndarray, n: int, salt: int, bits: int):
    """(row, bucket) of all n-grams that lie within a row."""
    g = gram_hashes(hashes, n) if n > 1 else hashes
    rows = tokens_of[: len(g)]
    inside = rows == tokens_of[n - 1 : n - 1 + len(g)]
    buckets = (mix(g[inside] + np.uint64(salt)) >> np.uint64(64 - bits)).astype(np.int64)
    return rows[inside], buckets


def features(texts: pa.Array, bits: int = BITS) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Chunks ``(i, j, rows, buckets)``: every feature occurrence of rows [i, j)."""
    data, offsets = text_buffers(texts)
    for i, j in chunks(offsets, CHUNK_BYTES // 2):
        part = data[offsets[i] : offsets[j]]
        starts, ends, first = token_spans(part, offsets[i : j + 1] - offsets[i])
        words = word_hashes(part, starts, ends, lower=True)
        shapes = token_shapes(part, starts, ends)
        of = np.repeat(np.arange(j - i), np.diff(first))
        found = [_grams(words, of, n, 11 * n, bits) for n in (1, 2)]
        found += [_grams(shapes, of, n, 101 * n, bits) for n in (1, 2, 3)]
        yield i, j, np.concatenate([r for r, _ in found]), np.concatenate([b for _, b in found])


def _sigmoid(z):
    return 1.0 / (1.0 + np.exp(-np.clip(z, -35, 35)))


class Ftrl:
    """FTRL-proximal state of one shard; the last entry is the bias."""

    def __init__(self, bits: int = BITS):
        self.z = np.zeros((1 << bits) + 1)
        self.n = np.zeros((1 << bits) + 1)

    def weights(self, at=slice(None)) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        return -(z - np.sign(z) * L1) * (np.abs(z) > L1) / ((BETA + np.sqrt(n)) / ALPHA + L2)

    def learn(self, index: np.ndarray, x: np.ndarray, label: float) -> None:
        w = self.weights(index)
        g = (_sigmoid(w @ x) - label) * x
        n = self.n[index]
        self.z[index] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / ALPHA * w
        self.n[index] = n + g * g


def _shard(bits: int, epochs: int):
    def run(batches):
        model, seen = Ftrl(bits), 0
        for batch in batches:
            labels = batch.column(1).to_numpy(zero_copy_only=False)
            docs = []
            for i, j, rows, buckets in features(batch.column(0), bits):
                order = np.argsort(rows, kind="stable")
                cut = np.searchsorted(rows[order], np.arange(j - i + 1))
                for k in range(j - i):
                    index, count = np.unique(buckets[order[cut[k] : cut[k + 1]]], return_counts=True)
                    x = np.append(count * (SCALE / max(1, count.sum())), 1.0)
                    docs.append((np.append(index, 1 << bits), x, float(labels[i + k])))
                if j == len(labels) or len(docs) >= 256:
                    for _ in range(epochs):  # a second pass over the rows at hand
                        for d in docs:
                            model.learn(*d)
                    seen += len(docs)
                    docs = []
        if seen:
            w = model.weights().astype(np.float32)
            yield pa.RecordBatch.from_arrays([pa.array([seen]), pa.array([w.tobytes()])], names=["n", "w"])

    return run


def train(labelled: DataFrame, text: str = "text", label: str = "label", key: str = "doc_id",
          bits: int = BITS, shards: int = SHARDS, epochs: int = EPOCHS) -> np.ndarray:
    """Weights (bias last) of the classifier learnt from ``labelled`` rows."""
    h = F.xxhash64(F.col(key))
    rows = (
        labelled.where(F.col(label).isNotNull())
        .select(F.col(text).alias("text"), F.col(label).cast("double").alias("label"), h.alias("h"))
        .repartition(shards, F.pmod("h", F.lit(shards)))
        .sortWithinPartitions("h", "label")
        .select("text", "label")
    )
    parts = rows.mapInArrow(_shard(bits, epochs), "n long, w binary").collect()
    total = sum(r["n"] for r in parts)
    weights = np.zeros((1 << bits) + 1)
    for r in parts:
        weights += np.frombuffer(r["w"], np.float32) * (r["n"] / total)
    return weights.astype(np.float32)


def scores_of(texts: pa.Array, weights: np.ndarray) -> np.ndarray:
    """One probability per text."""
    bits = (len(weights) - 1).bit_length() - 1
    out = np.empty(len(texts))
    for i, j, rows, buckets in features(texts, bits):
        total = np.bincount(rows, weights=weights[buckets], minlength=j - i)
        count = np.bincount(rows, minlength=j - i)
        out[i:j] = _sigmoid(total * (SCALE / np.maximum(count, 1)) + weights[-1])
    return out


def score(docs: DataFrame, weights: np.ndarray, text: str = "text", out: str = "score") -> DataFrame:
    """``docs`` (all columns) plus ``out``: the probability of label 1 (replaces a
    column of that name). The texts are read once, nothing is shuffled."""
    kept = [c for c in docs.columns if c != out]
    given = docs.select(*kept)
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in given.schema), f"`{out}` double"])

    def run(batches):
        for batch in batches:
            p = scores_of(batch.column(text), weights)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(p)], names=[*kept, out])

    return given.mapInArrow(run, schema)


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", folds: int = 5, held_out: int = 0,
        sample: int = SAMPLE) -> np.ndarray:
    """Learn from ``sample`` labelled rows outside the held-out fold."""
    known = labels.where(
        F.col("doc_id").isNotNull() & F.col(label).isNotNull() & (id_remainder(F.col("doc_id"), folds) != held_out)
    ).select(F.col("doc_id"), F.col(label).alias("label"))
    # (id, label) pairs of a fixed number: small enough to go to every executor
    chosen = smallest(known, F.xxhash64("doc_id"), sample, "doc_id", "label")
    return train(docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id"))


THRESHOLD = 0.3


def op10_quality_classifier(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    weights = fit(docs, table(spark, sf_dir, "labels"))
    scored = score(docs.select("doc_id", "text"), weights).drop("text")
    return scored.select(
        "doc_id",
        (id_remainder(F.col("doc_id"), 5) == 0).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
