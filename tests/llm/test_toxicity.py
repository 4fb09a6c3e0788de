import random

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from termsim.llm import toxicity as tx
from termsim.llm.storage import id_remainder


def corpus(n=500, seed=1):
    rng = random.Random(seed)
    bad = ["zork", "blarg", "fump", "gnarl"]
    rows, labels = [], []
    for k in range(n):
        w = [f"{rng.choice(['an', 'er', 'tion', 'ou'])}{rng.choice(['the', 'ing', 're'])}" for _ in range(rng.randrange(10, 80))]
        toxic = rng.random() < 0.25
        if toxic:
            for _ in range(rng.randrange(1, 4)):
                w.insert(rng.randrange(len(w)), rng.choice(bad) + rng.choice(["", "!!", ","]))
        rows.append((k, " ".join(w)))
        labels.append((k, int(toxic)))
    return rows, labels


def test_held_out(spark):
    rows, labels = corpus()
    docs = spark.createDataFrame([(d, t, "x", 0.1) for d, t in rows], "doc_id long, text string, label string, score double")
    model = tx.fit(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
    truth = dict(labels)
    got = tx.score(docs, model).withColumn("held", id_remainder(F.col("doc_id"), 3) == 1).collect()
    held = [r for r in got if r["held"]]
    assert len(got) == 500 and len(held) > 100
    assert np.mean([(r["score"] >= 0.7) == truth[r["doc_id"]] for r in held]) > 0.97
    assert abs(np.mean([r["score"] for r in held]) - np.mean([truth[r["doc_id"]] for r in held])) < 0.06  # calibrated
    for r in got:
        assert 0 <= r["score"] <= 1
        assert all(truth[e["doc_id"]] == e["label"] and e["doc_id"] not in {h["doc_id"] for h in held} for e in r["evidence"])


def test_neighbours_are_exact():
    rng = np.random.default_rng(2)
    terms, n = 40, 500
    idf = rng.random(terms) + 0.5
    index = tx.Index(np.arange(n), rng.integers(0, 2, n), [], idf)
    vectors = []
    for _ in range(n):
        t = np.unique(rng.integers(0, terms, rng.integers(0, 6)))
        vectors.append(index.vector(t, rng.integers(1, 4, len(t))))
    index = tx.Index(np.arange(n) * 3, rng.integers(0, 2, n), vectors, idf)
    dense = np.zeros((n, terms))
    for k, (t, w) in enumerate(vectors):
        dense[k, t] = w
    kept = np.flatnonzero([len(t) > 0 for t, _ in vectors])
    for _ in range(60):
        q = np.unique(rng.integers(0, terms, 4))
        t, w = index.vector(q, rng.integers(1, 3, len(q)))
        best, similar = index.nearest(t, w, k=7)
        full = dense[:, t] @ w
        order = sorted((k for k in kept if full[k] > 0), key=lambda k: (-round(full[k], 12), k))[:7]
        assert index.ids[best].tolist() == [3 * k for k in order]
        assert np.allclose(similar, full[order])


def test_frequencies_count_all_documents(spark):
    rows, _ = corpus(200)
    docs = spark.createDataFrame(rows + [(999, None)], "doc_id long, text string")
    words = ["zork", "anthe", "nowhere"]
    hashes = [int(next(tx._terms(pa.array([w])))[3][0]) for w in words]
    order = np.argsort(np.array(hashes, np.uint64))
    n, df = tx.document_frequencies(docs, np.sort(np.array(hashes, np.uint64)))
    strip = lambda t: {w.strip("!,") for w in t.split()}
    assert n == 201
    for place, k in enumerate(order):
        assert df[place] == sum(words[k] in strip(t) for _, t in rows)


def test_defined_cases(spark):
    docs = spark.createDataFrame([(1, None), (1, None), (None, ""), (2, "a b"), (3, "x " * 30_000)], "doc_id long, text string")
    labels = lambda rows: spark.createDataFrame(rows, "doc_id long, toxic int")
    assert {r["score"] for r in tx.score(docs, tx.fit(docs, labels([]))).collect()} == {0.5}
    one = tx.score(docs, tx.fit(docs, labels([(1, 0), (2, 0), (3, 0), (4, None), (None, 1)]))).collect()
    assert len(one) == 5 and {r["score"] for r in one} == {0.0}
    both = tx.score(docs, tx.fit(docs, labels([(3, 0), (2, 1), (5, 1), (1, 0), (6, 1), (7, 0)]))).collect()
    assert len(both) == 5 and all(0 <= r["score"] <= 1 for r in both)
    assert tx.score(docs.limit(0), tx.fit(docs, labels([(3, 0), (2, 1)]))).collect() == []
