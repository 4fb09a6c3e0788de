"""Toxicity from the nearest labelled examples, by exact TF-IDF cosine.

1. Examples: at most ``EXAMPLES`` labelled documents per class, those with the
   smallest id hashes (a documented, bounded sample; labels come from outside the
   held-out fold only).
2. Terms: words (runs of letters, lower-cased) that lean to class 1 in one half
   of the examples (z of at least ``Z_FIRST``) and again in the other half
   (``Z_AGAIN``), by a share of ``LEAN`` in each. Their document frequencies are counted over all documents.
3. Vectors: ``(1 + ln tf) * ln((N + 1) / (df + 1/2))``, scaled to length 1.
4. Search: an inverted index with the examples in blocks of ``BLOCK``; per term and
   block the largest weight. A query sums these maxima to a bound per block and
   scores blocks from the highest bound down until the ``K``-th best similarity
   beats the next bound, so the ``K`` nearest are exact (ties: lower example id).
5. Score: votes of the neighbours weighted by ``1 / (FADE + distance)``, turned
   into a probability by a logistic curve over the vote and the nearest similarity.
   It is fitted on the examples, each scored without itself and weighted to the
   classes' shares among the labelled rows. The neighbours are the evidence.

Scale: documents are read twice (frequencies, scores), nothing of them is
shuffled. The index holds terms and examples of bounded number and goes to the
executors with the task; what reaches the driver are the examples' words and one
count per term.

Defined cases: NULL or empty text, or one without any term, has no neighbours and
scores by the share of toxic examples that have none either; NULL ids are never
examples; repeated rows get equal results; without labelled rows of both classes
every score is the share of toxic labels (0.5 without labels); further columns
are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termsim.llm.storage import id_remainder, smallest, table
from termsim.llm.words import chunks, text_buffers, token_spans, word_hashes

#: Bound of the examples of each class, in rows.
EXAMPLES = 3000
Z_FIRST, Z_AGAIN = 4.5, 3.5
#: Share of class 1 among a term's documents, both classes counted alike, at least.
LEAN = 0.8
K = 15
BLOCK = 64
FADE = 0.1


def _terms(texts: pa.Array):
    """Chunks ``(i, j, row, term)``: every word hash of rows [i, j)."""
    data, offsets = text_buffers(texts)
    for i, j in chunks(offsets):
        part = data[offsets[i] : offsets[j]]
        starts, ends, first = token_spans(part, offsets[i : j + 1] - offsets[i])
        yield i, j, np.repeat(np.arange(j - i), np.diff(first)), word_hashes(part, starts, ends, lower=True)


def _example_batches(batches):
    for batch in batches:
        rows = []
        for i, j, row, term in _terms(batch.column(2)):
            cut = np.searchsorted(row, np.arange(j - i + 1))
            rows += [np.unique(term[cut[k] : cut[k + 1]], return_counts=True) for k in range(j - i)]
        yield pa.RecordBatch.from_arrays(
            [
                *batch.columns[:2],
                pa.array([t.tobytes() for t, _ in rows], pa.binary()),
                pa.array([c.astype(np.int32).tobytes() for _, c in rows], pa.binary()),
            ],
            names=["doc_id", "label", "terms", "counts"],
        )


def examples(docs: DataFrame, labels: DataFrame, label: str, folds: int, held_out: int, bound: int):
    """``(ids, labels, terms, counts, share)``: the examples and the share of label 1
    among all labelled rows outside the held-out fold."""
    known = labels.where(
        F.col("doc_id").isNotNull() & F.col(label).isNotNull() & (id_remainder(F.col("doc_id"), folds) != held_out)
    ).select("doc_id", F.col(label).cast("int").alias("label"))
    share = known.agg(F.avg("label")).first()[0]
    of_class = [smallest(known.where(F.col("label") == c), F.xxhash64("doc_id"), bound, "doc_id") for c in (0, 1)]
    chosen = F.broadcast(of_class[0].union(of_class[1]))  # (id, label) pairs of a fixed number
    rows = (
        docs.select("doc_id", "text").join(chosen, "doc_id").select("doc_id", "label", "text")
        .mapInArrow(_example_batches, "doc_id long, label int, terms binary, counts binary").collect()
    )
    rows.sort(key=lambda r: (r["doc_id"], r["label"], r["terms"], r["counts"]))
    return (
        np.array([r["doc_id"] for r in rows], np.int64),
        np.array([r["label"] for r in rows], np.int64),
        [np.frombuffer(r["terms"], np.uint64) for r in rows],
        [np.frombuffer(r["counts"], np.int32) for r in rows],
        0.5 if share is None else float(share),
    )


def _lean(terms: list[np.ndarray], labels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(term, z)``: how far each term's share of class 1 is from chance, 0 for
    terms that are not clearly commoner in class 1."""
    every = np.concatenate([np.zeros(0, np.uint64), *terms])
    found, at = np.unique(every, return_inverse=True)
    of = np.repeat(labels, [len(t) for t in terms])
    ones = np.bincount(at, weights=of, minlength=len(found))
    n = np.bincount(at, minlength=len(found))
    total, positive = max(1, len(labels)), labels.sum()
    share = n / total
    expected = positive * share
    spread = np.sqrt(np.maximum(1e-12, expected * (1 - share) * (total - positive) / total))
    often = ones / max(1, positive)
    rare = (n - ones) / max(1, total - positive)
    z = (ones - expected) / spread
    return found, np.where(often >= LEAN * (often + rare), z, 0.0)


def leaning_terms(terms: list[np.ndarray], labels: np.ndarray) -> np.ndarray:
    """Sorted terms that lean to class 1 in both halves of the examples."""
    sides = []
    half = np.zeros(len(labels), np.int64)
    for c in (0, 1):
        half[labels == c] = np.arange((labels == c).sum()) % 2
    for h in (0, 1):
        sides.append(_lean([t for t, x in zip(terms, half, strict=True) if x == h], labels[half == h]))
    both, a, b = np.intersect1d(sides[0][0], sides[1][0], return_indices=True)
    za, zb = sides[0][1][a], sides[1][1][b]
    return both[(np.maximum(za, zb) >= Z_FIRST) & (np.minimum(za, zb) >= Z_AGAIN)]


def document_frequencies(docs: DataFrame, vocabulary: np.ndarray) -> tuple[int, np.ndarray]:
    """``(N, df)`` of the terms, over all documents."""

    def run(batches):
        df, n = np.zeros(len(vocabulary), np.int64), 0
        for batch in batches:
            n += batch.num_rows
            for _, _, row, at in _known(batch.column(0), vocabulary):
                pairs = np.unique(row * len(vocabulary) + at)
                df += np.bincount(pairs % len(vocabulary), minlength=len(vocabulary))
        some = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(some, -1)), pa.array(np.append(df[some], n))], names=["term", "n"]
        )

    counts = docs.select("text").mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(len(vocabulary), np.int64)
    for r in counts:
        if r["term"] >= 0:
            out[r["term"]] = r["n"]
    return next((r["n"] for r in counts if r["term"] < 0), 0), out


def _known(texts: pa.Array, vocabulary: np.ndarray):
    """Chunks ``(i, j, row, place in the vocabulary)`` of the words that are terms."""
    bits = np.zeros(1 << 16, bool)
    bits[(vocabulary >> np.uint64(48)).astype(np.int64)] = True
    for i, j, row, term in _terms(texts):
        maybe = np.flatnonzero(bits[(term >> np.uint64(48)).astype(np.int64)])
        at = np.searchsorted(vocabulary, term[maybe])
        at[at == len(vocabulary)] = 0
        same = vocabulary[at] == term[maybe] if len(vocabulary) else np.zeros(len(maybe), bool)
        yield i, j, row[maybe[same]], at[same]


class Index:
    """The block-max inverted index of the examples."""

    def __init__(self, ids, labels, vectors: list[tuple[np.ndarray, np.ndarray]], idf: np.ndarray):
        kept = [k for k, (t, _) in enumerate(vectors) if len(t)]
        self.ids, self.labels, self.idf = ids[kept], labels[kept], idf
        self.size = len(kept)
        term = np.concatenate([np.zeros(0, np.int64), *[vectors[k][0] for k in kept]])
        weight = np.concatenate([np.zeros(0), *[vectors[k][1] for k in kept]])
        example = np.repeat(np.arange(len(kept)), [len(vectors[k][0]) for k in kept])
        order = np.lexsort((example, term))
        self.example, self.weight = example[order], weight[order]
        self.first = np.searchsorted(term[order], np.arange(len(idf) + 1))
        self.blocks = -(-self.size // BLOCK)
        self.top = np.zeros((len(idf), max(1, self.blocks)))
        np.maximum.at(self.top, (term, example // BLOCK), weight)

    def vector(self, terms: np.ndarray, counts: np.ndarray):
        w = (1 + np.log(counts)) * self.idf[terms]
        norm = np.sqrt((w * w).sum())
        return (terms, w / norm) if norm > 0 else (terms[:0], w[:0])

    def nearest(self, terms: np.ndarray, weights: np.ndarray, k: int = K, without: int = -1):
        """``(examples, similarities)`` of the ``k`` nearest with a positive one."""
        if self.size == 0 or len(terms) == 0:
            return np.zeros(0, np.int64), np.zeros(0)
        bound = weights @ self.top[terms]
        order = np.argsort(-bound, kind="stable")
        lists = [(self.example[self.first[t] : self.first[t + 1]], w * self.weight[self.first[t] : self.first[t + 1]]) for t, w in zip(terms, weights, strict=True)]
        best, similar = np.zeros(0, np.int64), np.zeros(0)
        at, step = 0, 4
        while at < len(order) and bound[order[at]] > 0:
            if len(best) >= k and bound[order[at]] < similar[k - 1] - 1e-12:
                break
            taken = np.sort(order[at : at + step])
            at, step = at + step, step * 2
            scores = np.zeros((len(taken), BLOCK))
            for e, w in lists:
                place = np.minimum(np.searchsorted(taken, e // BLOCK), len(taken) - 1)
                inside = taken[place] == e // BLOCK
                scores[place[inside], e[inside] % BLOCK] += w[inside]
            found = (taken[:, None] * BLOCK + np.arange(BLOCK)).ravel()
            scores = scores.ravel()
            good = (scores > 0) & (found != without)
            best, similar = np.append(best, found[good]), np.append(similar, scores[good])
            top = np.lexsort((best, -np.round(similar, 12)))[:k]
            best, similar = best[top], similar[top]
        return best, similar

    def votes(self, best: np.ndarray, similar: np.ndarray) -> np.ndarray:
        """What the curve reads: 1, vote (-1 to 1), nearest similarity."""
        w = 1 / (FADE + 1 - np.minimum(similar, 1))
        return np.array([1.0, 2 * (w @ self.labels[best]) / w.sum() - 1, similar[0]])


def _sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -35, 35)))


def _curve(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 0.02) -> np.ndarray:
    """Weighted logistic regression by Newton steps."""
    b = np.zeros(x.shape[1])
    keep = ridge * np.diag([0.01, *[1.0] * (x.shape[1] - 1)])
    for _ in range(30):
        p = _sigmoid(x @ b)
        h = (x * (weight * p * (1 - p))[:, None]).T @ x + keep
        b = b - np.linalg.solve(h, x.T @ (weight * (p - y)) + keep @ b)
    return b


class Model:
    """Vocabulary, index, curve and the score without evidence."""

    def __init__(self, vocabulary: np.ndarray, index: Index | None, curve: np.ndarray, without: float):
        self.vocabulary, self.index, self.curve, self.without = vocabulary, index, curve, without

    def score(self, texts: pa.Array):
        """``(scores, neighbours)`` per text; neighbours: (id, label, similarity)."""
        scores = np.full(len(texts), self.without)
        evidence: list[list[tuple]] = [[] for _ in range(len(texts))]
        if self.index is None:
            return scores, evidence
        for i, _, row, at in _known(texts, self.vocabulary):
            order = np.argsort(row, kind="stable")
            row, at = row[order], at[order]
            head = np.flatnonzero(np.append(True, row[1:] != row[:-1])) if len(row) else []
            for a, b in zip(head, np.append(head[1:], len(row)) if len(row) else [], strict=True):
                best, similar = self.index.nearest(*self.index.vector(*np.unique(at[a:b], return_counts=True)))
                if len(best):
                    k = i + int(row[a])
                    scores[k] = _sigmoid(self.index.votes(best, similar) @ self.curve)
                    evidence[k] = [
                        (int(self.index.ids[e]), int(self.index.labels[e]), float(s)) for e, s in zip(best, similar, strict=True)
                    ]
        return scores, evidence


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", folds: int = 3, held_out: int = 1, bound: int = EXAMPLES) -> Model:
    ids, of, terms, counts, share = examples(docs, labels, label, folds, held_out, bound)
    if len(set(of.tolist())) < 2:
        return Model(np.zeros(0, np.uint64), None, np.zeros(3), share)
    vocabulary = leaning_terms(terms, of)
    n, df = document_frequencies(docs, vocabulary)
    idf = np.log((n + 1) / (df + 0.5))
    index = Index(ids, of, [], idf)
    vectors = []
    for t, c in zip(terms, counts, strict=True):
        both, a, b = np.intersect1d(t, vocabulary, assume_unique=True, return_indices=True)
        vectors.append(index.vector(b, c[a]))
    index = Index(ids, of, vectors, idf)
    # each example without itself, weighted to the classes' shares
    size = np.array([len(t) for t, _ in vectors])
    place = np.cumsum(size > 0) - 1
    weight = np.where(of == 1, share / (of == 1).sum(), (1 - share) / (of == 0).sum()) * len(of)
    x, y, w, none = [], [], [], np.array([share * 2, 2.0])  # two rows' worth of the share
    for k, (t, v) in enumerate(vectors):
        best, similar = index.nearest(t, v, without=place[k]) if size[k] else ([], [])
        if len(best):
            x.append(index.votes(best, similar))
            y.append(of[k])
            w.append(weight[k])
        else:
            none += [weight[k] * of[k], weight[k]]
    curve = _curve(np.array(x), np.array(y), np.array(w)) if x else np.zeros(3)
    return Model(vocabulary, index, curve, float(none[0] / none[1]))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``(doc_id, score, evidence)``: probability of label 1 and the neighbours."""
    kind = pa.list_(pa.struct([("doc_id", pa.int64()), ("label", pa.int32()), ("similarity", pa.float64())]))

    def run(batches):
        for batch in batches:
            p, evidence = model.score(batch.column(1))
            rows = [[{"doc_id": i, "label": c, "similarity": s} for i, c, s in e] for e in evidence]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(p), pa.array(rows, kind)], names=["doc_id", "score", "evidence"])

    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id long, score double, evidence array<struct<doc_id:bigint,label:int,similarity:double>>"
    )


THRESHOLD = 0.7


def op3_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = score(docs.withColumn("doc_id", F.col("doc_id").cast("long")), fit(docs, table(spark, sf_dir, "labels")))
    return scored.select(
        "doc_id",
        (id_remainder(F.col("doc_id"), 3) == 1).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
        "evidence",
    )
