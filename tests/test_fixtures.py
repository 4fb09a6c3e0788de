"""Golden values (FIXTURES.md F1, F2) for every stage."""

import math

import pytest

from conftest import F1, F2
from termsim import (
    corpus_size,
    idf,
    similar_terms,
    similarity_matrix,
    term_frequencies,
    term_norms,
)

F1_NORMS = {
    "A": 0.288811325, "B": 0.346573590, "I": 0.153505338, "data": 0.139788360,
    "hate": 0.462098120, "like": 0.245064536, "science": 0.346573590, "want": 0.462098120,
}
F1_IDF = {"A": 0.693147181, "B": 1.386294361, "I": 0.287682072, "data": 0.287682072}

F1_RANKINGS = {
    "I": [("data", 0.669589480), ("hate", 0.624695048), ("want", 0.624695048), ("A", 0.499756038),
          ("science", 0.468521286), ("like", 0.331294578)],
    "like": [("data", 0.727606875), ("B", 0.707106781), ("science", 0.707106781), ("A", 0.424264069),
             ("I", 0.331294578)],
    "data": [("like", 0.727606875), ("hate", 0.685994341), ("I", 0.669589480), ("B", 0.514495755),
             ("science", 0.514495755), ("A", 0.308697453)],
    "science": [("like", 0.707106781), ("data", 0.514495755), ("I", 0.468521286)],
    "hate": [("data", 0.685994341), ("I", 0.624695048)],
    "want": [("A", 0.800000000), ("I", 0.624695048)],
    "A": [("want", 0.800000000), ("B", 0.600000000), ("I", 0.499756038), ("like", 0.424264069),
          ("data", 0.308697453)],
    "B": [("like", 0.707106781), ("A", 0.600000000), ("data", 0.514495755)],
}


def _close(a, b, tol=1e-9):
    return math.isclose(a, b, abs_tol=tol)


def test_f1_idf_and_norms(lines):
    c = lines(F1)
    tf = term_frequencies(c, None)
    n = corpus_size(c)
    assert n.collect()[0]["n_docs"] == 4
    idfs = {r["term"]: r["idf"] for r in idf(tf, n).collect()}
    for t, v in F1_IDF.items():
        assert _close(idfs[t], v)
    norms = {r["term"]: r["norm"] for r in term_norms(tf, n).collect()}
    assert set(norms) == set(F1_NORMS)
    for t, v in F1_NORMS.items():
        assert _close(norms[t], v)


@pytest.mark.parametrize("n", [None, 3])
def test_f1_rankings(lines, n):
    c = lines(F1)
    queries = list(F1_RANKINGS) + ["cake"]
    got = {}
    for r in similar_terms(c, queries, pattern=None, n=n).orderBy("query", "rank").collect():
        got.setdefault(r["query"], []).append((r["rank"], r["term"], r["similarity"]))
    assert "cake" not in got
    for q, exp in F1_RANKINGS.items():
        exp = exp if n is None else exp[:n]
        assert [(i + 1, t) for i, (t, _) in enumerate(exp)] == [(k, t) for k, t, _ in got[q]]
        for (_, s), (_, _, g) in zip(exp, got[q]):
            assert _close(s, g)


def test_f1_default_pattern_keeps_nothing(lines):
    assert similar_terms(lines(F1), ["I", "data"]).count() == 0


F2_NORMS = {
    "filtered": {"dis_a_dis": 0.776836199, "dis_b_dis": 0.541858077, "gene_x_gene": 0.915510241,
                 "gene_y_gene,": 0.895879735},
    "original": {"dis_a_dis": 0.457755120, "dis_b_dis": 0.438993214, "gene_x_gene": 0.518214380,
                 "gene_y_gene,": 0.895879735},
}
F2_SIMS = {
    "filtered": {("dis_a_dis", "dis_b_dis"): 0.452267017, ("dis_a_dis", "gene_x_gene"): 0.424264069,
                 ("dis_b_dis", "gene_x_gene"): 0.341121146, ("dis_b_dis", "gene_y_gene,"): 0.639602149},
    "original": {("dis_a_dis", "dis_b_dis"): 0.421052632, ("dis_a_dis", "gene_x_gene"): 0.317999364,
                 ("dis_b_dis", "gene_x_gene"): 0.267788938, ("dis_b_dis", "gene_y_gene,"): 0.789473684},
}


@pytest.mark.parametrize("length", ["filtered", "original"])
def test_f2_default_pattern_and_lengths(lines, length):
    c = lines(F2)
    assert corpus_size(c).collect()[0]["n_docs"] == 6
    tf = term_frequencies(c, length=length)
    dfs = {r["term"]: r["df"] for r in idf(tf, corpus_size(c)).collect()}
    assert dfs == {"dis_a_dis": 2, "dis_b_dis": 3, "gene_x_gene": 2, "gene_y_gene,": 1}
    norms = {r["term"]: r["norm"] for r in term_norms(tf, corpus_size(c)).collect()}
    for t, v in F2_NORMS[length].items():
        assert _close(norms[t], v)
    cells = {(r["term1"], r["term2"]): r["similarity"] for r in similarity_matrix(c, length=length).collect()}
    assert set(cells) == set(F2_SIMS[length])  # the two zero cells are absent
    for k, v in F2_SIMS[length].items():
        assert _close(cells[k], v)
