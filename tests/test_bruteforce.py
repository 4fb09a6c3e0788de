"""Random small corpora against a brute-force recomputation of the formulas
(TF over the filtered length, idf = ln(N/df), cosine of TF-IDF vectors)."""

import math
from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

import termsim.operators.similarity as sim_mod
from termsim import similar_terms, similarity_matrix, to_occurrences
from termsim.sources.corpus import parse_lines

VOCAB = ["a", "b", "c", "d", "e", "f", "g", "h", "hot"]


def brute_matrix(docs):
    n = len(docs)
    tfs = []
    for terms in docs:
        c = Counter(terms)
        tfs.append({t: k / len(terms) for t, k in c.items()} if terms else {})
    df = Counter(t for tf in tfs for t in tf)
    w = {t: {i: tf[t] * math.log(n / df[t]) for i, tf in enumerate(tfs) if t in tf} for t in df}
    norm = {t: math.sqrt(sum(v * v for v in w[t].values())) for t in w}
    out = {}
    for a in w:
        for b in w:
            if a == b or norm[a] == 0 or norm[b] == 0:
                continue
            dot = sum(v * w[b][i] for i, v in w[a].items() if i in w[b])
            if dot > 0:
                out[(a, b)] = dot / (norm[a] * norm[b])
    return out


corpora = st.lists(
    st.lists(st.sampled_from(VOCAB), min_size=0, max_size=12), min_size=2, max_size=8
).map(lambda docs: docs + [["hot"] * 3 + VOCAB * 2])  # one long document holding every term


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(docs=corpora)
def test_matrix_and_lookup_against_brute_force(spark, monkeypatch, docs):
    monkeypatch.setattr(sim_mod, "BLOCK_TERMS", 3)  # the long document goes through the block split
    lines = [" ".join([f"D{i}"] + terms) for i, terms in enumerate(docs)]
    corpus = parse_lines(spark.createDataFrame([(x,) for x in lines], "value string"))
    expected = brute_matrix(docs)
    for c in (corpus, to_occurrences(corpus)):
        got = {(r["term1"], r["term2"]): r["similarity"] for r in similarity_matrix(c, None, both_orders=True).collect()}
        off_diagonal = {k: v for k, v in got.items() if k[0] != k[1]}
        assert set(off_diagonal) == set(expected)
        for k, v in expected.items():
            assert math.isclose(off_diagonal[k], round(v, 9), abs_tol=2e-9)
    ranked = similar_terms(corpus, ["hot", "a"], pattern=None, n=None).collect()
    assert {(r["query"], r["term"]) for r in ranked} == {k for k in expected if k[0] in ("hot", "a")}


def brute_matrix_filtered(docs, pattern, length):
    """Reference semantics with a term pattern: N counts every document, TF
    divides by the kept length (default) or the original length."""
    import re

    rx = re.compile(pattern)
    n = len(docs)
    tfs = []
    for terms in docs:
        kept = [t for t in terms if rx.search(t)]
        denom = len(kept) if length == "filtered" else len(terms)
        c = Counter(kept)
        tfs.append({t: k / denom for t, k in c.items()} if kept else {})
    df = Counter(t for tf in tfs for t in tf)
    w = {t: {i: tf[t] * math.log(n / df[t]) for i, tf in enumerate(tfs) if t in tf} for t in df}
    norm = {t: math.sqrt(sum(v * v for v in w[t].values())) for t in w}
    out = {}
    for a in w:
        for b in w:
            if a != b and norm[a] > 0 and norm[b] > 0:
                dot = sum(v * w[b][i] for i, v in w[a].items() if i in w[b])
                if dot > 0:
                    out[(a, b)] = dot / (norm[a] * norm[b])
    return out


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(docs=corpora, length=st.sampled_from(["filtered", "original"]))
def test_pattern_and_length_against_brute_force(spark, monkeypatch, docs, length):
    monkeypatch.setattr(sim_mod, "BLOCK_TERMS", 2)
    pattern = "^[a-dh]"
    lines = [" ".join([f"D{i}"] + terms) for i, terms in enumerate(docs)]
    corpus = parse_lines(spark.createDataFrame([(x,) for x in lines], "value string"))
    expected = brute_matrix_filtered(docs, pattern, length)
    for c in (corpus, to_occurrences(corpus)):
        got = {
            (r["term1"], r["term2"]): r["similarity"]
            for r in similarity_matrix(c, pattern, length, both_orders=True).collect()
            if r["term1"] != r["term2"]
        }
        assert set(got) == set(expected)
        for k, v in expected.items():
            assert math.isclose(got[k], round(v, 9), abs_tol=2e-9)
        ranked = similar_terms(c, ["a", "hot", "e"], pattern=pattern, length=length, n=None).collect()
        assert {(r["query"], r["term"]) for r in ranked} == {k for k in expected if k[0] in ("a", "hot", "e")}
        for r in ranked:
            assert math.isclose(r["similarity"], round(expected[(r["query"], r["term"])], 9), abs_tol=2e-9)
