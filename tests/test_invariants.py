"""Invariants and equality of the alternative physical strategies."""

import pytest
from pyspark.sql import functions as F

import termsim.operators.similarity as sim_mod
from conftest import F1
from termsim import (
    corpus_from_pairs,
    corpus_from_table,
    query_similarities,
    rank_terms,
    similar_terms,
    similarity_diff,
    similarity_matrix,
    to_occurrences,
)
from termsim.operators.lookup import rank_all

SF = "/root/testdata/sf0.001"
SHORT = r"^[a-z]{1,3}$"


@pytest.fixture(scope="module")
def docs(spark):
    return corpus_from_table(spark.read.parquet(f"{SF}/documents.parquet"))


def _rows(df, cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_matrix_symmetric_with_unit_diagonal(docs):
    m = similarity_matrix(docs, SHORT, both_orders=True)
    cells = {(r["term1"], r["term2"]): r["similarity"] for r in m.collect()}
    for (a, b), v in cells.items():
        assert cells[(b, a)] == v
        assert 0 < v <= 1.0 + 1e-9
    diag = [k for k in cells if k[0] == k[1]]
    assert diag and all(cells[k] == 1.0 for k in diag)


def test_document_rows_equal_occurrence_rows(docs):
    a = similarity_matrix(docs, SHORT)
    b = similarity_matrix(to_occurrences(docs), SHORT)
    assert _rows(a, a.columns) == _rows(b, a.columns)
    verdicts = similarity_diff(a, b).collect()
    assert verdicts and all(r["passed"] for r in verdicts)


def test_block_split_equals_in_row(docs, monkeypatch):
    base = _rows(similarity_matrix(docs, SHORT), ["term1", "term2", "similarity"])
    monkeypatch.setattr(sim_mod, "BLOCK_TERMS", 7)
    split = _rows(similarity_matrix(docs, SHORT), ["term1", "term2", "similarity"])
    assert base == split


def test_list_queries_equal_dataframe_queries(spark, docs):
    qs = ["the", "and", "of"]
    a = similar_terms(docs, qs, pattern=None, n=None)
    qdf = spark.createDataFrame(list(enumerate(qs)), "pos int, query string")
    b = similar_terms(docs, qdf, pattern=None, n=None)
    cols = ["query", "rank", "term", "similarity"]
    assert _rows(a, cols) == _rows(b, cols)


def test_lookup_equals_matrix_rows(docs):
    qs = ["the", "and"]
    looked = similar_terms(docs, qs, pattern=SHORT, n=None).select("query", "term", "similarity")
    m = similarity_matrix(docs, SHORT, both_orders=True).where(
        F.col("term1").isin(qs) & (F.col("term1") != F.col("term2"))
    )
    assert _rows(looked, ["query", "term", "similarity"]) == _rows(m, ["term1", "term2", "similarity"])


def test_batch_equals_union_of_single_queries(docs):
    qs = ["the", "and", "is"]
    batch = _rows(similar_terms(docs, qs, pattern=None, n=5), ["query", "rank", "term", "similarity"])
    single = []
    for q in qs:
        single += _rows(similar_terms(docs, [q], pattern=None, n=5), ["query", "rank", "term", "similarity"])
    assert batch == sorted(single)


def test_top_n_is_prefix_of_full_ranking(docs):
    full = similar_terms(docs, ["the", "of"], pattern=None, n=None)
    top = similar_terms(docs, ["the", "of"], pattern=None, n=7)
    cols = ["query", "rank", "term", "similarity"]
    assert _rows(top, cols) == _rows(full.where("rank <= 7"), cols)


def window_ranks(scored):
    """The ranking by one plain window per query."""
    from pyspark.sql import Window

    s = scored.select("query", "term", F.round("similarity", 9).alias("similarity"))
    w = Window.partitionBy("query").orderBy(F.col("similarity").desc(), F.col("term"))
    return s.withColumn("rank", F.row_number().over(w))


@pytest.mark.parametrize("reuse", ["true", "false"])
def test_distributed_rank_equals_window_rank(spark, docs, reuse):
    scored = query_similarities(docs, ["the", "and", "is", "of"], None)
    cols = ["query", "rank", "term", "similarity"]
    expected = _rows(window_ranks(scored), cols)
    spark.conf.set("spark.sql.exchange.reuse", reuse)
    try:
        assert _rows(rank_terms(scored, None), cols) == expected
        assert _rows(rank_terms(scored, 10**6), cols) == expected
        assert _rows(rank_terms(scored, 1500), cols) == [r for r in expected if r[1] <= 1500]
    finally:
        spark.conf.unset("spark.sql.exchange.reuse")


def test_rank_of_ties_zeros_and_repeats(spark):
    rows = [("q", f"t{i:03d}", s) for i, s in enumerate([0.5] * 40 + [1.0] * 3 + [1e-12] * 5 + [0.0] * 2 + [0.3, 0.30000000001])]
    scored = spark.createDataFrame(rows + [("", "x", 0.5)], "query string, term string, similarity double")
    cols = ["query", "rank", "term", "similarity"]
    assert _rows(rank_terms(scored, None), cols) == _rows(window_ranks(scored), cols)


def test_pairs_corpus_matches_text_corpus(spark):
    pairs = spark.createDataFrame(
        [("D1", t) for t in "I like data science".split()]
        + [("D2", t) for t in "I hate data".split()]
        + [("D3", t) for t in "I want A".split()]
        + [("D4", t) for t in "A data like B".split()],
        "d string, t string",
    )
    from termsim.sources.corpus import parse_lines

    text = parse_lines(spark.createDataFrame([(x,) for x in F1], "value string"))
    a = similar_terms(corpus_from_pairs(pairs, "d", "t"), ["data", "A"], pattern=None, n=None)
    b = similar_terms(text, ["data", "A"], pattern=None, n=None)
    cols = ["query", "rank", "term", "similarity"]
    assert _rows(a, cols) == _rows(b, cols)


@pytest.mark.parametrize("length", ["filtered", "original"])
def test_length_modes_agree_across_corpus_shapes(docs, length):
    qs = ["the", "and"]
    a = similar_terms(docs, qs, pattern=SHORT, length=length, n=None)
    b = similar_terms(to_occurrences(docs), qs, pattern=SHORT, length=length, n=None)
    cols = ["query", "rank", "term", "similarity"]
    assert _rows(a, cols) == _rows(b, cols)


def test_search_with_query_dataframe(spark, docs):
    qs = ["the", "of"]
    qdf = spark.createDataFrame(list(enumerate(qs)), "pos int, query string")
    a = similar_terms(docs, qs, pattern=None, search="^[a-z]*ing$", n=3)
    b = similar_terms(docs, qdf, pattern=None, search="^[a-z]*ing$", n=3)
    cols = ["query", "rank", "term", "similarity"]
    assert _rows(a, cols) == _rows(b, cols)
    assert all(r["term"].endswith("ing") for r in a.collect())


def test_pairs_with_null_terms_count_in_n(spark):
    from termsim import corpus_size, term_frequencies

    rows = [("o1", "p1"), ("o1", "p2"), ("o2", "p1"), ("o3", None)]
    c = corpus_from_pairs(spark.createDataFrame(rows, "d string, t string"), "d", "t")
    assert corpus_size(c).collect()[0]["n_docs"] == 3
    tf = {(r["doc_id"], r["term"]): r["tf"] for r in term_frequencies(c, None).collect()}
    assert tf == {("o1", "p1"): 0.5, ("o1", "p2"): 0.5, ("o2", "p1"): 1.0}


def test_merge_mode_for_tables(spark):
    from termsim import corpus_size, term_frequencies

    df = spark.createDataFrame([(1, "a b"), (1, "b c"), (2, "a")], "id long, txt string")
    c = corpus_from_table(df, "id", "txt", on_duplicate="merge")
    assert corpus_size(c).collect()[0]["n_docs"] == 2
    tf = {(r["doc_id"], r["term"]): (r["n"], r["len"]) for r in term_frequencies(c, None).collect()}
    assert tf == {(1, "a"): (1, 4), (1, "b"): (2, 4), (1, "c"): (1, 4), (2, "a"): (1, 1)}


@pytest.mark.parametrize(
    "kw",
    [
        {"pattern": None, "n": None},
        {"pattern": SHORT, "length": "original", "n": 7},
        {"pattern": None, "search": "^[a-z]*ing$", "n": 3},
    ],
)
def test_wide_lookup_equals_row_lookup(docs, monkeypatch, kw):
    import termsim.operators.lookup as lookup_mod

    qs = ["the", "and", "is", "of", "a", "cake"]
    wide = _rows(similar_terms(docs, qs, **kw), ["query", "rank", "term", "similarity"])
    monkeypatch.setattr(lookup_mod, "WIDE_QUERY_MAX", 0)
    rows = _rows(similar_terms(docs, qs, **kw), ["query", "rank", "term", "similarity"])
    assert wide == rows and wide


def test_distributed_rank_with_sort_merge_offsets(spark, monkeypatch):
    """Many queries and no broadcasts: the offsets join becomes a sort-merge
    join and the positioned rows pass through another shuffle."""
    from pyspark.sql import functions as F

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        parts = spark.read.parquet(f"{SF}/part.parquet").where(F.col("p_size") <= 10)
        qdf = parts.select(F.col("p_partkey").cast("int").alias("pos"), F.col("p_partkey").cast("string").alias("query"))
        baskets = corpus_from_pairs(spark.read.parquet(f"{SF}/lineitem.parquet"), "l_orderkey", "l_partkey")
        scored = query_similarities(baskets, qdf, None)
        s = scored.select("query", "term", F.round("similarity", 9).alias("similarity"))
        ranked = rank_all(s)
        cols = ["query", "rank", "term", "similarity"]
        got = _rows(ranked, cols)
        assert "SortMergeJoin" in ranked._jdf.queryExecution().executedPlan().toString()
        assert got and got == _rows(window_ranks(scored), cols)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("pattern,length,search,n", [(None, "filtered", None, 3), ("^[a-m]", "original", "[aeiou]", 2), (None, "filtered", None, 0)])
def test_long_list_prunes_terms_without_loss(spark, monkeypatch, pattern, length, search, n):
    """The first n of a long list come from terms a bound has left; the joined plan,
    which forms every pair, gives the same."""
    import random

    from termsim import similar_terms
    from termsim.operators import lookup
    from termsim.sources.corpus import to_occurrences

    rng = random.Random(4)
    words = [a + b for a in "abcdefghijklmnop" for b in "aeiou"] + [f"x{k}" for k in range(200)]
    rows = [(d, [words[int(rng.paretovariate(0.4)) % len(words)] for _ in range(rng.randrange(0, 60))]) for d in range(120)]
    docs = spark.createDataFrame(rows, "doc_id int, terms array<string>")
    asked = [*words[:75], "nowhere"]
    monkeypatch.setattr(lookup, "COLUMNS_AT_ONCE", 30)
    monkeypatch.setattr(lookup, "PIVOT_SHARE", 4)
    left = lookup._pruned_similarities(docs, asked, pattern, length, search, max(n, 1), True)
    assert 0 < left.select("term").distinct().count() < len(words)
    got = similar_terms(docs, asked, pattern, length, search, n)
    expected = similar_terms(to_occurrences(docs), asked, pattern, length, search, n)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, expected.collect()))
    monkeypatch.setattr(lookup, "ABLE_TERMS_MAX", 1)  # too many to broadcast: the plan of all pairs
    assert lookup._pruned_similarities(docs, asked, pattern, length, search, max(n, 1), True) is None
    assert sorted(map(tuple, similar_terms(docs, asked, pattern, length, search, n).collect())) == sorted(map(tuple, expected.collect()))
