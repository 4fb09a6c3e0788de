"""Plan shape: the properties the engine relies on at scale."""

import pytest
from pyspark.sql import functions as F

from termsim import corpus_from_table, document_vectors, similar_terms, similarity_matrix

SF = "/root/testdata/sf0.001"


def _final_plan(df) -> str:
    """The adaptive plan as it ran (after ``collect``): the initial plans that
    adaptive subqueries also print are cut out."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().executedPlan().toString()
    kept, skip_indent = [], None
    for line in plan.splitlines():
        indent = len(line) - len(line.lstrip(" :|+-"))
        if "== Initial Plan ==" in line:
            skip_indent = indent
            continue
        if skip_indent is not None:
            if indent >= skip_indent:  # the initial plan's root sits at the header's column
                continue
            skip_indent = None
        kept.append(line)
    return "\n".join(kept)


def _physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def docs(spark):
    return corpus_from_table(spark.read.parquet(f"{SF}/documents.parquet"))


def test_lookup_reads_text_once_and_shares_the_aggregate(docs):
    final = _final_plan(similar_terms(docs, ["the", "and", "is", "of"], pattern=None, n=5))
    text_scans = [ln for ln in final.splitlines() if "FileScan parquet" in ln and "text" in ln]
    assert len(text_scans) == 1, final
    # the query-term statistics (a scalar subquery) read the term aggregate's exchange
    assert final.count("ReusedExchange") >= 1, final
    # statistics of the co-occurring terms sit on the same aggregate row: no join
    assert "HashJoin" not in final and "SortMergeJoin" not in final, final


def test_long_query_lists_share_the_pair_aggregate(docs, monkeypatch):
    import termsim.operators.lookup as lookup_mod

    monkeypatch.setattr(lookup_mod, "WIDE_QUERY_MAX", 2)
    final = _final_plan(similar_terms(docs, ["the", "and", "is", "of"], pattern=None, n=5))
    text_scans = [ln for ln in final.splitlines() if "FileScan parquet" in ln and "text" in ln]
    assert len(text_scans) == 1, final
    assert final.count("ReusedExchange") >= 2, final


def test_matrix_statistics_share_the_pair_aggregate(docs):
    final = _final_plan(similarity_matrix(docs, r"^[a-z]{1,3}$"))
    assert final.count("ReusedExchange") >= 2, final


def test_top_n_uses_group_limit(docs):
    plan = _physical(similar_terms(docs, ["the"], pattern=None, n=5))
    assert "WindowGroupLimit" in plan


def test_full_ranking_is_cut_into_pieces(docs):
    plan = _physical(similar_terms(docs, ["the"], pattern=None, n=None))
    assert "hashpartitioning(query" in plan and "_piece" in plan
    assert "WindowGroupLimit" not in plan


def test_no_python_udf_and_no_cartesian(docs):
    for df in (
        similar_terms(docs, ["the", "and"], pattern=None, n=None),
        similarity_matrix(docs, r"^[a-z]{1,3}$", both_orders=True),
    ):
        plan = _physical(df)
        for bad in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"):
            assert bad not in plan, bad


def test_filters_on_vectors_stay_above_the_fence(docs):
    vec = document_vectors(docs, None).where(F.size("terms") > 5)
    plan = _physical(vec)
    # the size filter is evaluated on the fenced column, not re-inlined into
    # the scan as a chain of sort / transform lambdas
    scan_line = [ln for ln in plan.splitlines() if "FileScan" in ln][0]
    assert "DataFilters: []" in scan_line
    filters = [ln for ln in plan.splitlines() if "Filter" in ln and "FileScan" not in ln]
    assert filters and not any("sort_array" in ln or "array_sort" in ln for ln in filters)


def test_scan_reads_only_needed_columns(docs):
    plan = _physical(similar_terms(docs, ["the"], pattern=None))
    for ln in plan.splitlines():
        if "FileScan parquet" in ln:
            assert "lang" not in ln and "source" not in ln and "n_chars" not in ln


def test_weight_dots_for_a_list_needs_no_join(docs):
    from termsim.operators.lookup import weight_dots

    final = _final_plan(weight_dots(docs, ["the", "and"], None))
    text_scans = [ln for ln in final.splitlines() if "FileScan parquet" in ln and "text" in ln]
    assert len(text_scans) == 1, final
    assert "HashJoin" not in final and "SortMergeJoin" not in final, final


def test_few_pairs_shuffle_no_postings(spark, monkeypatch):
    """Up to PAIR_TERMS_MAX asked terms meet in the rows: no posting is shuffled, and the
    longer plans give the same rows."""
    from termsim.operators import lookup

    docs = spark.createDataFrame(
        [(1, ["a", "b", "a", "c"]), (2, ["a", "c", "d"]), (3, ["b", "b", "d"]), (4, ["c"]), (5, [])], "doc_id int, terms array<string>"
    )
    asked = [("a", "b"), ("b", "a"), ("a", "a"), ("c", "d"), ("a", "zzz"), (None, "a"), ("", "a"), ("a", "b")]
    pairs = spark.createDataFrame(asked, "term1 string, term2 string")

    def rows(corpus):
        got = lookup.cosine_pairs(corpus, pairs, None, check_ids=False)
        plan = got._jdf.queryExecution().executedPlan().toString()
        return sorted((r["term1"] or "-", r["term2"], r["similarity"] or -1.0) for r in got.collect()), "hashpartitioning(doc_id" in plan

    few, shuffled = rows(docs)
    assert len(few) == len(asked) and not shuffled
    joined, shuffled = rows(docs.select("doc_id", F.explode_outer("terms").alias("term")))
    assert joined == few and shuffled
    monkeypatch.setattr(lookup, "PAIR_TERMS_MAX", 0)
    assert rows(docs) == (few, True)
    monkeypatch.setattr(lookup, "SMALL_QUERY_LIST", 0)
    assert rows(docs) == (few, True)


def test_occurrence_lookup_shuffles_pairs_twice(spark):
    """Postings carry their term's norm: pairs are shuffled to be summed and to be ranked,
    not to meet the statistics of either term."""
    rows = [(d, f"t{(d * k) % 7}") for d in range(30) for k in range(1, 4)] + [(99, "t1"), (99, None)]
    occ = spark.createDataFrame(rows, "doc_id int, term string")
    qdf = spark.createDataFrame([(k, f"t{k}") for k in range(9)], "pos int, query string")
    got = similar_terms(occ, qdf, pattern=None, n=3)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    above = plan[: plan.index("Aggregate [query")]  # what is above the sums of pairs
    assert "Join" not in above
    some = spark.createDataFrame([(k, f"t{k}") for k in (2, 2, 4, 8)], "pos int, query string")
    for queries, names, search in ((qdf, range(9), None), (qdf, range(9), "[245]"), (some, (2, 4, 8), None), (some, (2, 4, 8), "[245]")):
        got = similar_terms(occ, queries, pattern=None, n=3, search=search)
        want = similar_terms(occ, [f"t{k}" for k in names], pattern=None, n=3, search=search)
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) != []


def test_occurrence_matrix_shuffles_pairs_once(spark):
    """Postings carry their term's norm: no pair meets the statistics of its terms."""
    rows = [(d, f"t{(d * k) % 7}") for d in range(30) for k in range(1, 4)] + [(d, "all") for d in range(30)] + [(99, "all"), (99, None), (7, "t3")]
    occ = spark.createDataFrame(rows, "doc_id int, term string")
    docs = occ.groupBy("doc_id").agg(F.collect_list("term").alias("terms"))
    for both, length in ((False, "filtered"), (True, "filtered"), (False, "original")):
        got = similarity_matrix(occ, "^(t|all)", length, both_orders=both)
        plan = got._jdf.queryExecution().optimizedPlan().toString()
        above = plan[: plan.index("Aggregate [term1")]  # what is above the sums of pairs
        assert "Join" not in above
        want = similarity_matrix(docs, "^(t|all)", length, both_orders=both)
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) != []
        assert got.where("term1 = 'all'").count() == 0  # in every document
