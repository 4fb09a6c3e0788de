
import math

import pytest
from pyspark.errors import PySparkException
from pyspark.sql.utils import CapturedException

from conftest import F1
from termsim import (
    corpus_size,
    idf,
    query_frame,
    read_corpus,
    similar_terms,
    similarity_matrix,
    term_frequencies,
    terms_not_found,
)


def test_term_in_every_document_has_no_rows(lines):
    c = lines(["E1 a b", "E2 a c"])
    assert similarity_matrix(c, None).count() == 0
    assert similar_terms(c, ["a", "b", "c"], pattern=None).count() == 0


def test_single_document(lines):
    assert similarity_matrix(lines(["E1 a b"]), None).count() == 0


def test_blank_lines_are_not_documents(lines):
    with_blank = lines(F1 + ["", "   \t "])
    assert corpus_size(with_blank).collect()[0]["n_docs"] == 4
    a = similar_terms(with_blank, ["data"], pattern=None, n=None).collect()
    b = similar_terms(lines(F1), ["data"], pattern=None, n=None).collect()
    assert sorted(map(tuple, a)) == sorted(map(tuple, b))


def test_id_only_line_counts_in_n(lines):
    c = lines(F1 + ["D5"])
    got = {r["term"]: (r["df"], r["idf"]) for r in idf(term_frequencies(c, None), corpus_size(c)).collect()}
    assert math.isclose(got["B"][1], math.log(5))
    assert math.isclose(got["A"][1], math.log(5 / 2))
    assert math.isclose(got["data"][1], math.log(5 / 3))


def test_duplicate_id_errors_by_default(lines):
    c = lines(F1 + ["D1 more"])
    with pytest.raises((PySparkException, CapturedException, Exception)) as err:
        similar_terms(c, ["data"], pattern=None).collect()
    assert "repeated or NULL doc_id" in str(err.value)


def test_duplicate_id_merge(spark, tmp_path):
    p = tmp_path / "c.txt"
    p.write_text("\n".join(F1 + ["D1 more data"]) + "\n")
    merged = read_corpus(spark, str(p), on_duplicate="merge")
    assert corpus_size(merged).collect()[0]["n_docs"] == 4
    tf = {(r["doc_id"], r["term"]): (r["n"], r["len"]) for r in term_frequencies(merged, None).collect()}
    assert tf[("D1", "data")] == (2, 6)
    assert tf[("D1", "more")] == (1, 6)


@pytest.mark.parametrize("sep", ["\t", "\u00a0", "\u3000", "\u001f", "\u0085", "\u2028", "\x0b"])
def test_whitespace_variants(lines, sep):
    c = lines([f"D1{sep}a{sep}{sep}b"])
    assert c.collect()[0]["terms"] == ["a", "b"]


def test_zero_width_space_is_not_whitespace(lines):
    assert lines(["D1 a\u200bb"]).collect()[0]["terms"] == ["a\u200bb"]


def test_pattern_found_anywhere(lines):
    c = lines(["X xdis_a_disy dis__dis dis_dis"])
    kept = sorted(r["term"] for r in term_frequencies(c).collect())
    assert kept == ["dis__dis", "xdis_a_disy"]


def test_top_n_zero_none_negative(lines):
    c = lines(F1)
    assert similar_terms(c, ["data"], pattern=None, n=0).count() == 0
    assert similar_terms(c, ["data"], pattern=None, n=None).count() == 6
    with pytest.raises(ValueError):
        similar_terms(c, ["data"], pattern=None, n=-1)


def test_search_before_ranking(lines):
    got = similar_terms(lines(F1), ["data"], pattern=None, search="^[a-z]", n=3).orderBy("rank").collect()
    assert [(r["rank"], r["term"]) for r in got] == [(1, "like"), (2, "hate"), (3, "science")]


def test_duplicate_queries_and_not_found(spark, lines):
    c = lines(F1)
    qs = ["data", "like", "data", "cake"]
    qf = query_frame(spark, qs)
    assert [tuple(r) for r in qf.orderBy("pos").collect()] == [(1, "data"), (2, "like"), (4, "cake")]
    ranked = similar_terms(c, qs, pattern=None, n=None)
    assert ranked.select("query").distinct().count() == 2
    assert [tuple(r) for r in terms_not_found(qf, ranked).collect()] == [(4, "cake")]


def test_query_filtered_out_is_not_found(spark, lines):
    c = lines(F1)
    qf = query_frame(spark, ["data"])
    ranked = similar_terms(c, ["data"], pattern="^[A-Z]")
    assert [tuple(r) for r in terms_not_found(qf, ranked).collect()] == [(1, "data")]


def test_empty_query_list(lines):
    assert similar_terms(lines(F1), [], pattern=None).count() == 0


def test_null_doc_id_is_reported(spark):
    from termsim import corpus_from_table

    df = spark.createDataFrame([(1, "a b"), (None, "b c"), (2, "a c")], "id long, txt string")
    with pytest.raises(Exception) as err:
        similar_terms(corpus_from_table(df, "id", "txt"), ["a"], pattern=None).collect()
    assert "NULL doc_id" in str(err.value)


@pytest.mark.parametrize("extra", [62, 63, 90])
def test_empty_and_null_terms_at_any_list_length(spark, extra):
    """The plan for long query lists answers like the one for short lists."""
    docs = spark.createDataFrame(
        [("1", ["", "a", "b"]), ("2", ["", "a", None]), ("3", ["b", "c", None, None]), ("4", ["c"])], "doc_id string, terms array<string>"
    )
    expected = sorted(map(tuple, similar_terms(docs, ["", "a"], pattern=None, n=None).collect()))
    queries = ["", "a"] + [f"unknown{i}" for i in range(extra)]
    assert sorted(map(tuple, similar_terms(docs, queries, pattern=None, n=None).collect())) == expected
    assert expected and not any(r[2] is None for r in expected)


def test_null_terms_count_alike_in_both_shapes(spark):
    from termsim import term_frequencies, to_occurrences

    docs = spark.createDataFrame([("1", [None, "a", "b"]), ("2", [None])], "doc_id string, terms array<string>")
    rows = lambda df: sorted(map(tuple, df.collect()))
    assert rows(term_frequencies(docs, None)) == rows(term_frequencies(to_occurrences(docs), None)) == [("1", "a", 1, 2, 0.5), ("1", "b", 1, 2, 0.5)]


def test_cosine_of_known_unknown_and_disjoint_terms(spark, lines):
    from termsim import cosine_pairs

    docs = lines(["D1 a b", "D2 a x", "D3 c d", "D4 c"])
    pairs = spark.createDataFrame([("a", "a"), ("a", "c"), ("a", "nope"), ("nope", "nope"), ("a", "b")], "term1 string, term2 string")
    got = {(r[0], r[1]): r[2] for r in cosine_pairs(docs, pairs, None).collect()}
    assert got["a", "a"] == 1.0 and got["a", "c"] == 0.0 and got["a", "nope"] is None and got["nope", "nope"] is None
    assert 0 < got["a", "b"] < 1
    everywhere = lines(["D1 a b", "D2 a c"])  # norm 0: in every document
    assert cosine_pairs(everywhere, spark.createDataFrame([("a", "a")], "term1 string, term2 string"), None).first()[2] is None


def test_building_a_corpus_runs_no_job(spark):
    from pyspark.sql import functions as F

    from termsim import corpus_from_table

    grouped = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet").groupBy("l_orderkey").agg(F.max(F.col("l_partkey").cast("string")).alias("c"))
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("build", "build")
    try:
        corpus_from_table(grouped, "l_orderkey", "c")
        assert list(tracker.getJobIdsForGroup("build")) == []
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_pairs_of_a_long_document_are_cut(spark, monkeypatch):
    import termsim.operators.similarity as sim

    rows = [("big", f"t{i % 70}") for i in range(100)] + [("d2", "t1"), ("d2", "t2"), ("d3", "t1"), ("d4", "z")]
    occ = spark.createDataFrame(rows, "doc_id string, term string")
    key = lambda df: sorted((r["term1"], r["term2"], r["similarity"]) for r in df.collect())
    whole = key(sim.similarity_matrix(occ, None))
    monkeypatch.setattr(sim, "BLOCK_TERMS", 16)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        cut = sim.similarity_matrix(occ, None)
        assert key(cut) == whole and len(whole) > 2000
        assert "hashpartitioning(doc_id" in cut._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
