"""The written index answers lookups exactly like the direct plan."""

import random

import pytest
from pyspark.sql import functions as F

from termsim import corpus_from_pairs, corpus_from_table, similar_terms
from termsim.plans import build_index, index, lookup_index, open_index, remove_old_builds, topn_index

SF = "/root/testdata/sf0.001"
COLS = ["query", "rank", "term", "similarity"]


def _rows(df):
    return sorted(tuple(r[c] for c in COLS) for r in df.collect())


@pytest.fixture(scope="module")
def doc_index(spark, tmp_path_factory):
    docs = corpus_from_table(spark.read.parquet(f"{SF}/documents.parquet"))
    path = str(tmp_path_factory.mktemp("idx") / "documents")
    build_index(docs, path, pattern=None)
    return docs, path


@pytest.mark.parametrize("n,search", [(5, None), (None, None), (3, "^[a-z]*ing$")])
def test_index_lookup_equals_direct(spark, doc_index, n, search):
    docs, path = doc_index
    qs = ["the", "and", "is", "of", "cake"]
    direct = similar_terms(docs, qs, pattern=None, search=search, n=n)
    assert _rows(lookup_index(spark, path, qs, search=search, n=n)) == _rows(direct)


def test_index_with_query_dataframe(spark, doc_index):
    docs, path = doc_index
    qdf = spark.createDataFrame([(1, "the"), (2, "of")], "pos int, query string")
    assert _rows(lookup_index(spark, path, qdf, n=4)) == _rows(similar_terms(docs, ["the", "of"], pattern=None, n=4))


@pytest.fixture
def joined(monkeypatch):
    """All query terms by the bucketed join: neither dense nor few."""
    monkeypatch.setattr(index, "DENSE_SHARE", 2.0)
    monkeypatch.setattr(index, "FEW_POSTINGS", -1)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _scans(df, part):
    return [ln for ln in _plan(df).splitlines() if "FileScan" in ln and f"_{part}" in ln]


def test_index_scan_prunes_by_term(spark, doc_index, joined):
    _, path = doc_index
    for qs, pushed in ((["the"], "EqualTo(term,the)"), (["the", "of"], "In(term, [of,the]")):
        scans = _scans(lookup_index(spark, path, qs), "postings")
        assert scans and all(pushed in ln for ln in scans), scans


def _above(plan, part):
    """The nodes from the join with a table down to its scan."""
    lines = plan.splitlines()
    depth = [len(ln) - len(ln.lstrip(" :+-")) for ln in lines]
    (at,) = [k for k, ln in enumerate(lines) if "FileScan" in ln and f"_{part}" in ln]
    path, level = [], depth[at]
    for k in range(at, -1, -1):
        if depth[k] < level:
            path.append(lines[k])
            level = depth[k]
            if "Join" in lines[k]:
                break
    return path


def test_join_moves_neither_vectors_nor_postings(spark, doc_index, joined):
    """Vectors and query postings meet in their buckets: the first shuffle is that of the sums."""
    docs, path = doc_index
    got = lookup_index(spark, path, ["the", "of", "cake"], n=6)
    plan = _plan(got)
    assert "ShuffledHashJoin [doc_id" in plan and "Sort [doc_id" not in plan
    for part in ("vectors", "postings"):
        assert not any("Exchange" in ln for ln in _above(plan, part)), plan
        assert all("Bucketed: true" in ln for ln in _scans(got, part))
    assert _rows(got) == _rows(similar_terms(docs, ["the", "of", "cake"], pattern=None, n=6))


def test_query_dataframe_does_not_move_the_vectors(spark, doc_index):
    docs, path = doc_index
    got = lookup_index(spark, path, spark.createDataFrame([(1, "the"), (2, "of")], "pos int, query string"), n=6)
    assert "Join" in _above(_plan(got), "vectors")[-1] and not any("Exchange" in ln for ln in _above(_plan(got), "vectors"))
    assert _rows(got) == _rows(similar_terms(docs, ["the", "of"], pattern=None, n=6))


def test_dense_terms_are_filtered_in_place(spark, doc_index):
    docs, path = doc_index
    got = lookup_index(spark, path, ["the", "and"], n=4)
    assert not _scans(got, "postings") and len(_scans(got, "vectors")) == 1 and "ShuffledHashJoin" not in _plan(got)
    assert _rows(got) == _rows(similar_terms(docs, ["the", "and"], pattern=None, n=4))


def test_index_for_pair_corpus(spark, tmp_path):
    baskets = corpus_from_pairs(spark.read.parquet(f"{SF}/lineitem.parquet"), "l_orderkey", "l_partkey")
    path = str(tmp_path / "baskets")
    build_index(baskets, path, pattern=None)
    qs = ["1", "2", "3", "17"]
    assert _rows(lookup_index(spark, path, qs, n=None)) == _rows(similar_terms(baskets, qs, pattern=None, n=None))


def test_few_documents_are_looked_up_by_id(spark, doc_index):
    docs, path = doc_index
    stats = open_index(spark, path).stats().where("df = 1").orderBy("term")
    rare = stats.first()["term"]
    got = lookup_index(spark, path, [rare], n=50)
    (scan,) = _scans(got, "vectors")
    assert "EqualTo(doc_id" in scan and "SelectedBucketsCount: 1 out of 4" in scan
    assert _rows(got) == _rows(similar_terms(docs, [rare], pattern=None, n=50))
    assert lookup_index(spark, path, ["zzzz-not-a-term"]).count() == 0


def test_index_with_pattern_and_original_length(spark, tmp_path):
    docs = corpus_from_table(spark.read.parquet(f"{SF}/documents.parquet"))
    path = str(tmp_path / "short")
    short = r"^[a-z]{1,3}$"
    build_index(docs, path, pattern=short, length="original", buckets=16)
    qs = ["the", "and", "of"]
    direct = similar_terms(docs, qs, pattern=short, length="original", n=None)
    assert _rows(lookup_index(spark, path, qs, n=None)) == _rows(direct)


def test_rebuild_with_another_shape(spark, tmp_path):
    path = str(tmp_path / "idx")
    docs = spark.createDataFrame([("1", ["a", "b"]), ("2", ["a", "c"]), ("3", ["d"])], "doc_id string, terms array<string>")
    occ = spark.createDataFrame([("1", "x"), ("1", "y"), ("2", "x"), ("2", "w"), ("3", "v")], "doc_id string, term string")
    build_index(docs, path, pattern=None)
    assert _rows(lookup_index(spark, path, ["a"])) == _rows(similar_terms(docs, ["a"], pattern=None))
    build_index(occ, path, pattern=None, mode="overwrite")
    assert _rows(lookup_index(spark, path, ["x"])) == _rows(similar_terms(occ, ["x"], pattern=None))
    with pytest.raises(Exception, match="exists|EXISTS"):
        build_index(docs, path, pattern=None)
    with pytest.raises(ValueError):
        build_index(docs, path, pattern=None, mode="append")


def test_repeated_ids_stop_a_build_before_it_writes(spark, tmp_path):
    path = tmp_path / "idx"
    docs = spark.createDataFrame([("1", ["a"]), ("1", ["b"])], "doc_id string, terms array<string>")
    with pytest.raises(Exception, match="repeated"):
        build_index(docs, str(path), pattern=None)
    assert not path.exists()
    with pytest.raises(ValueError):
        lookup_index(spark, str(path), ["a"])


def test_a_failed_build_blocks_nothing(spark, tmp_path):
    path = str(tmp_path / "idx")
    bad = spark.createDataFrame([("1", ["a"]), ("1", ["b"])], "doc_id string, terms array<string>")
    good = spark.createDataFrame([("1", ["a", "b"]), ("2", ["a", "c"]), ("3", ["d"])], "doc_id string, terms array<string>")
    for mode in ("error", "overwrite"):
        with pytest.raises(Exception, match="repeated"):
            build_index(bad, path, pattern=None, mode=mode)
    build_index(good, path, pattern=None)
    with pytest.raises(Exception, match="repeated"):
        build_index(bad, path, pattern=None, mode="overwrite")
    assert _rows(lookup_index(spark, path, ["a"])) == _rows(similar_terms(good, ["a"], pattern=None))


def test_old_builds_are_removed(spark, tmp_path):
    path = str(tmp_path / "idx")
    docs = spark.createDataFrame([(1, ["a", "b"]), (2, ["a", "c"]), (3, ["d"])], "doc_id int, terms array<string>")
    build_index(docs, path, pattern=None)
    first = open_index(spark, path).row["version"]
    build_index(docs.where("doc_id > 1"), path, pattern=None, mode="overwrite")
    topn_index(spark, path, ["a"])
    other = tmp_path / "idx" / "notes"
    other.mkdir()
    gone = remove_old_builds(spark, path)
    assert first in gone and len(gone) == 2  # the first build and the written rounds
    assert {p.name for p in (tmp_path / "idx").iterdir()} == {"builds", "notes", open_index(spark, path).row["version"]}
    with pytest.raises(ValueError):
        remove_old_builds(spark, str(other))
    assert [r["term"] for r in lookup_index(spark, path, ["a"]).collect()] == ["c"]


def test_another_session_learns_the_buckets(spark, doc_index, joined):
    """The catalog of a session that did not build the index has no table of it."""
    docs, path = doc_index
    opened = open_index(spark, path)
    for part in ("vectors", "postings"):
        spark.sql(f"DROP TABLE {index._table_name(opened.base, part)}")
    got = lookup_index(spark, path, ["cake"], n=3)
    assert all("Bucketed: true" in ln for ln in _scans(got, "vectors"))
    assert _rows(got) == _rows(similar_terms(docs, ["cake"], pattern=None, n=3))


# --------------------------------------------------------------------------
# top n with early stop
# --------------------------------------------------------------------------


@pytest.mark.parametrize("n,search,share", [(10, None, 0.5), (3, "^[a-z]*ing$", 0.8)])
def test_topn_equals_direct(spark, doc_index, n, search, share):
    docs, path = doc_index
    qs = ["the", "and", "is", "of", "cake", "zzzz-not-a-term", "the"]
    rounds = []
    got = topn_index(spark, path, qs, n=n, search=search, share=share, report=rounds)
    assert _rows(got) == _rows(similar_terms(docs, qs, pattern=None, search=search, n=n))
    assert rounds[-1].blocks_read <= rounds[-1].blocks and rounds[-1].postings_read <= rounds[-1].postings


def test_topn_reads_fewer_blocks(spark, tmp_path):
    """Frequent terms are alike, so the threshold is high after the heaviest blocks."""
    docs = corpus_from_table(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))
    path = str(tmp_path / "idx")
    build_index(docs, path, pattern=None)
    rounds = []
    got = topn_index(spark, path, ["the", "and", "is", "of"], n=10, report=rounds)
    assert _rows(got) == _rows(similar_terms(docs, ["the", "and", "is", "of"], pattern=None, n=10))
    last = rounds[-1]
    assert last.blocks_read < last.blocks and last.postings_read < 0.7 * last.postings
    assert last.candidates < 0.05 * open_index(spark, path).stats().count()


@pytest.mark.parametrize("seed", range(2))
def test_topn_on_random_corpora(spark, tmp_path, seed):
    """Ties, terms of one document, terms found everywhere, both corpus shapes."""
    rng = random.Random(seed)
    vocabulary = [f"t{k}" for k in range(25)]
    rows = [(d, [rng.choice(vocabulary[: rng.randrange(2, 26)]) for _ in range(rng.randrange(1, 30))]) for d in range(40)]
    docs = spark.createDataFrame(rows, "doc_id int, terms array<string>")
    corpus = docs if seed % 2 else docs.select("doc_id", F.explode("terms").alias("term"))
    path = str(tmp_path / "idx")
    build_index(corpus, path, pattern=None)
    qs = vocabulary[::3]
    assert _rows(topn_index(spark, path, qs, n=3, share=0.7)) == _rows(similar_terms(corpus, qs, pattern=None, n=3))


def test_topn_with_many_candidates(spark, doc_index, monkeypatch):
    """More terms left than fit into a list: their postings are found by a join."""
    docs, path = doc_index
    monkeypatch.setattr(index, "SMALL_QUERY_LIST", 3)
    got = topn_index(spark, path, ["the", "of"], n=20, share=0.9)
    assert _rows(got) == _rows(similar_terms(docs, ["the", "of"], pattern=None, n=20))


def test_topn_blocks_spread_over_buckets(spark, doc_index):
    """A term's postings lie in as many files as its documents have buckets."""
    _, path = doc_index
    postings = open_index(spark, path).bucketed("postings").where("term = 'the'")
    assert postings.select(F.input_file_name()).distinct().count() == 4
    assert postings.select("level").distinct().count() > 5


def test_topn_arguments(spark, doc_index):
    _, path = doc_index
    for bad in ({"n": 0}, {"share": 1.0}):
        with pytest.raises(ValueError):
            topn_index(spark, path, ["the"], **bad)
    assert topn_index(spark, path, [], n=2).count() == 0


def test_build_shuffles_no_postings(spark, tmp_path, monkeypatch):
    """The postings are read from the buckets of the written vectors, one file each."""
    from termsim.plans import index

    seen, write = {}, index._write_bucketed
    auto = "spark.sql.sources.bucketing.autoBucketedScan.enabled"
    before = spark.conf.get(auto)

    def record(df, base, part, *rest, **more):
        spark.conf.set(auto, "false")
        seen[part] = df._jdf.queryExecution().executedPlan().toString()
        spark.conf.set(auto, before)
        write(df, base, part, *rest, **more)
        seen[f"{part} files"] = len(list((tmp_path / base.rsplit("/", 1)[1] / part).glob("*.parquet")))

    monkeypatch.setattr(index, "_write_bucketed", record)
    rows = [(d, [f"t{(d * k) % 11}" for k in range(1, 8)]) for d in range(40)]
    build_index(spark.createDataFrame(rows, "doc_id int, terms array<string>"), str(tmp_path), pattern=None, buckets=5)
    assert "Bucketed: true" in seen["postings"] and "Exchange" not in seen["postings"]
    assert seen["vectors files"] == seen["postings files"] == 5
    assert spark.conf.get(auto) == before
