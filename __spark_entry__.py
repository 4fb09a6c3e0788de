"""

``entry(spark)`` runs the flagship lookup on sf0.001. ``queries()`` maps each
``oracle_sql()`` gives the same result as DuckDB SQL, written independently
from the reference formulas (TF-IDF weights joined per document, cosine from
the weights), so it also checks the engine's algebraic shortcuts.

Corpora used (always whole tables):
* ``documents``: document = ``doc_id``, terms = whitespace tokens of ``text``;
* ``lineitem``: document = order (``l_orderkey``), term = part (``l_partkey``);
* ``events``: document = user, term = event type (every type occurs for every
  user, so every term has idf 0: the zero-norm case);
* ``part``: all parts as a query set for the order baskets.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from termsim.functions.text import tokenize
from termsim.operators.compare import TOLERANCE, similarity_diff
from termsim.operators.frequencies import corpus_size, doc_lengths, term_frequencies
from termsim.operators.lookup import (
    cosine_pairs,
    query_frame,
    similar_terms,
    terms_not_found,
    weight_dots,
)
from termsim.operators.report import report_lines
from termsim.operators.similarity import matrix_axis, rounded, similarity_matrix
from termsim.operators.weights import document_frequency, idf, term_norms, tfidf
from termsim.plans.index import build_index, lookup_index, topn_index
from termsim.plans.jobs import tfidf_job
from termsim.plans.nearest import nearest_terms
from termsim.session import checkpoint_dir
from termsim.sources.corpus import corpus_from_pairs, corpus_from_table, parse_lines, read_corpus, to_occurrences

# Query parameters (the reference's command-line arguments).
QUERIES = ["the", "and", "is", "of"]
BATCH_QUERIES = ["the", "and", "the", "cake", "is", "of", "and"]
MISSING_QUERIES = ["the", "cake", "The", "zzzz", "of"]
REPORT_QUERIES = ["the", "cake", "of"]
SHORT_WORDS = r"^[a-z]{1,3}$"
FUNCTION_WORDS = r"^(the|and|of|to|in|is|was|for|on|with)$"
SEARCH = r"^[a-z]*ing$"
PART_PATTERN = r"^1"
# More query terms than the term-keyed plan takes: letter pairs, most of them unknown.
LONG_LIST = QUERIES + [a + b for a in "aeinorst" for b in "adehnorst" if a + b not in QUERIES]
# 100 letter pairs, all 10,000 pairs of them: some frequent, some rare, some unknown.
PAIR_TERMS = [a + b for a in "aeinorstdl" for b in "adehnorstu"]
COSINE_PAIRS = [(a, b) for a in QUERIES for b in QUERIES] + [("the", "cake"), ("cake", "cake")]


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_from_table(_read(spark, sf_dir, "documents"), "doc_id", "text")


def _baskets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_from_pairs(_read(spark, sf_dir, "lineitem"), "l_orderkey", "l_partkey")


def _r9(name: str):
    return rounded(F.col(name)).alias(name)


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: the 5 terms most similar to each of four query terms."""
    return similar_terms(_documents(spark, "/root/testdata/sf0.001"), QUERIES, pattern=None, n=5)


# --------------------------------------------------------------------------
# Spark side
# --------------------------------------------------------------------------


def q_corpus_scan(spark, sf):
    lines = _read(spark, sf, "documents").select(
        F.concat(F.col("doc_id").cast("string"), F.lit(" "), F.col("text")).alias("value")
    )
    docs = parse_lines(lines)
    return docs.select("doc_id", F.posexplode("terms").alias("pos", "term"))


def q_tokenize(spark, sf):
    docs = _read(spark, sf, "documents").select("doc_id", tokenize(F.col("text")).alias("t"))
    return docs.select("doc_id", F.posexplode("t").alias("pos", "term"))


def q_doc_lengths(spark, sf):
    return doc_lengths(_documents(spark, sf), SHORT_WORDS)


def q_term_filter(spark, sf):
    return term_frequencies(_documents(spark, sf), FUNCTION_WORDS).select("doc_id", "term", "n")


def q_tf_nofilter(spark, sf):
    return term_frequencies(_documents(spark, sf), None)


def q_term_frequency(spark, sf):
    return term_frequencies(_baskets(spark, sf), None)


def q_tf_filtered_len(spark, sf):
    return term_frequencies(_documents(spark, sf), SHORT_WORDS, "filtered")


def q_tf_original_len(spark, sf):
    return term_frequencies(_documents(spark, sf), SHORT_WORDS, "original")


def q_postings(spark, sf):
    return term_frequencies(_documents(spark, sf), SHORT_WORDS).select("term", "doc_id", "tf")


def q_inverted_index(spark, sf):
    return term_frequencies(_baskets(spark, sf), None).select("term", "doc_id", "tf")


def q_corpus_size(spark, sf):
    return corpus_size(_documents(spark, sf))


def q_corpus_size_merged(spark, sf):
    # every source is one document made of all its texts
    merged = corpus_from_table(_read(spark, sf, "documents"), "source", "text", on_duplicate="merge")
    return corpus_size(merged)


def q_document_frequency(spark, sf):
    return document_frequency(term_frequencies(_documents(spark, sf), None))


def q_idf(spark, sf):
    docs = _documents(spark, sf)
    return idf(term_frequencies(docs, None), corpus_size(docs)).select("term", "df", _r9("idf"))


def q_tfidf(spark, sf):
    docs = _documents(spark, sf)
    return tfidf(term_frequencies(docs, None), corpus_size(docs)).select("term", "doc_id", _r9("w"))


def q_term_norms(spark, sf):
    docs = _documents(spark, sf)
    return term_norms(term_frequencies(docs, None), corpus_size(docs)).select("term", _r9("norm"))


def q_dot_product(spark, sf):
    return weight_dots(_documents(spark, sf), QUERIES, None).select("query", "term", _r9("dot"))


def q_cosine_pair(spark, sf):
    pairs = spark.createDataFrame(COSINE_PAIRS, "term1 string, term2 string")
    return cosine_pairs(_documents(spark, sf), pairs, None)


def q_similarity_matrix(spark, sf):
    return similarity_matrix(_baskets(spark, sf), None)


def q_similarity_matrix_docs(spark, sf):
    return similarity_matrix(_documents(spark, sf), SHORT_WORDS)


def q_similarity_matrix_full(spark, sf):
    return similarity_matrix(_documents(spark, sf), SHORT_WORDS, both_orders=True)


def q_matrix_axis(spark, sf):
    return matrix_axis(_documents(spark, sf), None)


def q_similarity_matrix_events(spark, sf):
    events = corpus_from_pairs(_read(spark, sf, "events"), "user_id", "event_type")
    return similarity_matrix(events, None)


def q_similar_terms(spark, sf):
    return similar_terms(_documents(spark, sf), QUERIES, pattern=None, n=None)


def q_similar_terms_topn(spark, sf):
    return similar_terms(_documents(spark, sf), QUERIES, pattern=None, n=10)


def q_similar_terms_search(spark, sf):
    return similar_terms(_documents(spark, sf), QUERIES, pattern=None, search=SEARCH, n=5)


def q_similar_terms_filtered(spark, sf):
    return similar_terms(_documents(spark, sf), QUERIES, pattern=SHORT_WORDS, n=5)


def q_similar_terms_original_len(spark, sf):
    return similar_terms(_documents(spark, sf), QUERIES, pattern=SHORT_WORDS, length="original", n=5)


def q_similar_terms_joined(spark, sf):
    # the same lookup through the occurrence-row plan (join on doc_id)
    return similar_terms(to_occurrences(_documents(spark, sf)), QUERIES, pattern=None, n=5)


def q_similarity_matrix_parts_original_len(spark, sf):
    return similarity_matrix(_baskets(spark, sf), PART_PATTERN, length="original")


def q_similar_terms_batch(spark, sf):
    qf = query_frame(spark, BATCH_QUERIES)
    ranked = similar_terms(_documents(spark, sf), BATCH_QUERIES, pattern=None, n=5)
    return qf.join(ranked, "query").select("pos", "query", "rank", "term", "similarity")


def q_similar_parts(spark, sf):
    qdf = _read(spark, sf, "part").select(
        F.col("p_partkey").cast("int").alias("pos"), F.col("p_partkey").cast("string").alias("query")
    )
    return similar_terms(_baskets(spark, sf), qdf, pattern=None, n=5)


def q_terms_not_found(spark, sf):
    qf = query_frame(spark, MISSING_QUERIES)
    ranked = similar_terms(_documents(spark, sf), MISSING_QUERIES, pattern=None, n=5)
    return terms_not_found(qf, ranked)


def q_report_lines(spark, sf):
    qf = query_frame(spark, REPORT_QUERIES)
    ranked = similar_terms(_documents(spark, sf), REPORT_QUERIES, pattern=None, n=5)
    return report_lines(qf, ranked)


def q_similarity_diff(spark, sf):
    # the two length modes weigh terms differently, so cells do differ
    docs = _documents(spark, sf)
    filtered = similarity_matrix(docs, SHORT_WORDS)
    original = similarity_matrix(to_occurrences(docs), SHORT_WORDS, length="original")
    return similarity_diff(filtered, original)


def q_similar_terms_top2000(spark, sf):
    return similar_terms(_documents(spark, sf), QUERIES, pattern=None, n=2000)


def q_similar_terms_long_list(spark, sf):
    return similar_terms(_documents(spark, sf), LONG_LIST, pattern=None, n=5)


def _shared(spark) -> str:
    """A folder for what a query writes: the session's shared one; local sessions
    that name none get a scratch folder."""
    base = checkpoint_dir(spark)
    if base is None and spark.sparkContext.master.startswith("local["):
        base = tempfile.mkdtemp(prefix="run-")
    if base is None:
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    return f"{base.rstrip('/')}/termsim-{uuid.uuid4().hex}"


def q_text_corpus(spark, sf):
    # the documents as text files, one per line (line breaks inside become spaces)
    path = _shared(spark)
    text = F.regexp_replace(F.coalesce("text", F.lit("")), r"[\n\r]", " ")
    _read(spark, sf, "documents").select(F.concat(F.col("doc_id").cast("string"), F.lit(" "), text)).write.text(path)
    return read_corpus(spark, path).select("doc_id", F.posexplode("terms").alias("pos", "term"))


def q_index_lookup(spark, sf):
    path = _shared(spark)
    build_index(_documents(spark, sf), path, pattern=None)
    return lookup_index(spark, path, QUERIES, n=10)


def q_tfidf_one_scan(spark, sf):
    return tfidf_job(_documents(spark, sf), pattern=None, folder=_shared(spark)).select("term", "doc_id", _r9("w"))


def q_index_topn(spark, sf):
    path = _shared(spark)
    build_index(_documents(spark, sf), path, pattern=None)
    return topn_index(spark, path, QUERIES, n=10)


def _nearest_rounded(spark, corpus):
    # ranked by 9 decimals, shown with 6
    ranked = nearest_terms(corpus, pattern=None, n=5, folder=_shared(spark))
    return ranked.withColumn("similarity", F.round("similarity", 6))


def q_nearest_terms(spark, sf):
    return _nearest_rounded(spark, _documents(spark, sf))


def q_nearest_parts(spark, sf):
    return _nearest_rounded(spark, _baskets(spark, sf))


def q_cosine_pairs_many(spark, sf):
    rows = [(a, b) for a in PAIR_TERMS for b in PAIR_TERMS]
    return cosine_pairs(_documents(spark, sf), spark.createDataFrame(rows, "term1 string, term2 string"), pattern=None)


def _llm() -> tuple[dict, dict]:
    """Queries and SQL of the training-data operators and the pipeline, when
    they can be imported (the rest of the library does not need them)."""
    try:
        import corpus_pipeline
        from termsim.llm.queries import ORACLE_SQL, QUERIES
    except ImportError:
        return {}, {}

    more = {} if corpus_pipeline.ORACLE_SQL is None else {"pipeline": corpus_pipeline.ORACLE_SQL}
    return {**QUERIES, "pipeline": corpus_pipeline.run}, {**ORACLE_SQL, **more}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """
    the training-data operators."""
    return {**_reference_queries(), **_llm()[0]}


def _reference_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "corpus_scan": q_corpus_scan,
        "tokenize": q_tokenize,
        "doc_lengths": q_doc_lengths,
        "term_filter": q_term_filter,
        "tf_nofilter": q_tf_nofilter,
        "term_frequency": q_term_frequency,
        "tf_filtered_len": q_tf_filtered_len,
        "tf_original_len": q_tf_original_len,
        "postings": q_postings,
        "inverted_index": q_inverted_index,
        "corpus_size": q_corpus_size,
        "corpus_size_merged": q_corpus_size_merged,
        "document_frequency": q_document_frequency,
        "idf": q_idf,
        "tfidf": q_tfidf,
        "term_norms": q_term_norms,
        "dot_product": q_dot_product,
        "cosine_pair": q_cosine_pair,
        "similarity_matrix": q_similarity_matrix,
        "similarity_matrix_docs": q_similarity_matrix_docs,
        "similarity_matrix_full": q_similarity_matrix_full,
        "matrix_axis": q_matrix_axis,
        "similarity_matrix_events": q_similarity_matrix_events,
        "similar_terms": q_similar_terms,
        "similar_terms_topn": q_similar_terms_topn,
        "similar_terms_search": q_similar_terms_search,
        "similar_terms_filtered": q_similar_terms_filtered,
        "similar_terms_original_len": q_similar_terms_original_len,
        "similar_terms_joined": q_similar_terms_joined,
        "similarity_matrix_parts_original_len": q_similarity_matrix_parts_original_len,
        "similar_terms_batch": q_similar_terms_batch,
        "similar_parts": q_similar_parts,
        "terms_not_found": q_terms_not_found,
        "report_lines": q_report_lines,
        "similarity_diff": q_similarity_diff,
        "similar_terms_top2000": q_similar_terms_top2000,
        "similar_terms_long_list": q_similar_terms_long_list,
        "text_corpus": q_text_corpus,
        "index_lookup": q_index_lookup,
        "tfidf_one_scan": q_tfidf_one_scan,
        "index_topn": q_index_topn,
        "nearest_terms": q_nearest_terms,
        "nearest_parts": q_nearest_parts,
        "cosine_pairs_many": q_cosine_pairs_many,
    }


# --------------------------------------------------------------------------
# DuckDB side
# --------------------------------------------------------------------------

# Same character set as the engine's separator, in RE2 syntax (RE2's \s has no \x0b).
_WS = r"[\s\x0b\x1c-\x1f\x{85}\p{Z}]+"


def _kept(col: str, pattern: str | None) -> str:
    return "TRUE" if pattern is None else f"regexp_matches({col}, '{pattern}')"


def _docs_sql(pattern: str | None = None, length: str = "filtered") -> str:
    ln = "kept_len" if length == "filtered" else "orig_len"
    return f"""
tok AS (SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '{_WS}'), lambda x: x <> '') AS ws FROM documents),
lens AS (SELECT doc_id, len(ws) AS orig_len, len(list_filter(ws, lambda x: {_kept('x', pattern)})) AS kept_len FROM tok),
occ AS (SELECT doc_id, unnest(ws) AS term FROM tok),
nd AS (SELECT count(*) AS n_docs FROM documents),
tf AS (SELECT doc_id, term, count(*) AS n, any_value({ln}) AS len, count(*) / any_value({ln})::DOUBLE AS tf
       FROM occ JOIN lens USING (doc_id) WHERE {_kept('term', pattern)} GROUP BY doc_id, term)"""


def _pairs_sql(table: str, doc: str, term: str, pattern: str | None = None, length: str = "filtered") -> str:
    ln = "kept_len" if length == "filtered" else "orig_len"
    return f"""
occ AS (SELECT {doc} AS doc_id, CAST({term} AS VARCHAR) AS term FROM {table}),
lens AS (SELECT doc_id, count(term) AS orig_len, count(term) FILTER (WHERE {_kept('term', pattern)}) AS kept_len
         FROM occ GROUP BY doc_id),
nd AS (SELECT count(DISTINCT doc_id) AS n_docs FROM occ),
tf AS (SELECT doc_id, term, count(*) AS n, any_value({ln}) AS len, count(*) / any_value({ln})::DOUBLE AS tf
       FROM occ JOIN lens USING (doc_id) WHERE term IS NOT NULL AND {_kept('term', pattern)} GROUP BY doc_id, term)"""


_WEIGHTS = """
st AS (SELECT term, count(*) AS df, sum(tf * tf) AS sumsq FROM tf GROUP BY term),
idf AS (SELECT term, df, ln((SELECT n_docs FROM nd) / df::DOUBLE) AS idf FROM st),
w AS (SELECT tf.term, tf.doc_id, tf.tf, idf.idf, tf.tf * idf.idf AS w FROM tf JOIN idf USING (term)),
nrm AS (SELECT term, sqrt(sum(w * w)) AS norm FROM w GROUP BY term),
u AS (SELECT w.term, w.doc_id, w.w, nrm.norm FROM w JOIN nrm USING (term) WHERE nrm.norm > 0)"""


def _in_list(values: list[str]) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in dict.fromkeys(values))


def _ranked_sql(base: str, qs: list[str], n: int | None, search: str | None = None) -> str:
    """WITH-list (without WITH) ending in ``rk(query, rank, term, similarity)``."""
    cut = "" if n is None else f"WHERE rank <= {n}"
    srch = "" if search is None else f"AND regexp_matches(b.term, '{search}')"
    return f"""{base},{_WEIGHTS},
qs AS (SELECT a.term AS query, b.term AS term,
              sum(a.w * b.w) / (any_value(a.norm) * any_value(b.norm)) AS similarity
       FROM u a JOIN u b USING (doc_id)
       WHERE a.term IN ({_in_list(qs)}) AND a.term <> b.term {srch}
       GROUP BY 1, 2),
rk0 AS (SELECT query,
               CAST(row_number() OVER (PARTITION BY query ORDER BY round(similarity, 9) DESC, term) AS INTEGER) AS rank,
               term, round(similarity, 9) AS similarity
        FROM qs WHERE similarity > 0),
rk AS (SELECT * FROM rk0 {cut})"""


def _ranked(base: str, qs: list[str], n: int | None, search: str | None = None) -> str:
    return f"WITH {_ranked_sql(base, qs, n, search)} SELECT query, rank, term, similarity FROM rk"


def _matrix(base: str, both_orders: bool = False) -> str:
    cond = "a.term <> b.term" if both_orders else "a.term < b.term"
    diag = (
        " UNION ALL SELECT term AS term1, term AS term2, 1.0::DOUBLE AS similarity FROM nrm WHERE norm > 0"
        if both_orders
        else ""
    )
    return f"""WITH {base},{_WEIGHTS},
cells AS (SELECT a.term AS term1, b.term AS term2,
                 round(sum(a.w * b.w) / (any_value(a.norm) * any_value(b.norm)), 9) AS similarity
          FROM u a JOIN u b USING (doc_id) WHERE {cond} GROUP BY 1, 2 HAVING sum(a.w * b.w) > 0)
SELECT term1, term2, similarity FROM cells{diag}"""


def _nearest(base: str, n: int) -> str:
    """Every term's first ``n`` from all pairs of co-occurring terms (numbered, so that
    the pairs stay small). The similarity is given with 6 decimals, the rank uses 9."""
    return f"""WITH {base},{_WEIGHTS},
k AS (SELECT term, CAST(row_number() OVER (ORDER BY term) AS INTEGER) AS id FROM nrm),
x AS (SELECT id, doc_id, w / norm AS x FROM u JOIN k USING (term)),
c AS (SELECT a.id AS a, b.id AS b, sum(a.x * b.x) AS s FROM x a JOIN x b ON a.doc_id = b.doc_id AND a.id <> b.id GROUP BY 1, 2),
r AS (SELECT a, b, s, row_number() OVER (PARTITION BY a ORDER BY round(s, 9) DESC, b) AS rank FROM c WHERE s > 0 QUALIFY rank <= {n})
SELECT ka.term AS query, CAST(rank AS INTEGER) AS rank, kb.term AS term, round(round(s, 9), 6) AS similarity
FROM r JOIN k ka ON ka.id = a JOIN k kb ON kb.id = b"""


def _positions(values: list[str]) -> str:
    first: dict[str, int] = {}
    for i, q in enumerate(values, start=1):
        first.setdefault(q, i)
    rows = ", ".join(f"({p}, '{q}')" for q, p in first.items())
    return f"qf AS (SELECT CAST(pos AS INTEGER) AS pos, query FROM (VALUES {rows}) v(pos, query))"


def _report_sql() -> str:
    sep = "repeat('=', 128)"
    return f"""WITH {_ranked_sql(_docs_sql(None), REPORT_QUERIES, 5)},
{_positions(REPORT_QUERIES)},
found AS (SELECT query, max(rank) AS last FROM rk GROUP BY query),
lines AS (
  SELECT 0 AS pos, 0 AS line_no, {sep} AS line
  UNION ALL SELECT pos, 0, 'FOUND   ' || query FROM qf JOIN found USING (query)
  UNION ALL SELECT pos, 1, rpad('RANK', 8, ' ') || rpad('TERM', 64, ' ') || 'COSINE SIMILARITY' FROM qf JOIN found USING (query)
  UNION ALL SELECT pos, last + 2, {sep} FROM qf JOIN found USING (query)
  UNION ALL SELECT pos, 0, 'No term similar to ' || query || ' has been found.' FROM qf WHERE query NOT IN (SELECT query FROM found)
  UNION ALL SELECT pos, 1, {sep} FROM qf WHERE query NOT IN (SELECT query FROM found)
  UNION ALL SELECT pos, rank + 1,
         CASE WHEN length(CAST(rank AS VARCHAR)) < 8 THEN rpad(CAST(rank AS VARCHAR), 8, ' ') ELSE CAST(rank AS VARCHAR) END
         || CASE WHEN length(term) < 64 THEN rpad(term, 64, '.') ELSE term END
         || printf('%.9f', similarity)
    FROM rk JOIN qf USING (query))
SELECT CAST(pos AS INTEGER) AS pos, CAST(line_no AS INTEGER) AS line_no, line FROM lines"""


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL per key of ``queries()`` (same column names and types)."""
    return {**_reference_sql(), **_llm()[1]}


def _reference_sql() -> dict[str, str]:
    docs = _docs_sql(None)
    short = _docs_sql(SHORT_WORDS)
    baskets = _pairs_sql("lineitem", "l_orderkey", "l_partkey")
    pair_rows = ", ".join(f"('{a}', '{b}')" for a, b in COSINE_PAIRS)
    lines = "SELECT CAST(doc_id AS VARCHAR) || ' ' || coalesce(text, '') AS value FROM documents"
    return {
        "corpus_scan": f"""WITH l AS (SELECT CAST(doc_id AS VARCHAR) || ' ' || text AS value FROM documents),
t AS (SELECT list_filter(string_split_regex(value, '{_WS}'), lambda x: x <> '') AS ws FROM l),
d AS (SELECT ws[1] AS doc_id, ws[2:] AS terms FROM t WHERE len(ws) > 0)
SELECT doc_id, CAST(unnest(generate_series(0, len(terms) - 1)) AS INTEGER) AS pos, unnest(terms) AS term FROM d""",
        "tokenize": f"""WITH t AS (SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '{_WS}'), lambda x: x <> '') AS ws FROM documents)
SELECT doc_id, CAST(unnest(generate_series(0, len(ws) - 1)) AS INTEGER) AS pos, unnest(ws) AS term FROM t""",
        "doc_lengths": f"WITH {_docs_sql(SHORT_WORDS)} SELECT doc_id, orig_len, kept_len FROM lens",
        "term_filter": f"WITH {_docs_sql(FUNCTION_WORDS)} SELECT doc_id, term, n FROM tf",
        "tf_nofilter": f"WITH {docs} SELECT doc_id, term, n, len, tf FROM tf",
        "term_frequency": f"WITH {baskets} SELECT doc_id, term, n, len, tf FROM tf",
        "tf_filtered_len": f"WITH {short} SELECT doc_id, term, n, len, tf FROM tf",
        "tf_original_len": f"WITH {_docs_sql(SHORT_WORDS, 'original')} SELECT doc_id, term, n, len, tf FROM tf",
        "postings": f"WITH {short} SELECT term, doc_id, tf FROM tf",
        "inverted_index": f"WITH {baskets} SELECT term, doc_id, tf FROM tf",
        "corpus_size": "SELECT count(*) AS n_docs FROM documents",
        "corpus_size_merged": "SELECT count(DISTINCT source) AS n_docs FROM documents",
        "document_frequency": f"WITH {docs} SELECT term, count(*) AS df FROM tf GROUP BY term",
        "idf": f"WITH {docs},{_WEIGHTS} SELECT term, df, round(idf, 9) AS idf FROM idf",
        "tfidf": f"WITH {docs},{_WEIGHTS} SELECT term, doc_id, round(w, 9) AS w FROM w",
        "tfidf_one_scan": f"WITH {docs},{_WEIGHTS} SELECT term, doc_id, round(w, 9) AS w FROM w",
        "term_norms": f"WITH {docs},{_WEIGHTS} SELECT term, round(norm, 9) AS norm FROM nrm",
        "dot_product": f"""WITH {docs},{_WEIGHTS}
SELECT a.term AS query, b.term AS term, round(sum(a.w * b.w), 9) AS dot
FROM w a JOIN w b USING (doc_id) WHERE a.term IN ({_in_list(QUERIES)}) AND a.term <> b.term GROUP BY 1, 2""",
        "cosine_pair": f"""WITH {docs},{_WEIGHTS},
p AS (SELECT * FROM (VALUES {pair_rows}) v(term1, term2)),
c AS (SELECT a.term AS term1, b.term AS term2, sum(a.w * b.w) / (any_value(a.norm) * any_value(b.norm)) AS s
      FROM u a JOIN u b USING (doc_id) WHERE a.term IN ({_in_list(QUERIES)}) GROUP BY 1, 2)
SELECT p.term1, p.term2, CASE WHEN p.term1 IN (SELECT term FROM nrm WHERE norm > 0) AND p.term2 IN (SELECT term FROM nrm WHERE norm > 0)
  THEN CASE WHEN p.term1 = p.term2 THEN 1.0::DOUBLE ELSE round(coalesce(c.s, 0.0), 9) END END AS similarity
FROM p LEFT JOIN c ON p.term1 = c.term1 AND p.term2 = c.term2""",
        "similarity_matrix": _matrix(baskets),
        "similarity_matrix_docs": _matrix(short),
        "similarity_matrix_full": _matrix(short, both_orders=True),
        "matrix_axis": f"WITH {docs},{_WEIGHTS} SELECT term, df FROM idf WHERE idf > 0",
        "similarity_matrix_events": _matrix(_pairs_sql("events", "user_id", "event_type")),
        "similar_terms": _ranked(docs, QUERIES, None),
        "similar_terms_topn": _ranked(docs, QUERIES, 10),
        "similar_terms_search": _ranked(docs, QUERIES, 5, SEARCH),
        "similar_terms_filtered": _ranked(short, QUERIES, 5),
        "similar_terms_original_len": _ranked(_docs_sql(SHORT_WORDS, "original"), QUERIES, 5),
        "similar_terms_joined": _ranked(docs, QUERIES, 5),
        "similarity_matrix_parts_original_len": _matrix(
            _pairs_sql("lineitem", "l_orderkey", "l_partkey", PART_PATTERN, "original")
        ),
        "similar_terms_batch": f"""WITH {_ranked_sql(docs, BATCH_QUERIES, 5)}, {_positions(BATCH_QUERIES)}
SELECT pos, query, rank, term, similarity FROM qf JOIN rk USING (query)""",
        "similar_parts": f"""WITH {baskets},{_WEIGHTS},
qp AS (SELECT DISTINCT CAST(p_partkey AS VARCHAR) AS q FROM part),
qs AS (SELECT a.term AS query, b.term AS term, sum(a.w * b.w) / (any_value(a.norm) * any_value(b.norm)) AS similarity
       FROM u a JOIN u b USING (doc_id) WHERE a.term IN (SELECT q FROM qp) AND a.term <> b.term GROUP BY 1, 2)
SELECT query, CAST(row_number() OVER (PARTITION BY query ORDER BY round(similarity, 9) DESC, term) AS INTEGER) AS rank,
       term, round(similarity, 9) AS similarity
FROM qs WHERE similarity > 0 QUALIFY rank <= 5""",
        "terms_not_found": f"""WITH {_ranked_sql(docs, MISSING_QUERIES, 5)}, {_positions(MISSING_QUERIES)}
SELECT pos, query FROM qf WHERE query NOT IN (SELECT query FROM rk)""",
        "report_lines": _report_sql(),
        "similarity_diff": f"""WITH m1 AS ({_matrix(short)}), m2 AS ({_matrix(_docs_sql(SHORT_WORDS, "original"))}),
j AS (SELECT coalesce(m1.term1, m2.term1) AS term1, abs(coalesce(m1.similarity, 0) - coalesce(m2.similarity, 0)) AS d
      FROM m1 FULL JOIN m2 ON m1.term1 = m2.term1 AND m1.term2 = m2.term2)
SELECT term1, count(*) AS cells, count(*) FILTER (WHERE d > {TOLERANCE!r}) AS differing, count(*) FILTER (WHERE d > {TOLERANCE!r}) = 0 AS passed
FROM j GROUP BY term1""",
        "similar_terms_top2000": _ranked(docs, QUERIES, 2000),
        "similar_terms_long_list": _ranked(docs, LONG_LIST, 5),
        "text_corpus": f"""WITH l AS ({lines}),
t AS (SELECT list_filter(string_split_regex(value, '{_WS}'), lambda x: x <> '') AS ws FROM l),
d AS (SELECT ws[1] AS doc_id, ws[2:] AS terms FROM t WHERE len(ws) > 0)
SELECT doc_id, CAST(unnest(generate_series(0, len(terms) - 1)) AS INTEGER) AS pos, unnest(terms) AS term FROM d""",
        "index_lookup": _ranked(docs, QUERIES, 10),
        "index_topn": _ranked(docs, QUERIES, 10),
        "nearest_terms": _nearest(docs, 5),
        "nearest_parts": _nearest(baskets, 5),
        "cosine_pairs_many": f"""WITH {docs},{_WEIGHTS},
t AS (SELECT unnest([{_in_list(PAIR_TERMS)}]) AS t),
p AS (SELECT a.t AS term1, b.t AS term2 FROM t a, t b),
c AS (SELECT a.term AS term1, b.term AS term2, sum(a.w * b.w) / (any_value(a.norm) * any_value(b.norm)) AS s
      FROM u a JOIN u b USING (doc_id) WHERE a.term IN (SELECT t FROM t) AND b.term IN (SELECT t FROM t) GROUP BY 1, 2)
SELECT p.term1, p.term2, CASE WHEN p.term1 IN (SELECT term FROM nrm WHERE norm > 0) AND p.term2 IN (SELECT term FROM nrm WHERE norm > 0)
  THEN CASE WHEN p.term1 = p.term2 THEN 1.0::DOUBLE ELSE round(coalesce(c.s, 0.0), 9) END END AS similarity
FROM p LEFT JOIN c ON p.term1 = c.term1 AND p.term2 = c.term2""",
    }
