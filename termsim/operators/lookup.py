"""Batch lookup of the terms most similar to a set of query terms.

One DataFrame plan answers all queries at once (the reference runs one job
per query term over a pre-built V x V matrix). Only pairs that involve a query
term are ever formed. Four plans, by the shape of the input:

* a query list of up to ``WIDE_QUERY_MAX`` terms: one aggregate keyed by term,
  each row carrying the term's df, its sum of tf^2 and one dot product per
  query term (``_wide_similarities``); for document rows the products come
  from the row itself, with no shuffle before the partial aggregation;
* the first ``n`` of a list up to ``PAIR_TERMS_MAX`` over document rows: terms that
  can be among them are told first, by a bound (``_pruned_similarities``; runs jobs);
* any other list over document rows: (query, term) rows and term-statistics
  rows in one aggregate keyed by both (``_one_pass_sums``);
* a query DataFrame, or a longer list over occurrence rows: the query
  postings are joined with all postings on ``doc_id``; adaptive execution
  picks broadcast or sort-merge from the real size of the query side. Occurrence
  rows are divided by their term's norm before (``_unit_similarities``).

Semantics kept from the reference: exact, case-sensitive match of the query
term; only similarities > 0; the query term itself is not a result; the
optional ``search`` pattern removes result terms before ranks are given;
top ``n`` (default 5, ``None`` = all); ties ranked by term.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from termsim.functions.text import DEFAULT_PATTERN
from termsim.operators.frequencies import (
    corpus_size,
    document_vectors,
    explode_terms,
    fence,
    term_frequencies,
)
from termsim.operators.similarity import rounded, within_row_products
from termsim.operators.weights import idf, term_stats
from termsim.sources.corpus import DOCUMENT_ROWS, corpus_shape

QueryInput = Sequence[str] | DataFrame

# Up to this n the top-n runs as a window with a per-partition group limit
# (Catalyst's WindowGroupLimit); beyond it, and for n=None, a query's rows are
# ranked in pieces so that no query's result list sits in one task.
WINDOW_TOP_N_MAX = 1000
RANK_STEPS = 64

# Query lists up to this many terms are a small side by their number.
SMALL_QUERY_LIST = 1000

# Up to this many query terms (a driver-side list) the lookup aggregates by
# term only, with one dot-product column per query term; beyond it, by
# (query, term) rows.
WIDE_QUERY_MAX = 64

# The first n of a list beyond that are picked from terms that can be among them, when
# these are this many at most (they are broadcast).
ABLE_TERMS_MAX = 50_000
# The jobs that tell them do not pay for shorter lists.
PRUNED_QUERY_MIN = 64
BOUND_SLACK = 1e-8
PIVOT_TERMS = 400
PIVOT_SHARE = 64
# Sums of products that one row of an aggregate carries there.
COLUMNS_AT_ONCE = 48

# Up to this many terms of a pair list meet inside the rows of the documents.
PAIR_TERMS_MAX = 256


# --------------------------------------------------------------------------
# queries
# --------------------------------------------------------------------------


def query_frame(spark: SparkSession, queries: QueryInput) -> DataFrame:
    """``(pos INT, query STRING)``, one row per distinct query term, keeping its
    first position (repeated query terms give one block)."""
    if isinstance(queries, DataFrame):
        if "pos" not in queries.columns:
            raise ValueError("a query DataFrame needs columns (pos, query)")
        return queries.groupBy("query").agg(F.min("pos").cast("int").alias("pos")).select("pos", "query")
    first: dict[str, int] = {}
    for i, q in enumerate(queries, start=1):
        first.setdefault(q, i)
    rows = [(pos, q) for q, pos in first.items()]
    return spark.createDataFrame(rows, "pos int, query string")


def _distinct_list(queries: QueryInput) -> list[str] | None:
    if isinstance(queries, DataFrame):
        return None
    return list(dict.fromkeys(queries))


# --------------------------------------------------------------------------
# (query, term) dot products and term statistics (O8, O21)
# --------------------------------------------------------------------------


def query_dots(
    corpus: DataFrame,
    queries: QueryInput,
    pattern: str | None = DEFAULT_PATTERN,
    length: str = "filtered",
) -> DataFrame:
    """``(query, term, dot, co_docs)`` over documents holding the query term,
    ``term <> query``; ``dot = sum_d tf_q * tf_t``. Join form (any corpus, any
    query input)."""
    tf = term_frequencies(corpus, pattern, length)
    qlist = _distinct_list(queries)
    if qlist is not None:
        qpost = tf.where(F.col("term").isin(qlist))
    else:
        qterms = queries.select(F.col("query").alias("term")).distinct()
        qpost = tf.join(qterms, "term")
    qpost = qpost.select("doc_id", F.col("term").alias("query"), F.col("tf").alias("tfq"))
    return (
        qpost.join(tf, "doc_id")
        .where(F.col("query") != F.col("term"))
        .groupBy("query", "term")
        .agg(F.sum(F.col("tfq") * F.col("tf")).alias("dot"), F.count(F.lit(1)).alias("co_docs"))
    )


def _one_pass_sums(
    corpus: DataFrame, qlist: list[str], pattern: str | None, length: str
) -> DataFrame:
    """Document rows + a query list: term statistics and query pair sums from
    one scan and one partial aggregate.

    Each entry ``e`` of a document emits a statistics row ``('', e.term,
    tf_e^2)`` and one pair row ``('=' + h.term, e.term, tf_h * tf_e)`` per query
    term ``h`` of the same document. The ``=`` tells the pair rows of any query
    term, the empty one too, from the statistics rows (it is taken
    off again); the column is non-nullable, so joins on it infer no
    not-null filter that would be pushed into one branch only (every branch
    must stay identical to share the exchange).

    Output ``(query, term, total, cnt, is_pair)``: for statistics rows
    ``total = sum tf^2`` and ``cnt = df``; for pair rows ``total = dot`` and
    ``cnt`` = shared documents.
    """
    vec = document_vectors(corpus, pattern, length).select(
        "len", "terms", F.filter("terms", lambda e: e["term"].isin(qlist)).alias("hits")
    )
    entries = explode_terms(vec, "terms", "e").select(
        F.col("e.term").alias("term"),
        (F.col("e.n") / F.col("len").cast("double")).alias("tf"),
        F.col("len").cast("double").alias("lenf"),
        "hits",
    )
    stat_row = F.array(
        F.struct(F.lit("").alias("query"), (F.col("tf") * F.col("tf")).alias("x"))
    )
    pair_rows = F.transform(
        F.filter("hits", lambda h: h["term"] != F.col("term")),
        lambda h: F.struct(F.concat(F.lit("="), h["term"]).alias("query"), ((h["n"] / F.col("lenf")) * F.col("tf")).alias("x")),
    )
    rows = explode_terms(
        entries.select("term", F.concat(stat_row, pair_rows).alias("rows")), "rows", "r"
    ).select(F.coalesce(F.col("r.query"), F.lit("")).alias("query"), "term", F.col("r.x").alias("x"))
    return rows.groupBy("query", "term").agg(
        F.sum("x").alias("total"),
        F.count(F.lit(1)).alias("cnt"),
        # a function of the key, kept as an aggregate so that branch filters on
        # it stay above the aggregate and all branches share one exchange
        F.max(F.col("query") != F.lit("")).alias("is_pair"),
    )


def _term_is(q: str):
    # a one-argument lambda: Spark passes (element, index) to two-argument ones
    return lambda h: h["term"] == F.lit(q)


def _wide_postings(corpus: DataFrame, qlist: list[str], pattern: str | None, length: str) -> DataFrame:
    """A short query list: one aggregate keyed by term (postings side).

    Each posting ``(d, t)`` becomes one row: ``tf^2`` and, when ``d`` holds any
    query term, the array ``[tf_{q_i,d} * tf_{t,d}]`` over the query list. The
    aggregate by ``t`` (partial, then one shuffle on ``t``) gives ``df_t``,
    ``sum tf_t^2`` and ``dot(q_i, t)`` on the same row, so no join with a term
    statistics table is needed.

    Document rows get the query terms' TFs from their own row. Occurrence rows
    get them from a per-document aggregate of the query postings (at most
    ``len(qlist)`` rows per document) joined back on ``doc_id``.
    """
    if corpus_shape(corpus) == DOCUMENT_ROWS:
        postings = _vector_postings(document_vectors(corpus, pattern, length), qlist)
    else:
        tf = term_frequencies(corpus, pattern, length)
        per_doc = (
            tf.where(F.col("term").isin(qlist))
            .groupBy("doc_id")
            .agg(
                F.array(
                    *[F.coalesce(F.sum(F.when(F.col("term") == F.lit(q), F.col("tf"))), F.lit(0.0)) for q in qlist]
                ).alias("qtf")
            )
        )
        postings = tf.join(per_doc, "doc_id", "left").select("term", "tf", "qtf")
    return postings


def _vector_postings(vectors: DataFrame, qlist: list[str]) -> DataFrame:
    """``(term, tf, qtf)`` of every entry of ``vectors``; ``qtf`` holds the TFs of the
    query terms in the same document, NULL when it has none of them."""
    vec = vectors.select("len", "terms", F.filter("terms", lambda e: e["term"].isin(qlist)).alias("hits"))
    lenf = F.col("len").cast("double")
    # tf of every query term in this document (0 when absent)
    qtf = F.when(
        F.size("hits") > 0,
        F.array(
            *[
                F.coalesce(F.get(F.filter("hits", _term_is(q)), 0)["n"] / lenf, F.lit(0.0))
                for q in qlist
            ]
        ),
    )
    return explode_terms(vec.select("len", "terms", qtf.alias("qtf")), "terms", "e").select(
        F.col("e.term").alias("term"),
        (F.col("e.n") / F.col("len").cast("double")).alias("tf"),
        "qtf",
    )


def wide_dots(vectors: DataFrame, qlist: list[str]) -> DataFrame:
    """``(query, term, dot)`` of up to ``WIDE_QUERY_MAX`` query terms from document
    vectors ``(len, terms)``, products formed in the row (no join)."""
    agg, _ = _wide_aggregate(_vector_postings(vectors, qlist), qlist)
    pairs = _wide_pairs(agg, qlist, F.col("df") > 0, ["term"])
    return pairs.select(F.col("d.query").alias("query"), "term", F.col("d.dot").alias("dot"))


def _wide_aggregate(postings: DataFrame, qlist: list[str]):
    """``(term, tf, qtf)`` rows -> ``(agg, qmap)``: the aggregate keyed by term
    (``df``, ``sumsq``, ``dot0..``) and, as a scalar subquery over the same
    aggregate, a map from each query term to its row (at most ``len(qlist)``
    entries). Filters on the aggregate are written against its outputs so that
    they stay above it and the subquery reuses the exchange."""
    rows = postings.select(
        "term",
        (F.col("tf") * F.col("tf")).alias("tf2"),
        F.transform("qtf", lambda v: v * F.col("tf")).alias("x"),
    )
    agg = rows.groupBy("term").agg(
        F.count(F.lit(1)).alias("df"),
        F.sum("tf2").alias("sumsq"),
        *[F.sum(F.col("x")[i]).alias(f"dot{i}") for i in range(len(qlist))],
    )
    # non-pushable form of "term IN qlist": df is an aggregate output (always > 0)
    qrows = agg.where(F.when(F.col("df") > 0, F.col("term").isin(qlist)))
    # every aggregate column is carried (the dots too, at most len(qlist)^2
    # numbers), so column pruning leaves this copy of the aggregate identical
    # to the main one and the subquery reads the same exchange
    dot_cols = [f"dot{i}" for i in range(len(qlist))]
    qmap = qrows.agg(
        F.map_from_entries(F.collect_list(F.struct("term", F.struct("df", "sumsq", *dot_cols)))).alias("m")
    ).scalar()
    return agg, qmap


def _wide_pairs(agg: DataFrame, qlist: list[str], keep, columns: list[str]) -> DataFrame:
    """Rows of ``agg`` passing ``keep``, one per (query term, co-occurring term),
    as ``columns`` plus the struct ``d = (query, dot)``."""
    dots = F.filter(
        F.array(*[F.struct(F.lit(q).alias("query"), F.col(f"dot{i}").alias("dot")) for i, q in enumerate(qlist)]),
        lambda d: (d["dot"] > 0) & (d["query"] != F.col("term")),
    )
    return explode_terms(agg.where(keep).select(*columns, dots.alias("ds")), "ds", "d")


def _wide_similarities(
    corpus: DataFrame,
    qlist: list[str],
    pattern: str | None,
    length: str,
    search: str | None,
    n_docs,
) -> DataFrame:
    """``(query, term, similarity)`` from the term-keyed aggregate."""
    agg, qmap = _wide_aggregate(_wide_postings(corpus, qlist, pattern, length), qlist)
    usable = F.col("df") < n_docs
    if search is not None:
        usable = usable & F.when(F.col("df") > 0, F.col("term").rlike(search))
    cand = _wide_pairs(agg, qlist, usable, ["term", "sumsq"])
    q = F.try_element_at(qmap, F.col("d.query"))
    return (
        cand.select(
            F.col("d.query").alias("query"),
            "term",
            (F.col("d.dot") / (F.sqrt(q["sumsq"]) * F.sqrt("sumsq"))).alias("similarity"),
            q["df"].alias("df_q"),
        )
        .where((F.col("df_q") < n_docs) & (F.col("similarity") > 0))
        .select("query", "term", "similarity")
    )


def _column_sums(vec: DataFrame, known: list[str], able: DataFrame | None) -> DataFrame:
    """``(term, list, df, sumsq, dot0..)`` from document vectors ``(len, terms, hits)``: one
    row per term (of ``able``) and ``COLUMNS_AT_ONCE`` of the query terms ``known``."""
    lenf = F.col("len").cast("double")
    lists = _query_lists(known)
    frequency = F.map_from_entries(F.transform("hits", lambda h: F.struct(h["term"], h["n"] / lenf)))
    # the document's tf of every query term, list by list
    columns = [F.struct(F.lit(i).alias("list"), F.array(*[F.coalesce(F.try_element_at(F.col("of"), F.lit(q)), F.lit(0.0)) for q in qs]).alias("x")) for i, qs in enumerate(lists)]
    holding = fence(vec.select("len", "terms", frequency.alias("of")), ["of"])
    holding = fence(holding.select("len", "terms", F.array(*columns).alias("lists")), ["lists"])
    posts = explode_terms(holding, "terms", "e").select(F.col("e.term").alias("term"), (F.col("e.n") / lenf).alias("tf"), "lists")
    if able is not None:
        posts = posts.join(F.broadcast(able), "term")
    met = explode_terms(posts, "lists", "l").select("term", "tf", "l.list", "l.x")
    dots = [F.sum(F.col("tf") * F.get("x", F.lit(i))).alias(f"dot{i}") for i in range(max(map(len, lists)))]
    return met.groupBy("term", "list").agg(F.count(F.lit(1)).alias("df"), F.sum(F.col("tf") * F.col("tf")).alias("sumsq"), *dots)


def _query_lists(known: list[str]) -> list[list[str]]:
    return [known[i : i + COLUMNS_AT_ONCE] for i in range(0, len(known), COLUMNS_AT_ONCE)]


def _best_known(corpus: DataFrame, qlist: list[str], pattern: str | None, length: str, search: str | None, n: int) -> dict[str, tuple[float, float]]:
    """Of every query term of the corpus its sum of tf^2 and a similarity that its ``n``-th
    best result has for certain: the ``n``-th best among the query terms and the
    ``PIVOT_TERMS`` most frequent terms of a few documents. Whichever these are, the
    similarities are exact, as they are summed over the whole corpus."""
    few = term_frequencies(corpus.where(F.pmod(F.xxhash64("doc_id"), F.lit(PIVOT_SHARE)) == 0), pattern)
    if search is not None:
        few = few.where(F.col("term").rlike(search))
    frequent = few.groupBy("term").count().orderBy(F.col("count").desc(), "term").limit(PIVOT_TERMS)
    pivots = [r["term"] for r in frequent.collect()]
    # only the asked tokens of a document are sorted; its length stands where its id is
    terms = F.array_compact("terms") if corpus.schema["terms"].dataType.containsNull else F.col("terms")
    kept = F.size(terms if pattern is None or length == "original" else F.filter(terms, lambda t: t.rlike(pattern)))
    tokens = fence(corpus.select("terms"), ["terms"])
    asked = tokens.select(kept.alias("doc_id"), F.filter(terms, lambda t: t.isin([*qlist, *pivots])).alias("terms"))
    vec = document_vectors(asked, pattern).select(F.col("doc_id").alias("len"), "terms", F.filter("terms", lambda e: e["term"].isin(qlist)).alias("hits"))
    rows, n_docs = _column_sums(vec, qlist, None).collect(), corpus.count()
    square = {r["term"]: r["sumsq"] for r in rows if r["df"] < n_docs}
    passing = set(square)
    if search is not None and square:
        listed = corpus.sparkSession.createDataFrame([(t,) for t in square], "term string")
        passing = {r["term"] for r in listed.where(F.col("term").rlike(search)).collect()}
    found: dict[str, list[float]] = {q: [] for q in qlist if q in square}
    lists = _query_lists(qlist)
    for r in rows:
        if r["term"] in passing:
            for i, q in enumerate(lists[r["list"]]):
                if q in found and q != r["term"] and r[f"dot{i}"]:
                    found[q].append(r[f"dot{i}"] / (square[q] * square[r["term"]]) ** 0.5)
    return {q: (square[q], sorted(x)[-n] if 0 < n <= len(x) else 0.0) for q, x in found.items()}


def _pruned_similarities(corpus: DataFrame, qlist: list[str], pattern: str | None, length: str, search: str | None, n: int, check_ids: bool) -> DataFrame | None:
    """``(query, term, similarity)`` of all pairs that can be among a query term's first
    ``n``; None when too many terms can or no query term is known.

    With ``u`` the vectors of norm 1, ``sum_d u_q u_t <= sqrt(sum of u_q^2 over t's
    documents)``. So a term can only reach a similarity that is certain for ``q``
    (``_best_known``) when its documents hold that share of ``q``; per document the
    largest such share of any query term is summed by term, along with its statistics.
    Products are formed of the terms that are left, in most corpora a few of many."""
    spark = corpus.sparkSession
    known = _best_known(corpus, qlist, pattern, length, search, n)
    if not known:
        return None
    lenf = F.col("len").cast("double")
    factor = F.create_map(*[F.lit(x) for q, (ss, least) in known.items() for x in (q, 1.0 / (ss * max(least - BOUND_SLACK, 1e-6) ** 2))])
    vec = document_vectors(corpus, pattern, length).select(
        "len", "terms", F.filter("terms", lambda e: e["term"].isin([*known])).alias("hits")
    )
    share = F.array_max(F.transform("hits", lambda h: (h["n"] / lenf) * (h["n"] / lenf) * F.try_element_at(factor, h["term"])))
    entries = explode_terms(fence(vec.select("len", "terms", share.alias("share")), ["share"]), "terms", "e")
    tf = F.col("e.n") / lenf
    stats = entries.select(F.col("e.term").alias("term"), (tf * tf).alias("tf2"), F.coalesce("share", F.lit(0.0)).alias("share")).groupBy("term").agg(
        F.count(F.lit(1)).alias("df"), F.sum("tf2").alias("sumsq"), F.sum("share").alias("share")
    )
    # a little under 1: sums are rounded
    able = stats.where(F.col("share") >= F.lit(1 - 1e-6))
    if search is not None:
        able = able.where(F.col("term").rlike(search))
    rows = able.select("term", "df", "sumsq").limit(ABLE_TERMS_MAX + 1).collect()
    if len(rows) > ABLE_TERMS_MAX:
        return None
    able = F.broadcast(spark.createDataFrame([(r["term"], r["df"], r["sumsq"]) for r in rows], "term string, df long, sumsq double"))
    lists = _query_lists([*known])
    width = max(map(len, lists))
    sums = _column_sums(vec.where(F.size("hits") > 0), [*known], able.select("term"))
    names = F.get(F.array(*[F.array(*[F.lit(q) for q in qs]) for qs in lists]), F.col("list"))
    dots = F.arrays_zip(names.alias("query"), F.array(*[f"dot{i}" for i in range(width)]).alias("dot"))
    pairs = explode_terms(sums.select("term", dots.alias("ds")), "ds", "d").select("term", "d.query", "d.dot")
    pairs = pairs.where((F.col("dot") > 0) & (F.col("query") != F.col("term")))
    asked = F.broadcast(spark.createDataFrame([(q, ss) for q, (ss, _) in known.items()], "query string, ss_q double"))
    found = pairs.join(able, "term").join(asked, "query").where(F.col("df") < corpus_size(corpus, check_ids).scalar())
    return found.select("query", "term", (F.col("dot") / (F.sqrt("ss_q") * F.sqrt("sumsq"))).alias("similarity")).where(F.col("similarity") > 0)


def query_similarities(
    corpus: DataFrame,
    queries: QueryInput,
    pattern: str | None = DEFAULT_PATTERN,
    length: str = "filtered",
    search: str | None = None,
    check_ids: bool = True,
) -> DataFrame:
    """``(query, term, similarity)`` unrounded, every positive similarity of
    every query term to another term (search filter applied)."""
    n_docs = corpus_size(corpus, check_ids).scalar()
    qlist = _distinct_list(queries)
    if qlist is not None and len(qlist) <= WIDE_QUERY_MAX:
        return _wide_similarities(corpus, qlist, pattern, length, search, n_docs)
    if corpus_shape(corpus) != DOCUMENT_ROWS:
        return _unit_similarities(corpus, queries, pattern, length, search, n_docs)
    if qlist is not None:
        sums = _one_pass_sums(corpus, qlist, pattern, length)
        is_pair = F.col("is_pair")
        stats = sums.where(~is_pair).select(
            "term", F.col("cnt").alias("df"), F.col("total").alias("sumsq")
        )
        qstats = sums.where(F.when(is_pair, F.lit(False)).otherwise(F.col("term").isin(qlist)))
        qstats = qstats.select(
            F.col("term").alias("query"), F.col("cnt").alias("df_q"), F.col("total").alias("ss_q")
        )
        keep = is_pair if search is None else F.when(is_pair, F.col("term").rlike(search)).otherwise(F.lit(False))
        dots = sums.where(keep).select(
            F.expr("substring(query, 2)").alias("query"), "term", F.col("total").alias("dot"), F.col("cnt").alias("co_docs")
        )
    else:
        tf = term_frequencies(corpus, pattern, length)
        stats = term_stats(tf)
        qstats = stats.join(queries.select(F.col("query").alias("term")).distinct(), "term")
        qstats = qstats.select(
            F.col("term").alias("query"), F.col("df").alias("df_q"), F.col("sumsq").alias("ss_q")
        )
        dots = query_dots(corpus, queries, pattern, length)
        if search is not None:
            dots = dots.where(F.col("term").rlike(search))
    stats = stats.where(F.col("df") < n_docs)
    qstats = qstats.where(F.col("df_q") < n_docs)
    if qlist is not None and len(qlist) <= SMALL_QUERY_LIST:
        # at most one row per distinct query term, so at most that many rows
        qstats = F.broadcast(qstats)
    return (
        dots.join(stats, "term")
        .join(qstats, "query")
        .select(
            "query",
            "term",
            (F.col("dot") / (F.sqrt("ss_q") * F.sqrt("sumsq"))).alias("similarity"),
            "co_docs",
        )
        # positive exactly when the terms share a document (weights are >= 0)
        .where((F.col("co_docs") > 0) & (F.col("similarity") > 0))
        .select("query", "term", "similarity")
    )


def _unit_similarities(corpus: DataFrame, queries: QueryInput, pattern: str | None, length: str, search: str | None, n_docs) -> DataFrame:
    """``(query, term, similarity)`` of occurrence rows, whose postings are shuffled in any
    case: they are divided by their term's norm first, so the sums of products are the
    similarities and no pair is shuffled again to meet statistics."""
    tf = term_frequencies(corpus, pattern, length)
    stats = term_stats(tf).where(F.col("df") < n_docs).select("term", "sumsq")
    unit = tf.join(stats, "term").select("doc_id", "term", (F.col("tf") / F.sqrt("sumsq")).alias("u"))
    qlist = _distinct_list(queries)
    if qlist is not None:
        marked = unit.withColumn("asked", F.col("term").isin(qlist))
    else:
        qterms = queries.select(F.col("query").alias("term")).distinct().withColumn("asked", F.lit(True))
        marked = unit.join(qterms, "term", "left").withColumn("asked", F.coalesce("asked", F.lit(False)))
    qpost = marked.where(F.col("asked")).select("doc_id", F.col("term").alias("query"), F.col("u").alias("uq"))
    # two query terms meet once, in the order of the terms
    met = qpost.join(marked, "doc_id").where(~F.col("asked") | (F.col("query") < F.col("term")))
    sums = met.groupBy("query", "term").agg(F.sum(F.col("uq") * F.col("u")).alias("similarity"), F.max("asked").alias("asked"))
    found = sums.where(F.col("similarity") > 0)
    there, back = F.struct("query", "term"), F.struct(F.col("term").alias("query"), F.col("query").alias("term"))
    both = found.select(F.explode(F.when(F.col("asked"), F.array(there, back)).otherwise(F.array(there))).alias("p"), "similarity")
    rows = both.select("p.query", "p.term", "similarity")
    return rows if search is None else rows.where(F.col("term").rlike(search))


# --------------------------------------------------------------------------
# ranking (O27-O29)
# --------------------------------------------------------------------------


def rank_terms(scored: DataFrame, n: int | None = 5) -> DataFrame:
    """``(query, rank, term, similarity)`` from ``(query, term, similarity)``.

    Similarity is rounded to 9 decimals and ranked descending, ties by term.
    ``n`` keeps ranks 1..n; ``None`` keeps all; 0 gives no rows.
    """
    if n is not None and n < 0:
        raise ValueError("n must be >= 0 or None")
    s = scored.select("query", "term", rounded(F.col("similarity")).alias("similarity"))
    if n is not None and n <= WINDOW_TOP_N_MAX:
        w = Window.partitionBy("query").orderBy(F.col("similarity").desc(), F.col("term"))
        return (
            s.select("query", F.row_number().over(w).alias("rank"), "term", "similarity")
            .where(F.col("rank") <= F.lit(n))
        )
    ranked = rank_all(s)
    return ranked if n is None else ranked.where(F.col("rank") <= F.lit(n))


def rank_all(s: DataFrame) -> DataFrame:
    """Rank every row within its query without gathering a query in one task.

    A query's rows are cut into pieces by the similarity itself (steps of its
    logarithm, so that the many small similarities spread over many pieces).
    The piece of a row depends on the row's values alone, and pieces follow each
    other in rank order. A row's rank is its place within its piece plus the
    number of rows in the pieces before, which one small aggregate gives.
    """
    cut = s.select("query", "term", "similarity", _piece(F.col("similarity")).alias("_piece"))
    counts = cut.groupBy("query", "_piece").agg(F.count(F.lit(1)).alias("_count"))
    before = Window.partitionBy("query").orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("query", "_piece", F.coalesce(F.sum("_count").over(before), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("query", "_piece").orderBy(F.col("similarity").desc(), F.col("term"))
    placed = cut.select("query", "_piece", "term", "similarity", F.row_number().over(inside).alias("_place"))
    return placed.join(offsets, ["query", "_piece"]).select(
        "query", (F.col("_before") + F.col("_place")).cast("int").alias("rank"), "term", "similarity"
    )


def _piece(similarity: Column) -> Column:
    """Pieces of a ranking: ``RANK_STEPS`` per halving of the similarity."""
    step = F.floor(-F.log2(similarity) * F.lit(RANK_STEPS)).cast("int")
    return F.coalesce(F.when(similarity > 0, step), F.lit(1 << 30))


# --------------------------------------------------------------------------
# user-facing lookups (O26, O30, O31)
# --------------------------------------------------------------------------


def similar_terms(
    corpus: DataFrame,
    queries: QueryInput,
    pattern: str | None = DEFAULT_PATTERN,
    length: str = "filtered",
    search: str | None = None,
    n: int | None = 5,
    check_ids: bool = True,
) -> DataFrame:
    """Ranked similar terms for every query term: ``(query, rank, term, similarity)``.

    ``pattern=None`` is the reference's ``--nofilter``; ``length='original'``
    its ``--original-doc-len``; ``search`` its ``--search``; ``n`` its ``--max``.
    """
    if n is not None and n < 0:
        raise ValueError("n must be >= 0 or None")
    if not isinstance(queries, DataFrame) and len(queries) == 0:
        return corpus.sparkSession.createDataFrame([], "query string, rank int, term string, similarity double")
    scored = None
    qlist = _distinct_list(queries)
    first_of_many = n is not None and n <= WINDOW_TOP_N_MAX and qlist is not None and max(WIDE_QUERY_MAX, PRUNED_QUERY_MIN) < len(qlist) <= PAIR_TERMS_MAX
    if first_of_many and corpus_shape(corpus) == DOCUMENT_ROWS:
        scored = _pruned_similarities(corpus, qlist, pattern, length, search, n, check_ids)
    if scored is None:
        scored = query_similarities(corpus, queries, pattern, length, search, check_ids)
    return rank_terms(scored, n)


def terms_not_found(queries: DataFrame, ranked: DataFrame) -> DataFrame:
    """``(pos, query)``: query terms with an empty ranking (unknown, filtered
    out, or nothing positive left)."""
    found = ranked.select("query").distinct()
    return queries.join(found, "query", "left_anti").select("pos", "query")


# --------------------------------------------------------------------------
# pair-level views (O21, O23)
# --------------------------------------------------------------------------


def weight_dots(
    corpus: DataFrame,
    queries: QueryInput,
    pattern: str | None = DEFAULT_PATTERN,
    length: str = "filtered",
    check_ids: bool = True,
) -> DataFrame:
    """``(query, term, dot)``: dot product of the TF-IDF vectors of each query
    term and each term sharing a document with it (``sum_d w_q * w_t``).

    ``w = idf * tf``, so the dot product is ``idf_q * idf_t * sum_d tf_q tf_t``;
    with a short query list all three factors come from the term-keyed
    aggregate (no join)."""
    qlist = _distinct_list(queries)
    if qlist is not None and 0 < len(qlist) <= WIDE_QUERY_MAX:
        n_docs = corpus_size(corpus, check_ids).scalar().cast("double")
        agg, qmap = _wide_aggregate(_wide_postings(corpus, qlist, pattern, length), qlist)
        # non-pushable always-true filter (df is an aggregate output)
        cand = _wide_pairs(agg, qlist, F.col("df") > 0, ["term", "df"])
        idf_t = F.ln(n_docs / F.col("df").cast("double"))
        idf_q = F.ln(n_docs / F.try_element_at(qmap, F.col("d.query"))["df"].cast("double"))
        return cand.select(
            F.col("d.query").alias("query"), "term", (F.col("d.dot") * idf_q * idf_t).alias("dot")
        )
    idfs = idf(term_frequencies(corpus, pattern, length), corpus_size(corpus, check_ids))
    idf_t = idfs.select("term", F.col("idf").alias("idf_t"))
    idf_q = idfs.select(F.col("term").alias("query"), F.col("idf").alias("idf_q"))
    return (
        query_dots(corpus, queries, pattern, length)
        .join(idf_t, "term")
        .join(idf_q, "query")
        .select("query", "term", (F.col("dot") * F.col("idf_q") * F.col("idf_t")).alias("dot"))
    )


def cosine_pairs(
    corpus: DataFrame,
    pairs: DataFrame,
    pattern: str | None = DEFAULT_PATTERN,
    length: str = "filtered",
    check_ids: bool = True,
) -> DataFrame:
    """``(term1, term2, similarity)`` for given term pairs: 1.0 for a term and
    itself, 0.0 for terms that share no document, NULL when a term is unknown or
    its vector has norm 0 (the cosine is not defined there).

    The asked terms are counted first, which runs a small job over ``pairs``. Up to
    ``PAIR_TERMS_MAX`` of them are picked out of the rows of document-row corpora, their
    products formed there, and only partial sums per asked pair are shuffled
    (``_sums_in_rows``). Longer lists and occurrence rows: only products that were asked
    for are formed. The postings of the asked terms are shuffled once, by document;
    statistics and both sides of the products read that exchange, so the text is scanned
    once. A pair starts from its rarer term: the postings of that term meet the pair
    list, and the result meets the postings of the other term on (document, term), where
    no key is hot. The price is the sum over pairs of the rarer term's documents,
    whatever else these documents hold.
    The result has one row per row of ``pairs``.
    """
    n_docs = corpus_size(corpus, check_ids).scalar()
    # NULL terms are known to no corpus; a non-nullable key infers no filter
    given = pairs.select("term1", "term2", *[F.coalesce(F.concat(F.lit("="), F.col(c)), F.lit("")).alias(f"_{c}") for c in ("term1", "term2")])
    wanted = given.select("_term1", "_term2").distinct()
    asked = wanted.select(F.col("_term1").alias("term")).union(wanted.select("_term2")).distinct()
    few = [r["term"] for r in asked.limit(SMALL_QUERY_LIST + 1).collect()]
    if len(few) <= PAIR_TERMS_MAX and corpus_shape(corpus) == DOCUMENT_ROWS:
        sums = _sums_in_rows(corpus, wanted, [t[1:] for t in few if t], pattern, length)
        stats = sums.where(~F.col("is_pair") & (F.col("cnt") < n_docs)).select(F.col("a").alias("term"), F.col("cnt").alias("df"), F.col("total").alias("sumsq"))
        known = _known_pairs(wanted, stats)
        met = sums.where(F.col("is_pair") & (F.col("cnt") > 0)).select("a", "b", F.col("total").alias("dot"))
        keyed = known.withColumns({"a": F.least("_term1", "_term2"), "b": F.greatest("_term1", "_term2")})
        return _pair_cosines(given, keyed.join(met, ["a", "b"], "left"))
    tf = term_frequencies(corpus, pattern, length)
    if len(few) <= SMALL_QUERY_LIST:  # picked where the postings arise, none other is shuffled
        tf = tf.where(F.col("term").isin([t[1:] for t in few if t]))
    tf = tf.select("doc_id", F.concat(F.lit("="), F.col("term")).alias("term"), "tf")
    if len(few) > SMALL_QUERY_LIST:
        tf = tf.join(asked, "term", "left_semi")
    post = tf.select("doc_id", "term", "tf").repartition("doc_id")
    # doc_id is read here too, which keeps this copy of the exchange like the others
    stats = post.groupBy("term").agg(
        F.count(F.struct("doc_id")).alias("df"), F.sum(F.col("tf") * F.col("tf")).alias("sumsq")
    )
    known = _known_pairs(wanted, stats.where(F.col("df") < n_docs))
    swap = F.col("df2") < F.col("df1")
    routed = known.where(F.col("_term1") != F.col("_term2")).select(
        "_term1",
        "_term2",
        F.when(swap, F.col("_term2")).otherwise(F.col("_term1")).alias("rare"),
        F.when(swap, F.col("_term1")).otherwise(F.col("_term2")).alias("other"),
    )
    from_rare = post.select("doc_id", F.col("term").alias("rare"), "tf").join(routed, "rare")
    met = from_rare.join(post.select("doc_id", F.col("term").alias("other"), F.col("tf").alias("tf2")), ["doc_id", "other"])
    dots = met.groupBy("_term1", "_term2").agg(F.sum(F.col("tf") * F.col("tf2")).alias("dot"))
    return _pair_cosines(given, known.join(dots, ["_term1", "_term2"], "left"))


def _known_pairs(wanted: DataFrame, stats: DataFrame) -> DataFrame:
    """The pairs of which both terms have a vector, with their statistics."""
    one = stats.select(F.col("term").alias("_term1"), F.col("df").alias("df1"), F.col("sumsq").alias("ss1"))
    two = stats.select(F.col("term").alias("_term2"), F.col("df").alias("df2"), F.col("sumsq").alias("ss2"))
    return wanted.join(one, "_term1").join(two, "_term2")


def _pair_cosines(given: DataFrame, known: DataFrame) -> DataFrame:
    """One row per given pair, from the known pairs with their dot products (NULL: none)."""
    cosine = F.when(F.col("_term1") == F.col("_term2"), F.lit(1.0)).otherwise(
        F.coalesce(F.col("dot") / (F.sqrt("ss1") * F.sqrt("ss2")), F.lit(0.0))
    )
    scored = known.select("_term1", "_term2", rounded(cosine).alias("similarity"))
    return given.join(scored, ["_term1", "_term2"], "left").select("term1", "term2", "similarity")


def _sums_in_rows(corpus: DataFrame, wanted: DataFrame, terms: list[str], pattern: str | None, length: str) -> DataFrame:
    """``(a, b, total, cnt, is_pair)`` of the wanted pairs (``a < b``, as in ``pair_sums``)
    and of every term with itself: at most ``PAIR_TERMS_MAX`` entries of a document meet
    in its row, so nothing but partial sums is shuffled."""
    vec = document_vectors(corpus, pattern, length)
    products = within_row_products(vec.select("len", F.filter("terms", lambda e: e["term"].isin(terms)).alias("terms")), "terms")
    keyed = products.select(*[F.concat(F.lit("="), F.col(f"term{i}")).alias(c) for i, c in ((1, "a"), (2, "b"))], "prod")
    each = wanted.select("_term1", "_term2").union(wanted.select("_term1", "_term1")).union(wanted.select("_term2", "_term2"))
    ordered = each.select(F.least("_term1", "_term2").alias("a"), F.greatest("_term1", "_term2").alias("b")).distinct()
    # at most PAIR_TERMS_MAX^2 rows
    return keyed.join(F.broadcast(ordered), ["a", "b"], "left_semi").groupBy("a", "b").agg(
        F.sum("prod").alias("total"),
        F.count(F.lit(1)).alias("cnt"),
        F.max(F.col("a") != F.col("b")).alias("is_pair"),
    )
