"""Cosine similarity between terms as sparse vectors over documents.

Two facts shape the plans here:

* Weights are never negative, so two terms have a positive similarity exactly
  when they share a document (and both have norm > 0). The all-pairs
  ``cartesian`` of the reference therefore becomes an equi-join on the
  document: only term pairs that co-occur are ever formed.
* ``w_{t,d} = idf_t * tf_{t,d}`` scales each term vector by one constant, and
  cosine ignores the scale of either vector. So the cosine of two TF-IDF
  vectors equals the cosine of their TF vectors whenever both IDFs are > 0;
  a term with idf 0 (found in every document) has a zero vector and no
  similarity at all. The pair sums run on ``tf`` and the IDF only decides
  which terms take part; postings are never joined with the IDF table.

For document rows the co-occurring pairs of a document are built inside its
row (no shuffle of postings). A document with more than ``BLOCK_TERMS``
distinct terms is cut into blocks of sorted terms and its block pairs are
spread over tasks, so one huge document does not land on one task. For
occurrence rows the pairs come from a join on ``doc_id`` and a block pair, by
which a large document is cut up in the same way. For document rows the diagonal pairs
(t, t) give each term's document frequency and squared TF norm out of the same aggregate;
occurrence rows are divided by their term's norm before they meet.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termsim.functions.text import DEFAULT_PATTERN
from termsim.operators.frequencies import (
    corpus_size,
    document_vectors,
    explode_terms,
    term_frequencies,
)
from termsim.operators.weights import term_stats
from termsim.sources.corpus import DOCUMENT_ROWS, corpus_shape

# Largest number of distinct terms of one document whose pairs one task builds.
BLOCK_TERMS = 1024

SIM_DIGITS = 9


def rounded(similarity: Column) -> Column:
    """Similarity as reported: rounded to 9 decimals (two engines' sums differ
    in the last digits)."""
    return F.round(similarity, SIM_DIGITS)


# --------------------------------------------------------------------------
# pair dot products over shared documents (O20, O21)
# --------------------------------------------------------------------------


def within_row_products(df: DataFrame, block: str) -> DataFrame:
    """Pairs ``a <= b`` of the sorted entries of one array column, per row.

    The diagonal ``(a, a)`` is kept on purpose: its product is ``tf_a^2``, so
    summed per term it gives the term's squared TF norm and its document
    frequency, out of the same aggregate as the pair sums.
    """
    first = df.select(
        "len", block, F.posexplode_outer(block).alias("p", "a")
    ).where(F.col("a").isNotNull())
    later = first.select(
        "len",
        "a",
        F.explode_outer(F.slice(block, F.col("p") + 1, F.size(block) - F.col("p"))).alias("b"),
    ).where(F.col("b").isNotNull())
    return _products(later)


def _across_blocks(df: DataFrame, left: str, right: str) -> DataFrame:
    """All pairs (left entry, right entry) of two disjoint sorted blocks, per row."""
    a = explode_terms(df.select("len", left, right), left, "a")
    b = explode_terms(a.select("len", "a", right), right, "b")
    return _products(b)


def _products(df: DataFrame) -> DataFrame:
    # Terms are never NULL here; non-nullable columns keep joins from inferring
    # not-null filters that would be pushed into one consumer of the aggregate.
    lenf = F.col("len").cast("double")
    return df.select(
        F.coalesce(F.col("a.term"), F.lit("")).alias("term1"),
        F.coalesce(F.col("b.term"), F.lit("")).alias("term2"),
        ((F.col("a.n") / lenf) * (F.col("b.n") / lenf)).alias("prod"),
    )


def _document_pair_products(corpus: DataFrame, pattern: str | None, length: str) -> DataFrame:
    """``(term1, term2, prod)`` with term1 <= term2 (diagonal included), from
    document rows."""
    k = F.size("terms")
    vec = document_vectors(corpus, pattern, length)
    small = within_row_products(vec.where(k <= BLOCK_TERMS).select("len", "terms"), "terms")
    # only a document with more tokens than BLOCK_TERMS can have more distinct
    # terms: the large-document branch tests the token count first, so most
    # documents are only split there, not sorted and counted
    long_docs = document_vectors(corpus.where(F.size("terms") > BLOCK_TERMS), pattern, length)
    big = long_docs.where(k > BLOCK_TERMS).select(
        "doc_id", "len", "terms", F.ceil(k / F.lit(BLOCK_TERMS)).cast("int").alias("nb")
    )
    units = (
        big.select("doc_id", "len", "terms", "nb", F.explode(F.sequence(F.lit(0), F.col("nb") - 1)).alias("i"))
        .select("doc_id", "len", "terms", "i", F.explode(F.sequence("i", F.col("nb") - 1)).alias("j"))
        .select(
            "doc_id",
            "len",
            "i",
            "j",
            F.slice("terms", F.col("i") * BLOCK_TERMS + 1, F.lit(BLOCK_TERMS)).alias("left"),
            F.slice("terms", F.col("j") * BLOCK_TERMS + 1, F.lit(BLOCK_TERMS)).alias("right"),
        )
        # one task per block pair of a large document instead of one per document
        .repartition("doc_id", "i", "j")
    )
    same = within_row_products(units.where(F.col("i") == F.col("j")).select("len", F.col("left").alias("blk")), "blk")
    cross = _across_blocks(units.where(F.col("i") < F.col("j")), "left", "right")
    return small.unionByName(same).unionByName(cross)


def _occurrence_pair_products(tf: DataFrame) -> DataFrame:
    """Pairs by a join on the document, cut into block pairs: the terms of a
    document longer than ``BLOCK_TERMS`` are dealt over blocks by hash, the left
    side goes to every pair (own block, any block), the right side to every pair
    (any block, own block), and the join key is (document, block pair). So the
    pairs of one huge document spread over as many tasks as it has block pairs;
    documents of one block take part once."""
    blocks = F.greatest(F.lit(1), F.ceil(F.col("len") / F.lit(BLOCK_TERMS))).cast("int")
    own = F.pmod(F.xxhash64("term"), blocks).cast("int")
    cut = tf.select("doc_id", "term", "tf", own.alias("own"), F.explode(F.sequence(F.lit(0), blocks - 1)).alias("other"))
    a = cut.select("doc_id", F.col("own").alias("i"), F.col("other").alias("j"), F.col("term").alias("term1"), F.col("tf").alias("tf1"))
    b = cut.select("doc_id", F.col("other").alias("i"), F.col("own").alias("j"), F.col("term").alias("term2"), F.col("tf").alias("tf2"))
    return (
        a.join(b, ["doc_id", "i", "j"])
        .where(F.col("term1") <= F.col("term2"))
        .select("term1", "term2", (F.col("tf1") * F.col("tf2")).alias("prod"))
    )


def pair_sums(
    corpus: DataFrame, pattern: str | None = DEFAULT_PATTERN, length: str = "filtered"
) -> DataFrame:
    """``(term1, term2, total, cnt, is_pair)`` for term1 <= term2.

    Pair rows (``is_pair``): ``total = sum_d tf1 * tf2`` over shared documents
    (the TF-IDF dot product divided by ``idf1 * idf2``), ``cnt`` = shared
    documents. Diagonal rows: ``total = sum_d tf^2``, ``cnt = df``. Partial
    aggregation runs before the shuffle. ``is_pair`` is an aggregate (not a
    filter on the key) so that filters on it stay above the aggregate and all
    consumers share one exchange.
    """
    if corpus_shape(corpus) == DOCUMENT_ROWS:
        prods = _document_pair_products(corpus, pattern, length)
    else:
        prods = _occurrence_pair_products(term_frequencies(corpus, pattern, length))
    return prods.groupBy("term1", "term2").agg(
        F.sum("prod").alias("total"),
        F.count(F.lit(1)).alias("cnt"),
        F.max(F.col("term1") != F.col("term2")).alias("is_pair"),
    )


def pair_dots(
    corpus: DataFrame, pattern: str | None = DEFAULT_PATTERN, length: str = "filtered"
) -> DataFrame:
    """``(term1, term2, dot, co_docs)`` for every co-occurring pair, term1 < term2."""
    sums = pair_sums(corpus, pattern, length)
    return sums.where(F.col("is_pair")).select(
        "term1", "term2", F.col("total").alias("dot"), F.col("cnt").alias("co_docs")
    )


# --------------------------------------------------------------------------
# cosine (O22, O23) and the matrix (O20, O33)
# --------------------------------------------------------------------------


def usable_terms(tf: DataFrame, n_docs: DataFrame) -> DataFrame:
    """``(term, df, sumsq)`` of the terms whose TF-IDF norm is > 0 (df < N)."""
    return term_stats(tf).where(F.col("df") < n_docs.scalar())


def similarity_matrix(
    corpus: DataFrame,
    pattern: str | None = DEFAULT_PATTERN,
    length: str = "filtered",
    both_orders: bool = False,
    check_ids: bool = True,
) -> DataFrame:
    """Sparse similarity table ``(term1, term2, similarity)``.

    Only positive cells exist (every absent cell is 0). By default each pair
    appears once with term1 < term2; ``both_orders=True`` adds the mirrored
    pairs and the diagonal (1.0 for every term with norm > 0), i.e. every
    non-zero cell of the full V x V matrix.
    """
    n_docs = corpus_size(corpus, check_ids)
    if corpus_shape(corpus) == DOCUMENT_ROWS:
        cells, terms = _cells_of_sums(corpus, pattern, length, n_docs.scalar())
    else:
        cells, terms = _cells_of_units(corpus, pattern, length, n_docs)
    out = cells
    if both_orders:
        # both orders from the one row, so that its joins run once
        both = F.array(F.struct("term1", "term2"), F.struct(F.col("term2").alias("term1"), F.col("term1").alias("term2")))
        cells = cells.select(F.explode(both).alias("p"), "similarity").select("p.term1", "p.term2", "similarity")
        diagonal = terms.select(
            F.col("term").alias("term1"), F.col("term").alias("term2"), F.lit(1.0).alias("similarity")
        )
        out = cells.unionByName(diagonal)
    return out.select("term1", "term2", rounded(F.col("similarity")).alias("similarity"))


def _cells_of_units(corpus: DataFrame, pattern: str | None, length: str, n_docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The positive cells with term1 < term2, and ``(term, df, sumsq)`` of the terms, of
    occurrence rows. Their postings are shuffled in any case, so each is divided by its
    term's norm there: the sums of products are the similarities, and the pairs, many
    more than the postings, are shuffled once and neither sorted nor joined."""
    tf = term_frequencies(corpus, pattern, length)
    terms = usable_terms(tf, n_docs)
    unit = tf.join(terms, "term").select("doc_id", "term", "len", (F.col("tf") / F.sqrt("sumsq")).alias("tf"))
    prods = _occurrence_pair_products(unit).where(F.col("term1") < F.col("term2"))
    sums = prods.groupBy("term1", "term2").agg(F.sum("prod").alias("similarity"))
    return sums.where(F.col("similarity") > 0), terms


def _cells_of_sums(corpus: DataFrame, pattern: str | None, length: str, n_docs: Column) -> tuple[DataFrame, DataFrame]:
    """As ``_cells_of_units``, of document rows: pair sums and term statistics come from
    one aggregate, pairs are joined with the statistics."""
    sums = pair_sums(corpus, pattern, length)
    terms = sums.where(~F.col("is_pair") & (F.col("cnt") < n_docs)).select(
        F.col("term1").alias("term"), F.col("total").alias("sumsq")
    )
    t1 = terms.select(F.col("term").alias("term1"), F.col("sumsq").alias("ss1"))
    t2 = terms.select(F.col("term").alias("term2"), F.col("sumsq").alias("ss2"))
    cells = (
        sums.where(F.col("is_pair"))
        .join(t1, "term1")
        .join(t2, "term2")
        .select(
            "term1",
            "term2",
            (F.col("total") / (F.sqrt("ss1") * F.sqrt("ss2"))).alias("similarity"),
            "cnt",
        )
        # positive exactly when the terms share a document (weights are >= 0)
        .where((F.col("cnt") > 0) & (F.col("similarity") > 0))
        .select("term1", "term2", "similarity")
    )
    return cells, terms


def matrix_axis(
    corpus: DataFrame,
    pattern: str | None = DEFAULT_PATTERN,
    length: str = "filtered",
    check_ids: bool = True,
) -> DataFrame:
    """``(term, df)`` of every term that has a row in the matrix (norm > 0).

    Together with the sparse table this is the whole dense matrix: every pair
    of axis terms that is not in the sparse table has similarity 0.
    """
    tf = term_frequencies(corpus, pattern, length)
    return usable_terms(tf, corpus_size(corpus, check_ids)).select("term", "df")
