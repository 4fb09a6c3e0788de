"""A written index for repeated lookups against one corpus.

The reference caches its TF-IDF table and matrix and runs every query term
against them. Here the reusable part is written once as parquet:

* ``vectors`` (document-row corpora): ``(doc_id, len, terms)``, the per-document
  term counts, bucketed and sorted by ``doc_id``;
* ``postings``: ``(doc_id, term, tf, level)``, bucketed by ``doc_id`` in the same
  way, sorted by ``(term, level)`` in each bucket. ``level`` orders a term's postings
  by weight (``LEVELS`` steps for each halving of ``tf``): postings of one term,
  level and bucket are a block;
* ``blocks``: ``(term, level, rows, max_tf, sumsq)``, what is needed to bound a
  block's contribution without reading it;
* ``stats``: ``(term, df, sumsq)``.

The files of ``blocks`` and ``stats`` are sorted by term. Each finished build appends one row
to ``builds``; lookups take the newest. A term's rows spread over all buckets, so
no task ever holds a whole term.

How a lookup reads it (the results are the same):

* terms found in most documents (``DENSE_SHARE``): the vectors are scanned once and
  products are formed in the row, without any join;
* terms with few postings (``FEW_POSTINGS`` together): their documents are looked up
  by id, which prunes buckets and row groups of the vectors;
* all others: query postings and vectors meet bucket by bucket, so neither is
  shuffled or sorted.

``topn_index`` gives the same top ``n`` by reading only the heaviest blocks of each
query term and bounding the rest; see there.
"""

from __future__ import annotations

import math
import re
import uuid
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from termsim.functions.text import DEFAULT_PATTERN
from termsim.operators.frequencies import (
    corpus_size,
    document_vectors,
    explode_terms,
    term_frequencies,
)
from termsim.operators.lookup import SMALL_QUERY_LIST, WIDE_QUERY_MAX, QueryInput, rank_terms, wide_dots
from termsim.sources.corpus import DOCUMENT_ROWS, corpus_shape

BUILDS = "seq long, version string, shape string, n_docs long, pattern string, length string, buckets int, id_type string"
RESULT = "query string, rank int, term string, similarity double"
#: Weight levels for each halving of ``tf``.
LEVELS = 4
DENSE_SHARE = 0.5
FEW_POSTINGS = 1000
#: Similarities are reported with 9 decimals; bounds leave room for that.
SLACK = 2e-9
#: A build's folder, or the written rounds of a lookup.
_OWN_FOLDER = re.compile("[0-9a-f]{8}(-rounds-[0-9a-f]{8})?")


class IndexExists(ValueError):
    """There is a finished build under the path already."""


# --------------------------------------------------------------------------
# building
# --------------------------------------------------------------------------


def build_index(
    corpus: DataFrame,
    path: str,
    pattern: str | None = DEFAULT_PATTERN,
    length: str = "filtered",
    check_ids: bool = True,
    mode: str = "error",
    buckets: int | None = None,
) -> None:
    """Write the index of ``corpus`` under ``path`` (runs the jobs).

    Each build goes to a folder of its own; the row that makes it the newest is
    appended when all of it is written, so a lookup sees a whole build or the one
    before, and a build that fails leaves the others as they are. ``mode``:
    ``error`` (not if there is a finished build) or ``overwrite`` (the new build
    takes its place; ``remove_old_builds`` deletes the ones before).

    ``buckets`` (default: the session's shuffle partitions) is the number of
    files that documents are dealt into; size it so that a bucket is a task's
    worth of data (128 MB to 1 GB)."""
    if mode not in ("error", "overwrite"):
        raise ValueError(f"mode must be 'error' or 'overwrite', not {mode!r}")
    spark = corpus.sparkSession
    before = _newest(spark, path)
    if mode == "error" and before is not None:
        raise IndexExists(f"an index exists under {path}")
    # repeated ids are found before anything is written
    n_docs = corpus_size(corpus, check_ids).first()["n_docs"]
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    version = uuid.uuid4().hex[:8]  # a folder that exists already fails the write
    base = f"{path}/{version}"
    shape = corpus_shape(corpus)
    if shape == DOCUMENT_ROWS:
        vec = document_vectors(corpus, pattern, length).select("doc_id", "len", "terms")
        _write_bucketed(vec, base, "vectors", buckets, ["doc_id"])
        # postings come from the written vectors: the corpus is tokenized once, and
        # later jobs start from files, not from the scan; a task reads one bucket
        written = spark.read.table(_table_name(base, "vectors"))
        tf = explode_terms(written, "terms", "e").select(
            "doc_id", F.col("e.term").alias("term"), (F.col("e.n") / F.col("len").cast("double")).alias("tf")
        )
    else:
        tf = term_frequencies(corpus, pattern, length).select("doc_id", "term", "tf")
    leveled = tf.withColumn("level", F.floor(-F.log2("tf") * F.lit(LEVELS)).cast("int"))
    _write_bucketed(leveled, base, "postings", buckets, ["term", "level", "doc_id"], dealt=shape == DOCUMENT_ROWS)
    blocks = spark.read.parquet(f"{base}/postings").groupBy("term", "level").agg(
        F.count(F.lit(1)).alias("rows"), F.max("tf").alias("max_tf"), F.sum(F.col("tf") * F.col("tf")).alias("sumsq")
    )
    # sorted within each file, where a lookup's few terms are pages; not shuffled again for it
    blocks.sortWithinPartitions("term", "level").write.parquet(f"{base}/blocks")
    stats = spark.read.parquet(f"{base}/blocks").groupBy("term").agg(F.sum("rows").alias("df"), F.sum("sumsq").alias("sumsq"))
    stats.sortWithinPartitions("term").write.parquet(f"{base}/stats")
    row = [((before["seq"] if before else 0) + 1, version, shape, n_docs, pattern, length, buckets, tf.schema["doc_id"].dataType.simpleString())]
    spark.createDataFrame(row, BUILDS).coalesce(1).write.mode("append").parquet(f"{path}/builds")


def _write_bucketed(df: DataFrame, base: str, part: str, buckets: int, order: list[str], dealt: bool = False) -> None:
    """One file per bucket. ``dealt``: ``df`` is rows of a table with these buckets, which
    is then read bucket by bucket and not shuffled again."""
    rows = df if dealt else df.repartition(buckets, "doc_id")
    spark, auto = df.sparkSession, "spark.sql.sources.bucketing.autoBucketedScan.enabled"
    before = spark.conf.get(auto)
    if dealt:  # else the scan ignores the buckets where no join or aggregate asks for them
        spark.conf.set(auto, "false")
    try:
        rows.write.bucketBy(buckets, "doc_id").sortBy(*order).option("path", f"{base}/{part}").saveAsTable(_table_name(base, part))
    finally:
        spark.conf.set(auto, before)


def _table_name(base: str, part: str) -> str:
    return f"termsim_{base.rsplit('/', 1)[1]}_{part}"


def _newest(spark: SparkSession, path: str):
    """The row of the newest finished build, or None."""
    try:
        builds = spark.read.schema(BUILDS).parquet(f"{path}/builds")
    except AnalysisException:  # no such folder
        return None
    return builds.orderBy(F.col("seq").desc(), "version").first()


def remove_old_builds(spark: SparkSession, path: str, keep: int = 1) -> list[str]:
    """Delete the folders under ``path`` that builds other than the newest ``keep`` left
    there (older ones, unfinished ones) and the written rounds of ``topn_index``; call it
    when no lookup still reads them. Only folders named as this module names them are
    touched, and none where there is no index. Returns the names of the deleted folders."""
    if keep < 1:
        raise ValueError("keep must be at least 1")
    if _newest(spark, path) is None:
        raise ValueError(f"no finished index under {path}")
    builds = spark.read.schema(BUILDS).parquet(f"{path}/builds")
    kept = {r["version"] for r in builds.orderBy(F.col("seq").desc(), "version").limit(keep).collect()}
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    gone = []
    for status in files.listStatus(folder):
        name = status.getPath().getName()
        if name in kept or not _OWN_FOLDER.fullmatch(name):
            continue
        for part in ("vectors", "postings"):
            spark.sql(f"DROP TABLE IF EXISTS `{_table_name(f'{path}/{name}', part)}`")
        files.delete(status.getPath(), True)
        gone.append(name)
    return gone


# --------------------------------------------------------------------------
# reading
# --------------------------------------------------------------------------


@dataclass
class Index:
    """An opened build."""

    spark: SparkSession
    path: str
    row: object
    base: str = field(init=False)

    def __post_init__(self):
        self.base = f"{self.path}/{self.row['version']}"
        self.n_docs = self.row["n_docs"]
        self.has_vectors = self.row["shape"] == DOCUMENT_ROWS

    def stats(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.base}/stats")

    def blocks(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.base}/blocks")

    def bucketed(self, part: str) -> DataFrame:
        """A bucketed table; the session's catalog learns its buckets when it does
        not know them yet."""
        name = _table_name(self.base, part)
        if not self.spark.catalog.tableExists(name):
            schema = self.spark.read.parquet(f"{self.base}/{part}").schema
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
            place = f"{self.base}/{part}".replace("\\", "\\\\").replace("'", "\\'")
            self.spark.sql(
                f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet CLUSTERED BY (doc_id) INTO {self.row['buckets']} BUCKETS LOCATION '{place}'"
            )
        return self.spark.read.table(name)


def open_index(spark: SparkSession, path: str) -> Index:
    row = _newest(spark, path)
    if row is None:
        raise ValueError(f"no finished index under {path}")
    return Index(spark, path, row)


def _products(index: Index, qpost: DataFrame, only: DataFrame | None = None) -> DataFrame:
    """``(query, term, tfq, tf)`` of all entries of the documents in ``qpost``
    (``doc_id, query, tfq``), or of those terms in ``only``. Both sides of the join
    are bucketed by ``doc_id``; the query side, a selection, is the hashed one."""
    qpost = qpost.hint("shuffle_hash")
    if index.has_vectors and only is None:
        docs = index.bucketed("vectors").join(qpost, "doc_id")
        return explode_terms(docs, "terms", "e").select(
            "query", F.col("e.term").alias("term"), "tfq", (F.col("e.n") / F.col("len").cast("double")).alias("tf")
        )
    entries = index.bucketed("postings").select("doc_id", "term", "tf") if only is None else only
    return entries.join(qpost, "doc_id").select("query", "term", "tfq", "tf")


def _query_postings(index: Index, terms: list[str]) -> DataFrame:
    return index.bucketed("postings").where(F.col("term").isin(terms))


def _dense_dots(index: Index, dense: list[str]) -> DataFrame:
    """``(query, term, dot)`` of terms found in most documents, from the rows of the vectors."""
    parts = [wide_dots(index.bucketed("vectors"), dense[i : i + WIDE_QUERY_MAX]) for i in range(0, len(dense), WIDE_QUERY_MAX)]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _dots(products: DataFrame) -> DataFrame:
    pairs = products.where(F.col("query") != F.col("term"))
    return pairs.groupBy("query", "term").agg(F.sum(F.col("tfq") * F.col("tf")).alias("dot"))


def _list_dots(index: Index, known: dict[str, int]) -> DataFrame | None:
    """``(query, term, dot)`` for query terms with their document frequencies."""
    dense = [q for q, df in known.items() if index.has_vectors and df > DENSE_SHARE * index.n_docs]
    others = [q for q in known if q not in set(dense)]
    parts = [_dense_dots(index, dense)] if dense else []
    if others:
        qpost = _query_postings(index, others).select("doc_id", F.col("term").alias("query"), F.col("tf").alias("tfq"))
        if index.has_vectors and sum(known[q] for q in others) <= FEW_POSTINGS:
            ids = [r["doc_id"] for r in qpost.select("doc_id").distinct().collect()]
            docs = index.bucketed("vectors").where(F.col("doc_id").isin(ids)).join(F.broadcast(qpost), "doc_id")
            entries = explode_terms(docs, "terms", "e")
            parts.append(_dots(entries.select("query", F.col("e.term").alias("term"), "tfq", (F.col("e.n") / F.col("len").cast("double")).alias("tf"))))
        else:
            parts.append(_dots(_products(index, qpost)))
    if not parts:
        return None
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def _known(index: Index, qlist: list[str]) -> dict[str, tuple[int, float]]:
    """Document frequency and squared norm of the query terms that have a vector; at
    most one row for each term of the list comes to the driver."""
    rows = index.stats().where(F.col("term").isin(qlist) & (F.col("df") < index.n_docs)).collect()
    return {r["term"]: (r["df"], r["sumsq"]) for r in rows}


def _scored(index: Index, dots: DataFrame, qstats: DataFrame, search: str | None) -> DataFrame:
    """``(query, term, similarity)`` from dot products."""
    if search is not None:
        dots = dots.where(F.col("term").rlike(search))
    stats = index.stats().where(F.col("df") < index.n_docs).select("term", "sumsq")
    similarity = F.col("dot") / (F.sqrt("ss_q") * F.sqrt("sumsq"))
    joined = dots.join(stats, "term").join(qstats, "query").select("query", "term", similarity.alias("similarity"))
    return joined.where(F.col("similarity") > 0)


def lookup_index(
    spark: SparkSession,
    path: str,
    queries: QueryInput,
    search: str | None = None,
    n: int | None = 5,
) -> DataFrame:
    """Ranked similar terms ``(query, rank, term, similarity)`` from an index."""
    if n is not None and n < 0:
        raise ValueError("n must be >= 0 or None")
    index = open_index(spark, path)
    if not isinstance(queries, DataFrame) and len(queries) <= SMALL_QUERY_LIST:
        known = _known(index, list(dict.fromkeys(queries)))
        dots = _list_dots(index, {q: df for q, (df, _) in known.items()})
        if dots is None:
            return spark.createDataFrame([], RESULT)
        qstats = F.broadcast(spark.createDataFrame([(q, ss) for q, (_, ss) in known.items()], "query string, ss_q double"))
    else:
        if isinstance(queries, DataFrame):
            qterms = queries.select(F.col("query").alias("term")).distinct()
        else:
            qterms = spark.createDataFrame([(q,) for q in dict.fromkeys(queries)], "term string")
        qpost = index.bucketed("postings").join(qterms, "term").select("doc_id", F.col("term").alias("query"), F.col("tf").alias("tfq"))
        dots = _dots(_products(index, qpost))
        qstats = index.stats().where(F.col("df") < index.n_docs).join(qterms, "term").select(F.col("term").alias("query"), F.col("sumsq").alias("ss_q"))
    return rank_terms(_scored(index, dots, qstats, search), n)


# --------------------------------------------------------------------------
# top n with early stop
# --------------------------------------------------------------------------


@dataclass
class Round:
    """What one round of ``topn_index`` read: query terms still open, their blocks and
    postings read so far, and candidates left after it."""

    open: int
    blocks_read: int
    blocks: int
    postings_read: int
    postings: int
    candidates: int


@dataclass
class _Query:
    """A query term's blocks, heaviest first, and how far they have been read."""

    term: str
    sumsq: float
    levels: list  # (level, rows, max_tf, sumsq)
    read: int = 0
    threshold: float = 0.0

    @property
    def unread(self) -> float:
        """Squared norm of the blocks not read; 0 when all are."""
        return math.fsum(b[3] for b in self.levels[self.read :])

    @property
    def heaviest(self) -> float:
        return self.levels[self.read][2] if self.read < len(self.levels) else 0.0

    @property
    def closed(self) -> bool:
        """No term that has not been seen can still reach the threshold."""
        return self.read == len(self.levels) or math.sqrt(self.unread / self.sumsq) < self.threshold - SLACK

    def advance(self, share: float) -> tuple[int, int]:
        """Read on until at most ``share`` of what was unread is left: the levels ``(from, to)``."""
        start, goal = self.read, self.unread * share
        while self.read < len(self.levels) and (self.read == start or self.unread > goal):
            self.read += 1
        return self.levels[start][0], self.levels[self.read - 1][0]


def topn_index(
    spark: SparkSession,
    path: str,
    queries: list[str],
    n: int = 5,
    search: str | None = None,
    share: float = 0.5,
    report: list[Round] | None = None,
) -> DataFrame:
    """The ``n`` most similar terms of each query term, as ``lookup_index`` gives them,
    without scoring every term that shares a document with one.

    A threshold algorithm in rounds of Spark jobs. Each round reads the next heaviest
    blocks of the open query terms, as much as halves the squared norm that is unread
    (``share``), adds the products of their documents to the sums so far and takes the
    ``n``-th best sum as the threshold. What is unread can add at most
    ``sqrt(min(u, k m^2)) sqrt(s)`` to a term's dot product (Cauchy-Schwarz; ``u`` unread
    squared norm and ``m`` largest unread weight of the query term, ``k`` unread
    documents and ``s`` unread squared norm of the term). A query term is closed when
    a term that was not seen at all cannot reach the threshold. Then only the seen
    terms whose bound reaches it are scored to the end, from their own postings: the
    documents of the unread blocks are never opened.

    ``report`` takes one ``Round`` per round. The sums of a round are written under
    the index; ``remove_old_builds`` deletes them."""
    if n < 1 or not 0 <= share < 1:
        raise ValueError("n must be at least 1, share in [0, 1)")
    if len(queries) > SMALL_QUERY_LIST:
        raise ValueError(f"at most {SMALL_QUERY_LIST} query terms; use lookup_index")
    index = open_index(spark, path)
    known = _known(index, list(dict.fromkeys(queries)))
    if not known:
        return spark.createDataFrame([], RESULT)
    by_term: dict[str, list] = {}
    for r in index.blocks().where(F.col("term").isin(list(known))).collect():  # at most some hundred levels a term
        by_term.setdefault(r["term"], []).append((r["level"], r["rows"], r["max_tf"], r["sumsq"]))
    asked = [_Query(q, known[q][1], sorted(levels)) for q, levels in by_term.items()]
    folder, sums, number = f"{index.base}-rounds-{uuid.uuid4().hex[:8]}", None, 0
    while True:
        going = [q for q in asked if not q.closed]
        if not going:
            break
        # terms that cannot reach the threshold any more are not carried on; met again, one
        # of them has a sum that is too small, but its whole sum would not be ranked either
        carried = None if sums is None else _alive(sums, asked, known)
        part = [(q.term, *q.advance(share)) for q in going]
        new = _round_sums(index, part)
        if sums is not None:
            new = carried.select(*new.columns).unionByName(new).groupBy("query", "term").agg(*[F.sum(c).alias(c) for c in ("dot", "seen", "seen_ss")])
        scored = _with_stats(index, new, known, search)
        number += 1
        scored.write.parquet(f"{folder}/{number}")
        sums = spark.read.schema(scored.schema).parquet(f"{folder}/{number}")
        _raise_thresholds(sums, asked, known, n)
        if report is not None:
            report.append(_progress(sums, asked, len(going), known))
    alive = _alive(sums, asked, known)
    unread = [(q.term, q.levels[q.read][0]) for q in asked if q.read < len(q.levels)]
    total = F.col("dot")
    if unread:
        alive.write.parquet(f"{folder}/alive")
        alive = spark.read.schema(alive.schema).parquet(f"{folder}/alive")
        rest = _rest(index, unread, alive)
        alive, total = alive.join(rest, ["query", "term"], "left"), F.col("dot") + F.coalesce("rest", F.lit(0.0))
    qstats = F.broadcast(spark.createDataFrame([(q, known[q][1]) for q in known], "query string, ss_q double"))
    similarity = total / (F.sqrt("ss_q") * F.sqrt("sumsq"))
    return rank_terms(alive.join(qstats, "query").select("query", "term", similarity.alias("similarity")), n)


def _levels_between(index: Index, part: list[tuple[str, int, int | None]]) -> DataFrame:
    """Query postings ``(doc_id, query, tfq)`` of given terms and level ranges."""
    ranges = F.broadcast(index.spark.createDataFrame(part, "query string, low int, high int"))
    rows = _query_postings(index, [p[0] for p in part]).withColumnRenamed("term", "query").join(ranges, "query")
    inside = (F.col("level") >= F.col("low")) & (F.col("high").isNull() | (F.col("level") <= F.col("high")))
    return rows.where(inside).select("doc_id", "query", F.col("tf").alias("tfq"))


def _round_sums(index: Index, part: list[tuple[str, int, int]]) -> DataFrame:
    """``(query, term, dot, seen, seen_ss)`` over the documents of the blocks of a round."""
    pairs = _products(index, _levels_between(index, part)).where(F.col("query") != F.col("term"))
    return pairs.groupBy("query", "term").agg(
        F.sum(F.col("tfq") * F.col("tf")).alias("dot"), F.count(F.lit(1)).alias("seen"), F.sum(F.col("tf") * F.col("tf")).alias("seen_ss")
    )


def _with_stats(index: Index, sums: DataFrame, known: dict, search: str | None) -> DataFrame:
    if search is not None:
        sums = sums.where(F.col("term").rlike(search))
    return sums.join(index.stats().where(F.col("df") < index.n_docs), "term").select("query", "term", "dot", "seen", "seen_ss", "df", "sumsq")


def _state(spark: SparkSession, asked: list[_Query]) -> DataFrame:
    """One row per query term: its squared norm, what is unread, the threshold."""
    rows = [(q.term, q.sumsq, q.unread, q.heaviest, q.threshold) for q in asked]
    return F.broadcast(spark.createDataFrame(rows, "query string, ss_q double, unread double, heaviest double, threshold double"))


def _raise_thresholds(sums: DataFrame, asked: list[_Query], known: dict, n: int) -> None:
    """The ``n``-th best similarity that is certain so far; 0 with fewer terms."""
    qstats = F.broadcast(sums.sparkSession.createDataFrame([(q, v[1]) for q, v in known.items()], "query string, ss_q double"))
    certain = (F.col("dot") / (F.sqrt("ss_q") * F.sqrt("sumsq"))).alias("similarity")
    best = rank_terms(sums.join(qstats, "query").select("query", "term", certain), n)
    nth = {r["query"]: r["similarity"] for r in best.where(F.col("rank") == n).collect()}
    for q in asked:
        q.threshold = max(q.threshold, nth.get(q.term, 0.0))


def _alive(sums: DataFrame, asked: list[_Query], known: dict) -> DataFrame:
    """The seen terms whose bound reaches the threshold of their query term."""
    state = sums.join(_state(sums.sparkSession, asked), "query")
    left = F.greatest(F.lit(0.0), F.col("sumsq") - F.col("seen_ss"))
    heavy = F.least(F.col("unread"), (F.col("df") - F.col("seen")) * F.col("heaviest") * F.col("heaviest"))
    bound = (F.col("dot") + F.sqrt(heavy) * F.sqrt(left)) / (F.sqrt("ss_q") * F.sqrt("sumsq"))
    return state.where(bound >= F.col("threshold") - F.lit(SLACK)).select(*sums.columns)


def _rest(index: Index, unread: list[tuple[str, int]], alive: DataFrame) -> DataFrame:
    """``(query, term, rest)``: what the unread blocks add to the terms that are left,
    from the postings of these terms."""
    few = [r["term"] for r in alive.select("term").distinct().limit(SMALL_QUERY_LIST + 1).collect()]
    postings = index.bucketed("postings").select("doc_id", "term", "tf")
    if len(few) <= SMALL_QUERY_LIST:
        postings = postings.where(F.col("term").isin(few))  # pruned in the scan
    else:
        postings = postings.join(alive.select("term").distinct(), "term", "left_semi")
    qpost = _levels_between(index, [(q, low, None) for q, low in unread])
    pairs = _products(index, qpost, only=postings).where(F.col("query") != F.col("term"))
    return pairs.groupBy("query", "term").agg(F.sum(F.col("tfq") * F.col("tf")).alias("rest"))


def _progress(sums: DataFrame, asked: list[_Query], going: int, known: dict) -> Round:
    read = [b for q in asked for b in q.levels[: q.read]]
    every = [b for q in asked for b in q.levels]
    left = _alive(sums, asked, known).count()
    return Round(going, len(read), len(every), sum(b[1] for b in read), sum(b[1] for b in every), left)
