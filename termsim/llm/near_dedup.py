"""MinHash near-duplicate detection from bottom-k sketches.

Method
1. Every document becomes its set of distinct word shingles (64-bit hashes) and,
   from the same hash function, the ``k`` smallest of them: its bottom-k sketch.
   Documents with equal sets form a class; one row per class goes on.
2. Inverted lists: sketch values held by one class only cannot join anything.
   Two sets over the threshold share most of their sketch values, so the classes
   need to meet in the lists of their ``size - t + 1`` rarest values only (``t``
   is a low bound of the values they must share). Frequent values, e.g. a licence
   line, are thereby no meeting place.
3. Star round: in each list every class is paired with the list's smallest id.
   Pairs whose Jaccard estimate from the union's bottom-k sketch is far below the
   threshold go; the others are verified on the full shingle sets. Verified links
   give components.
4. Members of lists that still hold several components are compared on their
   full sets, by an exact prefix filter: a set must share ``percent`` of its
   shingles with a partner, so it meets partners in the lists of its rarest
   ``n - ceil(percent n) + 1`` shingles. First each list's member with the most
   common shingles, the likely origin of a group of loose copies, meets all members
   of other components. Then each remaining pair of different components comes up
   in the first list that both are in, and only if it can still be over the
   threshold: shingles of one member alone, and those that stand before the place
   of the first meeting, count against the pair. This ends nearly all pairs of a
   group of loose copies before they are formed. What is left is filtered and
   verified like the pairs of the star.

Exactness: the verification is exact (up to 64-bit hash equality). Both bounds
on sketches are more than seven standard deviations of a bottom-k estimate wide
at the defaults, so a pair over the threshold misses them with a chance of about
1e-8; sets of at most ``k`` shingles are compared whole.

Scale: all steps are joins and aggregates by value, id or (pivot, salt); a hot
pivot's pairs are salted. Texts move once, and only those of classes in a list
are kept. Nothing but counters reaches the driver.

Defined cases: NULL or wordless text has an empty set and is linked with
nothing; texts shorter than a shingle count as one shingle of all their words;
an id listed with several texts is one document with the links of all of them;
a NULL id is returned with a NULL component and ``kept`` true; repeated rows give
repeated results; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termsim.llm.components import components
from termsim.llm.storage import table, written
from termsim.llm.words import batches_of, gram_hashes, mix

SHINGLE = 5
K = 64
PERCENT = 85
#: How far below the threshold the shared part of two sketches may lie.
LIST_SLACK = 0.35
ESTIMATE_SLACK = 0.30
SALTS = 64
#: Shingles before its place that a row of a list carries.
NEAR = 6

_SIGN = np.uint64(1 << 63)


def shingle_sets(batch: pa.RecordBatch, text: str = "text", n: int = SHINGLE) -> Iterator[np.ndarray]:
    """Per row the sorted distinct shingle hashes of its lower-cased text."""
    for i, j, _, _, _, first, words in batches_of(batch, text, lower=True):
        grams = gram_hashes(words, n)
        for k in range(j - i):
            a, b = first[k], first[k + 1]
            if b - a >= n:
                yield np.unique(grams[a : b - n + 1])
            elif b > a:
                # the whole sequence, told from a shingle of n words by its length
                yield mix(gram_hashes(words[a:b], b - a) + np.uint64(b - a))
            else:
                yield np.zeros(0, np.uint64)


def _sketch_batches(n: int, k: int):
    names = ["doc_id", "n_shingles", "s1", "s2", "sketch"]

    def run(batches):
        for batch in batches:
            size, s1, s2, sketches = [], [], [], []
            for s in shingle_sets(batch, "text", n):
                size.append(len(s))
                s1.append(int(np.sum(s, dtype=np.uint64).astype(np.int64)))
                s2.append(int(np.bitwise_xor.reduce(mix(s)).astype(np.int64)) if len(s) else 0)
                sketches.append((s[:k] ^ _SIGN).view(np.int64))  # keeps the order when read as signed
            offsets = np.concatenate([[0], np.cumsum([len(s) for s in sketches])]).astype(np.int32)
            values = np.concatenate([np.zeros(0, np.int64), *sketches])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(size, pa.int64()),
                    pa.array(s1, pa.int64()),
                    pa.array(s2, pa.int64()),
                    pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, pa.int64())),
                ],
                names=names,
            )

    return run


def sketches(docs: DataFrame, n: int = SHINGLE, k: int = K) -> DataFrame:
    """``(doc_id, n_shingles, s1, s2, sketch)``: set size, a 128-bit signature of
    the whole set and its ``k`` smallest values."""
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        _sketch_batches(n, k), "doc_id long, n_shingles long, s1 long, s2 long, sketch array<bigint>"
    )


def list_members(classes: DataFrame, fraction: float, k: int = K) -> DataFrame:
    """``(v, id, n)``: the inverted lists (two members at least) in which a class
    must look for partners."""
    values = classes.where("n > 0").select("id", "n", F.explode("sketch").alias("v"))
    shared = values.groupBy("v").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    hits = values.join(shared, "v")
    per = hits.groupBy("id", "n").agg(F.sort_array(F.collect_list(F.struct("df", "v"))).alias("hits"))
    least = F.greatest(F.lit(1), F.floor(F.least(F.col("n"), F.lit(k)) * fraction).cast("int"))
    need = F.size("hits") - least + 1  # values of one member only come before all others
    prefix = per.where(need > 0).select("id", "n", F.explode(F.slice("hits", F.lit(1), F.greatest(need, F.lit(0)))).alias("h"))
    return prefix.select(F.col("h.v").alias("v"), "id", "n")


def _set_batches(n: int):
    def run(batches):
        for batch in batches:
            sets = [x.view(np.int64) for x in shingle_sets(batch, "text", n)]
            offsets = np.concatenate([[0], np.cumsum([len(x) for x in sets])]).astype(np.int32)
            values = pa.array(np.concatenate([np.zeros(0, np.int64), *sets]), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(pa.array(offsets), values)], names=["id", "s"])

    return run


def full_members(texts: DataFrame, ids: DataFrame, percent: int, n: int) -> DataFrame:
    """``(id, n, alone, weight, prefix)`` of the rows ``ids`` on their full sets, without
    those that cannot have a partner: shingles of this member alone, how common the
    others are, and the rarest of them in which it must meet every partner."""
    sets = texts.join(ids.select("id"), "id", "left_semi").select("id", "text").mapInArrow(_set_batches(n), "id long, s array<bigint>")
    sets = written(sets.select("id", F.size("s").alias("n"), "s"), "full-sets")
    values = sets.select("id", "n", F.explode("s").alias("v"))
    shared = values.groupBy("v").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    per = values.join(shared, "v").groupBy("id", "n").agg(F.sort_array(F.collect_list(F.struct("df", "v"))).alias("hits"))
    alone = F.col("n") - F.size("hits")
    length = F.col("n") - F.ceil(F.col("n") * percent / F.lit(100)).cast("int") + 1 - alone
    prefix = F.transform(F.slice("hits", F.lit(1), F.greatest(length, F.lit(0))), lambda h: h["v"])
    weight = F.aggregate("hits", F.lit(0).cast("long"), lambda total, h: total + h["df"])
    return written(per.where(length > 0).select("id", "n", alone.alias("alone"), weight.alias("weight"), prefix.alias("prefix")), "full-members")


def central_pairs(member: DataFrame, label: DataFrame, percent: int) -> DataFrame:
    """Pairs ``(a, b)``: in each list the member with the most common shingles, the
    likely origin of copies, and every member of another component."""
    lists = member.join(label, "id").select(F.explode("prefix").alias("v"), "id", "n", "weight", "c")
    pivot = lists.groupBy("v").agg(F.min(F.struct((-F.col("weight")).alias("w"), F.col("id").alias("a"), F.col("n").alias("m"), F.col("c").alias("pc"))).alias("p"))
    met = lists.join(pivot, "v").select(F.col("p.a").alias("a"), F.col("p.m").alias("m"), F.col("p.pc").alias("pc"), F.col("id").alias("b"), "n", "c")
    fits = F.least("n", "m") * 100 >= F.greatest("n", "m") * percent
    return met.where((F.col("c") != F.col("pc")) & fits).select("a", "b").distinct()


def cross_pairs(member: DataFrame, label: DataFrame, percent: int) -> DataFrame:
    """Pairs ``(a, b)`` of different components ``label(id, c)`` that the exact
    prefix and positional filters leave.

    Shingles have one order (rarest first). When two members first meet at places
    ``i`` and ``j`` of their prefixes, all that stands before is in one of them only,
    so they share at most ``min(n - alone - i, n' - alone' - j)``. A row carries the
    ``NEAR`` shingles before its place: a pair that has met just before is not formed
    again, one that has met long before is, with a bound that may be too low; it then
    has been kept or dropped at its first meeting."""
    place = F.sequence(F.lit(0), F.size("prefix") - 1)
    entry = lambda i: F.struct(
        F.get("prefix", i).alias("v"), i.alias("i"), F.slice("prefix", F.greatest(i - (NEAR - 1), F.lit(1)), F.least(i, F.lit(NEAR))).alias("near")
    )
    cut = member.join(label, "id").select("id", "n", "alone", "c", F.explode(F.transform(place, entry)).alias("e"))
    lists = written(cut.select("e.v", "id", "n", "c", (F.col("n") - F.col("alone") - F.col("e.i")).alias("left"), "e.near"), "full-lists")
    # the members outside a list's largest component meet all others
    sizes = lists.groupBy("v", "c").agg(F.count(F.lit(1)).alias("size"))
    largest = sizes.groupBy("v").agg(F.max(F.struct("size", "c"))["c"].alias("major"), F.count(F.lit(1)).alias("k")).where("k > 1")
    other = lists.join(largest.select("v", "major"), "v")
    minor = other.where("c != major").select(*[F.col(x).alias(x + "_") for x in ("v", "id", "n", "c", "left", "near")])
    most = F.least("left", "left_")
    within = (
        (F.col("c") != F.col("c_"))
        & ((F.col("c") == F.col("major")) | (F.col("id_") < F.col("id")))  # two minor members: once
        & (100 * most >= percent * (F.col("n") + F.col("n_") - most))
        & ~F.arrays_overlap("near", "near_")
    )
    met = minor.join(other, (F.col("v") == F.col("v_")) & within)
    return met.select(F.least("id", "id_").alias("a"), F.greatest("id", "id_").alias("b")).distinct()


def _similar_sketches(pairs: DataFrame, classes: DataFrame, least: float, k: int) -> DataFrame:
    """Pairs ``(a, b)`` whose union-sketch estimate is at least ``least``."""
    side = classes.select(F.col("id"), F.col("sketch"))
    both = pairs.join(side.toDF("a", "sa"), "a").join(side.toDF("b", "sb"), "b")
    union = both.select("a", "b", "sa", "sb", F.slice(F.array_sort(F.array_union("sa", "sb")), 1, k).alias("u"))
    shared = F.size(F.array_intersect(F.array_intersect("u", "sa"), "sb"))
    return union.where(shared >= F.size("u") * F.lit(least)).select("a", "b").distinct()


def _verify_batches(n: int, percent: int):
    """Rows sorted by (a, salt, kind): a pivot's text, then its partners'."""

    def run(batches):
        current, pivots = None, []
        for batch in batches:
            a, salt = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            kind, b = batch.column(2).to_pylist(), batch.column(3).to_pylist()
            found = []
            for i, s in enumerate(shingle_sets(batch, "text", n)):
                if kind[i] == 0:
                    if current != (a[i], salt[i]):
                        current, pivots = (a[i], salt[i]), []
                    pivots.append(s)
                else:
                    for p in pivots:
                        both = len(np.intersect1d(p, s, assume_unique=True))
                        if both and 100 * both >= percent * (len(p) + len(s) - both):
                            found.append((a[i], b[i]))
                            break
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[0] for x in found], pa.int64()), pa.array([x[1] for x in found], pa.int64())],
                names=["u", "v"],
            )

    return run


def verify(pairs: DataFrame, texts: DataFrame, n: int, percent: int) -> DataFrame:
    """Links ``(u, v)``: the pairs ``(a, b)`` that reach the threshold on full sets.
    A pivot's text goes once to each salt that its partners use."""
    salted = pairs.withColumn("salt", F.pmod(F.xxhash64("b"), F.lit(SALTS)))
    partners = salted.join(texts.toDF("b", "text"), "b").select("a", "salt", F.lit(1).alias("kind"), "b", "text")
    pivots = salted.select("a", "salt").distinct().join(texts.toDF("a", "text"), "a")
    rows = partners.unionByName(pivots.select("a", "salt", F.lit(0).alias("kind"), F.lit(None).cast("long").alias("b"), "text"))
    return (
        rows.repartition("a", "salt")
        .sortWithinPartitions("a", "salt", "kind", "b")
        .mapInArrow(_verify_batches(n, percent), "u long, v long")
    )


def near_duplicates(docs: DataFrame, percent: int = PERCENT, n: int = SHINGLE, k: int = K) -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)``, one row per row of ``docs``:
    documents are linked when ``100 * |A & B| >= percent * |A | B|``."""
    threshold = percent / 100
    rows = written(sketches(docs, n, k), "sketches")
    known = rows.where(F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0))
    classes = written(
        known.groupBy("n_shingles", "s1", "s2", "sketch").agg(F.min("doc_id").alias("id"))
        .select("id", F.col("n_shingles").alias("n"), "s1", "s2", "sketch"),
        "classes",
    )
    members = written(list_members(classes, threshold - LIST_SLACK, k), "lists")
    in_lists = members.select("id").distinct()
    sketch_of = written(classes.join(in_lists, "id", "left_semi").select("id", "sketch"), "list-sketches")
    texts = written(
        docs.select(F.col("doc_id").cast("long").alias("id"), "text").join(in_lists, "id", "left_semi"), "list-texts"
    )

    def links(pairs: DataFrame) -> DataFrame:
        likely = written(_similar_sketches(pairs, sketch_of, threshold - ESTIMATE_SLACK, k), "pairs")
        return verify(likely, texts, n, percent)

    # an id with several texts stands in several classes: they are one document
    of_id = known.join(classes.select("id", "n", "s1", "s2"), [F.col("n_shingles") == F.col("n"), rows.s1 == classes.s1, rows.s2 == classes.s2])
    of_id = written(of_id.select("doc_id", "id").distinct(), "class-of-id")
    same = of_id.groupBy("doc_id").agg(F.min("id").alias("u"), F.max("id").alias("v"), F.count(F.lit(1)).alias("c"))
    same = same.where("c > 1").select("doc_id", "u").join(of_id, "doc_id").select("u", F.col("id").alias("v"))

    fits = F.least("n", "m") * 100 >= F.greatest("n", "m") * percent
    pivot = members.groupBy("v").agg(F.min(F.struct(F.col("id").alias("a"), F.col("n").alias("m"))).alias("p"))
    star = members.join(pivot, "v").select(F.col("p.a").alias("a"), F.col("p.m").alias("m"), F.col("id").alias("b"), "n")
    first = written(links(star.where((F.col("a") < F.col("b")) & fits).select("a", "b").distinct()).union(same), "links")
    found = components(first)

    # lists that still hold several components
    label = members.join(found.withColumnRenamed("id", "i"), F.col("id") == F.col("i"), "left")
    label = label.select("v", "id", F.coalesce("component", "id").alias("c"))
    mixed = label.groupBy("v").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).where("lo != hi").select("v")
    label = written(label.join(mixed, "v", "left_semi").select("id", "c").distinct(), "mixed-members")
    member = full_members(texts, label, percent, n)
    second = written(links(central_pairs(member, label, percent)), "links")
    linked = first.union(second)
    found = components(linked)
    label = label.select("id").join(found.withColumnRenamed("id", "i"), F.col("id") == F.col("i"), "left")
    label = written(label.select("id", F.coalesce("component", "id").alias("c")), "mixed-members")
    all_links = linked.union(links(cross_pairs(member, label, percent)))
    found = components(all_links)

    merged = of_id.join(found, "id", "left").groupBy("doc_id").agg(F.min(F.coalesce("component", "id")).alias("component_id"))
    out = rows.select("doc_id", "n_shingles").join(merged, "doc_id", "left")
    component = F.coalesce("component_id", "doc_id")
    return out.select(
        "doc_id", "n_shingles", component.alias("component_id"),
        F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept"),
    )


def op1_near_dedup(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
OP1_SQL = f"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w
  FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < {SHINGLE} THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - {SHINGLE - 2}), lambda i: array_to_string(w[i:i + {SHINGLE - 1}], ' '))) END AS s
  FROM words),
grams AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets),
shared AS (SELECT a.doc_id AS u, b.doc_id AS v, any_value(a.n) AS n, any_value(b.n) AS m, count(*) AS k
  FROM grams a JOIN grams b ON a.g = b.g AND a.doc_id < b.doc_id
    AND least(a.n, b.n) * 100 >= greatest(a.n, b.n) * {PERCENT} GROUP BY 1, 2),
links AS (SELECT u, v FROM shared WHERE 100 * k >= {PERCENT} * (n + m - k)),
ways AS (SELECT u, v FROM links UNION SELECT v, u FROM links),
reach AS (SELECT doc_id, doc_id AS r FROM documents UNION SELECT reach.doc_id, ways.v FROM reach JOIN ways ON reach.r = ways.u),
least_of AS (SELECT doc_id, min(r) AS component_id FROM reach GROUP BY doc_id)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept
FROM sets JOIN least_of USING (doc_id)"""
