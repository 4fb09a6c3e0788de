"""Substring de-duplication with prefix-partitioned suffix trees.

A window is ``WINDOW`` consecutive words of one text. Every word covered by a
window whose word sequence also starts anywhere else (another text, or another
place of the same one) is a repeat; windows are judged on the input.

Method
1. Scan. Per text: words, digest of the whole, and its anchors. An anchor of a
   window is the smallest hash among its ``BLOCK``-word grams, so equal windows
   have equal anchors; about 7 % of the positions are anchors.
2. Anchors that occur once cannot lie in a repeated window. Only texts with an
   anchor that occurs twice go on, and only their windows with such an anchor
   become suffixes. Texts that are copies of each other go on once.
3. Prefix partition. A suffix is cut at the window's depth and read as symbols
   (words 1-7, 8-14, the whole). Suffixes are grouped by a 7-word prefix; groups
   larger than ``GROUP`` are split by the 14-word prefix, and those still larger by
   all 35 words, so that every group fits in memory. A single window that fills a
   group by itself is known as a repeat from its count and is spread over tasks.
4. Subtrees. Each group is sorted into the leaf order of its suffix tree; the
   common prefixes of neighbours give the internal nodes; the leaves below nodes
   as deep as the window are the repeats. Overlapping windows of a text join into
   its maximal repeated spans.

Scale: texts move once by their hash (those with common anchors); all else are
numbers. Counts by anchor, prefix and window are map-side combined. Tables that
are used several times are written in the shared folder. Word sequences are
compared by hashes of 128 bits.

Defined cases: NULL or empty text has no words and keeps the empty text; texts
shorter than a window keep all words; repeated rows are copies of each other;
a NULL id is returned as NULL; further columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termsim.llm.storage import parallelism, table, written
from termsim.llm.words import batches_of, gram_hashes, mix

WINDOW = 35
BLOCK = 7
#: Suffixes that a subtree is built from at most.
GROUP = 100_000
#: Prefix buckets per shuffle partition.
BUCKETS = 256


def _sliding(a: np.ndarray, n: int, pick) -> np.ndarray:
    """``pick`` (minimum or maximum) over every ``n`` consecutive entries."""
    size = 1
    while 2 * size <= n:
        a = pick(a[:-size], a[size:])
        size *= 2
    return pick(a[: len(a) - (n - size)], a[n - size :]) if size < n else a


def _windows(hashes: np.ndarray, first: np.ndarray, window: int, block: int):
    """``(grams, starts, anchors)``: gram hash per word position, the positions where
    a window of one row starts, and the anchor of each of these windows."""
    grams = gram_hashes(hashes, block)
    if len(hashes) < window:
        return grams, np.zeros(0, np.int64), np.zeros(0, np.uint64)
    anchors = _sliding(grams, window - block + 1, np.minimum)
    row_end = np.repeat(first[1:], np.diff(first))
    starts = np.flatnonzero(np.arange(len(anchors)) + window <= row_end[: len(anchors)])
    return grams, starts, anchors[starts]


def _row_anchors(grams, starts, anchors, first, window, block):
    """Per row ``(row, anchor, more than one place)``."""
    if len(starts) == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, bool)
    span = window - block + 1
    low = np.zeros(len(grams) + span - 1, np.uint64)  # anchors by start, moved by span - 1
    low[starts + span - 1] = anchors
    at = np.flatnonzero(_sliding(low, span, np.maximum) == grams)  # grams that some window has as anchor
    row = np.searchsorted(first, at, side="right") - 1
    order = np.lexsort((grams[at], row))
    row, value = row[order], grams[at][order]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (value[1:] != value[:-1])
    head = np.flatnonzero(new)
    return row[head], value[head], np.diff(np.append(head, len(row))) > 1


def _kept_digest(words: list[bytes]) -> str:
    return hashlib.sha256(b" ".join(words)).hexdigest()


def _scan_batches(window: int, block: int):
    names = ["doc_id", "h1", "h2", "n_words", "sha", "anchors", "often"]

    def run(batches):
        for batch in batches:
            n_words, sha, sizes, values, often = [], [], [], [], []
            texts = batch.column(3)
            for i, j, _, _, _, first, hashes in batches_of(batch, "text"):
                n = np.diff(first)
                n_words.append(n)
                grams, starts, anchors = _windows(hashes, first, window, block)
                row, value, more = _row_anchors(grams, starts, anchors, first, window, block)
                sizes.append(np.bincount(row, minlength=j - i))
                values.append(value)
                often.append(more)
                sha += [_kept_digest((t or "").encode().split()) for t in texts.slice(i, j - i).to_pylist()]
            if not sizes:
                continue
            offsets = pa.array(np.concatenate([[0], np.cumsum(np.concatenate(sizes))]).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[:3],
                    pa.array(np.concatenate(n_words), pa.int64()),
                    pa.array(sha),
                    pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(values).view(np.int64))),
                    pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(often))),
                ],
                names=names,
            )

    return run


def _suffix_batches(window: int, block: int):
    """Rows ``(h1, hp, prefix, whole)``: ``hp`` = 32 bits of h2, then the position;
    ``prefix`` = 32-bit hashes of the first 7 and 14 words; ``whole`` = all words."""
    offsets = [*range(0, window - block, block), window - block]

    def run(batches):
        for batch in batches:
            h1 = batch.column(0).to_numpy()
            h2 = batch.column(1).to_numpy()
            common = batch.column(3)
            for i, j, _, _, _, first, hashes in batches_of(batch, "text"):
                grams, starts, anchors = _windows(hashes, first, window, block)
                cut = np.searchsorted(starts, first)
                keep = np.zeros(len(starts), bool)
                for k in range(j - i):
                    a, b = cut[k], cut[k + 1]
                    if b > a:
                        found = common[i + k].values.to_numpy(zero_copy_only=False).view(np.uint64)
                        keep[a:b] = np.isin(anchors[a:b], found)
                s = starts[keep]
                row = np.searchsorted(first, s, side="right") - 1
                whole, fourteen = np.zeros(len(s), np.uint64), None
                for k, o in enumerate(offsets):
                    whole = mix(whole * np.uint64(31) + grams[s + o])
                    if k == 1:
                        fourteen = whole
                if fourteen is None:
                    fourteen = whole
                high = np.uint64(32)
                prefix = (grams[s] >> high << high) | (fourteen >> high)
                hp = (h2[i + row].astype(np.int64) << 32) | (s - first[row])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h1[i + row]), pa.array(hp), pa.array(prefix.view(np.int64)), pa.array(whole.view(np.int64))],
                    names=["h1", "hp", "prefix", "whole"],
                )

    return run


def subtree_repeats(seven: np.ndarray, fourteen: np.ndarray, whole: np.ndarray) -> np.ndarray:
    """Which suffixes of a group are leaves below an internal node as deep as the
    window. The leaves are put in the tree's order, the common prefix (in symbols)
    of neighbours is the depth of the node that joins them, and a deep node is a
    run of neighbours joined at full depth."""
    order = np.lexsort((whole, fourteen, seven))
    a, b, c = seven[order], fourteen[order], whole[order]
    depth = np.zeros(len(order) + 1, np.int8)
    same = a[1:] == a[:-1]
    depth[1:-1] += same
    same = same & (b[1:] == b[:-1])
    depth[1:-1] += same
    depth[1:-1] += same & (c[1:] == c[:-1])
    out = np.zeros(len(order), bool)
    out[order] = (depth[:-1] == 3) | (depth[1:] == 3)
    return out


def _subtree_batches(batches):
    """Rows ``(key, known, h1, hp, prefix, whole)`` sorted by key; a group that runs
    over a batch's end is carried on."""
    held = None

    def solve(t: pa.Table) -> pa.RecordBatch:
        key = t.column("key").to_numpy()
        known = t.column("known").to_numpy(zero_copy_only=False)
        prefix = t.column("prefix").to_numpy().view(np.uint64)
        whole = t.column("whole").to_numpy().view(np.uint64)
        out = known.copy()
        head = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        # groups side by side: the key is one more leading symbol of the order
        for a, b in zip(head, np.append(head[1:], len(key)), strict=True):
            if b - a > 1 and not known[a]:
                p = prefix[a:b]
                out[a:b] = subtree_repeats(p >> np.uint64(32), p, whole[a:b])
        hit = t.filter(pa.array(out)).select(["h1", "hp"]).combine_chunks()
        return hit

    def emit(t):
        yield from solve(t).to_batches()

    for batch in batches:
        t = pa.Table.from_batches([batch])
        if held is not None:
            t = pa.concat_tables([held, t])
        key = t.column("key").to_numpy()
        if len(key) == 0:
            continue
        last = int(np.searchsorted(key, key[-1]))
        if t.column("known")[-1].as_py():
            last = len(key)  # known repeats need no group
        if last:
            yield from emit(t.slice(0, last))
        held = t.slice(last) if last < len(key) else None
    if held is not None:
        yield from emit(held)


def _partitioned(suffixes: DataFrame, group: int) -> DataFrame:
    """``suffixes`` plus ``key`` (the group's prefix bucket) and ``known``."""
    n = BUCKETS * parallelism(suffixes.sparkSession)
    seven = F.pmod(F.shiftrightunsigned("prefix", 32), F.lit(n))
    fourteen = F.pmod("prefix", F.lit(n))
    whole = F.pmod("whole", F.lit(n))
    level = [F.struct(F.lit(k).alias("level"), x.cast("long").alias("bucket")) for k, x in enumerate((seven, fourteen, whole))]
    counts = suffixes.select(F.inline(F.array(*level))).groupBy("level", "bucket").agg(F.count(F.lit(1)).alias("n"))
    heavy = written(counts.where(F.col("n") > group).select("level", "bucket"), "heavy-prefixes")
    # windows that fill a group alone: counted exactly, among those of heavy buckets only
    full = heavy.where("level = 2").select(F.col("bucket").alias("b2"))
    hot = suffixes.withColumn("b2", whole.cast("long")).join(full, "b2", "left_semi").groupBy("prefix", "whole").agg(F.count(F.lit(1)).alias("n"))
    hot = written(hot.where(F.col("n") > group).select("prefix", "whole", F.lit(True).alias("known")), "hot-windows")
    rows = suffixes.withColumns({"b0": seven.cast("long"), "b1": fourteen.cast("long"), "b2": whole.cast("long")})
    for k in (0, 1):
        mark = heavy.where(F.col("level") == k).select(F.col("bucket").alias(f"b{k}"), F.lit(True).alias(f"heavy{k}"))
        rows = rows.join(mark, f"b{k}", "left")
    rows = rows.join(hot, ["prefix", "whole"], "left")
    step = F.lit(1 << 40)
    key = (
        F.when(F.col("heavy0").isNull(), F.col("b0"))
        .when(F.col("heavy1").isNull(), F.col("b1") + step)
        .otherwise(F.col("b2") + step * 2)
    )
    known = F.coalesce("known", F.lit(False))
    key = F.when(known, F.pmod(F.xxhash64("h1", "hp"), F.lit(n)) + step * 3).otherwise(key)
    return rows.select(key.alias("key"), known.alias("known"), "h1", "hp", "prefix", "whole")


def _spans(positions: np.ndarray, window: int) -> np.ndarray:
    """``[start, end)`` rows of the union of the windows at sorted positions."""
    if len(positions) == 0:
        return np.zeros((0, 2), np.int64)
    new = np.append(True, positions[1:] > positions[:-1] + window)
    head = np.flatnonzero(new)
    tail = np.append(head[1:] - 1, len(positions) - 1)
    return np.stack([positions[head], positions[tail] + window], axis=1)


def _cut_batches(window: int):
    names = ["h1", "h2", "n_removed", "spans", "kept_text"]
    types = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def run(batches):
        for batch in batches:
            removed, spans, kept = [], [], []
            for text, at in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                words = text.encode().split()
                found = _spans(np.unique(np.array(at, np.int64)), window)
                left, last = [], 0
                for a, b in found.tolist():
                    left += words[last:a]
                    last = b
                left += words[last:]
                removed.append(len(words) - len(left))
                spans.append([{"start": a, "end": b} for a, b in found.tolist()])
                kept.append(b" ".join(left).decode())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:2], pa.array(removed, pa.int64()), pa.array(spans, types), pa.array(kept, pa.string())], names=names
            )

    return run


def substring_dedup(docs: DataFrame, window: int = WINDOW, block: int = BLOCK, group: int = GROUP) -> DataFrame:
    """``(doc_id, n_words, n_removed, spans, copies, kept_sha256)`` per row.

    ``spans`` are the removed word ranges ``[start, end)``; ``copies`` the number of
    rows with the same text (over one: a text of a window or more goes whole)."""
    keyed = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).select(
        "doc_id", F.xxhash64("text").alias("h1"), F.xxhash64(F.lit(1), "text").alias("h2"), "text"
    )
    schema = "doc_id long, h1 long, h2 long, n_words long, sha string, anchors array<bigint>, often array<boolean>"
    scan = written(keyed.withColumn("doc_id", F.col("doc_id").cast("long")).mapInArrow(_scan_batches(window, block), schema), "scan")
    copies = scan.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("c"), F.min("doc_id").alias("rep")).where("c > 1")
    copies = written(copies, "copies")

    # anchors of two texts or two places; copies of a text count once
    anchors = scan.select("h1", F.explode(F.arrays_zip("anchors", "often")).alias("x")).select(
        F.col("x.anchors").alias("anchor"), "h1", F.col("x.often").alias("often")
    )
    common = anchors.groupBy("anchor").agg(F.min("h1").alias("lo"), F.max("h1").alias("hi"), F.max("often").alias("often"))
    common = common.where("often or lo != hi").select("anchor")
    per_text = anchors.select("anchor", "h1").join(common, "anchor").groupBy("h1").agg(F.collect_set("anchor").alias("common"))
    chosen = per_text.join(copies.select(F.col("h1").alias("hc"), "rep"), F.col("h1") == F.col("hc"), "left")
    chosen = chosen.select(F.col("h1").alias("hk"), "common", F.col("hc").isNotNull().alias("copied"), "rep")
    texts = keyed.join(chosen, F.col("h1") == F.col("hk")).where(~F.col("copied") | F.col("doc_id").eqNullSafe(F.col("rep")))
    texts = written(texts.select("h1", "h2", "text", "common"), "common-texts")

    suffixes = texts.select("h1", "h2", "text", "common").mapInArrow(
        _suffix_batches(window, block), "h1 long, hp long, prefix long, whole long"
    )
    grouped = _partitioned(suffixes, group).repartition("key").sortWithinPartitions("key")
    hits = grouped.mapInArrow(_subtree_batches, "h1 long, hp long")
    low = (1 << 32) - 1
    per = hits.groupBy("h1", F.shiftright("hp", 32).alias("h2_low")).agg(
        F.collect_list(F.col("hp").bitwiseAND(low).cast("int")).alias("at")
    )
    same = (F.col("t.h1") == F.col("p.h1")) & (F.shiftright(F.shiftleft("t.h2", 32), 32) == F.col("p.h2_low"))
    cut = (
        texts.alias("t").join(per.alias("p"), same).select("t.h1", "t.h2", "t.text", "p.at")
        .mapInArrow(_cut_batches(window), "h1 long, h2 long, n_removed long, spans array<struct<start:bigint,end:bigint>>, kept_text string")
        .select(F.col("h1").alias("k1"), F.col("h2").alias("k2"), "n_removed", "spans", F.sha2(F.col("kept_text").cast("binary"), 256).alias("cut_sha"))
        .dropDuplicates(["k1", "k2"])
    )
    rows = scan.select("doc_id", "h1", "h2", "n_words", "sha").join(copies.select("h1", "h2", "c"), ["h1", "h2"], "left")
    rows = rows.join(cut, (F.col("h1") == F.col("k1")) & (F.col("h2") == F.col("k2")), "left")
    gone = F.col("c").isNotNull() & (F.col("n_words") >= window)
    n_removed = F.when(gone, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0)))
    whole = F.array(F.struct(F.lit(0).cast("long").alias("start"), F.col("n_words").alias("end")))
    none = F.expr("cast(array() as array<struct<start:bigint,end:bigint>>)")
    return rows.select(
        "doc_id",
        "n_words",
        n_removed.alias("n_removed"),
        F.when(gone, whole).otherwise(F.coalesce("spans", none)).alias("spans"),
        F.coalesce("c", F.lit(1)).alias("copies"),
        F.when(gone, F.sha2(F.lit("").cast("binary"), 256)).when(n_removed > 0, F.col("cut_sha")).otherwise(F.col("sha")).alias("kept_sha256"),
    )


def op4_substring_dedup(spark, sf_dir: str) -> DataFrame:
    found = substring_dedup(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", "kept_sha256")


OP4_SQL = f"""
WITH texts AS (
  SELECT row_number() OVER () AS rid, doc_id,
    list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents),
starts AS (SELECT rid, w, unnest(range(1, len(w) - {WINDOW - 2})) AS s FROM texts WHERE len(w) >= {WINDOW}),
windows AS (SELECT rid, s, array_to_string(w[s:s + {WINDOW - 1}], ' ') AS k FROM starts),
repeats AS (SELECT rid, s FROM (SELECT rid, s, count(*) OVER (PARTITION BY k) AS c FROM windows) WHERE c > 1),
words AS (SELECT rid, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM texts),
judged AS (
  SELECT words.rid, i, word, max(s) OVER (PARTITION BY words.rid ORDER BY i ROWS BETWEEN {WINDOW - 1} PRECEDING AND CURRENT ROW) IS NOT NULL AS gone
  FROM words LEFT JOIN repeats ON words.rid = repeats.rid AND i = s),
per AS (SELECT rid, count(*) FILTER (WHERE gone) AS n_removed, string_agg(word, ' ' ORDER BY i) FILTER (WHERE NOT gone) AS kept FROM judged GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM texts LEFT JOIN per USING (rid)"""
