"""Phrase collocation mining by SON partitioning.

Texts (A-Z folded) are cut at sentence signs and line breaks into pieces and those at
blanks into words; phrases are two or three consecutive words of a piece, counted per
language with overlaps. A phrase that occurs ``SUPPORT`` times is a candidate; its
score is ``floor(10^6 a^2 / (l r))`` of its weakest cut, and two-word candidates that
mostly occur inside one longer candidate go.

Method
1. Rows are dealt into ``SHARDS`` shards by a hash. With ``N_i`` of the ``N`` word
   occurrences in shard ``i``, a phrase with ``SUPPORT`` occurrences has at least
   ``SUPPORT N_i / N`` of them in some shard: the local support.
2. Each shard is mined completely, word by word longer: counts of words, of two-word
   phrases whose words are locally frequent somewhere, of three-word phrases whose
   two halves are. A shard is not a task: its counts are a column of one distributed
   aggregate.
3. The phrases that reach the local support of any shard are united: the candidates.
   A candidate has been counted in every shard, also where it is rare (whether a
   phrase is counted depends on its words, not on the shard), so the sum over the
   shards is its exact count, without another pass over the texts.
"Is locally frequent" is asked of a bitmap of fixed size (``FILTER_BITS``) that is
sent to the tasks. It knows every frequent phrase and may let others pass, which then
are counted too and fall below the support: no count ever depends on it. On corpora
with more frequent phrases than it has room for, it only saves less. For a support
that does not grow with the corpus many shards would have a local support of 1 and
prune nothing, hence the few shards.

Words are 64-bit hashes of language and word while they are counted. The vocabulary
(every distinct word with its text) shows whether two words share a hash; then
all is done again with other hashes, so that counts are exact.

Scale: tasks add up phrases over millions of words before they send them, Spark again
before the shuffle, so that a frequent phrase reaches its reducer as a row per map
task. Nothing is gathered by language: the ranking keeps the best rows of every task
first. Each step's counts are written in the shared folder.

Defined cases: NULL texts have no words, NULL languages are ``und`` (as is that
name); rows with equal ids or texts all count; equal scores are ranked by count,
then phrase; a language without candidates has no rows, and neither has an empty
table; further columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from termsim.llm.storage import table, written
from termsim.llm.words import chunks, mix, text_buffers, word_hashes

SUPPORT = 10
#: A two-word candidate goes when a longer one that holds it has this share of its occurrences, in percent.
INSIDE = 50
TOP = 2000
SHARDS = 3
FILTER_BITS = 1 << 27
#: Phrases that a task holds before it adds up equal ones.
HELD = 400_000
_ROWS = 100_000
#: Texts whose bytes are copied at a time.
_BATCH = 1000

_BLANK = np.zeros(256, dtype=bool)
_BLANK[[0x20, 0x09]] = True
_CUT = np.zeros(256, dtype=bool)
_CUT[[*b".,;:!?", 0x0A, 0x0B, 0x0C, 0x0D]] = True
#: Bits of one row of the bitmap (``bitmap_construct_agg``).
_ROW_BITS = 1 << 15


# --------------------------------------------------------------------------
# words and phrases of a batch (numpy)
# --------------------------------------------------------------------------


def _words(data: np.ndarray, offsets: np.ndarray):
    """``(starts, ends, row, joined)``: byte spans of the words, the row of each, and
    whether the next word follows in the same piece."""
    inside = np.zeros(len(data) + 2, dtype=bool)
    inside[1:-1] = ~(_BLANK | _CUT)[data]
    begin, close = inside[1:-1] & ~inside[:-2], inside[1:-1] & ~inside[2:]
    edges = offsets[1:-1]
    edges = edges[(edges > 0) & (edges < len(data))]
    begin[edges] = inside[1:-1][edges]  # a word never runs over the end of its row
    close[edges - 1] = inside[1:-1][edges - 1]
    starts, ends = np.flatnonzero(begin), np.flatnonzero(close) + 1
    row = np.searchsorted(offsets, starts, side="right") - 1
    piece = np.cumsum(_CUT[data])[starts] if len(starts) else starts
    joined = np.append((row[1:] == row[:-1]) & (piece[1:] == piece[:-1]), False)[: len(starts)]
    return starts, ends, row, joined


def _turn(x: np.ndarray, n: int) -> np.ndarray:
    return (x << np.uint64(n)) | (x >> np.uint64(64 - n))


def _joined(parts: list[np.ndarray]) -> np.ndarray:
    out = parts[0]
    for k, p in enumerate(parts[1:], 1):
        out = out ^ _turn(p, 21 * k)
    return out


def _slots(parts: list[np.ndarray], bits: int):
    """The two places of phrases in the bitmap (:func:`_slot_columns` in numpy)."""
    z, mask = _joined(parts), np.uint64(bits - 1)
    return z & mask, (z >> np.uint64(32)) & mask


def _slot_columns(parts: list[Column], bits: int) -> Column:
    z = parts[0]
    for k, p in enumerate(parts[1:], 1):
        z = z.bitwiseXOR(F.shiftleft(p, 21 * k).bitwiseOR(F.shiftrightunsigned(p, 64 - 21 * k)))
    return F.array(z.bitwiseAND(F.lit(bits - 1)), F.shiftrightunsigned(z, 32).bitwiseAND(F.lit(bits - 1)))


def _known(bitmap: np.ndarray, parts: list[np.ndarray]) -> np.ndarray:
    found = np.ones(len(parts[0]), dtype=bool)
    for slot in _slots(parts, 8 * len(bitmap)):
        found &= (bitmap[slot >> np.uint64(3)] >> (slot & np.uint64(7)).astype(np.uint8)) & 1 == 1
    return found


def _added_up(parts: list[np.ndarray], counts: np.ndarray):
    """Equal phrases together: ``(parts, counts[phrase, shard], first place)``."""
    order = np.argsort(_joined(parts), kind="stable")
    parts = [p[order] for p in parts]
    new = np.ones(len(order), dtype=bool)
    new[1:] = np.logical_or.reduce([p[1:] != p[:-1] for p in parts])
    starts = np.flatnonzero(new)
    counts = np.add.reduceat(counts[order], starts, axis=0) if len(starts) else counts
    return [p[new] for p in parts], counts, order[starts]


class _Held:
    """Phrases and counts that a task has not sent yet. Equal ones are added up when
    there are ``HELD``; they go only when that leaves more than half."""

    def __init__(self):
        self.parts, self.counts, self.size = [], [], 0

    def add(self, parts: list[np.ndarray], counts: np.ndarray) -> None:
        self.parts.append(parts)
        self.counts.append(counts)
        self.size += len(counts)

    def full(self) -> bool:
        if self.size < HELD:
            return False
        self.add(*self.take())
        return self.size >= HELD // 2

    def take(self) -> tuple[list[np.ndarray], np.ndarray]:
        whole = [np.concatenate(p) for p in zip(*self.parts, strict=True)]
        parts, counts, _ = _added_up(whole, np.concatenate(self.counts))
        self.parts, self.counts, self.size = [], [], 0
        return parts, counts


def _grams(hashes, joined, n: int):
    """``(place, words)`` of all ``n``-word phrases."""
    size = len(hashes) - n + 1
    if size <= 0:
        return np.zeros(0, np.int64), [np.zeros(0, np.uint64)] * n
    whole = np.ones(size, dtype=bool)
    for k in range(n - 1):
        whole &= joined[k : k + size]
    at = np.flatnonzero(whole)
    return at, [hashes[at + k] for k in range(n)]


def _parsed(batches, seed: int):
    """Per bounded chunk of rows: ``(data, starts, ends, row, joined, hashes, shard, langs)``."""
    salt = mix(np.array([seed], np.uint64))
    for batch in (b.slice(k, _BATCH) for b in batches for k in range(0, b.num_rows, _BATCH)):
        data, offsets = text_buffers(batch.column(1))
        lang_hash = mix(batch.column(2).to_numpy().astype(np.int64).view(np.uint64) ^ salt)
        shard = batch.column(3).to_numpy().astype(np.int64)
        for i, j in chunks(offsets):
            part = data[offsets[i] : offsets[j]]
            starts, ends, row, joined = _words(part, offsets[i : j + 1] - offsets[i])
            if len(starts):
                hashes = mix(word_hashes(part, starts, ends, lower=True) ^ lang_hash[i:j][row])
                yield part, starts, ends, row, joined, hashes, shard[i:j][row], batch.column(0).slice(i, j - i)


def _count_columns(counts: np.ndarray) -> dict[str, pa.Array]:
    return {f"c{k}": pa.array(counts[:, k].astype(np.int64)) for k in range(counts.shape[1])}


def _rows(columns: dict[str, pa.Array]):
    whole = pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))
    for i in range(0, whole.num_rows, _ROWS):
        yield whole.slice(i, _ROWS)


def _ints(a: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(a).view(np.int64))


def _count_words(seed: int, shards: int):
    one = np.eye(shards, dtype=np.int32)

    def run(batches):
        held, names = _Held(), {}

        def sent():
            (h,), counts = held.take()
            texts = [names[k] for k in h.tolist()]
            names.clear()
            out = {"h1": _ints(h), "lang": pa.array([t[0] for t in texts], pa.string()), "word": pa.array([t[1] for t in texts], pa.string())}
            yield from _rows(out | _count_columns(counts))

        for part, starts, ends, row, _, h, s, langs in _parsed(batches, seed):
            raw, of = part.tobytes(), langs.to_pylist()
            (distinct,), counts, first = _added_up([h], one[s])
            for k, i in zip(distinct.tolist(), first.tolist(), strict=True):
                if k not in names:
                    names[k] = of[row[i]], raw[starts[i] : ends[i]].lower().decode()
            held.add([distinct], counts)
            if held.full():
                yield from sent()
        if held.size:
            yield from sent()

    return run


def _count_phrases(n: int, seed: int, shards: int, bitmap):
    """Counts by shard of the ``n``-word phrases whose two shorter halves the bitmap knows."""
    one = np.eye(shards, dtype=np.int32)

    def run(batches):
        bits, held = np.frombuffer(bitmap.value, np.uint8), _Held()

        def sent():
            parts, counts = held.take()
            yield from _rows({f"h{k + 1}": _ints(p) for k, p in enumerate(parts)} | _count_columns(counts))

        for *_, joined, h, s, _ in _parsed(batches, seed):
            at, parts = _grams(h, joined, n)
            keep = _known(bits, parts[:-1]) & _known(bits, parts[1:])
            parts, counts, _ = _added_up([p[keep] for p in parts], one[s[at][keep]])
            held.add(parts, counts)
            if held.full():
                yield from sent()
        if held.size:
            yield from sent()

    return run


# --------------------------------------------------------------------------
# Spark
# --------------------------------------------------------------------------


def _bitmap(spark, slots: DataFrame, bits: int):
    """The bitmap of a column ``slots`` (arrays of places), broadcast: ``bits / 8`` bytes,
    whatever the number of rows."""
    one = slots.select(F.explode("slots").alias("slot"))
    rows = one.groupBy(F.shiftrightunsigned("slot", 15).alias("row")).agg(
        F.bitmap_construct_agg(F.col("slot").bitwiseAND(F.lit(_ROW_BITS - 1))).alias("bits")
    )
    whole = bytearray(bits // 8)
    for row, part in rows.toLocalIterator():
        whole[row * _ROW_BITS // 8 : (row + 1) * _ROW_BITS // 8] = part
    return spark.sparkContext.broadcast(bytes(whole))


def _vocabulary(rows: DataFrame, shards: int, seeds: int = 4) -> tuple[DataFrame, int]:
    """``(h1, lang, word, c0..)`` of every distinct word, and the seed of its hashes."""
    counts = ", ".join(f"c{k} long" for k in range(shards))
    for seed in range(seeds):
        made = rows.mapInArrow(_count_words(seed, shards), f"h1 long, lang string, word string, {counts}")
        found = made.groupBy("h1", "lang", "word").agg(*[F.sum(f"c{k}").alias(f"c{k}") for k in range(shards)])
        vocabulary = written(found, "phrase-words")
        if vocabulary.groupBy("h1").count().where(F.col("count") > 1).isEmpty():
            return vocabulary, seed
    raise ArithmeticError("words with equal hashes under every seed")


def phrase_counts(docs: DataFrame, support: int = SUPPORT, shards: int = SHARDS, bits: int = FILTER_BITS) -> tuple[DataFrame, DataFrame]:
    """``(words, phrases)``: every word ``(h1, lang, word, f)``, and every phrase of two
    or three words with ``support`` occurrences: ``(h1, h2, h3, a)``, ``h3`` NULL for two."""
    spark = docs.sparkSession
    lang = F.coalesce(F.col("lang").cast("string"), F.lit("und"))
    shard = F.pmod(F.xxhash64("doc_id", "text"), F.lit(shards)).cast("int")
    rows = docs.select(lang.alias("lang"), F.col("text").cast("string").alias("text"), F.xxhash64(lang).alias("lang_hash"), shard.alias("shard"))
    vocabulary, seed = _vocabulary(rows, shards)
    sizes = vocabulary.agg(*[F.sum(f"c{k}") for k in range(shards)]).first()
    sizes = [n or 0 for n in sizes]
    least = [max(1, -(-support * n // max(1, sum(sizes)))) for n in sizes]

    counts = [f"c{k}" for k in range(shards)]
    schema = ", ".join(f"{c} long" for c in counts)
    reached = F.exists(F.array(*[F.col(c) >= t for c, t in zip(counts, least, strict=True)]), lambda x: x)
    total = sum((F.col(c) for c in counts[1:]), F.col(counts[0]))
    shorter, found = vocabulary.where(reached), []
    for n in (2, 3):
        keys = [f"h{k + 1}" for k in range(n)]
        known = _bitmap(spark, shorter.select(_slot_columns([F.col(h) for h in keys[:-1]], bits).alias("slots")), bits)
        made = rows.mapInArrow(_count_phrases(n, seed, shards, known), ", ".join(f"{h} long" for h in keys) + ", " + schema)
        local = made.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in counts])
        shorter = written(local.where(reached), f"phrase-candidates-{n}")
        exact = shorter.where(total >= support)
        found.append(exact.select("h1", "h2", (F.col("h3") if n == 3 else F.lit(None).cast("long")).alias("h3"), total.alias("a")))
    words = vocabulary.select("h1", "lang", "word", total.alias("f"))
    return words, found[0].unionByName(found[1])


def _score(a: str, left: str, right: str) -> Column:
    """``floor(10^6 a^2 / (l r))`` in 38 decimal digits."""
    return F.expr(f"(cast({a} as decimal(38,0)) * {a} * 1000000) div (cast({left} as decimal(38,0)) * {right})")


def collocations(docs: DataFrame, support: int = SUPPORT, inside: int = INSIDE, top: int = TOP, shards: int = SHARDS, bits: int = FILTER_BITS) -> DataFrame:
    """``(lang, rank, phrase, a, l, r, n, score)``: each language's first ``top`` phrases."""
    words, phrases = phrase_counts(docs, support, shards, bits)
    sizes = words.groupBy("lang").agg(F.sum("f").alias("n"))
    often = words.where(F.col("f") >= support)
    first = often.select("h1", "lang", F.col("f").alias("f1"))
    last = often.select(F.col("h1").alias("last"), F.col("f").alias("f_last"))
    two = phrases.where(F.col("h3").isNull()).select("h1", "h2", "a")
    three = phrases.where(F.col("h3").isNotNull())

    longer = three.select("h1", "h2", "a").unionByName(three.select(F.col("h2").alias("h1"), F.col("h3").alias("h2"), "a"))
    longer = longer.groupBy("h1", "h2").agg(F.max("a").alias("longest"))
    alone = two.join(longer, ["h1", "h2"], "left").where(F.coalesce(F.lit(100) * F.col("longest") < F.lit(inside) * F.col("a"), F.lit(True)))
    scored = alone.join(first, "h1").join(last, F.col("h2") == F.col("last")).select(
        "lang", "h1", "h2", F.lit(None).cast("long").alias("h3"), "a", F.col("f1").alias("l"), F.col("f_last").alias("r"), _score("a", "f1", "f_last").alias("score")
    )
    head = two.select("h1", "h2", F.col("a").alias("f12"))
    tail = two.select(F.col("h1").alias("h2"), F.col("h2").alias("h3"), F.col("a").alias("f23"))
    cuts = three.join(head, ["h1", "h2"]).join(tail, ["h2", "h3"]).join(first, "h1").join(last, F.col("h3") == F.col("last"))
    cuts = cuts.withColumn("s1", _score("a", "f1", "f23")).withColumn("s2", _score("a", "f12", "f_last"))
    second = F.col("s2") < F.col("s1")
    scored = scored.unionByName(
        cuts.select(
            "lang", "h1", "h2", "h3", "a",
            F.when(second, F.col("f12")).otherwise(F.col("f1")).alias("l"),
            F.when(second, F.col("f_last")).otherwise(F.col("f23")).alias("r"),
            F.least("s1", "s2").alias("score"),
        )
    )
    # the texts are looked up only for what can be among the first
    best = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc())
    near = scored.withColumn("place", F.rank().over(best)).where(F.col("place") <= top)
    for h in ("h1", "h2", "h3"):
        near = near.join(often.select(F.col("h1").alias(h), F.col("word").alias(f"w_{h}")), h, "inner" if h != "h3" else "left")
    named = near.withColumn("phrase", F.concat_ws(" ", "w_h1", "w_h2", "w_h3"))
    order = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase")
    ranked = named.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= top)
    return ranked.join(sizes, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op12_phrases(spark, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
OP12_SQL = f"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[.,;:!?\\x0A-\\x0D]')) AS p
  FROM documents),
ws AS (SELECT lang, list_filter(regexp_split_to_array(p, '[\\x20\\x09]+'), lambda x: x <> '') AS w FROM pieces),
grams AS (
  SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS phrase
  FROM ws, (SELECT unnest([1, 2, 3]) AS k) WHERE len(w) >= k),
f AS (SELECT lang, k, phrase, count(*) AS a FROM grams GROUP BY ALL),
sizes AS (SELECT lang, CAST(sum(a) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY lang),
cands AS (SELECT *, string_split(phrase, ' ') AS w FROM f WHERE k > 1 AND a >= {SUPPORT}),
cuts AS (
  SELECT c.lang, c.k, c.phrase, c.a, x.a AS l, y.a AS r, cut, (1000000::HUGEINT * c.a * c.a) // (x.a::HUGEINT * y.a) AS score
  FROM (SELECT *, unnest(range(1, k)) AS cut FROM cands) c
  JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[1:cut], ' ')
  JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[cut + 1:], ' ')),
scored AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
longer AS (
  SELECT lang, part, max(a) AS longest FROM (
    SELECT lang, a, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) AS part FROM cands WHERE k = 3) GROUP BY ALL)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, s.a DESC, phrase) AS rank, phrase, s.a, l, r, n, CAST(score AS BIGINT) AS score
FROM scored s JOIN sizes USING (lang) LEFT JOIN longer ON longer.lang = s.lang AND part = phrase AND k = 2
WHERE longest IS NULL OR 100 * longest < {INSIDE} * s.a
QUALIFY rank <= {TOP}"""
