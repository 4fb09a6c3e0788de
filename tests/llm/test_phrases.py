import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from termsim.llm import phrases as ph

SCHEMA = "doc_id long, text string, lang string"


def pieces(text):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return [[w for w in re.split("[ \t]+", p) if w] for p in re.split("[.,;:!?\n-\r]", text)]


def brute(rows, support, inside=50, top=2000):
    out = []
    for lang in sorted({g or "und" for _, _, g in rows}):
        f, n = Counter(), 0
        for _, text, g in rows:
            if (g or "und") != lang:
                continue
            for w in pieces(text):
                n += len(w)
                for k in (1, 2, 3):
                    f.update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
        found = []
        for p, a in f.items():
            if len(p) == 1 or a < support:
                continue
            if any(len(q) > len(p) and b >= support and p in (q[:2], q[1:]) and 100 * b >= inside * a for q, b in f.items()):
                continue
            score, k = min((1000000 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, p, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n, -score))
    return out


def made(seed, n=120, words="the of a bé cat Dog sat mat on it's x y"):
    rng = random.Random(seed)
    vocabulary = words.split(" ")
    texts = []
    for _ in range(n):
        some = [rng.choice(vocabulary[: rng.randrange(2, len(vocabulary) + 1)]) for _ in range(rng.randrange(30))]
        texts.append("".join(w + rng.choice([" ", " ", "  ", "\t", ". ", ",", "\n", " "]) for w in some))
    return [(i, t, rng.choice(["en", "de", None, "und"])) for i, t in enumerate(texts)]


def check(spark, rows, support=10, **more):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = ph.collocations(df, support=support, **more)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    more = {k: v for k, v in more.items() if k in ("inside", "top")}
    assert sorted(map(tuple, got.collect())) == brute(rows, support, **more)
    return got


@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force(spark, seed):
    check(spark, made(seed), bits=1 << 16)


def test_filter_without_room_and_other_shards(spark):
    """A bitmap too small for the phrases lets all pass and changes nothing."""
    check(spark, made(3, 60), support=4, shards=5, bits=1 << 15, top=7)


def test_small_blocks_and_inside(spark, monkeypatch):
    monkeypatch.setattr(ph, "HELD", 50)
    check(spark, made(4, 60), support=3, inside=80, bits=1 << 16)


def test_edges(spark):
    rows = [(1, None, "en"), (2, "", "en"), (3, " \t ", "de"), (4, "one", "fr"), (5, ".,;:!?\n", "fr")]
    check(spark, rows, support=1)
    check(spark, [], support=1)
    long = "a b c " * 200_000  # one text over several chunks, one piece
    df = spark.createDataFrame([(1, long, "en")] + [(7, "a b. c", None)] * 12, SCHEMA)
    got = {(r["lang"], r["phrase"]): (r["a"], r["l"], r["r"], r["n"]) for r in ph.collocations(df).collect()}
    assert got == {
        ("en", "a b c"): (200_000, 200_000, 200_000, 600_000),
        ("en", "b c a"): (199_999, 200_000, 200_000, 600_000),
        ("en", "c a b"): (199_999, 200_000, 200_000, 600_000),
        ("und", "a b"): (12, 12, 12, 36),
    }


def test_hot_phrase_and_further_columns(spark):
    rows = [(1, "In Spring it rains", "en")] * 300 + made(5, 30)
    df = spark.createDataFrame(rows, SCHEMA)
    names = ("h1", "h2", "a", "l", "word", "shard", "c0", "f", "n", "lang_hash")
    more = df.select("*", *[F.lit(1).alias(c) for c in names])
    assert sorted(map(tuple, ph.collocations(more).collect())) == brute(rows, 10)


def test_scores_past_64_bits(spark):
    big = spark.createDataFrame([(3_000_000_000_000, 4_000_000_000_000, 3_000_000_000_001)], "a long, l long, r long")
    a, left, right = big.first()
    assert big.select(ph._score("a", "l", "r")).first()[0] == 1000000 * a * a // (left * right)


def test_slots_agree(spark):
    rng = np.random.default_rng(1)
    h = rng.integers(-(1 << 63), (1 << 63) - 1, (20, 3))
    df = spark.createDataFrame([tuple(map(int, r)) for r in h], "h1 long, h2 long, h3 long")
    for n in (1, 2, 3):
        got = df.select(ph._slot_columns([F.col(f"h{k + 1}") for k in range(n)], 1 << 20).alias("s")).collect()
        a, b = ph._slots([h[:, k].copy().view(np.uint64) for k in range(n)], 1 << 20)
        assert [r["s"] for r in got] == [[int(x), int(y)] for x, y in zip(a, b, strict=True)]


def test_words_with_equal_hashes(spark, monkeypatch):
    """Words that share a hash under every seed are an error, not a wrong count."""

    def alike(seed, shards):
        def run(batches):
            for batch in batches:
                words = batch.column(1).to_pylist()
                yield from ph._rows({"h1": ph.pa.array([5] * len(words)), "lang": batch.column(0), "word": batch.column(1), "c0": ph.pa.array([1] * len(words))})

        return run

    monkeypatch.setattr(ph, "_count_words", alike)
    rows = spark.createDataFrame([("en", "a"), ("en", "a"), ("en", "b")], "lang string, text string")
    with pytest.raises(ArithmeticError):
        ph._vocabulary(rows, 1)
    vocabulary, seed = ph._vocabulary(rows.where("text = 'a'"), 1)
    assert seed == 0 and [tuple(r) for r in vocabulary.collect()] == [(5, "en", "a", 2)]
