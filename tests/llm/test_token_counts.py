import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from termsim.llm import token_counts as tc

ODD = [
    "", " ", "a  b", " x", "x ", "a\n b", "  \n\n  x\n", "don't you'll we've they're I'd 'rex 'lo 've", "he said ''re '", "<|endoftext|>", "a  <|endoftext|>  b<|endoftext|",
    "x<|<|endoftext|><|endoftext|>y", "é naïve 東京都　　です 😀😀 é", "a\x1cb \x1c c\x85 d​ e  f᠎g", "0123456789 ½ ²³ ٣٤", "\x00\x01\t\x7f￿\U0010ffff",
    "ababababab" * 20, "=" * 300, " " * 300 + "x", "\n" * 50, "aaaaaaaa" * 30, "https://example.org/a_b?c=d&e=f#g", "'s't're've'm'll'd", "I'M WE'RE 'Ll", "supercalifragilisticexpialidocious " * 5,
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(tc.tokenizer_path())


@pytest.fixture(scope="module")
def counter():
    return tc.PrefixCounter(tc.tokenizer_path())


def brute(library, text):
    """Every prefix encoded as a text of its own."""
    return [len(e.ids) for e in library.encode_batch([text[:k] for k in range(len(text) + 1)], add_special_tokens=False)]


def check(counter, library, texts):
    tokens, packed = counter.tables(texts)
    for t, n, p in zip(texts, tokens, packed, strict=True):
        want = brute(library, t)
        assert tc.counts(p).tolist() == want, t
        assert n == want[-1]


def test_every_prefix_of_odd_texts(counter, library):
    check(counter, library, ODD)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet="abrelstv'SL1 .,\n\t\xa0é東%|<>\x01", max_size=40), min_size=1, max_size=5))
def test_every_prefix_of_any_text(counter, library, texts):
    check(counter, library, texts)


@settings(max_examples=60, deadline=None)
@given(st.text(max_size=60))
def test_every_prefix_of_any_unicode(counter, library, text):
    check(counter, library, [text])


def merged(counter, made, tokens):
    """Plain BPE: the best-ranked leftmost pair until none is left."""
    parts = [counter.tokens[bytes([b])] for b in b"".join(tokens)]
    while True:
        ranks = [counter.rank.get(p, len(counter.rank)) for p in zip(parts, parts[1:], strict=False)]
        if not ranks or min(ranks) == len(counter.rank):
            return parts
        k = ranks.index(min(ranks))
        parts[k : k + 2] = [made[parts[k], parts[k + 1]]]


def test_fitting_tokens_against_merging(counter):
    rng = random.Random(7)
    made = {(a, b): t for t, (_, a, b) in counter.made.items()}
    tokens = sorted(counter.tokens)
    alike = [t for t in tokens if set(t) <= set(b"aeinrst ") or set(t) <= set(b"= -")]
    for some in (tokens, alike):
        for _ in range(4000):
            a, b = rng.choice(some), rng.choice(some)
            whole = merged(counter, made, [b]) == [counter.tokens[b]]
            assert counter.fits(-1, counter.tokens[b]) == whole
            if merged(counter, made, [a]) == [counter.tokens[a]]:
                assert counter.fits(counter.tokens[a], counter.tokens[b]) == (merged(counter, made, [a, b]) == [counter.tokens[a], counter.tokens[b]])


def test_white_space_is_the_librarys(library):
    """One sign between letters is a piece apart or joins them; white space never joins a following word."""
    points = [*range(0xD800), *range(0xE000, 0x3100), *range(0xFE00, 0x10000)]
    white = {chr(c) for c in points if len(library.pre_tokenizer.pre_tokenize_str(f"{chr(c)}{chr(c)}.")) == 3 and chr(c) != "."}
    assert white <= set(tc.WHITE) | {"'"}
    assert set(tc.WHITE) <= white | {" "}


def test_small_memory_and_portions(library, monkeypatch):
    monkeypatch.setattr(tc, "PORTION", 50)
    monkeypatch.setattr(tc, "LONG_CHUNK", 5)
    check(tc.PrefixCounter(tc.tokenizer_path(), chunks=3), library, ODD)


def test_real_texts(spark, library):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").orderBy("doc_id").limit(12)
    for r in tc.prefix_tables(docs, keep=("doc_id", "text")).collect():
        text = r["text"][:1500]
        assert tc.counts(r["prefix_table"])[: len(text) + 1].tolist() == brute(library, text)


def test_query_against_the_library(spark, library):
    got = tc.op11_token_counts(spark, "/root/testdata/sf0.001")
    assert got.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    ids = list(texts)
    sizes = [len(e.ids) for e in library.encode_batch([texts[i] for i in ids], add_special_tokens=False)]
    want = sorted((i, len(texts[i].encode()), n, n > 1024) for i, n in zip(ids, sizes, strict=True))
    assert sorted(map(tuple, got.collect())) == want


def test_defined_cases(spark, library):
    long = "word and line\n" * 90_000 + "x" * 5_000  # over a portion, ends in a chunk that is not kept
    rows = [(1, None), (2, ""), (None, "no id"), (3, "twice"), (3, "twice"), (4, long), (5, "<|endoftext|> " * 3)]
    docs = spark.createDataFrame(rows, "doc_id int, text string").withColumn("t", F.lit("x")).withColumn("n_tokens", F.lit(7)).withColumn("c0", F.lit(1))
    got = tc.prefix_tables(docs).collect()
    size = {t: len(library.encode(t or "", add_special_tokens=False).ids) for _, t in rows}
    assert sorted([(r["doc_id"], r["n_bytes"], r["n_chars"], r["n_tokens"]) for r in got], key=repr) == sorted(
        [(i, len((t or "").encode()), len(t or ""), size[t]) for i, t in rows], key=repr
    )
    assert tc.prefix_tables(docs.limit(0)).count() == 0


def test_questions(spark, library):
    rng = random.Random(3)
    texts = ["".join(rng.choice("the quick brown  fox\n é") for _ in range(rng.randrange(60))) for _ in range(30)]
    rows = spark.createDataFrame([(k, t, k) for k, t in enumerate(texts)], "doc_id int, text string, ask int")
    asked = tc.prefix_tables(rows, keep=("doc_id", "text", "ask"))
    got = asked.select("text", "ask", tc.tokens_before(F.col("prefix_table"), F.col("ask")).alias("n"), tc.fitting_prefix(F.col("prefix_table"), F.lit(9)).alias("cut"))
    for text, k, n, cut in got.collect():
        every = brute(library, text)
        assert n == every[min(k, len(text))]
        assert cut == int(np.flatnonzero(np.array(every) <= 9)[-1])
    cut_texts = got.select(F.expr("substring(text, 1, int(cut))").alias("t")).collect()
    assert all(len(library.encode(r["t"], add_special_tokens=False).ids) <= 9 for r in cut_texts)


def test_other_tokenizers_are_refused():
    import public_tokenizers

    with pytest.raises(ValueError):
        tc.PrefixCounter(public_tokenizers.path("word_bpe_49k.json"))
