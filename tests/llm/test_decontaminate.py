import random

import numpy as np
import pyarrow as pa

from termsim.llm import decontaminate as dc


def distance(item, text):
    """Edits of the whole item against its best region, by the full table."""
    p, t = dc.fold_text(item), dc.fold_text(text)
    if len(p) < dc.MIN_CHARS:
        return None
    prev, k = np.zeros(len(t) + 1, int), np.arange(len(t) + 1)
    for i, c in enumerate(p, 1):
        cur = np.empty_like(prev)
        cur[0] = i
        cur[1:] = np.minimum(prev[1:] + 1, prev[:-1] + (t != c))
        prev = np.minimum.accumulate(cur - k) + k
    return int(prev.min())


def words(rng, n):
    return " ".join(rng.choice(["the", "anon", "thed", "ingé", "ou", "er", "st", "Wha"]) + rng.choice(["", "re", "st,", "ing", "ed."]) for _ in range(n))


def case(seed=1):
    rng = random.Random(seed)
    items = [(i, words(rng, rng.randrange(8, 40))) for i in range(25)] + [(90, "short"), (91, None), (92, ""), (3, words(rng, 20))]
    texts = []
    for _ in range(70):
        text = words(rng, rng.randrange(0, 80))
        x = list(rng.choice(items[:25])[1])
        for _ in range(rng.randrange(0, 1 + int(len(x) * 0.09))):
            i, op = rng.randrange(len(x)), rng.randrange(3)
            if op == 0:
                x[i] = rng.choice("abcdeé")
            elif op == 1:
                x.insert(i, rng.choice("xyz !"))
            else:
                del x[i]
        leak = "".join(x)
        texts.append(text + " " + rng.choice([leak, leak.upper(), leak.replace(" ", " %% ")]) + " " + words(rng, rng.randrange(30)))
    texts += [words(rng, 60) for _ in range(20)] + ["", None, items[0][1], items[1][1][:40]]
    return items, texts


def test_block_finds_what_the_full_table_finds():
    items, texts = case()
    block = dc.Block(items)
    got = {}
    for row, item, edits, start, end in dc._search(block)(pa.array(texts, pa.string())):
        got[row, item] = min(edits, got.get((row, item), 99))
        assert 0 <= start < end <= len(texts[row])
    expected = {}
    for row, text in enumerate(texts):
        for (item, body) in items:
            d = distance(body or "", text or "")
            if d is not None and d <= int(len(dc.fold_text(body)) * dc.ERROR_RATE):
                expected[row, item] = min(d, expected.get((row, item), 99))
    assert got == expected and 30 < len(expected)


def test_spark_rows_and_filter(spark, monkeypatch):
    items, texts = case(2)
    bench = spark.createDataFrame([(i, t, 0) for i, t in items], "item_id long, text string, doc_id int")
    docs = spark.createDataFrame([(k if k % 7 else None, t, 1.5, k) for k, t in enumerate(texts)], "doc_id long, text string, edits double, row long")
    once = sorted((tuple(r) for r in dc.leaks(docs, bench).collect()), key=repr)
    block = dc.Block(items)
    rows = {r[0] for r in dc._search(block)(pa.array(texts, pa.string()))}
    clean = dc.without_leaks(docs, bench)
    assert clean.columns == docs.columns
    assert {r["row"] for r in clean.collect()} == set(range(len(texts))) - rows
    # small blocks give the same rows; each block is a pass of its own
    blocks = list(dc.blocks(bench, 900))
    assert len(blocks) > 2
    monkeypatch.setattr(dc, "blocks", lambda benchmark, limit=900: iter(blocks))
    assert sorted((tuple(r) for r in dc.leaks(docs, bench).collect()), key=repr) == once


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    bench = spark.createDataFrame([], "item_id long, text string")
    some = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    assert dc.leaks(docs, bench).collect() == [] and dc.leaks(some, bench).collect() == []
    assert dc.without_leaks(some, bench).count() == 1
    assert dc.leaks(docs, spark.createDataFrame([(1, "x" * 50)], "item_id long, text string")).collect() == []
