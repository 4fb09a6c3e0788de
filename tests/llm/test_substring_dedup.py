import collections
import hashlib
import random
import re

import numpy as np
import pytest

from termsim.llm.substring_dedup import subtree_repeats, substring_dedup


def brute(rows, window=35):
    docs = [(d, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for d, t in rows]
    count = collections.Counter(tuple(w[i : i + window]) for _, w in docs for i in range(len(w) - window + 1))
    out = []
    for d, w in docs:
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if count[tuple(w[i : i + window])] > 1:
                gone[i : i + window] = [True] * window
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out.append((d, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=repr)


def run(spark, rows, **kw):
    df = spark.createDataFrame([(d, t, 1, 2, "c") for d, t in rows], "doc_id long, text string, h1 int, key int, at string")
    got = substring_dedup(df, **kw)
    return sorted((tuple(r) for r in got.select("doc_id", "n_words", "n_removed", "kept_sha256").collect()), key=repr)


def corpus(seed):
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(3000)}"
    passages = [[word() for _ in range(n)] for n in (34, 35, 36, 60, 120)]
    rows = []
    for k in range(60):
        w = [word() for _ in range(rng.randrange(0, 200))]
        for _ in range(rng.randrange(3)):
            p = list(rng.choice(passages))
            if rng.random() < 0.3:
                p[rng.randrange(len(p))] = word()
            a = rng.randrange(len(w) + 1)
            w[a:a] = p
        rows.append((k, rng.choice([" ", "\n", "  "]).join(w)))
    rows += [(100 + i, rows[i][1]) for i in range(4)]
    rows += [(200, "The " * 400), (201, "a b c " * 60), (202, None), (203, ""), (None, "The " * 400), (None, None), (204, "x " * 34), (205, "x " * 35), (206, "x " * 36), (3, rows[3][1])]
    return rows


@pytest.mark.parametrize("group", [100_000, 25])
def test_brute_force(spark, group):
    rows = corpus(1)
    assert run(spark, rows, group=group) == brute(rows)


@pytest.mark.parametrize("window,block", [(10, 7), (7, 7), (12, 5)])
def test_other_windows(spark, window, block):
    rows = corpus(2)[:30]
    assert run(spark, rows, window=window, block=block) == brute(rows, window)


def test_spans(spark):
    p = " ".join(f"p{i}" for i in range(40))
    rows = [(1, "a b " + p + " c"), (2, p + " d e"), (3, "f g")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: [(s["start"], s["end"]) for s in r["spans"]] for r in substring_dedup(df).collect()}
    assert got == {1: [(2, 42)], 2: [(0, 40)], 3: []}


def test_empty_table(spark):
    assert run(spark, []) == []


def test_subtree_marks_equal_leaves_only():
    seven = np.array([5, 5, 5, 9, 9], np.uint64)
    fourteen = np.array([1, 1, 1, 1, 1], np.uint64)
    whole = np.array([7, 8, 7, 7, 6], np.uint64)
    assert subtree_repeats(seven, fourteen, whole).tolist() == [True, False, True, False, False]
