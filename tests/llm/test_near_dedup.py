import itertools
import random
import re

import pytest

from termsim.llm import near_dedup
from termsim.llm.components import components
from termsim.llm.near_dedup import near_duplicates

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, percent=85):
    sets = []
    for d, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(FOLD))
        sets.append((d, {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()))
    root = {d: d for d, _ in rows if d is not None}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for (a, s), (b, t) in itertools.combinations([x for x in sets if x[0] is not None], 2):
        if s and t and 100 * len(s & t) >= percent * len(s | t):
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return sorted(((d, len(s), None if d is None else find(d), d is None or find(d) == d) for d, s in sets), key=repr)


def run(spark, rows, **kw):
    df = spark.createDataFrame([(d, t, 1, "x") for d, t in rows], "doc_id long, text string, n int, id string")
    return sorted((tuple(r) for r in near_duplicates(df, **kw).collect()), key=repr)


def mutated(rng, words, n):
    out = list(words)
    for _ in range(n):
        out[rng.randrange(len(out))] = f"w{rng.randrange(10**6)}"
    return out


def test_group_of_loose_copies(spark):
    rng = random.Random(3)
    rows, k = [], 0
    for size, copies in ((150, 60), (400, 25), (40, 25), (9, 8)):
        base = [f"b{rng.randrange(500)}" for _ in range(size)]
        for _ in range(copies):  # from nearly equal to clearly different
            rows.append((k, " ".join(mutated(rng, base, rng.randrange(0, max(2, size // 15))))))
            k += 1
    rng.shuffle(rows)
    expected = brute(rows)
    assert run(spark, rows) == expected
    assert 30 < sum(not r[3] for r in expected) < len(rows) - 10


@pytest.mark.parametrize("percent", [80])
def test_large_group_forms_few_pairs(spark, monkeypatch, percent):
    """Copies of one text with up to a third of it changed: the pairs that are formed
    grow with the group, not with its square, and no link is lost."""
    rng = random.Random(percent)
    words = [f"base{k}" for k in range(150)]
    rows = [(i, " ".join(mutated(rng, words, rng.randrange(12)))) for i in rng.sample(range(10**6), 600)]
    counts, plain = [], near_dedup._similar_sketches

    def counted(pairs, *more):
        counts.append(pairs.count())
        return plain(pairs, *more)

    monkeypatch.setattr(near_dedup, "_similar_sketches", counted)
    want = brute(rows, percent)
    assert run(spark, rows, percent=percent) == want
    assert len({w[2] for w in want}) > 50  # many stay alone
    assert counts[-1] < 300 and sum(counts) < 10 * len(rows), counts


def test_small_sketches(spark):
    """A sketch of fewer values asks for fewer shared ones."""
    rng = random.Random(9)
    rows = []
    for k in range(20):
        words = [f"d{k}w{j}" for j in range(300)]
        rows += [(2 * k, " ".join(words)), (2 * k + 1, " ".join(mutated(rng, words, 2)))]
    want = brute(rows)
    assert sum(w[3] for w in want) == 20
    assert run(spark, rows, k=16) == want


def test_int_ids_and_long_texts(spark):
    long = [f"w{k}" for k in range(30_000)]
    rows = [(1, " ".join(long)), (2, " ".join(long[:29_000])), (3, " ".join(long[:20_000])), (4, None)]
    got = near_duplicates(spark.createDataFrame(rows, "doc_id int, text string"))
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute(rows)


def test_chain_of_steps(spark):
    rng = random.Random(5)
    words = [f"a{i}" for i in range(200)]
    rows = []
    for i in range(12):  # each near the one before, the ends far apart
        rows.append((20 - i, " ".join(words)))
        words = mutated(rng, words, 3)
    assert run(spark, rows) == brute(rows)


def test_defined_cases(spark):
    rows = [
        (1, None), (2, ""), (3, " \t\n"), (4, "One two"), (5, "one  TWO"), (6, "one two three"), (None, "one two"), (None, None),
        (7, "x " * 3000), (8, "x " * 3000), (9, "É b c d e f"), (10, "é b c d e f"), (11, "p q r s t u"), (11, "p q r s t u"),
        (12, "a b c d e f g h"), (12, "k l m n o p q r"), (13, "a b c d e f g h"), (14, "k l m n o p q r"),
    ]
    got = run(spark, rows)
    known = {(r[0], r[1]): r for r in got}
    assert [r for r in got if r[0] in (1, 2, 3)] == [(i, 0, i, True) for i in (1, 2, 3)]
    assert known[5, 1][2:] == (4, False) and known[6, 1][2:] == (6, True)
    assert [r for r in got if r[0] is None] == [(None, 0, None, True), (None, 1, None, True)]
    assert known[8, 1][2:] == (7, False)
    assert known[10, 2][2:] == (10, True)
    assert sum(r[0] == 11 for r in got) == 2
    # an id with two texts is one document with the links of both
    assert {r[2] for r in got if r[0] in (12, 13, 14)} == {12}


def test_empty_table(spark):
    assert run(spark, []) == []


def test_percent_is_a_parameter(spark):
    a = " ".join(f"w{i}" for i in range(104))
    b = " ".join([f"w{i}" for i in range(94)] + [f"v{i}" for i in range(10)])  # 90 of 110 shared
    assert [r[2] for r in run(spark, [(1, a), (2, b)], percent=80)] == [1, 1]
    assert [r[2] for r in run(spark, [(1, a), (2, b)])] == [1, 2]


@pytest.mark.parametrize("edges", [[], [(1, 1)], [(i, i + 1) for i in range(40)], [(0, i) for i in range(1, 30)] + [(29, 31), (40, 41)]])
def test_components(spark, edges):
    got = {r["id"]: r["component"] for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    root = {x: x for e in edges for x in e}
    for _ in root:
        for u, v in edges:
            m = min(root[u], root[v])
            root[u] = root[v] = m
    assert all(got.get(x, x) == r for x, r in root.items())
