import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from termsim.llm import source_mixing as sm


def corpus(n=300, seed=1):
    rng = random.Random(seed)
    kinds = {"a": ["the", "and", "thing", "with", "what"], "b": ["le", "une", "été", "que", "dans"], "c": ["zzy", "xoxo", "jazz", "kkw"]}
    rows = []
    for k in range(n):
        d = rng.choices("abc", (6, 3, 1))[0]
        rows.append((k, " ".join(rng.choice(kinds[d]) for _ in range(rng.randrange(5, 120))), d))
    return rows


def frames(spark, rows):
    docs = spark.createDataFrame([(d, t, s, 1, "q") for d, t, s in rows], "doc_id long, text string, lang string, _n int, p string")
    labelled = docs.where("doc_id % 3 = 0").select("doc_id", F.col("lang").alias("domain"))
    return docs, labelled


def test_targets_are_met_and_rates_follow_posteriors(spark):
    rows = corpus()
    docs, labelled = frames(spark, rows)
    target = {"a": 0.4, "b": 0.35, "c": 0.25}
    mixture, stats = sm.fit(docs, labelled, target)
    got = sm.rates(mixture, stats).toPandas().sort_values("doc_id")
    p = got[["p_a", "p_b", "p_c"]].to_numpy()
    assert np.allclose(p.sum(1), 1, atol=1e-6)
    truth = dict((d, s) for d, _, s in rows)
    right = [("abc"[k] == truth[d]) for k, d in zip(p.argmax(1), got.doc_id)]
    assert np.mean(right) > 0.95
    words = {d: len(t.split()) for d, t, _ in rows}
    assert [words[d] for d in got.doc_id] == got.n_tokens.tolist()
    total = (p * (got.n_tokens * got.rate).to_numpy()[:, None]).sum(0)
    assert np.abs(total / total.sum() - list(target.values())).max() < 1e-3
    assert (got.rate >= 0).all()


def test_projection_against_numpy(spark):
    rng = np.random.default_rng(3)
    n, p = rng.integers(1, 50, 80), rng.dirichlet([0.4, 0.4, 0.4], 80)
    stats = spark.createDataFrame([(int(a), [float(x) for x in b]) for a, b in zip(n, p)], "n long, p array<double>")
    weights = [0.7, 0.2, 0.1]
    for least in (0.0, 1.0):
        steps = sm.fit_rates(stats, weights, least=least)
        r = np.ones(80)
        for s in steps:
            r = np.maximum(r - p @ np.array(s), least)
        got = np.array([x[0] for x in stats.select(sm.rate(F.col("p"), steps, least)).collect()])
        assert np.allclose(r, got) and r.min() >= least
        have = (n[:, None] * p).sum(0)
        want = max(have / weights) * np.array(weights)
        now = ((n * r)[:, None] * p).sum(0)
        assert np.linalg.norm(now - want) <= np.linalg.norm(have - want)
        # no better point in a descent by small projected steps from there
        best, x = np.linalg.norm(now - want), r.copy()
        a = (n[:, None] * p)
        for _ in range(3000):
            x = np.maximum(x - 1.0 / np.linalg.norm(a, 2) ** 2 * (a @ (a.T @ x - want)), least)
        assert best <= np.linalg.norm(a.T @ x - want) + 5e-3 * want.sum()


def test_apply_repeats_rows(spark):
    rows = corpus(120)
    docs, labelled = frames(spark, rows)
    mixture, stats = sm.fit(docs, labelled, {"a": 0.3, "b": 0.4, "c": 0.3}, least=1.0)
    rate = {r["doc_id"]: r["rate"] for r in sm.rates(mixture, stats).collect()}
    mixed = sm.apply_rates(docs, mixture)
    assert mixed.columns == docs.columns
    count = {r["doc_id"]: r["count"] for r in mixed.groupBy("doc_id").count().collect()}
    assert set(count) == set(rate) and all(int(rate[d]) <= c <= int(rate[d]) + 1 for d, c in count.items())
    assert abs(sum(count.values()) - sum(rate.values())) < 3 * np.sqrt(len(rate))
    assert sorted(map(str, mixed.collect())) == sorted(map(str, sm.apply_rates(docs, mixture).collect()))
    assert mixed.first()["_n"] == 1 and mixed.first()["p"] == "q"


def test_defined_cases(spark):
    rows = [(1, None, "a"), (2, "", "a"), (None, "the thing", "b"), (3, "the and", None), (3, "the and", None), (4, "le " * 30_000, "b")]
    docs, labelled = frames(spark, rows)
    for known in (labelled, labelled.limit(0)):
        mixture, stats = sm.fit(docs, known, {"a": 1.0, "b": 1.0})
        got = sm.rates(mixture, stats).collect()
        assert len(got) == 6 and all(r["rate"] >= 0 for r in got)
        assert sorted(r["n_tokens"] for r in got) == [0, 0, 2, 2, 2, 30_000]
    mixture, stats = sm.fit(docs.limit(0), labelled.limit(0), {"a": 1.0, "b": 1.0})
    assert sm.rates(mixture, stats).collect() == [] and sm.apply_rates(docs.limit(0), mixture).collect() == []


def test_main_path_has_no_python(spark):
    docs, labelled = frames(spark, corpus(40))
    mixture, stats = sm.fit(docs, labelled, {"a": 1.0, "b": 1.0, "c": 1.0})
    for df in (sm.rates(mixture, stats), sm.apply_rates(docs, mixture)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))


def test_least_squares_point_on_slow_mixtures(spark):
    rng = np.random.default_rng(8)
    cases = [(0.4, 0.0), (0.4, 1.0), (30.0, 0.0), (30.0, 1.0)]  # sharp and soft posteriors, rates held or not
    for alpha, least in cases:
        n, p = rng.integers(1, 50, 80), rng.dirichlet([alpha] * 3, 80)
        n[0] = 2000  # a hot document
        weights = [0.7, 0.2, 0.1]
        stats = spark.createDataFrame([(int(a), [float(x) for x in b]) for a, b in zip(n, p)], "n long, p array<double>")
        steps, residual, gradient = sm.solve_rates(stats, weights, least=least)
        r = np.ones(80)
        for s in steps:
            r = np.maximum(r - p @ np.array(s), least)
        a = n[:, None] * p
        want = max(a.sum(0) / weights) * np.array(weights)
        now = np.linalg.norm(a.T @ r - want)
        assert gradient <= sm.TOLERANCE and abs(residual - now / want.sum()) < 1e-9
        # the least distance, by accelerated projected steps in the scale of the square roots of n
        root = np.sqrt(n)
        b = root[:, None] * p
        x = y = root * np.maximum(1.0, least)
        k, step = 1.0, 1.0 / np.linalg.norm(b, 2) ** 2
        for _ in range(100_000):
            z = np.maximum(y - step * (b @ (b.T @ y - want)), least * root)
            nxt = (1 + np.sqrt(1 + 4 * k * k)) / 2
            x, y, k = z, z + (k - 1) / nxt * (z - x), nxt
        assert now <= np.linalg.norm(b.T @ x - want) + 1e-4 * want.sum()


def test_fit_that_does_not_end_raises(spark):
    stats = spark.createDataFrame([(5, [0.9, 0.1]), (7, [0.2, 0.8])], "n long, p array<double>")
    with pytest.raises(ArithmeticError):
        sm.fit_rates(stats, [0.8, 0.2], rounds=0)
