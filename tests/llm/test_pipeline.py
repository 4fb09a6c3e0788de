import random

import numpy as np
import pytest

import corpus_pipeline as cp
from termsim.llm import decontaminate, quality_classifier, source_mixing
from termsim.llm.queries import ORACLE_SQL, QUERIES


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """A small corpus with planted copies, leaks and junk."""
    rng = random.Random(6)
    kinds = {"en": ["the", "and", "with", "thing"], "de": ["der", "und", "nicht", "über"], "fr": ["les", "été", "dans", "que"], "es": ["los", "niño", "para", "según"]}
    text = lambda lang, n: " ".join(rng.choice(kinds[lang]) + str(rng.randrange(50)) for _ in range(n))
    items = [(k, text("en", 30)) for k in range(6)]
    docs, labels = [], []
    for k in range(240):
        lang = rng.choices(list(kinds), (6, 2, 1, 1))[0]
        body = text(lang, rng.randrange(30, 90))
        junk = rng.random() < 0.2
        if junk:
            body = " ".join(w.upper() + "!!" for w in body.split())
        docs.append([k, body, lang, f"src{k % 3}"])
        labels.append((k, int(not junk), 0))
    copies, leaks = list(range(200, 215)), list(range(220, 226))
    good = [d[0] for d, y in zip(docs, labels) if y[1] and d[0] < 200]
    for k, of in zip(copies, good):
        docs[k][1] = docs[of][1] if k % 2 else docs[of][1] + " last"
        labels[k] = (k, 1, 0)
    for k, (_, leak) in zip(leaks, items):
        docs[k][1] = text("en", 20) + " " + leak + " " + text("en", 20)
        labels[k] = (k, 1, 0)
    folder = str(tmp_path_factory.mktemp("tables"))
    write = lambda rows, schema, name: spark.createDataFrame(rows, schema).write.parquet(f"{folder}/{name}.parquet")
    write([(*d, len(d[1])) for d in docs], "doc_id long, text string, lang string, source string, n_chars long", "documents")
    write([y for y in labels if y[0] % 5 != 2], "doc_id long, quality int, toxic int", "labels")
    write(items, "item_id long, text string", "benchmark")
    return folder, docs, labels, copies, leaks


def test_stages(spark, tables):
    folder, rows, labels, copies, leaks = tables
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    good = {d for d, q, _ in labels if q}
    assert [n for n, _ in cp.STAGES] == ["quality classifier", "MinHash near-dedup", "benchmark decontamination", "mixing sources to target weights", "token-ID / binary output"]

    ids = lambda df: sorted(r["doc_id"] for r in df.select("doc_id").collect())
    one = cp.STAGES[0][1](spark, docs, folder)
    assert one.columns == docs.columns
    kept = set(ids(one))
    assert len(kept ^ good) <= 4 and good & kept >= set(leaks)
    two = cp.STAGES[1][1](spark, docs, folder)
    assert two.columns == docs.columns and ids(two) == sorted({d[0] for d in rows} - set(copies))
    three = cp.STAGES[2][1](spark, docs, folder)
    assert three.columns == docs.columns and ids(three) == sorted({d[0] for d in rows} - set(leaks))
    four = cp.STAGES[3][1](spark, docs, folder)
    assert four.columns == docs.columns and set(ids(four)) == {d[0] for d in rows}
    five = cp.STAGES[4][1](spark, docs, folder)
    assert ids(five) == sorted(d[0] for d in rows)


def test_run(spark, tables):
    folder, rows, labels, copies, leaks = tables
    got = cp.run(spark, folder).collect()
    kept = {r["doc_id"] for r in got}
    assert not kept & set(copies) and not kept & set(leaks)
    good = {d for d, q, _ in labels if q} - set(copies) - set(leaks)
    assert len(kept ^ good) <= 4
    assert sorted(r["start"] for r in got)[0] == 0
    ends = sorted((r["start"], r["start"] + r["n_tokens"]) for r in got)
    assert all(a[1] == b[0] for a, b in zip(ends, ends[1:]))


def test_empty_documents(spark, tables, tmp_path):
    folder = tables[0]
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{folder}/{name}.parquet").write.parquet(f"{tmp_path}/{name}.parquet")
    spark.read.parquet(f"{folder}/documents.parquet").limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    assert cp.run(spark, str(tmp_path)).collect() == []


def test_null_rows_pass_through(spark, tables):
    folder = tables[0]
    docs = spark.createDataFrame([(None, None, None, None, None, 1), (1, "", "en", "s", 0, 2), (1, None, "en", "s", 0, 3)], "doc_id long, text string, lang string, source string, n_chars long, _quality int")
    for _, stage in cp.STAGES[1:4]:
        out = stage(spark, docs, folder)
        assert out.columns == docs.columns and {r["_quality"] for r in out.collect()} == {1, 2, 3}
    assert cp.STAGES[0][1](spark, docs, folder).columns == docs.columns
    assert cp.STAGES[4][1](spark, docs, folder).count() == 3


def test_registered():
    import __spark_entry__ as entry

    names = entry.queries()
    assert set(QUERIES) | {"pipeline"} <= set(names) and set(ORACLE_SQL) <= set(entry.oracle_sql())
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


def test_near_dedup_stage_links_from_80_percent(spark, tables):
    rng = random.Random(9)
    rows = []
    for k in range(40):
        words = [f"w{rng.randrange(10**6)}" for _ in range(200)]
        rows.append((2 * k, " ".join(words)))
        for m in range(k % 6):  # Jaccard 1, 0.95, 0.90, 0.86, 0.81, 0.77
            words[20 + 30 * m] = "other"
        rows.append((2 * k + 1, " ".join(words)))
    sets = {d: {tuple(w[i : i + 5]) for i in range(len(w) - 4)} for d, t in rows for w in [t.split()]}
    like = {d: len(sets[d] & sets[d + 1]) / len(sets[d] | sets[d + 1]) for d in sets if d % 2 == 0}
    assert sum(0.8 <= x < 0.85 for x in like.values()) >= 5 and min(like.values()) < 0.8
    out = cp.near_dedup_stage(spark, spark.createDataFrame(rows, "doc_id long, text string"), tables[0])
    assert sorted(r["doc_id"] for r in out.collect()) == sorted(d for d in sets if d % 2 == 0 or like[d - 1] < 0.8)
