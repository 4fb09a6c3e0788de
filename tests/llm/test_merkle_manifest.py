import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from termsim.llm import merkle_manifest as mm

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, text=None):
    doc_id, t, lang, source, n = row
    values = [doc_id, source, lang, n, t if text is None else text]
    return digest(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def tree(nodes, fanout):
    """``(root, siblings of every leaf as (before, after) lists)`` of a list of digests."""
    ways = [[] for _ in nodes]
    places = list(range(len(nodes)))
    while len(nodes) > 1:
        for way, at in zip(ways, places, strict=True):
            run = nodes[at // fanout * fanout : at // fanout * fanout + fanout]
            way.append(("".join(run[: at % fanout]), "".join(run[at % fanout + 1 :])))
        nodes = [digest(*nodes[i : i + fanout]) for i in range(0, len(nodes), fanout)]
        places = [p // fanout for p in places]
    return nodes[0], ways


def brute(rows, fanout=8):
    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append(r)
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for g in order:
        groups[g].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees[g] = tree([leaf(r) for r in groups[g]], fanout)
    root, tops = tree([trees[g][0] for g in order], fanout)
    out = []
    for g, top in zip(order, tops, strict=True):
        for r, way in zip(groups[g], trees[g][1], strict=True):
            way = way + top
            hit = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0
            lowered = None if r[1] is None else "".join(c.lower() if "A" <= c <= "Z" else c for c in r[1])
            node = leaf(r, lowered) if hit and lowered is not None else leaf(r)
            for lo, hi in way:
                node = digest(lo, node, hi)
            out.append((r[0], leaf(r), trees[g][0], root, digest(*[x for s in way for x in s]), node, node == root))
    return sorted(out, key=repr)


def run(spark, rows, tmp_path, schema=SCHEMA):
    spark.createDataFrame(rows, schema).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    got = mm.op13_merkle_manifest(spark, str(tmp_path))
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return sorted(map(tuple, got.collect()), key=repr)


def test_against_brute_force(spark, tmp_path):
    rows = [(i, f"Text {i}\n é", "en", f"s{i % 3}", i) for i in range(600)]  # three levels, a run of one block and more
    rows += [(i, "Ab", "de", "s", None) for i in range(1000, 1009)]  # a last run of one node
    rows += [(i, None if i % 2 else "", None, None, 0) for i in range(2000, 2008)]  # NULL group, NULL and empty texts
    rows += [(3000, "Alone", "fr", "s", 5), (None, "No id", "en", "s", 5), (None, None, "en", None, None)]
    rows += [(4000, "Same", "es", "s", 4)] * 20 + [(4000, "Other", "es", "s", 4)]  # repeated rows, one key with two texts
    assert run(spark, rows, tmp_path) == brute(rows)


def test_many_groups_and_long_text(spark, tmp_path):
    rows = [(i, "X" * (300_000 if i == 7 else i), f"g{i % 20}", "s", i) for i in range(40)]  # the top tree has two levels
    assert run(spark, rows, tmp_path) == brute(rows)


@pytest.mark.parametrize("n", [1, 65])
def test_sizes(spark, n):
    rows = [(i, "t", "en", "s", 1) for i in range(n)]
    got = mm.manifest(spark.createDataFrame(rows, SCHEMA)).select("doc_id", "leaf", "subroot", "root", mm.proof_digest().alias("p"))
    assert sorted(map(tuple, got.collect()), key=repr) == [b[:5] for b in brute(rows)]


def test_other_fanout(spark):
    rows = [(i, "t", f"g{i % 5}", "s", 1) for i in range(100)]
    got = mm.manifest(spark.createDataFrame(rows, SCHEMA), fanout=3).select("doc_id", "leaf", "subroot", "root", mm.proof_digest().alias("p"))
    assert sorted(map(tuple, got.collect()), key=repr) == [b[:5] for b in brute(rows, 3)]


def test_empty_table(spark, tmp_path):
    assert run(spark, [], tmp_path) == []


def test_further_columns_with_clashing_names(spark):
    rows = [(i, "t", "en", "s", 1) for i in range(10)]
    plain = spark.createDataFrame(rows, SCHEMA)
    more = plain.select("*", *[F.lit("x").alias(c) for c in ("tree", "idx", "n", "digest", "before", "key", "leaf", "root", "_tie", "_part")])
    assert sorted(map(repr, mm.manifest(more).collect())) == sorted(map(repr, mm.manifest(plain).collect()))


def test_verify(spark):
    rows = [(i, f"Text {i}", "en" if i % 2 else "de", "s", 1) for i in range(30)]
    proofs = mm.manifest(spark.createDataFrame(rows, SCHEMA))
    changed = [(i, t.lower() if i == 4 else t, g, s, n + (i == 5)) for i, t, g, s, n in rows] + [(99, "new", "en", "s", 1)]
    got = {r["doc_id"]: r["verified"] for r in mm.verify(spark.createDataFrame(changed, SCHEMA), proofs).collect()}
    assert got == {i: i not in (4, 5) for i in range(30)} | {99: False}


def test_blocks_bound_the_windows(spark):
    """Windows run over blocks of a group, the numbering over ranges: no plan sorts a whole group."""
    plan = mm._with_siblings(spark.createDataFrame([("=en", 1, 2, "x")], "tree string, idx long, n long, digest string"), 8)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "div 512" in text and text.count("Window [") == 1
