"""Merkle manifest of a data set from lag and lead windows.

Every row is a leaf: the sha256 of its fields, each written as ``-`` (NULL) or
``<UTF-8 byte count>:<value>``, so that no two different rows read alike. The
leaves of a group (``lang``) ascend by key; every ``FANOUT`` consecutive nodes become
the hash of their concatenated digests (hexadecimal text), level by level, until
one is left: the group's subroot. The subroots, ordered by group (NULL first, then
bytewise), give the root in the same way. A proof of a row is the list of the
siblings on its way to the root; folding a leaf with it gives the root again
exactly when the row is unchanged.

Method
1. Leaves are hashed where the texts are read; only digests move. They are sorted
   into key ranges and numbered: place within the range plus the rows of the group
   in the ranges before (one small row per range and group).
2. Up. Per level a window over blocks of ``FANOUT^3`` nodes gives each node fixed-
   offset lag and lead columns, masked by its slot and by the length of its run: the
   digests left and right of it. Rows of slot 0 hash the parent and go up.
3. Down. From the top each node hands its way to its children by an equi-join on
   (group, place of the parent), so that a leaf takes part in one join whatever the
   depth of the tree.

Scale: a block never cuts a run and is the largest thing that a task holds at once,
so a group with a third of all rows spreads over as many tasks as it has blocks;
ranges split repeated keys too. Levels shrink by ``FANOUT`` and are written in the
shared folder. The driver learns the size of the largest group, nothing else.

Defined cases: NULL fields are ``-`` and a NULL group is a group of its own; a row
with a NULL key comes first; rows with one key are ordered by their leaf, and
repeated rows are leaves of their own; a run may be shorter, also one node, which is
hashed alone; a group of one row has its leaf as subroot, a table of one group its
subroot as root; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from termsim.llm.storage import table, written

FANOUT = 8
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: The low bits of ``monotonically_increasing_id`` are the row's place in its partition.
_PLACE_BITS = 33
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def sha(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def leaf_digest(fields: dict[str, Column] | None = None) -> Column:
    """The leaf of a row; ``fields`` replaces columns by other values of them."""
    values = [(fields or {}).get(name, F.col(name)).cast("string") for name in FIELDS]
    return sha(*[F.coalesce(F.concat(F.octet_length(v).cast("string"), F.lit(":"), v), F.lit("-")) for v in values])


def _numbered(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` with ``idx`` (place within ``tree`` by ``order``) and ``n`` (rows of
    the tree). Equal rows are told apart by where they were read, so that a range
    may end between them."""
    keys = ["tree", *order, "_tie"]
    ranged = rows.withColumn("_tie", F.monotonically_increasing_id()).repartitionByRange(*keys).sortWithinPartitions(*keys)
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << _PLACE_BITS) - 1))
    placed = written(ranged.select(*rows.columns, F.spark_partition_id().alias("_part"), place.alias("_at")), "merkle-ranges")
    sizes = placed.groupBy("tree", "_part").agg(F.count(F.lit(1)).alias("_rows"), F.min("_at").alias("_first"))
    tree = Window.partitionBy("tree")  # one row per range: as many as there are partitions
    before = tree.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "tree", "_part", (F.coalesce(F.sum("_rows").over(before), F.lit(0)) - F.col("_first")).alias("_shift"), F.sum("_rows").over(tree).alias("n")
    )
    joined = placed.join(offsets, ["tree", "_part"])
    return joined.select(*rows.columns, (F.col("_shift") + F.col("_at")).alias("idx"), "n")


def _with_siblings(nodes: DataFrame, fanout: int) -> DataFrame:
    """``nodes`` with ``before`` and ``after``: the digests of the run on either side."""
    slot = F.col("idx") % fanout
    run = F.least(F.lit(fanout), F.col("n") - (F.col("idx") - slot))
    block = Window.partitionBy("tree", F.expr(f"idx div {fanout**3}")).orderBy("idx")
    lags = [F.when(slot >= o, F.lag("digest", o).over(block)) for o in range(fanout - 1, 0, -1)]
    leads = [F.when(slot + o < run, F.lead("digest", o).over(block)) for o in range(1, fanout)]
    return nodes.select("*", F.concat_ws("", *lags).alias("before"), F.concat_ws("", *leads).alias("after"))


def _climb(nodes: DataFrame, fanout: int) -> list[DataFrame]:
    """The levels of all trees from ``nodes`` (numbered leaves) up, each written:
    ``(tree, idx, n, digest, before, after)``. A tree ends at the level where ``n`` is 1."""
    levels = [written(_with_siblings(nodes, fanout), "merkle-level")]
    most = levels[0].agg(F.max("n")).first()[0] or 0
    while most > 1:
        first = levels[-1].where((F.col("n") > 1) & (F.col("idx") % fanout == 0))
        up = first.select(
            "tree",
            F.expr(f"idx div {fanout}").alias("idx"),
            F.expr(f"(n + {fanout - 1}) div {fanout}").alias("n"),
            sha("before", "digest", "after").alias("digest"),
        )
        levels.append(written(_with_siblings(up, fanout), "merkle-level"))
        most = -(-most // fanout)
    return levels


def _apexes(levels: list[DataFrame]) -> DataFrame:
    """``(tree, digest)`` of the last node of every tree."""
    tops = [level.where(F.col("n") == 1).select("tree", "digest") for level in levels]
    out = tops[0]
    for t in tops[1:]:
        out = out.unionByName(t)
    return out


def _descend(levels: list[DataFrame], seeds: DataFrame, fanout: int) -> DataFrame:
    """The leaves with ``way`` (the siblings up to the apex, then the seed's own way)
    and the seed's columns. ``seeds``: ``(tree, way, ...)``, one row per tree."""
    carried = [c for c in seeds.columns if c not in ("tree", "way")]
    down = None
    for level in reversed(levels):
        own = level.where(F.col("n") == 1).join(seeds, "tree")
        if down is not None:
            parents = down.select("tree", F.col("idx").alias("_up"), F.col("way").alias("_way"), *carried)
            children = level.where(F.col("n") > 1).withColumn("_up", F.expr(f"idx div {fanout}"))
            below = children.join(parents, ["tree", "_up"]).withColumn("way", F.concat(F.array(F.struct("before", "after")), "_way"))
            own = own.select(*level.columns, "way", *carried).unionByName(below.select(*level.columns, "way", *carried))
        down = own
    return down


def manifest(docs: DataFrame, group: str = "lang", key: str = "doc_id", keep: dict[str, Column] | None = None, fanout: int = FANOUT) -> DataFrame:
    """One row per input row: the key, the columns ``keep`` (of the input row),
    ``leaf``, ``subroot``, ``root`` and ``way``, the proof: an array of ``(before,
    after)`` digests, level by level, from the leaf to the root."""
    keep = keep or {}
    tree = F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit(""))  # NULL sorts first
    leaves = docs.select(
        tree.alias("tree"), F.col(key).alias("key"), leaf_digest().alias("digest"), *[c.alias(f"keep_{k}") for k, c in enumerate(keep.values())]
    )
    # written first, so that finding the ranges does not read and hash the texts again
    levels = _climb(_numbered(written(leaves, "merkle-leaves"), ["key", "digest"]), fanout)
    subroots = _apexes(levels)
    top = _climb(_numbered(subroots.select(F.lit("").alias("tree"), F.col("tree").alias("group"), "digest"), ["group"]), fanout)
    no_way = F.array().cast("array<struct<before:string,after:string>>")
    roots = _apexes(top).select("tree", no_way.alias("way"), F.col("digest").alias("root"))
    seeds = _descend(top, roots, fanout).select(F.col("group").alias("tree"), "way", "root", F.col("digest").alias("subroot"))
    out = _descend(levels, seeds, fanout)
    kept = [F.col(f"keep_{k}").alias(name) for k, name in enumerate(keep)]
    return out.select(F.col("key").alias(key), *kept, F.col("digest").alias("leaf"), "subroot", "root", "way")


def proof_digest(way: Column | str = "way") -> Column:
    """The hash of all siblings of a proof, from left to right and from the leaf up."""
    return sha(F.array_join(F.transform(way, lambda s: F.concat(s["before"], s["after"])), ""))


def fold(leaf: Column, way: Column | str = "way") -> Column:
    """The root that a leaf and a proof lead to."""
    return F.aggregate(way, leaf, lambda node, s: sha(s["before"], node, s["after"]))


def verify(docs: DataFrame, proofs: DataFrame, key: str = "doc_id") -> DataFrame:
    """Rows of ``docs`` held against the proofs of unique keys: ``(key, verified)``;
    a key without a proof is not verified."""
    claimed = docs.select(F.col(key), leaf_digest().alias("_claimed"))
    known = proofs.select(F.col(key), "way", "root")
    same = fold(F.col("_claimed")) == F.col("root")
    return claimed.join(known, key, "left").select(key, F.coalesce(same, F.lit(False)).alias("verified"))


def op13_merkle_manifest(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    tampered = F.when(hit, leaf_digest({"text": F.translate("text", _UPPER, _LOWER)}))
    proofs = manifest(docs, keep={"_tampered": tampered})
    folded = fold(F.coalesce("_tampered", "leaf"))
    out = proofs.select("doc_id", "leaf", "subroot", "root", proof_digest().alias("proof_sha256"), folded.alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


def _op13_sql(levels: int = 7) -> str:
    """The tree by ordered string aggregates, ``levels`` levels written out (8^levels
    rows a language, 8^levels languages), crc32 by its bitwise definition."""
    parts = " || ".join(f"coalesce(strlen({c}::VARCHAR)::VARCHAR || ':' || {c}::VARCHAR, '-')" for c in FIELDS)
    lower = parts.replace("text::VARCHAR", f"translate(text, '{_UPPER}', '{_LOWER}')")
    ctes = ["bits0 AS (SELECT c AS i, c::BIGINT AS c FROM (SELECT unnest(range(256)) AS c))"]
    for k in range(8):
        ctes.append(f"bits{k + 1} AS (SELECT i, xor(c >> 1, 3988292384 * (c & 1)) AS c FROM bits{k})")
    ctes.append("byte_table AS (SELECT list(c ORDER BY i) AS t FROM bits8)")
    crc = (
        "xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)), "
        "lambda a, b: xor(a >> 8, t[(xor(a & 255, b) + 1)::INTEGER])))"
    )
    ctes.append(
        f"""leaves AS (SELECT doc_id, coalesce('=' || lang, '') AS tree, sha256({parts}) AS leaf,
  CASE WHEN {crc} % 3 = 0 THEN sha256({lower}) ELSE sha256({parts}) END AS claimed FROM documents, byte_table)"""
    )
    ctes.append(
        """a0 AS (SELECT *, leaf AS digest, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx,
  count(*) OVER (PARTITION BY tree) AS n FROM leaves)"""
    )

    def side(frame: str) -> str:
        return f"CASE WHEN n > 1 THEN coalesce(string_agg(digest, '') OVER (PARTITION BY tree, idx // 8 ORDER BY idx ROWS BETWEEN {frame}), '') ELSE '' END"

    def climb(name: str):
        for k in range(levels):
            ctes.append(
                f"{name}s{k} AS (SELECT tree, idx, n, digest, {side('UNBOUNDED PRECEDING AND 1 PRECEDING')} AS lo, {side('1 FOLLOWING AND UNBOUNDED FOLLOWING')} AS hi FROM {name}{k})"
            )
            ctes.append(
                f"""{name}{k + 1} AS (SELECT tree, idx // 8 AS idx, any_value((n + 7) // 8) AS n,
  CASE WHEN any_value(n) > 1 THEN sha256(string_agg(digest, '' ORDER BY idx)) ELSE any_value(digest) END AS digest FROM {name}{k} GROUP BY tree, idx // 8)"""
            )

    def way(name: str) -> tuple[str, str]:
        joins = "".join(f" JOIN {name}s{k} ON {name}s{k}.tree = {name}0.tree AND {name}s{k}.idx = {name}0.idx // {8**k}" for k in range(levels))
        return joins, " || ".join(f"{name}s{k}.lo || {name}s{k}.hi" for k in range(levels))

    climb("a")
    ctes.append(f"b0 AS (SELECT '' AS tree, tree AS grp, digest, row_number() OVER (ORDER BY tree) - 1 AS idx, count(*) OVER () AS n FROM a{levels})")
    climb("b")
    ctes.append(f"root AS (SELECT digest AS root FROM b{levels})")
    joins_a, proof_a = way("a")
    joins_b, proof_b = way("b")
    sides = ", ".join(f"as{k}.lo AS al{k}, as{k}.hi AS ah{k}, as{k}.n AS an{k}" for k in range(levels))
    tops = ", ".join(f"bs{k}.lo AS bl{k}, bs{k}.hi AS bh{k}, bs{k}.n AS bn{k}" for k in range(levels))
    ctes.append(f"tops AS (SELECT b0.grp, b0.digest AS subroot, {proof_b} AS proof_b, {tops} FROM b0{joins_b})")
    ctes.append(f"f0 AS (SELECT a0.doc_id, a0.leaf, a0.tree, {proof_a} AS proof_a, {sides}, a0.claimed AS acc FROM a0{joins_a})")
    ctes.append("g0 AS (SELECT * FROM f0 JOIN tops ON tops.grp = f0.tree)")
    k = 0
    for name in ("a", "b"):
        for level in range(levels):
            lo, hi, n = f"{name}l{level}", f"{name}h{level}", f"{name}n{level}"
            ctes.append(f"g{k + 1} AS (SELECT * REPLACE (CASE WHEN {n} > 1 THEN sha256({lo} || acc || {hi}) ELSE acc END AS acc) FROM g{k})")
            k += 1
    return f"""WITH {', '.join(ctes)}
SELECT doc_id, leaf, subroot, root, sha256(proof_a || proof_b) AS proof_sha256, acc AS folded_root, acc = root AS verified FROM g{k}, root"""


OP13_SQL = _op13_sql()
