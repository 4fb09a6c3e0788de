"""Benchmark decontamination: q-gram lemma filtering over diagonal bands.

Texts are compared as their letters and digits, lower-cased, everything else
left out. A benchmark item of ``m`` characters occurs in a document when a region
of it is within ``e = floor(ERROR_RATE * m)`` edits of the whole item.

Method: such a region shares at least ``m - q + 1 - q * e`` q-grams with the item,
all on diagonals (position in document minus position in item) within ``2 e + 1``
of each other. Every document position whose q-gram occurs in an item is counted
for the two bands, ``2 (2 e + 1)`` diagonals wide and overlapping by half, that
hold its diagonal; one of them holds a region's diagonals entirely. Bands that
reach the bound are verified by banded alignment (free start and end in the
document, all candidate regions of a chunk row by row at once).

Scale: the benchmark is the stated query set. It is read in blocks of at most
``BLOCK_CHARS`` characters; a block's q-gram table goes to the executors with the
task, and each block is one pass over the documents without any shuffle. A
document is cut nowhere; long ones are taken alone.

Defined cases: NULL or empty text has no region; an item with fewer than
``MIN_CHARS`` letters and digits (or NULL) is too short to tell a leak and
matches nothing; repeated items match each under its id; a NULL id is carried as
NULL; several regions of one item in one document give one row, the one with the
fewest edits (then the first); further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termsim.llm.storage import table
from termsim.llm.words import chunks, mix, text_buffers

Q = 12
ERROR_RATE = 0.05
MIN_CHARS = 32
BLOCK_CHARS = 500_000
#: Bits of the filter that is asked before the q-gram table.
FILTER_BITS = 21


def _folding() -> np.ndarray:
    """Code point -> folded code point, 0 for what is left out (first plane)."""
    out = np.zeros(0x10000, dtype=np.uint16)
    for i in range(0x10000):
        c = chr(i)
        if c.isalnum():
            low = c.lower()
            out[i] = ord(low) if len(low) == 1 and ord(low) < 0x10000 else i
    return out


_FOLD = _folding()
_B = 0x9E3779B97F4A7C15
_BI = pow(_B, -1, 1 << 64)
_table: dict[str, np.ndarray] = {}


def _powers(n: int):
    if len(_table.get("up", ())) < n:
        size = max(n, 1 << 19)
        for key, base in (("up", _B), ("down", _BI)):
            steps = np.full(size, base, dtype=np.uint64)
            steps[0] = 1
            _table[key] = np.multiply.accumulate(steps)
    return _table["up"][:n], _table["down"][:n]


def fold(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(characters, positions)`` of the kept code points."""
    low = np.where(codes < 0x10000, _FOLD[np.minimum(codes, 0xFFFF)], codes).astype(np.uint32)
    at = np.flatnonzero(low)
    return low[at], at


def fold_text(text: str) -> np.ndarray:
    return fold(np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32))[0]


def qgrams(chars: np.ndarray, q: int) -> np.ndarray:
    """The hash of every q-gram."""
    if len(chars) < q:
        return np.zeros(0, np.uint64)
    up, down = _powers(len(chars) + 1)
    total = np.zeros(len(chars) + 1, dtype=np.uint64)
    np.cumsum((chars.astype(np.uint64) + np.uint64(0x1F3D5B79)) * up[:-1], out=total[1:])
    return mix((total[q:] - total[:-q]) * down[: len(chars) - q + 1])


class Block:
    """The q-gram table of one block of benchmark items."""

    def __init__(self, items: list[tuple[int, str]], q: int = Q, rate: float = ERROR_RATE):
        kept = [(i, fold_text(t or "")) for i, t in items]
        kept = [(i, c) for i, c in kept if len(c) >= MIN_CHARS]
        self.q = q
        self.ids = [i for i, _ in kept]
        self.chars = [c for _, c in kept]
        self.length = np.array([len(c) for c in self.chars], dtype=np.int64)
        self.edits = np.minimum((self.length * rate).astype(np.int64), np.maximum(0, (self.length - q) // q))
        grams = [qgrams(c, q) for c in self.chars]
        key = np.concatenate([np.zeros(0, np.uint64), *grams])
        item = np.repeat(np.arange(len(kept)), [len(g) for g in grams])
        offset = np.concatenate([np.zeros(0, np.int64), *[np.arange(len(g)) for g in grams]]).astype(np.int64)
        order = np.argsort(key, kind="stable")
        self.item, self.offset = item[order], offset[order]
        self.keys, self.first = np.unique(key[order], return_index=True)
        self.first = np.append(self.first, len(key))
        self.filter = np.zeros(1 << FILTER_BITS, dtype=bool)
        self.filter[(self.keys >> np.uint64(64 - FILTER_BITS)).astype(np.int64)] = True

    def hits(self, chars: np.ndarray):
        """``(position, item, offset)`` of all shared q-grams."""
        g = qgrams(chars, self.q)
        at = np.flatnonzero(self.filter[(g >> np.uint64(64 - FILTER_BITS)).astype(np.int64)])
        k = np.searchsorted(self.keys, g[at])
        k[k == len(self.keys)] = 0
        same = self.keys[k] == g[at] if len(self.keys) else np.zeros(len(at), bool)
        at, k = at[same], k[same]
        n = self.first[k + 1] - self.first[k]
        entry = np.repeat(self.first[k] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
        return np.repeat(at, n), self.item[entry], self.offset[entry]

    def bands(self, chars: np.ndarray, row_of: np.ndarray):
        """Candidate ``(row, item, lowest diagonal)`` that reach the q-gram bound."""
        pos, item, off = self.hits(chars)
        inside = row_of[pos] == row_of[pos + self.q - 1] if len(pos) else np.zeros(0, bool)
        pos, item, off = pos[inside], item[inside], off[inside]
        if len(pos) == 0:
            return []
        step = 2 * self.edits[item] + 1
        low = np.floor_divide(pos - off, step)
        row, item, off = (np.concatenate([x, x]) for x in (row_of[pos], item, off))
        band = np.concatenate([low, low - 1])
        table = np.stack([row, item, band, off], axis=1)
        table = table[np.lexsort((off, band, item, row))]
        new = np.ones(len(table), bool)
        new[1:] = (table[1:] != table[:-1]).any(axis=1)  # an item's q-gram counts once in a band
        table = table[new]
        start = np.ones(len(table), bool)
        start[1:] = (table[1:, :3] != table[:-1, :3]).any(axis=1)
        at = np.flatnonzero(start)
        count = np.diff(np.append(at, len(table)))
        i = table[at, 1]
        good = count >= np.maximum(1, self.length[i] - self.q + 1 - self.q * self.edits[i])
        at, i = at[good], i[good]
        return list(zip(table[at, 0].tolist(), i.tolist(), (table[at, 2] * (2 * self.edits[i] + 1)).tolist(), strict=True))


_OUT = 0xFFFFFFFF  # equals no character


def banded_alignment(items: list[np.ndarray], texts: list[np.ndarray], low: np.ndarray, width: np.ndarray):
    """For each pair: ``(edits, end)`` of the best alignment of the whole item with
    any region of the text on the diagonals ``[low, low + width)``."""
    n, w = len(items), int(width.max())
    length = np.array([len(x) for x in items])
    m, k = int(length.max()), np.arange(w)
    pattern = np.full((n, m), _OUT, np.uint32)
    region = np.full((n, m + w), _OUT - 1, np.uint32)
    exists = np.zeros((n, m + w + 1), bool)  # text positions (prefix lengths) that there are
    for i in range(n):
        pattern[i, : length[i]] = items[i]
        a, b = max(0, int(low[i])), min(len(texts[i]), int(low[i]) + m + w)
        region[i, a - low[i] : b - low[i]] = texts[i][a:b]
        exists[i, a - low[i] : b - low[i] + 1] = True
    far = 1 << 20
    usable = k[None, :] < width[:, None]
    cost = np.where(usable & exists[:, :w], 0, far)
    best, end = np.full(n, far), np.zeros(n, np.int64)
    for r in range(1, m + 1):
        step = cost + (region[:, r - 1 : r - 1 + w] != pattern[:, r - 1 : r])
        step[:, :-1] = np.minimum(step[:, :-1], cost[:, 1:] + 1)
        step = np.where(usable & exists[:, r : r + w], step, far)
        cost = np.minimum.accumulate(step - k, axis=1) + k
        cost = np.where(usable & exists[:, r : r + w], cost, far)
        done = np.flatnonzero(length == r)
        if len(done):
            c = cost[done].argmin(axis=1)
            best[done], end[done] = cost[done, c], low[done] + r + c
    return best, end


def _search(block: Block):
    """Rows ``(row, item_id, edits, start, end)`` found in a column of texts."""

    def rows(texts: pa.Array) -> Iterator[tuple[int, int, int, int, int]]:
        data, offsets = text_buffers(texts)
        for i, j in chunks(offsets):
            part = data[offsets[i] : offsets[j]]
            codes = np.frombuffer(part.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
            heads = np.cumsum(np.append(0, (part & 0xC0) != 0x80))
            borders = heads[offsets[i : j + 1] - offsets[i]]
            chars, at = fold(codes)
            row_of = np.searchsorted(borders, at, side="right") - 1
            found = block.bands(chars, row_of)
            if not found:
                continue
            first = np.searchsorted(at, borders)
            # the best region per (row, item), aligned in groups of like length
            best: dict[tuple[int, int], tuple[int, int, int]] = {}
            found.sort(key=lambda x: len(block.chars[x[1]]))
            for s in range(0, len(found), 256):
                group = found[s : s + 256]
                items = [block.chars[x[1]] for x in group]
                docs = [chars[first[x[0]] : first[x[0] + 1]] for x in group]
                low = np.array([x[2] - first[x[0]] for x in group])
                width = np.array([2 * (2 * block.edits[x[1]] + 1) for x in group])
                edits, end = banded_alignment(items, docs, low, width)
                # the same from behind gives the start
                n = np.array([len(d) for d in docs])
                m = np.array([len(c) for c in items])
                back, rest = banded_alignment([c[::-1] for c in items], [d[::-1] for d in docs], n - m - low - width + 1, width)
                for x, e, b, z, y, size in zip(group, edits, back, end, rest, n, strict=True):
                    if e <= block.edits[x[1]]:
                        key, region = (x[0], x[1]), (int(e), int(size - y), int(z))
                        best[key] = min(best.get(key, region), region)
            for (row, item), (e, a, z) in sorted(best.items()):
                chars_at = at[first[row] : first[row + 1]] - borders[row]
                yield i + row, block.ids[item], e, int(chars_at[a]), int(chars_at[max(a, z - 1)]) + 1

    return rows


def blocks(benchmark: DataFrame, limit: int = BLOCK_CHARS) -> Iterator[Block]:
    """The benchmark's items, block by block (one block in the driver at a time)."""
    items, size = [], 0
    for r in benchmark.select("item_id", "text").orderBy("item_id", "text").toLocalIterator():
        if items and size + len(r["text"] or "") > limit:
            yield Block(items)
            items, size = [], 0
        items.append((r["item_id"], r["text"]))
        size += len(r["text"] or "")
    if items:
        yield Block(items)


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``(doc_id, item_id, edits, start_char, end_char)``: every benchmark item that
    occurs in a document, with its best region (code points of the text)."""
    schema = "doc_id long, item_id long, edits int, start_char long, end_char long"
    given = docs.select(F.col("doc_id").cast("long"), "text")

    def over(block: Block):
        search = _search(block)

        def run(batches):
            for batch in batches:
                found = list(search(batch.column(1)))
                ids = batch.column(0)
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.take(pa.array([x[0] for x in found], pa.int64())),
                        pa.array([x[1] for x in found], pa.int64()),
                        pa.array([x[2] for x in found], pa.int32()),
                        pa.array([x[3] for x in found], pa.int64()),
                        pa.array([x[4] for x in found], pa.int64()),
                    ],
                    names=["doc_id", "item_id", "edits", "start_char", "end_char"],
                )

        return run

    out = None
    for block in blocks(benchmark):
        part = given.mapInArrow(over(block), schema)
        out = part if out is None else out.unionByName(part)
    return docs.sparkSession.createDataFrame([], schema) if out is None else out


def without_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` (all columns) in which no benchmark item occurs; one
    pass per block, no shuffle, no join."""
    out = docs
    names = docs.columns

    def keep(block: Block):
        search = _search(block)

        def run(batches):
            for batch in batches:
                clean = np.ones(batch.num_rows, bool)
                clean[[x[0] for x in search(batch.column(names.index("text")))]] = False
                yield batch.filter(pa.array(clean))

        return run

    for block in blocks(benchmark):
        out = out.mapInArrow(keep(block), docs.schema)
    return out


def op5_decontaminate(spark, sf_dir: str) -> DataFrame:
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
