"""Token-ID output: a static range asymmetric numeral system (rANS) store.

File format
A data set is a folder of Parquet part files, one row per shard: ``part`` and
``seq`` (their order is the order of the ids), ``n_docs``, ``n_ids`` and
``payload``. A payload stands alone::

    "RANS1\\0"  u32 head length, u32 crc32 of the head, head, then u32 words
    head = JSON: n_ids, n_docs, block_ids, lanes, scale_bits, n_blocks, sizes
           + zlib of the document table: u64 ids, u8 null flags, u32 lengths
           + zlib of the frequency table shared by the shard's blocks: u32
             symbols, u32 frequencies (sum 2^scale_bits)
           + checkpoints: per block u64 first word, u32 crc32 of its words, u32
             crc32 of its ids, u32 first document, u64 first states of its lanes

Each block of ``block_ids`` ids is coded by itself: its ids are interleaved over
``lanes`` 64-bit states that share one stream of 32-bit words. A reader starts at
any checkpoint, and all blocks decode side by side (numpy works on all lanes of
all blocks at once). The last block is filled up with the end id.

Tokenizing: byte-level BPE first splits a text into words, signs and white space
and never joins across these. So a text is cut at places where that split always
cuts, equal pieces are encoded by the tokenizers library once per task (a table
of bounded size), and a text where the rule does not hold is encoded whole.

Scale: texts are range-partitioned by ``(doc_id, text hash)``, so the order is
global and a repeated id does not land in one task; a task holds one shard
(``SHARD_IDS`` ids, or one longer document) at a time and writes through Spark,
whose commit survives lost executors. Offsets of shards are a running sum over
per-shard counts.

Defined cases: NULL or empty text is the end id alone; NULL ids come first;
repeated rows are written as often as they are given, equal ids in the order of a
hash of their text; further columns are ignored; an empty table gives no shard.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from termsim.llm.storage import table, written

MAGIC = b"RANS1\x00"
SCALE_BITS = 20
LANES = 32
BLOCK_IDS = 32 * 1024
SHARD_IDS = 4 << 20
LOW = np.uint64(1 << 31)
END_ID = 0
#: Entries of the table of pieces that a task keeps.
PIECES = 400_000
#: Stands before a piece that no space precedes (texts that hold it go whole).
_MARK = "\x01"
_STOPS = (_MARK + ",", _MARK + ".")
#: Latin letters alone: after a space, one word of the tokenizer's first split.
_LETTERS = re.compile("[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]+")


def _byte_letters() -> dict[int, str]:
    """The letter that byte-level BPE writes for each byte."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {**{b: chr(b) for b in shown}, **{b: chr(256 + i) for i, b in enumerate(hidden)}}


_BYTES = _byte_letters()


# --------------------------------------------------------------------------
# rANS
# --------------------------------------------------------------------------


def frequencies(ids: np.ndarray, bits: int = SCALE_BITS) -> tuple[np.ndarray, np.ndarray]:
    """``(symbols, frequencies)`` with frequencies of 1 at least, sum ``2^bits``."""
    counts = np.bincount(ids)
    symbols = np.flatnonzero(counts)
    counts = counts[symbols]
    total = 1 << bits
    freq = np.maximum(1, counts * (total / counts.sum())).astype(np.int64)
    over = int(freq.sum()) - total
    order = np.argsort(-freq, kind="stable")
    while over:  # what rounding has left over goes to (or comes from) the most frequent ones
        room = freq[order] - 1 if over > 0 else np.full(len(freq), -over)
        take = np.minimum(room, max(1, abs(over) // 8 + 1))
        take = np.where(np.cumsum(take) - take < abs(over), np.minimum(take, abs(over) - (np.cumsum(take) - take)), 0)
        freq[order] -= np.sign(over) * take
        over = int(freq.sum()) - total
    return symbols.astype(np.uint32), freq.astype(np.uint32)


def _encode_blocks(index: np.ndarray, freq: np.ndarray, bits: int):
    """Codes ``index[block, step, lane]`` (places in the frequency table): the words
    of each block and its first states."""
    blocks, steps, lanes = index.shape
    f64 = freq.astype(np.uint64)
    start = np.concatenate([[0], np.cumsum(f64)[:-1]]).astype(np.uint64)
    limit = (LOW >> np.uint64(bits) << np.uint64(32)) * f64
    x = np.full((blocks, lanes), LOW, dtype=np.uint64)
    out = np.empty((blocks, steps, lanes), np.uint32)
    put = np.empty((blocks, steps, lanes), bool)
    for t in range(steps - 1, -1, -1):
        i = index[:, t]
        full = x >= limit[i]
        out[:, t] = x  # the low 32 bits
        put[:, t] = full
        x = np.where(full, x >> np.uint64(32), x)
        f = f64[i]
        q = x // f
        x = (q << np.uint64(bits)) + (x - q * f) + start[i]
    return [out[b][put[b]] for b in range(blocks)], x


def _decode_blocks(words: np.ndarray, first: np.ndarray, states: np.ndarray, steps: int, symbols, freq, bits: int):
    """The ids ``[block, step, lane]`` of the blocks that start at ``first``."""
    f64 = freq.astype(np.uint64)
    start = np.concatenate([[0], np.cumsum(f64)[:-1]]).astype(np.uint64)
    place = np.repeat(np.arange(len(freq), dtype=np.uint32), freq)
    mask = np.uint64((1 << bits) - 1)
    x, at = states.copy(), first.astype(np.int64).copy()
    words = np.append(words, np.uint32(0))
    out = np.empty((len(first), steps, states.shape[1]), np.uint32)
    for t in range(steps):
        slot = x & mask
        i = place[slot]
        out[:, t] = symbols[i]
        x = f64[i] * (x >> np.uint64(bits)) + slot - start[i]
        need = x < LOW
        taken = np.cumsum(need, axis=1)
        w = words[np.minimum(at[:, None] + taken - 1, len(words) - 1)]
        x = np.where(need, (x << np.uint64(32)) | w, x)
        at += taken[:, -1]
    return out


def _packed(a: np.ndarray) -> bytes:
    return zlib.compress(a.tobytes(), 1)


def encode_shard(doc_ids: list, lengths: np.ndarray, ids: np.ndarray, lanes: int = LANES, block_ids: int = BLOCK_IDS) -> bytes:
    """The payload of one shard: documents of ``lengths`` ids each."""
    n = len(ids)
    symbols, freq = frequencies(ids)
    blocks = -(-n // block_ids)
    padded = np.full(blocks * block_ids, END_ID if END_ID in symbols else symbols[0], np.uint32)
    padded[:n] = ids
    place = np.zeros(int(symbols[-1]) + 1, np.int32)
    place[symbols] = np.arange(len(symbols))
    index = place[padded].reshape(blocks, block_ids // lanes, lanes)
    words, states = _encode_blocks(index, freq, SCALE_BITS)
    sizes = np.array([len(w) for w in words], np.uint64)
    ends = np.cumsum(lengths)
    mark = np.zeros(blocks, dtype=[("word", "<u8"), ("words_crc", "<u4"), ("ids_crc", "<u4"), ("doc", "<u4"), ("states", "<u8", (lanes,))])
    mark["word"] = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    mark["words_crc"] = [zlib.crc32(w.tobytes()) for w in words]
    mark["ids_crc"] = [zlib.crc32(p.tobytes()) for p in padded.reshape(blocks, block_ids)]
    mark["doc"] = np.searchsorted(ends, np.arange(blocks) * block_ids, side="right")
    mark["states"] = states
    docs = [
        np.array([0 if d is None else d for d in doc_ids], "<i8").tobytes(),
        np.array([d is None for d in doc_ids], np.uint8).tobytes(),
        lengths.astype("<u4").tobytes(),
    ]
    parts = [zlib.compress(b"".join(docs), 1), _packed(np.concatenate([symbols, freq]).astype("<u4")), mark.tobytes()]
    info = {"n_ids": n, "n_docs": len(doc_ids), "block_ids": block_ids, "lanes": lanes, "scale_bits": SCALE_BITS, "n_blocks": blocks, "sizes": [len(p) for p in parts]}
    text = json.dumps(info).encode()
    head = len(text).to_bytes(4, "little") + text + b"".join(parts)
    stream = np.concatenate(words).astype("<u4").tobytes()
    return MAGIC + len(head).to_bytes(4, "little") + zlib.crc32(head).to_bytes(4, "little") + head + stream


class Shard:
    """A payload opened for reading; blocks are decoded on demand."""

    def __init__(self, payload: bytes):
        if payload[:6] != MAGIC:
            raise ValueError("not a token shard")
        size = int.from_bytes(payload[6:10], "little")
        head = payload[14 : 14 + size]
        if zlib.crc32(head) != int.from_bytes(payload[10:14], "little"):
            raise ValueError("the shard's head is damaged")
        n = int.from_bytes(head[:4], "little")
        info = json.loads(head[4 : 4 + n])
        docs, freq, mark = info["sizes"]
        self.n_ids, self.n_docs, self.block_ids, self.lanes = (info[k] for k in ("n_ids", "n_docs", "block_ids", "lanes"))
        self.bits, at = info["scale_bits"], 4 + n
        d = zlib.decompress(head[at : at + docs])
        ids = np.frombuffer(d, "<i8", self.n_docs)
        null = np.frombuffer(d, np.uint8, self.n_docs, 8 * self.n_docs)
        self.doc_ids = [None if z else int(x) for x, z in zip(ids, null, strict=True)]
        self.lengths = np.frombuffer(d, "<u4", self.n_docs, 9 * self.n_docs).astype(np.int64)
        both = np.frombuffer(zlib.decompress(head[at + docs : at + docs + freq]), "<u4")
        self.symbols, self.freq = np.split(both, 2)
        self.mark = np.frombuffer(
            head[at + docs + freq : at + docs + freq + mark],
            dtype=[("word", "<u8"), ("words_crc", "<u4"), ("ids_crc", "<u4"), ("doc", "<u4"), ("states", "<u8", (self.lanes,))],
        )
        self.words = np.frombuffer(payload, "<u4", offset=14 + size)

    def blocks(self, low: int = 0, high: int | None = None) -> np.ndarray:
        """The ids of blocks ``[low, high)``, checked against their checksums."""
        mark = self.mark[low:high]
        last = low + len(mark) < len(self.mark)
        ends = np.append(mark["word"][1:], self.mark["word"][low + len(mark)] if last else len(self.words)).astype(np.int64)
        for a, b, crc in zip(mark["word"].astype(np.int64), ends, mark["words_crc"], strict=True):
            if zlib.crc32(self.words[a:b].tobytes()) != crc:
                raise ValueError("a block's words are damaged")
        ids = _decode_blocks(self.words, mark["word"], mark["states"], self.block_ids // self.lanes, self.symbols, self.freq, self.bits)
        for block, crc in zip(ids, mark["ids_crc"], strict=True):
            if zlib.crc32(block.tobytes()) != crc:
                raise ValueError("a block's ids are damaged")
        return ids.reshape(-1)[: max(0, self.n_ids - low * self.block_ids)]


# --------------------------------------------------------------------------
# tokenizing
# --------------------------------------------------------------------------


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


class Encoder:
    """Whole-text ids through the tokenizers library, equal pieces only once.

    A text is cut before single spaces, around line breaks and before full stops
    and commas: places where the tokenizer's own first split always cuts, as long
    as a stop or comma follows a letter or digit and no piece holds other white
    space. A text with a piece that breaks this is encoded whole instead.

    A piece of Latin letters after a space is one word to the first split, so it goes
    to the library's BPE model without it. When the table is full, the pieces that
    were met again since it last was stay."""

    def __init__(self, path: str, end_id: int | None = END_ID, pieces: int = PIECES):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, models, pre_tokenizers

        self.tokenizer = t = Tokenizer.from_file(path)
        split = t.pre_tokenizer
        plain_split = type(split) is pre_tokenizers.ByteLevel and split.use_regex and not split.add_prefix_space
        self.words = t.model if t.normalizer is None and plain_split and type(t.model) is models.BPE else None
        self.end = [] if end_id is None else [end_id]
        self.limit = pieces
        (self.line_break,) = self._whole("\n")
        self._reset()

    def _whole(self, text: str) -> list[int]:
        return self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids

    def _reset(self):
        # piece -> row of the arrays; a key is a piece after a space, one that
        # starts with a mark (no space before it), or a 1-tuple: a text's first
        self.known: dict = {}
        self.flat = np.array([*self.end, self.line_break], np.uint32)
        self.start, self.size = np.array([0, len(self.end)]), np.array([len(self.end), 1])
        self.odd, self.stop, self.open = (np.zeros(2, bool) for _ in range(3))
        self.known[()] = 0  # the end of a text
        self.known[_MARK + "\n"] = 1
        self.again = np.zeros(2, bool)

    def _shrink(self) -> None:
        """Only pieces met again stay, if they leave half of the table free."""
        stay = self.again.copy()
        stay[:2] = True
        if 2 * int(stay.sum()) > self.limit:
            return self._reset()
        rows = np.flatnonzero(stay)
        keys = list(self.known)  # in the order of their rows
        self.known = {keys[i]: k for k, i in enumerate(rows.tolist())}
        size, first = self.size[rows], self.start[rows]
        start = np.cumsum(size) - size
        self.flat = self.flat[np.repeat(first - start, size) + np.arange(int(size.sum()))]
        self.start, self.size = start, size
        self.odd, self.stop, self.open = self.odd[rows], self.stop[rows], self.open[rows]
        self.again = np.zeros(len(rows), bool)

    def _add(self, new: list, size: np.ndarray, ids: np.ndarray, odd, stop, open_) -> None:
        self.start = np.append(self.start, len(self.flat) + np.cumsum(size) - size)
        self.size = np.append(self.size, size)
        self.flat = np.append(self.flat, ids)
        self.odd, self.stop, self.open = np.append(self.odd, odd), np.append(self.stop, stop), np.append(self.open, open_)
        self.again = np.append(self.again, np.zeros(len(new), bool))
        self.known.update(zip(new, range(len(self.known), len(self.known) + len(new)), strict=True))

    def _learn_letters(self, new: list[str]) -> None:
        written = (" " + "\n ".join(new)).encode().decode("latin-1").translate(_BYTES)
        ids = [[t.id for t in self.words.tokenize(w)] for w in written.split(_BYTES[10])]
        no = np.zeros(len(new), bool)
        self._add(new, np.fromiter(map(len, ids), np.int64, len(new)), np.fromiter(chain.from_iterable(ids), np.uint32), no, no, no)

    def _learn(self, new: list) -> None:
        if self.words is not None:
            letters = [w for w in new if type(w) is str and _LETTERS.fullmatch(w)]
            if letters:
                self._learn_letters(letters)
                new = list(set(new).difference(letters))
        if not new:
            return
        raw = [w[0] if type(w) is tuple else w[1:] if w[:1] == _MARK else " " + w for w in new]
        # white space inside, or a missing piece where two separators meet
        odd = [r.split() != [r.strip(" ")] or r[1:2] == " " for r in raw]
        odd = [o and not (type(w) is tuple and w[0] == "") for o, w in zip(odd, new, strict=True)]
        plain = [r for r, o in zip(raw, odd, strict=True) if not o]
        # one call for all: the pieces, each followed by a line break
        ids = np.array(self._whole("\n".join([*plain, ""])), np.uint32)
        cut = np.flatnonzero(ids == self.line_break)
        if len(cut) != len(plain):  # a piece that holds the id itself: one by one
            parts = [self._whole(r) for r in plain]
            size = np.array([len(x) for x in parts], np.int64)
            ids = np.array([i for x in parts for i in x], np.uint32)
        else:
            size = np.diff(cut, prepend=-1) - 1
            ids = np.delete(ids, cut)
        sizes = np.zeros(len(new), np.int64)
        sizes[~np.array(odd, bool)] = size
        stop = [type(w) is str and w[:2] in _STOPS for w in new]
        self._add(new, sizes, ids, np.array(odd, bool), stop, [not r[-1:].isalnum() for r in raw])

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """``(lengths, ids)``: the ids of all texts one after the other, each text
        closed by the end id."""
        if len(self.known) > self.limit:
            self._shrink()
        words, counts, whole = [], [], []
        for k, t in enumerate(texts):
            if _MARK in t:
                whole.append(k)
                t = ""
            pieces = t.replace(",", " \x01,").replace(".", " \x01.").replace("\n", " \x01\n \x01").split(" ")
            pieces[0] = (pieces[0],)
            pieces.append(())
            words += pieces
            counts.append(len(pieces))
        new = list(set(words).difference(self.known))
        before = len(self.known)
        if new:
            self._learn(new)
        at = np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))
        self.again[at[at < before]] = True
        ends = np.cumsum(counts)
        bad = self.odd[at]
        bad[1:] |= self.stop[at[1:]] & self.open[at[:-1]]
        whole = np.union1d(np.array(whole, np.int64), np.searchsorted(ends, np.flatnonzero(bad), side="right")).astype(int)
        size = self.size[at]
        total = np.cumsum(size)
        ids = self.flat[np.repeat(self.start[at] - (total - size), size) + np.arange(total[-1] if len(total) else 0)]
        upto = total[ends - 1] if len(ends) else np.zeros(0, np.int64)
        lengths = np.diff(upto, prepend=0)
        if len(whole):
            parts = np.split(ids, upto[:-1])
            for k in whole:
                parts[k] = np.array(self._whole(texts[k]) + self.end, np.uint32)
            ids, lengths = np.concatenate(parts), np.array([len(p) for p in parts])
        return lengths.astype(np.int64), ids


# --------------------------------------------------------------------------
# Spark
# --------------------------------------------------------------------------

SHARD_SCHEMA = "part int, seq int, n_docs long, n_ids long, payload binary"


_encoders: dict[tuple, Encoder] = {}


def _encoder(path: str, end_id: int | None) -> Encoder:
    """One per worker process, so that tasks share its table of pieces."""
    if (path, end_id) not in _encoders:
        _encoders[path, end_id] = Encoder(path, end_id)
    return _encoders[path, end_id]


def _write_batches(path: str, end_id: int, shard_ids: int):
    def run(batches):
        encoder, part, seq = _encoder(path, end_id), TaskContext.get().partitionId(), 0
        docs, lengths, ids, held = [], [], [], 0

        def shard():
            nonlocal docs, lengths, ids, held, seq
            payload = encode_shard(docs, np.concatenate(lengths), np.concatenate(ids))
            row = [[part], [seq], [len(docs)], [held], [payload]]
            types = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary()]
            batch = pa.RecordBatch.from_arrays(
                [pa.array(v, t) for v, t in zip(row, types, strict=True)], names=["part", "seq", "n_docs", "n_ids", "payload"]
            )
            docs, lengths, ids, held, seq = [], [], [], 0, seq + 1
            return batch

        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                some = batch.slice(i, 256)
                n, e = encoder.encode([t or "" for t in some.column(1).to_pylist()])
                docs += some.column(0).to_pylist()
                lengths.append(n)
                ids.append(e)
                held += len(e)
                if held >= shard_ids:
                    yield shard()
        if docs:
            yield shard()

    return run


def write_tokens(docs: DataFrame, tokenizer: str | None = None, end_id: int = END_ID, shard_ids: int = SHARD_IDS) -> DataFrame:
    """Encode all texts in ascending ``doc_id`` order and write them in the shared
    folder; returns the written shards."""
    path = tokenizer or tokenizer_path()
    keyed = docs.select(F.col("doc_id").cast("long"), "text", F.xxhash64("text").alias("h"))
    ordered = keyed.repartitionByRange("doc_id", "h").sortWithinPartitions("doc_id", "h").select("doc_id", "text")
    return written(ordered.mapInArrow(_write_batches(path, end_id, shard_ids), SHARD_SCHEMA), "tokens")


def _read_batches(batches):
    for batch in batches:
        for row in batch.to_pylist():
            shard = Shard(row["payload"])
            step = max(1, SHARD_IDS // shard.block_ids)
            parts = [shard.blocks(b, b + step) for b in range(0, len(shard.mark), step)]
            ids = np.concatenate(parts).astype("<u4")
            ends = np.cumsum(shard.lengths)
            begins = ends - shard.lengths
            raw = memoryview(ids.tobytes())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([row["part"]] * shard.n_docs, pa.int32()),
                    pa.array([row["seq"]] * shard.n_docs, pa.int32()),
                    pa.array(shard.doc_ids, pa.int64()),
                    pa.array(begins, pa.int64()),
                    pa.array(shard.lengths, pa.int64()),
                    pa.array([zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(begins, ends, strict=True)], pa.int64()),
                ],
                names=["part", "seq", "doc_id", "begin", "n_tokens", "ids_crc32"],
            )


def read_digests(shards: DataFrame) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32)`` per document, from the payloads."""
    read = shards.select("part", "seq", "payload").mapInArrow(
        _read_batches, "part int, seq int, doc_id long, begin long, n_tokens long, ids_crc32 long"
    )
    # ids before each shard: parts first (one row per part), then within a part
    per_part = shards.groupBy("part").agg(F.sum("n_ids").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = per_part.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("parts_before"))
    inside = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    own = shards.select("part", "seq", F.coalesce(F.sum("n_ids").over(inside), F.lit(0)).alias("seqs_before"))
    offset = own.join(parts, "part").select("part", "seq", (F.col("parts_before") + F.col("seqs_before")).alias("before"))
    return read.join(offset, ["part", "seq"]).select(
        "doc_id", (F.col("before") + F.col("begin")).alias("start"), "n_tokens", "ids_crc32"
    )


def op9_token_store(spark, sf_dir: str) -> DataFrame:
    return read_digests(write_tokens(table(spark, sf_dir, "documents")))
