"""Token counts at every prefix by dynamic programming over byte-level BPE.

For each text the operator stores how many tokens each of its prefixes has (a prefix
of ``k`` code points counts as the library would count it as a text of its own).
From the stored table follow the count of the whole text, the count up to any
place, and the longest prefix within a budget, without encoding anything again.

Method
* Byte-level BPE encodes a string to exactly one sequence in which every two
  neighbours ``(a, b)`` fit: encoding the bytes of ``a`` and ``b`` gives ``a, b`` back.
  So for the prefixes of a piece, ``count[j] = count[i] + 1`` for the one token
  ``piece[i:j]`` that fits behind the last token of ``piece[:i]``; walking ``i`` upwards
  and a trie of the vocabulary from ``i`` costs a piece its length times the length
  of a token. All new pieces of a portion are walked at once (numpy).
* Two tokens fit when no merge crosses their border before both are complete. The last
  symbol of the one and the first of the other grow by known merges; at each stage the
  merge of the two, if there is one, must rank behind the next growth of either side.
* Pieces come from the tokenizer's own first split. They never run from a sign into
  white space, so a text is cut into chunks (white space, then other signs) that can
  be counted apart; plain words and stops are chunks, and pieces, of their own. The
  table of a text is the tables of its chunks in a row, as differences between
  neighbouring prefixes. Equal chunks are counted once per worker (a table of bounded
  size).
* Where a prefix is split otherwise than the text: white space at its end is one
  piece; a contraction of two letters that has only its first is two pieces; a special
  string that is cut is ordinary text. The tables hold these counts.

Scale: one pass over the texts without a shuffle; texts are taken in portions of a
bounded size, so a long one costs its own table (two bytes a code point) and little
else. Only a chunk without any white space is taken whole. Tables are compressed and
written by Spark in the shared folder.

Defined cases: NULL or empty text has 0 bytes, 0 tokens and an empty table; special
strings inside texts count as the library's default has it (one token); repeated
rows and rows with a NULL id are counted like others; an empty table gives no rows;
further columns are ignored. Tokenizers other than byte-level BPE are refused.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termsim.llm.storage import table, written

LIMIT = 1024
#: Bounds of what a worker keeps: chunks, code points of their tables, fitting pairs.
CHUNKS, POINTS, PAIRS = 800_000, 16 << 20, 1 << 20
#: Longer chunks are not kept, longer texts are taken in portions.
LONG_CHUNK, PORTION = 64, 1 << 20
#: Pieces of up to so many bytes are walked together, by groups of similar length.
GROUPS = (8, 16, 32)

# --- Fixed values: the tokenizer's white space (Unicode's White_Space) and the
# contractions of two letters that its first split takes as one piece. ---------
WHITE = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
LONG_CONTRACTIONS = ("'re", "'ve", "'ll")
# ------------------------------------------------------------------------------

# Latin letters: surely letters for the tokenizer, which may know more.
_LETTER = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff"
_STOP = ".,;:!?"
# a word between signs that surely end it, a run of stops in front of a word or a
# blank, or all up to the next white space
_PLAIN = f" ?[{_LETTER}]+(?![^{WHITE}{_STOP}])|[{_STOP}]+(?![^{WHITE}{_LETTER}])"
_CHUNK = re.compile(f"{_PLAIN}|[{WHITE}]*[^{WHITE}]+|[{WHITE}]+")
_PLAIN_CHUNK = re.compile(f" ?[{_LETTER}]+|[{_STOP}]+")
_BREAK = re.compile(f"[^{WHITE}][{WHITE}]")


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _byte_letters() -> list[str]:
    """The sign that stands for each byte in a byte-level vocabulary: printable
    ones for themselves, the others by their order from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return [chr(b) if b in shown else chr(256 + hidden.index(b)) for b in range(256)]


class PrefixCounter:
    """Token counts of all prefixes of a text for one tokenizer file."""

    def __init__(self, path: str, chunks: int = CHUNKS):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, first = spec["model"], spec["pre_tokenizer"] or {}
        plain = not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges"))
        split = first.get("type") == "ByteLevel" and first.get("use_regex", True) and not first.get("add_prefix_space")
        added = spec.get("added_tokens") or []
        if spec["normalizer"] or not (plain and split and model.get("type", "BPE") in ("BPE", 3)):
            raise ValueError(f"not a plain byte-level BPE tokenizer: {path}")
        if any(a.get("lstrip") or a.get("rstrip") or a.get("single_word") for a in added):
            raise ValueError("special strings that take in their surroundings are not supported")
        self.split = Tokenizer.from_file(path).pre_tokenizer.pre_tokenize_str
        byte = {c: b for b, c in enumerate(_byte_letters())}
        raw = lambda t: bytes(byte[c] for c in t)
        self.tokens = {raw(t): i for t, i in model["vocab"].items()}
        merges = [tuple(map(raw, m.split(" ") if isinstance(m, str) else m)) for m in model["merges"]]
        self.rank = {(self.tokens[a], self.tokens[b]): k for k, (a, b) in enumerate(merges)}
        self.made = {self.tokens[a + b]: (k, self.tokens[a], self.tokens[b]) for k, (a, b) in enumerate(merges)}
        if len(self.made) < len(merges) or any(len(t) > 1 and i not in self.made for t, i in self.tokens.items()):
            raise ValueError("a token has several merges, or none")
        if any(bytes([b]) not in self.tokens for b in range(256)):
            raise ValueError("a byte is no token")
        self._trie()
        special = sorted((a["content"] for a in added), key=len, reverse=True)
        self.special = re.compile("|".join(map(re.escape, special))) if special else None
        self.spines: tuple[dict, dict] = {}, {}
        self.valid: dict[int, bool] = {}
        self._forget_pairs()
        self.limit = chunks
        self._reset()

    def _trie(self) -> None:
        """``edge`` (node * 256 + byte, sorted), ``child`` and the token of each node."""
        node = {b"": 0}
        edges = {}
        for t in self.tokens:
            for j in range(1, len(t) + 1):
                if t[:j] not in node:
                    node[t[:j]] = len(node)
                    edges[node[t[: j - 1]] * 256 + t[j - 1]] = node[t[:j]]
        self.begins = {t: self.tokens.get(t, -1) for t in node}
        self.edge = np.array(sorted(edges), np.int64)
        self.child = np.array([edges[e] for e in self.edge.tolist()], np.int64)
        self.token_of = np.full(len(node), -1, np.int64)
        for t, i in self.tokens.items():
            self.token_of[node[t]] = i

    # -- which tokens fit ----------------------------------------------------

    def _forget_pairs(self) -> None:
        self.pair_key, self.pair_fit = np.array([-1], np.int64), np.array([False])

    def _spine(self, token: int, side: int) -> list[tuple[int, int]]:
        """The last (side 0) or first (side 1) symbol of a token as it is merged:
        ``(symbol, rank of the merge that ends it)``, the token itself at the end."""
        known = self.spines[side].get(token)
        if known is None:
            if token in self.made:
                rank, *parts = self.made[token]
                inner = self._spine(parts[1 - side], side)
                known = [*inner[:-1], (inner[-1][0], rank), (token, len(self.rank))]
            else:
                known = [(token, len(self.rank))]
            self.spines[side][token] = known
        return known

    def _crossing(self, a: int, b: int) -> tuple[int, int] | None:
        """The symbols that the first merge across the border of ``a b`` joins."""
        left, right, i, j, never = self._spine(a, 0), self._spine(b, 1), 0, 0, len(self.rank)
        while True:
            (x, ends_x), (y, ends_y) = left[i], right[j]
            rank = self.rank.get((x, y))
            # of merges of one rank the leftmost is done first
            if rank is not None and rank < ends_x and rank <= ends_y:
                return x, y
            if ends_x == ends_y == never:
                return None
            if ends_x <= ends_y:
                i += 1
            else:
                j += 1

    def _whole(self, token: int) -> bool:
        """Whether encoding a token's bytes gives the token."""
        known = self.valid.get(token)
        if known is None:
            known = True
            if token in self.made:
                _, a, b = self.made[token]
                known = self._whole(a) and self._whole(b) and self._crossing(a, b) == (a, b)
            self.valid[token] = known
        return known

    def fits(self, a: int, b: int) -> bool:
        """Whether token ``b`` may stand behind ``a`` (-1: at the start of a piece)."""
        return self._whole(b) and (a < 0 or self._crossing(a, b) is None)

    def _fits_many(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = (a + 1 << 32) | b
        at = np.minimum(np.searchsorted(self.pair_key, key), len(self.pair_key) - 1)
        new = np.unique(key[self.pair_key[at] != key])
        if len(new):
            if len(self.pair_key) > PAIRS:
                self._forget_pairs()
                return self._fits_many(a, b)
            fit = np.array([self.fits((k >> 32) - 1, k & 0xFFFFFFFF) for k in new.tolist()])
            keys = np.concatenate([self.pair_key, new])
            order = np.argsort(keys, kind="stable")
            self.pair_key, self.pair_fit = keys[order], np.concatenate([self.pair_fit, fit])[order]
            at = np.searchsorted(self.pair_key, key)
        return self.pair_fit[at]

    # -- pieces --------------------------------------------------------------

    def _long_piece(self, piece: bytes) -> list[int]:
        """Counts of the prefixes of 0 to n bytes of one piece."""
        n, begins = len(piece), self.begins
        count, last = [0] * (n + 1), [-1] * (n + 1)
        for i in range(n):
            for j in range(i + 1, n + 1):
                token = begins.get(piece[i:j])
                if token is None:
                    break
                if token >= 0 and self.fits(last[i], token):
                    count[j], last[j] = count[i] + 1, token
        return count

    def _pieces(self, pieces: list[bytes]) -> np.ndarray:
        """The same for many pieces: ``counts[piece, bytes]``."""
        size = np.array([len(p) for p in pieces])
        width = int(size.max())
        inside = np.arange(width) < size[:, None]
        letters = np.zeros((len(pieces), width), np.int64)
        letters[inside] = np.frombuffer(b"".join(pieces), np.uint8)
        # all places where a token stands: piece, from, to, token
        p, i = np.nonzero(inside)
        j, node = i.copy(), np.zeros(len(p), np.int64)
        found = []
        while len(p):
            key = node * 256 + letters[p, j]
            at = np.minimum(np.searchsorted(self.edge, key), len(self.edge) - 1)
            known = self.edge[at] == key
            p, i, j, node = p[known], i[known], j[known] + 1, self.child[at[known]]
            token = self.token_of[node]
            hit = token >= 0
            found.append((p[hit], i[hit], j[hit], token[hit]))
            more = j < size[p]
            p, i, j, node = p[more], i[more], j[more], node[more]
        p, i, j, token = (np.concatenate(c) for c in zip(*found, strict=True))
        order = np.argsort(i, kind="stable")
        p, j, token = p[order], j[order], token[order]
        ends = np.searchsorted(i[order], np.arange(width + 1))
        count, last = np.zeros((len(pieces), width + 1), np.int32), np.full((len(pieces), width + 1), -1, np.int64)
        for k in range(width):
            q, to, t = (c[ends[k] : ends[k + 1]] for c in (p, j, token))
            fit = self._fits_many(last[q, k], t)
            q, to, t = q[fit], to[fit], t[fit]
            count[q, to], last[q, to] = count[q, k] + 1, t
        return count

    def _by_point(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """``(counts, sizes)`` of texts that are one piece each, sorted by their bytes:
        the counts after each of their code points, one text after the other."""
        raw = [t.encode() for t in texts]
        counts, sizes, at = [], [np.array([len(t) for t in texts], np.int64)], 0
        for limit in GROUPS:
            end = at
            while end < len(raw) and len(raw[end]) <= limit:
                end += 1
            if end > at:
                group = raw[at:end]
                found = self._pieces(group)
                size = np.array([len(g) for g in group])
                letters = np.zeros((len(group), found.shape[1]), np.uint8)
                letters[np.arange(found.shape[1]) < size[:, None]] = np.frombuffer(b"".join(group), np.uint8)
                # a code point ends where the next byte does not continue it
                point = (letters & 0xC0) != 0x80
                point[:, 0] = False
                point &= np.arange(found.shape[1]) <= size[:, None]
                counts.append(found[point])
            at = end
        for t, r in zip(texts[at:], raw[at:], strict=True):
            ends = np.cumsum([len(c.encode()) for c in t])
            counts.append(np.array(self._long_piece(r), np.int64)[ends])
        return np.concatenate([np.zeros(0, np.int64), *counts]), sizes[0]

    # -- chunks --------------------------------------------------------------

    def _general_chunks(self, chunks: list[str]) -> list[np.ndarray]:
        """Counts after each code point of chunks of any kind."""
        split = [(c, len(c) - len(c.lstrip(WHITE)), [(c[a:b], a) for _, (a, b) in self.split(c)]) for c in chunks]
        needed = {c[:white] for c, white, _ in split if white} | {t for *_, parts in split for t, _ in parts}
        if not needed.isdisjoint(LONG_CONTRACTIONS):
            needed |= {"'"} | {c[1] for c in LONG_CONTRACTIONS}
        pieces = sorted(needed, key=lambda t: len(t.encode()))
        flat, sizes = self._by_point(pieces)
        known = dict(zip(pieces, np.split(flat, np.cumsum(sizes)[:-1]), strict=True))
        out = []
        for c, white, parts in split:
            # white space at the end of a prefix is one piece
            counts, total = [known[c[:white]]] if white else [], 0
            for t, at in parts:
                own = known[t]
                end = own[-1]
                if t in LONG_CONTRACTIONS:
                    own = own.copy()
                    own[1] = known["'"][0] + known[t[1]][0]
                counts.append(total + own[max(0, white - at) :])
                total += end
            out.append(np.concatenate(counts))
        return out

    # -- texts -------------------------------------------------------------

    def _reset(self):
        self.known: dict[str, int] = {}
        self.start, self.size, self.total = (np.zeros(0, np.int64) for _ in range(3))
        self.flat = np.zeros(0, np.int16)

    def _learn(self, new: list[str]) -> None:
        plain = sorted((c for c in new if _PLAIN_CHUNK.fullmatch(c)), key=lambda t: len(t.encode()))
        others = list(set(new).difference(plain))
        counts, sizes = self._by_point(plain)
        if others:
            general = self._general_chunks(others)
            counts = np.concatenate([counts, *general])
            sizes = np.append(sizes, [len(g) for g in general])
        upto = np.cumsum(sizes)
        steps = np.diff(counts, prepend=0)
        steps[upto[:-1]] = counts[upto[:-1]]  # the first of a chunk counts from 0
        if len(steps) and np.abs(steps).max() > np.iinfo(np.int16).max:
            raise ArithmeticError("a step between prefixes does not fit into 16 bits")
        self.start = np.append(self.start, len(self.flat) + upto - sizes)
        self.size = np.append(self.size, sizes)
        self.total = np.append(self.total, counts[upto - 1])
        self.flat = np.append(self.flat, steps.astype(np.int16))
        self.known.update(zip([*plain, *others], range(len(self.known), len(self.known) + len(new)), strict=True))

    def _plain_steps(self, text: str) -> Iterator[np.ndarray]:
        """Steps of a text without special strings, portion by portion."""
        at = 0
        while at < len(text):
            cut = _BREAK.search(text, at + PORTION) if len(text) - at > PORTION else None
            end = cut.start() + 1 if cut else len(text)
            yield self._steps_of([text[at:end]])[1]
            at = end

    def _special_steps(self, text: str) -> np.ndarray:
        """Steps of a text with special strings: up to the last sign of one the prefix
        is ordinary text, with it the string is one token."""
        parts, at = [], 0
        for m in self.special.finditer(text):
            before = m.start() - at
            steps = np.concatenate([*self._plain_steps(text[at : m.end() - 1]), np.zeros(0, np.int16)]).astype(np.int64)
            parts.append(np.append(steps, steps[:before].sum() + 1 - steps.sum()))
            at = m.end()
        parts += self._plain_steps(text[at:])
        return np.concatenate(parts).astype(np.int16)

    def _steps_of(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """``(tokens of each text, steps of all of them in a row)``."""
        chunks, ends = [], []
        for t in texts:
            chunks += _CHUNK.findall(t)
            ends.append(len(chunks))
        new = [c for c in set(chunks) if c not in self.known]
        if len(self.known) + len(new) > self.limit or len(self.flat) > POINTS:
            self._reset()
            new = list(set(chunks))
        kept = len(self.known), len(self.flat)
        short = [c for c in new if len(c) <= LONG_CHUNK]
        if short:
            self._learn(short)
            kept = len(self.known), len(self.flat)
        long = [c for c in new if len(c) > LONG_CHUNK]
        if long:
            self._learn(long)
        at = np.fromiter(map(self.known.__getitem__, chunks), np.int64, len(chunks))
        size = self.size[at]
        upto = np.cumsum(size)
        steps = self.flat[np.repeat(self.start[at] - (upto - size), size) + np.arange(upto[-1] if len(upto) else 0)]
        tokens = np.diff(np.concatenate([[0], np.cumsum(self.total[at])])[ends], prepend=0)
        if long:
            for c in long:
                del self.known[c]
            rows, points = kept
            self.start, self.size, self.total, self.flat = self.start[:rows], self.size[:rows], self.total[:rows], self.flat[:points]
        return tokens, steps

    def tables(self, texts: list[str]) -> tuple[list[int], list[bytes]]:
        """``(tokens, table)`` of each text; a table is the compressed steps between
        the counts of neighbouring prefixes, two bytes a code point."""
        tokens, packed = [0] * len(texts), [b""] * len(texts)
        held, size = [], 0
        for k, t in enumerate([*texts, None]):
            if held and (t is None or size + len(t) > PORTION):
                counts, steps = self._steps_of([texts[h] for h in held])
                cuts = np.cumsum([len(texts[h]) for h in held])[:-1]
                for h, n, s in zip(held, counts, np.split(steps, cuts), strict=True):
                    tokens[h], packed[h] = int(n), pack(s)
                held, size = [], 0
            if t is None or t == "":
                continue
            if self.special is not None and self.special.search(t):
                steps = self._special_steps(t)
            elif len(t) > PORTION:
                steps = np.concatenate(list(self._plain_steps(t)))
            else:
                held.append(k)
                size += len(t)
                continue
            tokens[k], packed[k] = int(steps.sum(dtype=np.int64)), pack(steps)
        return tokens, packed


# --------------------------------------------------------------------------
# questions to a stored table
# --------------------------------------------------------------------------


def pack(steps: np.ndarray) -> bytes:
    return zlib.compress(steps.astype("<i2").tobytes(), 1)


def counts(packed: bytes | None) -> np.ndarray:
    """The token counts of the prefixes of 0 to n code points."""
    steps = np.frombuffer(zlib.decompress(packed), "<i2") if packed else np.zeros(0, "<i2")
    return np.concatenate([[0], np.cumsum(steps, dtype=np.int64)])


def tokens_before(packed: Column, points: Column) -> Column:
    """Tokens of the first ``points`` code points (all of them where the text is shorter)."""

    @F.pandas_udf("long")
    def ask(tables: pd.Series, places: pd.Series) -> pd.Series:
        found = []
        for t, p in zip(tables, places, strict=True):
            c = counts(t)
            found.append(None if pd.isna(p) else int(c[max(0, min(int(p), len(c) - 1))]))
        return pd.Series(found, dtype="Int64")

    return ask(packed, points)


def fitting_prefix(packed: Column, budget: Column) -> Column:
    """The most code points whose prefix has at most ``budget`` tokens."""

    @F.pandas_udf("long")
    def ask(tables: pd.Series, budgets: pd.Series) -> pd.Series:
        found = [None if pd.isna(b) or b < 0 else int(np.flatnonzero(counts(t) <= b)[-1]) for t, b in zip(tables, budgets, strict=True)]
        return pd.Series(found, dtype="Int64")

    return ask(packed, budget)


# --------------------------------------------------------------------------
# Spark
# --------------------------------------------------------------------------

_counters: dict[str, PrefixCounter] = {}


def _counter(path: str) -> PrefixCounter:
    """One per worker process, so that tasks share what it has learnt."""
    if path not in _counters:
        _counters[path] = PrefixCounter(path)
    return _counters[path]


def _batches(path: str, names: list[str]):
    def run(batches):
        counter = _counter(path)
        for batch in batches:
            for i in range(0, batch.num_rows, 512):
                some = batch.slice(i, 512)
                text = some.column(len(names)).cast(pa.large_string()).fill_null("")
                texts = text.to_pylist()
                tokens, packed = counter.tables(texts)
                added = [
                    pc.cast(pc.binary_length(text), pa.int64()),
                    pa.array([len(t) for t in texts], pa.int64()),
                    pa.array(tokens, pa.int64()),
                    pa.array(packed, pa.binary()),
                ]
                columns = [some.column(k) for k in range(len(names))] + added
                yield pa.RecordBatch.from_arrays(columns, names=[*names, "n_bytes", "n_chars", "n_tokens", "prefix_table"])

    return run


def prefix_tables(docs: DataFrame, tokenizer: str | None = None, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns ``keep`` with ``n_bytes``, ``n_chars``, ``n_tokens`` and ``prefix_table`` of each text."""
    taken = docs.select(*[F.col(c) for c in keep])
    names = [f"c{k}" for k in range(len(keep))]
    rows = docs.select(*[F.col(c).alias(n) for c, n in zip(keep, names, strict=True)], F.col("text").cast("string").alias("t"))
    schema = ", ".join(f"{n} {f.dataType.simpleString()}" for n, f in zip(names, taken.schema, strict=True))
    schema = f"{schema}{', ' if names else ''}n_bytes long, n_chars long, n_tokens long, prefix_table binary"
    made = rows.mapInArrow(_batches(tokenizer or tokenizer_path(), names), schema)
    return made.select(*[F.col(n).alias(c) for c, n in zip(keep, names, strict=True)], "n_bytes", "n_chars", "n_tokens", "prefix_table")


def store_tables(docs: DataFrame, tokenizer: str | None = None, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The prefix tables, written in the shared folder and read from there."""
    return written(prefix_tables(docs, tokenizer, keep), "prefix-tables")


def op11_token_counts(spark, sf_dir: str) -> DataFrame:
    tables = store_tables(table(spark, sf_dir, "documents"))
    return tables.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > LIMIT).alias("over_limit"))
