import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from termsim.llm.words import batches_of, gram_hashes, token_spans

WORD = re.compile(r"[^\x20\x09-\x0D]+")
TEXT = st.lists(st.one_of(st.none(), st.text(alphabet="abAB éÉ\t\n\x0b\x85\xa0|%1", max_size=40)), max_size=8)


@settings(max_examples=80, deadline=None)
@given(TEXT)
def test_words_match_the_regex_and_hash_by_content(texts):
    batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], names=["t"])
    got, seen = [], {}
    for i, j, data, starts, ends, first, hashes in batches_of(batch, "t"):
        raw = data.tobytes()
        for k in range(j - i):
            words = [raw[a:b].decode() for a, b in zip(starts[first[k] : first[k + 1]], ends[first[k] : first[k + 1]])]
            got.append(words)
            for w, h in zip(words, hashes[first[k] : first[k + 1]]):
                assert seen.setdefault(w, h) == h
    assert got == [WORD.findall(t or "") for t in texts]
    assert len(set(seen.values())) == len(seen)


def test_lower_folds_ascii_only():
    batch = pa.RecordBatch.from_arrays([pa.array(["The the É é"])], names=["t"])
    (_, _, _, _, _, _, h), = batches_of(batch, "t", lower=True)
    assert h[0] == h[1] and h[2] != h[3]


def test_grams_depend_on_order():
    w = np.array([1, 2, 3, 2, 1, 2, 3], np.uint64)
    g = gram_hashes(w, 3)
    assert len(g) == 5 and g[0] == g[4] and len(set(g.tolist())) == 4
    assert len(gram_hashes(w[:2], 3)) == 0


def test_tokens_split_by_class():
    data = np.frombuffer("ab%%% 12|é".encode(), np.uint8)
    starts, ends, first = token_spans(data, np.array([0, len(data)]))
    assert [data[a:b].tobytes().decode() for a, b in zip(starts, ends)] == ["ab", "%%%", "12", "|", "é"]
    assert first.tolist() == [0, 5]
