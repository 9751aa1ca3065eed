from __future__ import annotations

import numpy as np
import pyarrow as pa
from hypothesis import given, strategies as st

from docstrata.llm.words import Hasher, Spans, Words, alphanumeric, buffers, chunks, not_space

TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet="aB9 \t\n.é\xa0\x00", max_size=30)), max_size=8)


def parse(texts, member, fold, limit):
    hasher = Hasher(member, 3, fold)
    data, offsets = buffers(pa.array(texts, pa.string()))
    out = []
    for low, high in chunks(offsets, limit):
        part = data[offsets[low] : offsets[high]]
        words = Words(part, offsets[low : high + 1] - offsets[low], member)
        hashes = words.hashes(hasher)
        spelled = [bytes(part[s:e]) for s, e in zip(words.starts, words.ends, strict=True)]
        for a, b in zip(words.first[:-1], words.first[1:], strict=True):
            out.append((spelled[a:b], hashes[a:b].tolist()))
    return out


@given(TEXTS, st.integers(1, 40))
def test_words_are_those_of_split(texts, limit):
    found = parse(texts, not_space(), False, limit)
    assert [w for w, _ in found] == [(t or "").encode().split() for t in texts]


@given(TEXTS)
def test_equal_words_have_equal_hashes_wherever_they_stand(texts):
    names: dict[bytes, int] = {}
    for limit in (1, 1000):
        for words, hashes in parse(texts, alphanumeric(), True, limit):
            for word, name in zip(words, hashes, strict=True):
                assert names.setdefault(word.lower(), name) == name
    assert len(set(names.values())) == len(names)


def test_spans_name_runs_of_words():
    words = np.array([7, 8, 9, 7, 8, 9, 7], np.uint64)
    spans = Spans(words, 1)
    at = spans(np.array([0, 3, 1, 0]), np.array([3, 6, 4, 2]))
    assert at[0] == at[1] and len(set(at.tolist())) == 3
