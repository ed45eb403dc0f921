"""Word and span arrays against plain Python."""

import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from tokenloom.llm.words import SpanHash, Words, chunks

texts = st.lists(st.one_of(st.none(), st.text(alphabet="ab é\t\n\r\x0b\x0c\x1c  漢", max_size=30)), max_size=8)


@settings(max_examples=200, deadline=None)
@given(texts)
def test_words_match_regex(values):
    w = Words(pa.array(values, pa.string()))
    data = w.data.tobytes()
    for r, v in enumerate(values):
        own = [data[a:b].decode() for a, b in zip(w.start[w.rows[r]:w.rows[r + 1]], w.end[w.rows[r]:w.rows[r + 1]])]
        assert own == re.findall(r"[^\x20\x09-\x0D]+", v or "")


def test_hashes_depend_on_content_only():
    a = Words(pa.array(["Foo bar foo", "x foo"])).hashes()
    assert a[2] == a[4] and a[0] != a[2]
    folded = Words(pa.array(["Foo bar foo", "x foo"])).hashes(fold=True)
    assert folded[0] == folded[2] == folded[4]
    s = SpanHash(np.array([5, 6, 5, 6], np.uint64))
    assert s.of(np.array([0]), np.array([2])) == s.of(np.array([2]), np.array([4]))


def test_sliced_arrays_and_chunks():
    a = pa.array(["one two", None, "three", ""]).slice(1, 3)
    assert Words(a).rows.tolist() == [0, 0, 1, 1]
    assert list(chunks(pa.array(["x" * 10, "y" * 50, "z"]), 20)) == [(0, 1), (1, 2), (2, 3)]
    assert list(chunks(pa.array([], pa.string()))) == []
