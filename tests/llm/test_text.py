import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tallyhouse.llm import text as tx
from tests.llm.cases import ALNUM, LOWER, SPACED

TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet="aB 9_-\n\t\x00é字\x0b")), max_size=12)


@pytest.mark.parametrize("pattern, table", [(SPACED, tx.SPACED), (ALNUM, tx.ALNUM)])
@settings(deadline=None)
@given(texts=TEXTS, most=st.integers(1, 20))
def test_words_and_lines_are_those_of_the_pattern(pattern, table, texts, most):
    found, lines = [], []
    for part in tx.slices(pa.array(texts, pa.string()), most):
        data = tx.LOWER[part.data]
        w = tx.words(data, part.bounds, table)
        split = tx.lines(data, part.bounds)
        for i in range(part.rows):
            own = range(w.first[i], w.first[i + 1])
            found.append([data[w.starts[k] : w.ends[k]].tobytes().decode() for k in own])
            own = range(split.first[i], split.first[i + 1])
            lines.append([data[split.starts[k] : split.ends[k]].tobytes().decode() for k in own])
    lowered = [(t or "").translate(LOWER) for t in texts]
    assert found == [re.findall(pattern, t) for t in lowered]
    assert lines == [t.split("\n") for t in lowered]


def test_equal_spans_have_equal_hashes_and_others_differ():
    data = np.frombuffer(b"abcabcabdabc" * 50, np.uint8)
    h = tx.Hashes(data)
    starts = np.arange(len(data) - 5)
    hashes = h.spans(starts, starts + 5)
    strings = [data[s : s + 5].tobytes() for s in starts]
    assert len(set(zip(strings, hashes.tolist(), strict=True))) == len(set(strings)) == len(set(hashes.tolist()))


def thue_morse(n: int) -> tuple[bytes, bytes]:
    """Two strings of n bytes whose polynomial hashes modulo 2**64 agree for any odd base."""
    bits = [bin(i).count("1") & 1 for i in range(n)]
    return bytes(97 + b for b in bits), bytes(98 - b for b in bits)


def test_span_hashes_tell_constructed_texts_apart():
    for n in (1, 7, 8, 9, 100, tx.LONG_SPAN, 1024, 4096):
        x, y = thue_morse(n)
        data = np.frombuffer(x + b" " + y + b" " + x, np.uint8)
        starts = np.array([0, n + 1, 2 * n + 2])
        a, b, c = tx.span_hashes(data, starts, starts + n).tolist()
        assert a == c != b
    assert len(tx.span_hashes(np.empty(0, np.uint8), np.empty(0, np.int64), np.empty(0, np.int64))) == 0


@settings(deadline=None)
@given(texts=st.lists(st.binary(max_size=40), max_size=12))
def test_span_hashes_are_equal_for_equal_spans_only(texts):
    ends = np.cumsum([len(t) for t in texts], dtype=np.int64)
    starts = ends - np.array([len(t) for t in texts], np.int64)
    found = tx.span_hashes(np.frombuffer(b"".join(texts), np.uint8), starts, ends).tolist()
    assert len(set(zip(texts, found, strict=True))) == len(set(texts)) == len(set(found))
