import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from loadlens.llm import texts as T

TEXT = st.text(st.sampled_from("aAbÉé \t\n.x\x0b"), max_size=30)


def split(text):
    low = text.translate({i: i + 32 for i in range(65, 91)})
    return [w for w in re.split("[\x20\x09-\x0d]+", low) if w]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.none() | TEXT, max_size=8))
def test_word_hashes_tell_words_apart(rows):
    h, off = T.word_hashes(*T.utf8(pa.array(rows, pa.string())))
    words = [w for r in rows for w in split(r or "")]
    assert [int(b - a) for a, b in zip(off[:-1], off[1:])] == [len(split(r or "")) for r in rows]
    assert len(h) == len(words)
    seen = {}
    for x, w in zip(h.tolist(), words):
        assert seen.setdefault(w, x) == x
    assert len(set(seen.values())) == len(seen)


@settings(max_examples=60, deadline=None)
@given(st.lists(TEXT, max_size=8))
def test_shingle_sets_have_the_sizes_of_the_real_sets(rows):
    sets = T.shingle_sets(*T.utf8(pa.array(rows, pa.string())))
    for row, s in zip(rows, sets):
        w = split(row)
        want = {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
        assert len(s) == len(want)
        assert (np.diff(s.astype(object)) > 0).all() if len(s) > 1 else True


def test_slices_keep_all_rows_in_order_and_bound_their_bytes():
    texts = ["x" * n for n in (3, 0, 50, 7, 7, 7, 200, 1)] + [None]
    table = pa.table({"text": pa.array(texts, pa.string()), "k": list(range(len(texts)))})
    for limit in (1, 10, 60, 1000):
        got = list(T.slices(table.to_batches(max_chunksize=4), limit=limit))
        assert [k for t in got for k in t["k"].to_pylist()] == list(range(len(texts)))
        for t in got:
            size = sum(len(x or "") for x in t["text"].to_pylist())
            assert size <= limit or t.num_rows == 1 or size - max(len(x or "") for x in t["text"].to_pylist()) <= limit


def test_planes_round_trip():
    x = np.array([0, 1, 255, 256, 2 ** 31, 77])
    assert (T.unplanes(T.planes(x, 5), 5) == x).all()
