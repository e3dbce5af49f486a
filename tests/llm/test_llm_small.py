"""Small checks without Spark of how batches are cut and keys are packed."""

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from mercato.llm import exchange
from mercato.llm.words import steps, tokenise


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(max_size=12)), max_size=30), st.integers(1, 20))
def test_steps_hold_every_text_once(texts, most):
    column = pa.array(texts, pa.string())
    got = list(steps(column, most))
    assert [t for _, _, part in got for t in part] == [(t or "").encode() for t in texts]
    assert all(b - a == len(part) and (sum(map(bool, part)) <= 1 or sum(map(len, part)) <= most) for a, b, part in got)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 2**64 - 1), st.integers(0, 2**24 - 1)), max_size=60), st.integers(1, 9))
def test_packed_keys_come_back(keys, n):
    one = np.array([k[0] for k in keys], np.uint64)
    two = np.array([k[1] for k in keys], np.uint32)
    a, b, times, where = exchange._distinct(one, two)
    assert sorted(set(keys)) == sorted(zip(a.tolist(), b.tolist())) and times.sum() == len(keys)
    assert all((a[w], b[w]) == k for w, k in zip(where.tolist(), keys))
    at = exchange._ranges(a, n)
    assert at[0] == 0 and at[-1] == len(a)
    for k in range(n):
        if at[k] < at[k + 1]:
            c, d = exchange._unpack(exchange._pack(a[at[k]:at[k + 1]], b[at[k]:at[k + 1]]))
            assert (c == a[at[k]:at[k + 1]]).all() and (d == b[at[k]:at[k + 1]]).all()


@settings(max_examples=100, deadline=None)
@given(st.lists(st.binary(max_size=20), max_size=10))
def test_tokenise_is_split(texts):
    ids, uniq, lens = tokenise(texts)
    assert [uniq[i] for i in ids] == [w for t in texts for w in t.split()]
    assert lens.tolist() == [len(t.split()) for t in texts]
