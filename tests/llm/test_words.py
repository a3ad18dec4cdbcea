from __future__ import annotations

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from derlem.llm.words import Minwise, counts, similarity, words


def test_words():
    assert words("IŞIK ışık Işık g\u0306 A1_b-2") == ["işik", "işik", "işik", "ğ", "a1", "b", "2"]
    assert words("I\u0307l İl il ıl") == ["il"] * 4
    assert words("") == []


@settings(max_examples=80, deadline=None)
@given(st.lists(st.sampled_from("abcde"), max_size=12), st.lists(st.sampled_from("abcde"), max_size=12))
def test_similarity_is_multiset_jaccard(a, b):
    x, y = counts(" ".join(a)), counts(" ".join(b))
    union = sum(max(x[k], y[k]) for k in {*x, *y})
    want = sum(min(x[k], y[k]) for k in {*x, *y}) / union if union else 0.0
    assert similarity(x, y) == want


def test_minwise_estimates_similarity():
    m = Minwise(512, 1)
    a = counts(" ".join(f"w{i}" for i in range(90)) + " x x x")
    b = counts(" ".join(f"w{i}" for i in range(80)) + " x x")
    values, digests = m([a, b, a])
    assert abs((values[0] == values[1]).mean() - similarity(a, b)) < 0.06
    assert (values[0] == values[2]).all() and (digests[0] == digests[2]).all() and (digests[0] != digests[1]).any()
    again, _ = Minwise(512, 1)([b])
    assert np.array_equal(again[0], values[1])  # no matter what came before
