from __future__ import annotations

import os
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from derlem.llm import bpe
from tests.conftest import rows

if not os.path.exists(bpe.VOCABULARY):
    pytest.skip("no vocabulary", allow_module_level=True)


@pytest.fixture(scope="module")
def exact():
    import tiktoken

    return tiktoken.Encoding("own", pat_str=bpe.PATTERN, mergeable_ranks=bpe.read_ranks(bpe.VOCABULARY), special_tokens={})


@pytest.fixture(scope="module")
def encoder():
    return bpe.Encoder()


@settings(max_examples=120, deadline=None)
@given(st.text(max_size=60))
def test_equals_the_library(encoder, exact, text):
    assert encoder.encode([text])[0] == exact.encode_ordinary(text)


def test_special_strings_blanks_and_long_words(encoder, exact):
    random.seed(3)
    texts = ["<|endoftext|>", " ", "\n\n \t", "ğ" * 500, "ab" * 3000, "a" * 5001, "".join(random.choices("abcdef", k=4000)), "İstanbul'da 2024 yılı!"]
    assert encoder.encode(texts) == [exact.encode_ordinary(t) for t in texts]


@pytest.mark.parametrize("script", ["abcçdeğ", "абвгдежз", "漢字仮名交文", "ابتثجحخ", "אבגדה", "กขคงจ", "0123456789", "-_=+*/", "😀😁👩\u200d🔬"])
def test_long_words_of_every_script(encoder, exact, script):
    random.seed(5)
    texts = ["".join(random.choices(script, k=n)) for n in (200, 257, 700, 3000)] + [script * 300, script[0] * 2001]
    assert encoder.encode(texts) == [exact.encode_ordinary(t) for t in texts]


def leftmost(ranks, word: bytes) -> list[int]:
    """The rule itself: the leftmost pair of the lowest rank, one at a time."""
    parts = [bytes([b]) for b in word]
    while True:
        pairs = [(ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in ranks]
        if not pairs:
            return [ranks[p] for p in parts]
        _, i = min(pairs)
        parts[i : i + 2] = [parts[i] + parts[i + 1]]


def test_rounds_are_the_leftmost_rule(encoder):
    ranks = bpe.read_ranks(bpe.VOCABULARY)
    random.seed(6)
    words = ["".join(random.choices("aeintrlkm", k=random.randrange(1, 40))) for _ in range(300)] + ["a" * n for n in range(1, 40)]
    assert encoder.encode(words) == [leftmost(ranks, w.encode()) for w in words]


def test_round_trip(encoder):
    back = {v: k for k, v in bpe.read_ranks(bpe.VOCABULARY).items()}
    text = "Ağrı, çocuk ve 12 mg/dL.\n\n  ﬁn"
    assert b"".join(back[i] for i in encoder.encode([text])[0]).decode() == text


def test_column(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (3, " "), (4, "the the")], "doc_id long, text string")
    assert rows(bpe.encode(df)) == [(1, []), (2, []), (3, [220]), (4, [1169, 262])]
    assert rows(bpe.encode(df, counts_only=True)) == [(1, 0), (2, 0), (3, 1), (4, 2)]
    assert bpe.encode(df.limit(0)).count() == 0
    with pytest.raises(FileNotFoundError):
        bpe.encode(df, "/none")
