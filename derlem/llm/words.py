"""Words, multiset similarity and minwise signatures shared by the near-duplicate operators.

A word is a longest run of letters and digits after NFC, ignoring case, with i, ı, İ and I as one
letter. A text is the multiset of its words; its elements are (word, n-th occurrence), so that the
Jaccard similarity of the element sets is the multiset similarity: shared words counted with
repetition over, for each word, the larger of both counts.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from itertools import chain

import numpy as np
import xxhash

WORD = re.compile(r"[^\W_]+")
PRIME = np.uint64((1 << 61) - 1)


def fold(text: str) -> str:
    if not text.isascii():
        text = unicodedata.normalize("NFC", text)
        text = text.replace("İ", "i").replace("ı", "i")  # far faster than translate()
    return text.casefold()


def words(text: str) -> list[str]:
    return WORD.findall(fold(text))


def counts(text: str) -> dict[str, int]:
    return Counter(words(text))


def similarity(a: dict[str, int], b: dict[str, int]) -> float:
    """Multiset Jaccard; two texts without words have none (0.0)."""
    if len(a) > len(b):
        a, b = b, a
    shared = sum(min(n, b[w]) for w, n in a.items() if w in b)
    union = sum(a.values()) + sum(b.values()) - shared
    return shared / union if union else 0.0


class Minwise:
    """k minwise hash values for each of many texts, vectorised over a batch."""

    def __init__(self, k: int, seed: int):
        rng = np.random.default_rng(seed)
        self.k = k
        self.a = (rng.integers(1, 1 << 62, k, dtype=np.int64).astype(np.uint64) << np.uint64(1)) | np.uint64(1)
        self.b = rng.integers(0, 1 << 62, k, dtype=np.int64).astype(np.uint64)
        self.first: dict[str, int] = {}

    def element_hashes(self, bag: dict[str, int]) -> list[int]:
        """A 64-bit hash of each (word, occurrence)."""
        first = self.first
        try:
            out = [first[w] for w in bag]
        except KeyError:
            if len(first) > 200_000:  # a memo, not a vocabulary: emptied when large
                first.clear()
            for w in bag:
                if w not in first:
                    first[w] = xxhash.xxh64_intdigest(w, 0)
            out = [first[w] for w in bag]
        if sum(bag.values()) > len(out):
            for w, n in bag.items():
                for k in range(1, n):
                    out.append(xxhash.xxh64_intdigest(w, k))
        return out

    def __call__(self, bags: list[dict[str, int]]) -> tuple[np.ndarray, np.ndarray]:
        """(uint32 [len(bags), k] minwise values, int64 [len(bags), 2] digests: equal multisets share theirs).

        bags must not be empty.
        """
        flat = [self.element_hashes(b) for b in bags]
        sizes = np.fromiter(map(len, flat), np.int64, len(flat))
        every = np.fromiter(chain.from_iterable(flat), np.uint64, int(sizes.sum()))
        starts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
        mixed = (every ^ (every >> np.uint64(29))) * self.a[0]
        digests = np.stack([np.add.reduceat(every, starts), np.add.reduceat(mixed ^ (mixed >> np.uint64(32)), starts)], axis=1).astype(np.int64)
        uniq, at = np.unique(every, return_inverse=True)
        out = np.empty((len(bags), self.k), np.uint32)
        for i in range(0, self.k, 16):  # blocks of hash functions keep the work in the cache
            h = ((uniq[:, None] * self.a[None, i : i + 16] + self.b[None, i : i + 16]) >> np.uint64(32)).astype(np.uint32)
            out[:, i : i + 16] = np.minimum.reduceat(h[at], starts, axis=0)
        return out, digests
