"""Near-duplicate texts by multi-index hashing (problem 1).

Fingerprint of a text: SYMBOLS one-byte minwise values in SEGMENTS segments, and 128 further one-bit
minwise values. Two texts of similarity s agree in a symbol with probability s, in a bit with (1+s)/2.
Each segment is an index: its Hamming ball of radius 1 over symbols is enumerated by leaving out one
position in turn, so two texts meet in the table of a segment iff they differ there in at most one
symbol. Pairs that meet are kept if the complete distance over the 128 bits is at most MAX_BITS, and
their similarity is then computed exactly from the texts. One-byte symbols instead of bits keep the
tables selective: at similarity 0.1, seven agreeing bits are common, seven agreeing symbols are not.

Texts with the same word multiset are one class throughout; only class representatives (the smallest
id) enter the index, so a group of copies holding a third of all rows is one entry. Nothing is capped.

Chance to miss a pair of similarity s: (1 - s^7 - 7(1-s)s^6)^SEGMENTS, 0.9 % at 0.75, 0.1 % at 0.8
and under 0.005 % from 0.85 on with the defaults.

Null texts and texts without a word have no similarity to anything and take no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from derlem.llm.components import connected_components
from derlem.llm.words import Minwise, counts, similarity
from derlem.session import materialize

SEGMENTS, SEGMENT = 8, 7
SYMBOLS = SEGMENTS * SEGMENT
BITS = 128
MAX_BITS = 36  # of 128; at similarity 0.75 16 differ on average, with a deviation of 3.7
SEED = 20_011
BLOCK = 1024


def signatures(texts: DataFrame) -> DataFrame:
    """texts(id, text) -> (id, w1, w2, fp, s1, s2) for each text with a word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        minwise = Minwise(SYMBOLS + BITS, SEED)
        for batch in batches:
            ids, values = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for at in range(0, len(ids), BLOCK):
                rows = [(i, b) for i, t in zip(ids[at : at + BLOCK], values[at : at + BLOCK]) if t and (b := counts(t))]
                if not rows:
                    continue
                m, digests = minwise([b for _, b in rows])
                fp = (m[:, :SYMBOLS] & 255).astype(np.uint8)
                bits = packed_bits(m[:, SYMBOLS:])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([i for i, _ in rows], pa.int64()),
                        pa.array(digests[:, 0]),
                        pa.array(digests[:, 1]),
                        pa.array([r.tobytes() for r in fp], pa.binary()),
                        pa.array(bits[:, 0]),
                        pa.array(bits[:, 1]),
                    ],
                    names=["id", "w1", "w2", "fp", "s1", "s2"],
                )

    return texts.select("id", "text").mapInArrow(run, "id long, w1 long, w2 long, fp binary, s1 long, s2 long")


def class_table(sig: DataFrame, *extra: str) -> tuple[DataFrame, DataFrame]:
    """(reps, members): one representative per word multiset (and extra columns), and id -> rep of all."""
    keys = [*extra, "w1", "w2"]
    reps = sig.groupBy(*keys).agg(F.min("id").alias("rep"), F.count("*").alias("copies"))
    members = sig.select("id", *keys).join(reps, keys).select("id", "rep", "copies", *extra)
    return reps, members


def packed_bits(m: np.ndarray) -> np.ndarray:
    """int64 [n, 2] of the lowest bits of 128 minwise values each."""
    return np.packbits((m & 1).astype(np.uint8), axis=1).view(">i8").astype(np.int64)


def distance(x: str, y: str) -> F.Column:
    """Hamming distance of the 128 bits (s1, s2) of two aliases."""
    return F.bit_count(F.col(f"{x}.s1").bitwiseXOR(F.col(f"{y}.s1"))) + F.bit_count(F.col(f"{x}.s2").bitwiseXOR(F.col(f"{y}.s2")))


def ball_keys() -> F.Column:
    """The keys of a fingerprint: for each segment and each position left out, a hash of the rest."""
    out = []
    for s in range(SEGMENTS):
        for p in range(SEGMENT):
            first = s * SEGMENT
            head, tail = F.substring("fp", first + 1, p), F.substring("fp", first + p + 2, SEGMENT - p - 1)
            out.append(F.xxhash64(F.lit(first + p), head, tail))
    return F.array(*out)


@F.pandas_udf(T.DoubleType())
def exact_similarity(a, b):
    import pandas as pd

    memo: dict[str, dict[str, int]] = {}

    def bag(t: str) -> dict[str, int]:
        if t not in memo:
            if len(memo) > 5000:
                memo.clear()
            memo[t] = counts(t)
        return memo[t]

    return pd.Series([similarity(bag(x), bag(y)) for x, y in zip(a, b)], dtype="float64")


def verified(pairs: DataFrame, left: DataFrame, right: DataFrame, threshold: float) -> DataFrame:
    """pairs(a, b) with the exact similarity of the texts of left(id, text) and right(id, text), if large enough."""
    one = left.join(pairs.select(F.col("a").alias("id")).distinct(), "id", "left_semi").select(F.col("id").alias("a"), F.col("text").alias("ta"))
    two = right.join(pairs.select(F.col("b").alias("id")).distinct(), "id", "left_semi").select(F.col("id").alias("b"), F.col("text").alias("tb"))
    return (
        pairs.join(one, "a").join(two, "b")
        .select("a", "b", exact_similarity("ta", "tb").alias("similarity"))
        .filter(F.col("similarity") >= threshold)
    )


def near_duplicates(texts: DataFrame, threshold: float = 0.75) -> tuple[DataFrame, DataFrame]:
    """texts(id unique, text) -> (links, members).

    links(a, b, similarity), a < b: every pair of class representatives found with at least that
    similarity; members(id, rep, copies): the class of every text that has a word.
    """
    texts = texts.select("id", "text")
    sig = materialize(signatures(texts), "neardup-sig")
    reps, members = class_table(sig)
    heads = reps.select("w1", "w2", F.col("rep").alias("id")).join(sig, ["w1", "w2", "id"]).select("id", "fp", "s1", "s2")
    entries = heads.select("id", "s1", "s2", F.explode(ball_keys()).alias("key"))
    x, y = entries.alias("x"), entries.alias("y")
    met = (
        x.join(y, (F.col("x.key") == F.col("y.key")) & (F.col("x.id") < F.col("y.id")) & (distance("x", "y") <= MAX_BITS))
        .select(F.col("x.id").alias("a"), F.col("y.id").alias("b"))
        .distinct()
    )
    met = materialize(met, "neardup-met")
    return verified(met, texts, texts, threshold), members


def all_pairs(links: DataFrame, members: DataFrame) -> DataFrame:
    """Pairs (a, b), a < b, of rows: links between classes expanded to their members, and the pairs within classes."""
    m = members.select("id", "rep", "copies")
    across = (
        links.select("a", "b")
        .join(m.select(F.col("rep").alias("a"), F.col("id").alias("x")), "a")
        .join(m.select(F.col("rep").alias("b"), F.col("id").alias("y")), "b")
        .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
    )
    many = m.filter("copies > 1")
    within = many.alias("x").join(many.alias("y"), (F.col("x.rep") == F.col("y.rep")) & (F.col("x.id") < F.col("y.id")))
    return across.unionByName(within.select(F.col("x.id").alias("a"), F.col("y.id").alias("b")))


def groups(links: DataFrame, members: DataFrame) -> DataFrame:
    """(id, rep, group, links): one row per text; group is the smallest id of its component, links the number of
    other classes its own class is linked to."""
    comp = connected_components(links.select("a", "b"))
    degree = links.select(F.explode(F.array("a", "b")).alias("rep")).groupBy("rep").agg(F.count("*").alias("links"))
    return (
        members.join(comp.select(F.col("node").alias("rep"), F.col("component")), "rep", "left")
        .join(degree, "rep", "left")
        .select("id", "rep", F.coalesce("component", "rep").alias("group"), F.coalesce("links", F.lit(0)).cast("long").alias("links"))
    )
