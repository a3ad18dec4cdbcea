"""Same or near-same texts across splits (problem 3): minwise hashing with banded buckets.

Elements are the words of words.py with repetition (shingles of one word, since the similarity asked
for is that of word multisets). Each text gets BANDS keys of ROWS minwise values; texts of different
splits that share a key are candidates, pairs within a split are never formed. The held-out keys are put
into a bitmap of fixed size first, and training keys that are not in it are dropped where they are made: this
decides how much is shuffled, not what is found. Of those whose signatures differ in more than MAX_BITS of 128
bits none can be expected to reach the threshold; the rest is verified exactly. Texts with equal word multisets
are one class per split, so hot copies meet once.

Chance to miss a pair of similarity s: (1 - s^ROWS)^BANDS: 0.2 % at 0.75, 0.006 % at 0.8.
Null texts and texts without a word take no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from derlem.llm.neardup import BLOCK, MAX_BITS, class_table, distance, packed_bits, verified
from derlem.llm.words import Minwise, counts
from derlem.session import materialize

BANDS, ROWS, SEED = 32, 6, 30_011
FILTER_BITS = 27


def band_table(texts: DataFrame, bitmap: Broadcast | None = None) -> DataFrame:
    """texts(id, text) -> (id, w1, w2, keys array<long>, s1, s2); with a bitmap only keys in it, and only texts that have one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        minwise = Minwise(BANDS * ROWS, SEED)
        mix = (np.random.default_rng(SEED).integers(1, 1 << 62, BANDS * ROWS, dtype=np.int64).astype(np.uint64) << np.uint64(1)) | np.uint64(1)
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for at in range(0, len(ids), BLOCK):
                rows = [(i, b) for i, t in zip(ids[at : at + BLOCK], texts[at : at + BLOCK]) if t and (b := counts(t))]
                if not rows:
                    continue
                values, digests = minwise([b for _, b in rows])
                bits = packed_bits(values[:, :128])
                m = (values.astype(np.uint64) + np.uint64(1)) * mix[None, :]
                m ^= m >> np.uint64(29)
                keys = m.reshape(len(rows), BANDS, ROWS).sum(axis=2, dtype=np.uint64)
                keys = (keys ^ (keys >> np.uint64(32))) * mix[None, :BANDS]
                ends = np.arange(0, len(rows) * BANDS + 1, BANDS, dtype=np.int32)
                keys = keys.astype(np.int64)
                if bitmap is not None:
                    place = keys & ((1 << FILTER_BITS) - 1)
                    inside = (np.frombuffer(bitmap.value, np.uint8)[place >> 3] >> (place & 7).astype(np.uint8) & 1).astype(bool)
                    some = inside.any(axis=1)
                    rows, digests, bits = [r for r, x in zip(rows, some) if x], digests[some], bits[some]
                    keys, inside = keys[some], inside[some]
                    ends = np.concatenate([[0], np.cumsum(inside.sum(axis=1))]).astype(np.int32)
                    keys = keys[inside]
                flat = pa.array(keys.ravel())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([i for i, _ in rows], pa.int64()),
                        pa.array(digests[:, 0]),
                        pa.array(digests[:, 1]),
                        pa.ListArray.from_arrays(pa.array(ends), flat),
                        pa.array(bits[:, 0]),
                        pa.array(bits[:, 1]),
                    ],
                    names=["id", "w1", "w2", "keys", "s1", "s2"],
                )

    return texts.select("id", "text").mapInArrow(run, "id long, w1 long, w2 long, keys array<long>, s1 long, s2 long")


def key_bitmap(sig: DataFrame) -> bytes:
    """A bit for each key, by its last FILTER_BITS bits: 16 MB at most, whatever the number of keys."""
    place = F.explode("keys").alias("k")
    rows = sig.select(place).select(F.col("k").bitwiseAND(F.lit((1 << FILTER_BITS) - 1)).alias("p"))
    rows = rows.groupBy(F.shiftright("p", 15).alias("part")).agg(F.bitmap_construct_agg(F.col("p").bitwiseAND(F.lit(32767))).alias("m"))
    out = bytearray(1 << (FILTER_BITS - 3))
    for r in rows.toLocalIterator():  # at most 4096 rows of 4 kB
        out[r["part"] << 12 : (r["part"] + 1) << 12] = r["m"]
    return bytes(out)


def cross_split_overlaps(train: DataFrame, held_out: DataFrame, threshold: float = 0.75) -> tuple[DataFrame, DataFrame, DataFrame]:
    """train(id, text), held_out(id, text) -> (links(a, b, similarity), members of train, members of held_out).

    a is the representative of a train class, b that of a held-out class.
    """
    sides, bitmap = [], None
    for df, label in ((held_out, "held"), (train, "train")):
        sig = materialize(band_table(df, bitmap), f"overlap-{label}")
        if bitmap is None:
            bitmap = df.sparkSession.sparkContext.broadcast(key_bitmap(sig))
        reps, members = class_table(sig)
        heads = sig.join(reps.select("w1", "w2", F.col("rep").alias("id")), ["w1", "w2", "id"], "left_semi")
        sides.append((heads.select("id", "s1", "s2", F.explode("keys").alias("key")), members))
    (y, my), (x, mx) = sides
    meet = (F.col("x.key") == F.col("y.key")) & (distance("x", "y") <= MAX_BITS)
    met = x.alias("x").join(y.alias("y"), meet).select(F.col("x.id").alias("a"), F.col("y.id").alias("b")).distinct()
    met = materialize(met, "overlap-met")
    return verified(met, train.select("id", "text"), held_out.select("id", "text"), threshold), mx, my


def expand(links: DataFrame, left: DataFrame, right: DataFrame) -> DataFrame:
    """(a, b, similarity) of all rows of the linked classes."""
    return (
        links.join(left.select(F.col("rep").alias("a"), F.col("id").alias("x")), "a")
        .join(right.select(F.col("rep").alias("b"), F.col("id").alias("y")), "b")
        .select(F.col("x").alias("a"), F.col("y").alias("b"), "similarity")
    )
