"""Encoding texts with a public byte-level BPE vocabulary (problem 8), by recursive SQL.

Each task keeps the merge table in an in-process DuckDB. The words a batch brings that the task has
not met yet become rows (word, position, token), one per byte. A recursive query joins neighbouring
rows with the merge table and contracts each word's pairs of the lowest rank, leftmost first, until no pair of
the word is in the table; an ordered aggregate then gives the word's ids. A round contracts all pairs of the
lowest rank, of pairs that overlap every other one from the left: that is what contracting the leftmost one
again and again comes to, since a pair that a merge makes holds the merged token and so ranks above it (a
token ranks above its parts). ROUNDS rounds at a time bound the rows held; words with pairs left go on.

Texts are split into words by the vocabulary's public pattern first, as merges never cross words.

Null and empty texts give an empty list; blank texts are encoded as they are. No special tokens: their
strings are ordinary text. The vocabulary's path is a parameter; it is read where it lies.
"""

from __future__ import annotations

import base64
import os
from collections.abc import Iterator

import duckdb
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: fixed value: the published pattern of this vocabulary
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
KNOWN = 300_000
CHUNK = 20_000

ROUNDS = 40

CONTRACT = f"""
WITH RECURSIVE state(round, word, pos, token) AS (
    SELECT 0, word, pos, token FROM start
    UNION ALL
    SELECT round + 1, word, row_number() OVER (PARTITION BY word ORDER BY pos), CASE WHEN here THEN merged ELSE token END
    FROM (
        SELECT *, coalesce(lag(here) OVER (PARTITION BY word ORDER BY pos), false) AS gone
        FROM (
            SELECT *, hit AND row_number() OVER (PARTITION BY word, hit, run ORDER BY pos) % 2 = 1 AS here
            FROM (
                SELECT *, pos - row_number() OVER (PARTITION BY word, hit ORDER BY pos) AS run
                FROM (
                    SELECT *, coalesce(merged = best, false) AS hit
                    FROM (
                        SELECT n.round, n.word, n.pos, n.token, m.merged, min(m.merged) OVER (PARTITION BY n.word) AS best
                        FROM (SELECT *, lead(token) OVER (PARTITION BY word ORDER BY pos) AS following FROM state) n
                        LEFT JOIN merges m ON m.a = n.token AND m.b = n.following
                    )
                    WHERE best IS NOT NULL
                )
            )
        )
    )
    WHERE NOT gone AND round < {ROUNDS}
)
SELECT word, list(token ORDER BY pos) AS ids, final = {ROUNDS} AS unfinished
FROM (SELECT *, max(round) OVER (PARTITION BY word) AS final FROM state)
WHERE round = final
GROUP BY word, final
"""


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def merge_rows(ranks: dict[bytes, int]) -> list[tuple[int, int, int]]:
    """(a, b, merged): all pairs of tokens whose concatenation is a token; its id is the pair's rank."""
    out = []
    for token, rank in ranks.items():
        for i in range(1, len(token)):
            a, b = ranks.get(token[:i]), ranks.get(token[i:])
            if a is not None and b is not None:
                out.append((a, b, rank))
    return out


class Encoder:
    """One per Python worker; words met are remembered, up to KNOWN of them."""

    def __init__(self, path: str = VOCABULARY):
        ranks = read_ranks(path)
        self.byte = [ranks[bytes([i])] for i in range(256)]
        self.db = duckdb.connect(":memory:")
        self.db.execute("SET threads TO 1")
        self.db.execute("SET memory_limit = '400MB'")
        rows = merge_rows(ranks)
        merges = pa.table({"a": pa.array([r[0] for r in rows], pa.int32()), "b": pa.array([r[1] for r in rows], pa.int32()), "merged": pa.array([r[2] for r in rows], pa.int32())})
        self.db.register("merge_rows", merges)
        self.db.execute("CREATE TABLE merges AS SELECT * FROM merge_rows")
        self.db.unregister("merge_rows")
        self.pattern = regex.compile(PATTERN)
        self.known: dict[str, list[int]] = {}

    def learn(self, words: list[str]) -> None:
        """Encode words by the recursive query, in chunks of bounded size; one longer than a chunk is its own."""
        size, chunk = 0, []
        for w in words:
            b = w.encode("utf-8", "replace")
            if chunk and size + len(b) > CHUNK * 8:
                self._learn(chunk)
                size, chunk = 0, []
            size += len(b)
            chunk.append((w, [self.byte[x] for x in b]))
        if chunk:
            self._learn(chunk)

    def _learn(self, chunk: list[tuple[str, list[int]]]) -> None:
        while chunk:
            start = pa.table(
                {
                    "word": pa.array([k for k, (_, ids) in enumerate(chunk) for _ in ids], pa.int32()),
                    "pos": pa.array([i for _, ids in chunk for i in range(1, len(ids) + 1)], pa.int64()),
                    "token": pa.array([x for _, ids in chunk for x in ids], pa.int32()),
                }
            )
            self.db.register("start", start)
            got = self.db.execute(CONTRACT).fetchall()
            self.db.unregister("start")
            self.known.update((chunk[k][0], ids) for k, ids, more in got if not more)
            chunk = [(chunk[k][0], ids) for k, ids, more in got if more]

    def encode(self, texts: list[str | None]) -> list[list[int]]:
        split = [self.pattern.findall(t) if t else [] for t in texts]
        if len(self.known) > KNOWN:
            self.known.clear()
        new = {w for ws in split for w in ws} - self.known.keys()
        if new:
            self.learn(sorted(new))
        known = self.known
        return [[i for w in ws for i in known[w]] for ws in split]


_encoder: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _encoder:
        _encoder.clear()
        _encoder[path] = Encoder(path)
    return _encoder[path]


def encode(texts: DataFrame, path: str = VOCABULARY, counts_only: bool = False, keep: tuple[str, ...] = ()) -> DataFrame:
    """texts(doc_id, text, *keep) -> (doc_id, *keep, ids array<int>), or (doc_id, *keep, tokens) with counts_only."""
    if not os.path.exists(path):
        raise FileNotFoundError(path)
    known = texts.select("doc_id", *keep, "text")
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in known.schema.fields[1:-1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(path)
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                ids = e.encode(part.column(len(keep) + 1).to_pylist())
                last = pa.array([len(x) for x in ids], pa.int64()) if counts_only else pa.array(ids, pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], last], names=["doc_id", *keep, "tokens" if counts_only else "ids"])

    return known.mapInArrow(run, f"doc_id long, {fields}{', ' * bool(keep)}" + ("tokens long" if counts_only else "ids array<int>"))
