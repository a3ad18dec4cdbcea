"""Records that differ only in formatting (problem 5): Merkle-style bottom-up hashing.

Leaves are normalised texts: NFC, case ignored (i, ı, İ, I alike), only letters and digits kept.
A message node hashes its stem leaf (its lines that are no options, in order) with the sorted digests
of its option leaves (letter and text); the root hashes the sorted digests of its messages, each with
its role. Rows with equal root digest are confirmed by comparing the canonical structures themselves.

A record without an assistant message (missing, null) equals only records that lack one, too. Null
messages and null contents count as lacking; extra messages of other roles enter like the two.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from derlem.llm.words import fold
from derlem.session import materialize

DROP = re.compile(r"[\W_]+")
OPTION = re.compile(r"^\W*([A-Ea-e])\s*[).:\-–](?=\s|$)\s*(.*)$", re.S)
INLINE = re.compile(r"(?:(?<=\s)|^)\(?([A-Ea-e])\s*[).](?=\s)|(?:(?<=\s)|^)([A-Ea-e]) - ")


def leaf(text: str) -> str:
    return DROP.sub("", fold(text))


def split_options(text: str) -> tuple[list[str], list[tuple[str, str]]]:
    """(other parts in order, option (letter, text) pairs)."""
    rest, options = [], []
    for line in text.replace("\r", "\n").split("\n"):
        m = OPTION.match(line)
        if m and leaf(m[2]):
            options.append((m[1].upper(), m[2]))
        elif line.strip():
            rest.append(line)
    return rest, options


def message_parts(text: str) -> tuple[str, tuple[str, ...]]:
    """(stem, sorted options) in canonical form. A continuation line after an option belongs to the stem."""
    rest, options = split_options(text)
    if len(options) < 2:  # options that run on in one line
        joined = " ".join(text.split())
        cut = [m for m in INLINE.finditer(joined)]
        if len({(m[1] or m[2]).upper() for m in cut}) >= 3:
            ends = [m.start() for m in cut[1:]] + [len(joined)]
            return leaf(joined[: cut[0].start()]), tuple(sorted((m[1] or m[2]).lower() + ":" + leaf(joined[m.end() : e]) for m, e in zip(cut, ends)))
    return leaf(" ".join(rest)), tuple(sorted(k.lower() + ":" + leaf(t) for k, t in options))


def canonical(messages: list[dict] | None) -> list[str]:
    """The sorted canonical messages: what two records must share to be the same."""
    out = []
    for m in messages or []:
        if m is None or m["content"] is None:
            continue
        if m["role"] == "user":
            stem, options = message_parts(m["content"])
        else:
            stem, options = leaf(m["content"]), ()
        out.append("\x1f".join((str(m["role"]), stem, *options)))
    return sorted(out)


def digest(*parts: bytes) -> bytes:
    h = hashlib.blake2b(digest_size=16)
    for p in parts:
        h.update(len(p).to_bytes(8, "big"))
        h.update(p)
    return h.digest()


def root_digest(messages: list[str]) -> bytes:
    """Bottom up: leaf digests, sorted children at unordered nodes, then the root."""
    nodes = []
    for m in messages:
        role, stem, *options = m.split("\x1f")
        children = sorted(digest(b"option", o.encode("utf-8", "surrogatepass")) for o in options)
        nodes.append(digest(b"message", role.encode(), digest(b"stem", stem.encode("utf-8", "surrogatepass")), *children))
    return digest(b"record", *sorted(nodes))


def hashed(records: DataFrame, with_structure: bool) -> DataFrame:
    """records(id, messages) -> (id, root[, structure])."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            forms = [canonical(m) for m in batch.column(1).to_pylist()]
            cols = [batch.column(0), pa.array([root_digest(f) for f in forms], pa.binary())]
            if with_structure:
                cols.append(pa.array(["\x1e".join(f) for f in forms], pa.string()))
            yield pa.RecordBatch.from_arrays(cols, names=["id", "root", "structure"][: len(cols)])

    return records.select("id", "messages").mapInArrow(run, "id long, root binary" + ", structure string" * with_structure)


def formatting_duplicates(records: DataFrame) -> DataFrame:
    """records(id unique, messages) -> (id, first, copies) of each record that has a twin.

    Digests alone are shuffled first; only rows whose digest occurs twice are canonicalised again and
    compared as a whole: rows of one digest but different structure fall apart into their own sets.
    """
    roots = materialize(hashed(records, False), "merkle-roots")
    twice = roots.groupBy("root").agg(F.count("*").alias("n"), F.min("id").alias("least")).filter("n > 1")
    ids = roots.join(twice.select("root"), "root", "left_semi").select("id")
    full = materialize(hashed(records.join(ids, "id", "left_semi"), True), "merkle-full")
    sets = full.groupBy("root", "structure").agg(F.min("id").alias("first"), F.count("*").alias("copies"))
    sets = sets.filter("copies > 1")
    return full.join(sets, ["root", "structure"]).select("id", "first", "copies")
