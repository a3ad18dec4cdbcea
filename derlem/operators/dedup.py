"""Exact deduplication, contradictions and decontamination over keyed records."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def keep_longest(records: DataFrame, key: str, text: str, tie: str, source: str) -> DataFrame:
    """records -> (key, kept tie, copies, sources): the longest text per key, the smallest tie on equal lengths.

    One aggregation with map-side combine; a key holding a third of all rows costs no more than any other,
    only its set of sources is gathered.
    """
    best = F.max_by(F.col(tie), F.struct(F.length(text), -F.col(tie)))
    return records.groupBy(key).agg(best.alias(tie), F.count("*").alias("copies"), F.array_sort(F.collect_set(source)).alias("sources"))


def settled(records: DataFrame, key: str, answer: str, text: str, tie: str, source: str) -> DataFrame:
    """keep_longest over the records whose key has one answer; keys with contradicting answers are left out as a whole."""
    clash = records.filter(F.col(answer).isNotNull()).groupBy(key).agg(F.min(answer).alias("_a"), F.max(answer).alias("_z")).filter("_a <> _z").select(key)
    return keep_longest(records.join(clash, key, "left_anti"), key, text, tie, source)


def preferred_copies(files: DataFrame, first: str) -> DataFrame:
    """files(path, root-relative rel, md5) -> (path, keep) of each file that is the copy of another: the one kept of byte-identical files is no
    "(1)" of another, in the folder `first`, and the first by path, in that order."""
    rank = F.struct(F.substring_index("rel", "/", -1).contains("(1)"), F.substring_index("rel", "/", 1) != first, F.col("path"))
    best = files.groupBy("md5").agg(F.min_by("path", rank).alias("keep"), F.count("*").alias("n")).filter("n > 1")
    return files.join(best, "md5").filter("path <> keep").select("path", "keep")


def contradictions(records: DataFrame, key: str, answer: str) -> DataFrame:
    """Rows whose key has more than one distinct answer, with those answers. The answers per key are few, rows are joined back."""
    many = records.filter(F.col(answer).isNotNull()).groupBy(key).agg(F.array_join(F.array_sort(F.collect_set(answer)), "").alias("letters")).filter("length(letters) > 1")
    return records.join(many, key)


def losers(records: DataFrame, key: str, winner: DataFrame, tie: str) -> DataFrame:
    """The rows that are not the winner of their key."""
    return records.join(winner.select(tie), tie, "left_anti")


def without(records: DataFrame, *others: DataFrame, on: str) -> DataFrame:
    """records whose key is in none of the others."""
    for o in others:
        records = records.join(o.select(on).distinct(), on, "left_anti")
    return records


def with_reasons(records: DataFrame, key: str, lists: dict[str, DataFrame]) -> DataFrame:
    """records with `sebep`: the name of the first list that holds their key, null if none does."""
    out = records
    for name, df in lists.items():
        out = out.join(df.select(key).distinct().withColumn(f"_{name}", F.lit(name)), key, "left")
    return out.withColumn("sebep", F.coalesce(*[F.col(f"_{n}") for n in lists])).drop(*[f"_{n}" for n in lists])


def leakage(sets: dict[str, DataFrame], key: str) -> DataFrame:
    """(sol, sag, ortak) for each pair of sets: keys held by both. One aggregation over all sets, no pairwise joins."""
    names = list(sets)
    tagged = None
    for i, n in enumerate(names):
        df = sets[n].select(F.col(key).alias("k")).filter("k is not null").withColumn("s", F.lit(i))
        tagged = df if tagged is None else tagged.unionByName(df)
    held = tagged.groupBy("k").agg(F.collect_set("s").alias("s"))
    pairs = [(i, j) for i in range(len(names)) for j in range(i + 1, len(names))]
    sums = [F.count_if(F.array_contains("s", i) & F.array_contains("s", j)).alias(f"{i}_{j}") for i, j in pairs]
    wide = held.agg(*sums)
    rows = [F.struct(F.lit(names[i]).alias("sol"), F.lit(names[j]).alias("sag"), F.col(f"{i}_{j}").alias("ortak")) for i, j in pairs]
    return wide.select(F.inline(F.array(*rows)))
