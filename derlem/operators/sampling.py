"""Deterministic holdouts, shards, priorities and order statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from derlem.session import materialize


def first_by_hash(df: DataFrame, key: str, n: int) -> DataFrame:
    """The n rows with the smallest keys (a hash): the same rows on every run."""
    return df.orderBy(key).limit(n)


def stratified_holdout(df: DataFrame, group: str, key: str, n: int, salts: int = 64) -> DataFrame:
    """n rows shared over groups by size: max(1, round half even(n * size / all)) each, smallest keys first.

    Groups come by their smallest key; the concatenation is cut at n. Rows are ranked within salted parts of
    their group first and only each part's first quota rows again as a whole, so a group of any size is
    sorted in `salts` tasks.
    """
    sizes = df.groupBy(group).agg(F.count("*").alias("_n"), F.min(key).alias("_first"))
    total = sizes.agg(F.sum("_n").alias("_all"))
    quota = sizes.join(F.broadcast(total)).withColumn("_q", F.greatest(F.lit(1), F.bround(F.lit(float(n)) * F.col("_n") / F.col("_all"), 0).cast("int")))
    parts = df.join(quota.select(group, "_q", "_first"), group).withColumn("_s", F.pmod(F.xxhash64(key), F.lit(salts)))
    few = parts.withColumn("_r", F.row_number().over(Window.partitionBy(group, "_s").orderBy(key))).filter("_r <= _q")
    picked = few.withColumn("_r", F.row_number().over(Window.partitionBy(group).orderBy(key))).filter("_r <= _q")
    return picked.orderBy("_first", "_r").limit(n).drop("_q", "_first", "_r", "_s")


def round_robin(df: DataFrame, order: list[Column], shards: int) -> DataFrame:
    """`pay`: 1..shards, dealt out in the given order.

    Global positions come from the sizes of range partitions, so no task sees more than its own range.
    """
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_p", F.spark_partition_id()).withColumn("_i", F.monotonically_increasing_id())
    ranged = materialize(ranged.withColumn("_i", F.col("_i") - F.shiftleft(F.col("_p").cast("long"), 33)), "ranged")  # read twice below
    sizes = ranged.groupBy("_p").agg(F.count("*").alias("_c"))  # one row per partition
    before = F.coalesce(F.sum("_c").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = sizes.select("_p", before.alias("_s"))
    return ranged.join(F.broadcast(starts), "_p").withColumn("pay", ((F.col("_s") + F.col("_i")) % shards + 1).cast("int")).drop("_p", "_i", "_s")


# fixed values: flags by how urgent their review is
FLAG_ORDER = (
    "aciklama_harf_celiskisi", "sik_kayip_yeniden_harf", "sik_onarimi", "soruda_gorsel", "aciklama_kisa", "aciklama_bozuk", "soru_bozuk", "aciklamada_cevap_satiri",
    "gomulu_soru_kesildi", "cop_cumle_atildi", "aciklama_uzun",
)


def flag_rank(flags: Column) -> Column:
    """Rank of the most urgent flag from 0 on, 99 if none is ranked."""
    order = F.array(*[F.lit(f) for f in FLAG_ORDER])
    ranks = F.transform(flags, lambda f: F.array_position(order, f))
    best = F.array_min(F.transform(F.filter(ranks, lambda r: r > 0), lambda r: r - 1))
    return F.coalesce(best, F.lit(99)).cast("int")


def nearest_rank(df: DataFrame, value: str, shares: list[float]) -> DataFrame:
    """(pay, deger): the value at rank floor(n * share), from 1 on; rank 0 wraps to the largest.

    Distinct values are counted first; ranks are cumulative counts, so only distinct values are sorted.
    """
    counts = df.filter(F.col(value).isNotNull()).groupBy(value).agg(F.count("*").alias("c"))
    upto = F.sum("c").over(Window.orderBy(value).rowsBetween(Window.unboundedPreceding, 0))
    total = F.sum("c").over(Window.partitionBy())
    ranked = counts.select(F.col(value).alias("v"), upto.alias("hi"), F.col("c"), total.alias("n"))
    out = None
    for s in shares:
        at = F.floor(F.col("n") * F.lit(s))
        at = F.when(at < 1, F.col("n")).otherwise(at)
        row = ranked.filter((F.col("hi") >= at) & (F.col("hi") - F.col("c") < at)).select(F.lit(s).alias("pay"), F.col("v").alias("deger"))
        out = row if out is None else out.unionByName(row)
    return out


def upper_median(df: DataFrame, value: str) -> DataFrame:
    """The value at place floor(n / 2), counted from 0."""
    counts = df.filter(F.col(value).isNotNull()).groupBy(value).agg(F.count("*").alias("c"))
    upto = F.sum("c").over(Window.orderBy(value).rowsBetween(Window.unboundedPreceding, 0))
    ranked = counts.select(F.col(value).alias("ortanca"), upto.alias("hi"), "c", F.sum("c").over(Window.partitionBy()).alias("n"))
    at = F.floor(F.col("n") / 2) + 1
    return ranked.filter((F.col("hi") >= at) & (F.col("hi") - F.col("c") < at)).select("ortanca")


def share_of_total(df: DataFrame, key: str) -> DataFrame:
    """(key, n, yuzde): rows per key and their percentage."""
    counts = df.groupBy(key).agg(F.count("*").alias("n"))
    return counts.withColumn("yuzde", F.round(F.lit(100.0) * F.col("n") / F.sum("n").over(Window.partitionBy()), 4))
