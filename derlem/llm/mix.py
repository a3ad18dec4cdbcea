"""Mixing sources to target weights (problem 9): Sainte-Laguë apportionment of equal-token blocks.

Sizes are tokens of a public tokenizer. The mix has a size of total tokens; without one given it is
the largest at which every source that has tokens can reach its target share with max_repeat copies
of its documents. Shares of sources without tokens fall to the others in proportion. The size is cut
into equal-token blocks, BLOCKS of them or PER_SHARE for the smallest share, whichever is more, and given to
the sources by highest quotients share / (2 k + 1), k being the blocks a source has, as long as its
capacity (tokens times max_repeat) allows.

A source's blocks are then divided among its shards (documents by a seeded hash) by the same rule over
the shards' tokens, in tables: rounding at the common divisor gives all but a few blocks, the rest go by
quotient. Within a shard whole rounds of copies come first, then documents in seeded order as far as they
fit the rest of the quota, and one more of the others, the one that comes nearest to it. The number of
shards grows with the rows, no shard exceeding about SHARD_ROWS documents, so that no task sorts an
unbounded group; the driver sees one row per source.

Null sources or targets, sources not in the table of targets and documents without tokens are not
mixed. Repeated rows of a source in the targets are an error.
"""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from derlem.session import materialize

BLOCKS, PER_SHARE, PER_SHARD = 10_000, 100, 64
SHARD_ROWS = 200_000
SEED = 9


def apportion(shares: dict[str, float], blocks: int, capacity: dict[str, int]) -> dict[str, int]:
    """Blocks per key by highest quotients share / (2 k + 1); ties go to the smaller key; none above its capacity.

    What each key has for certain is rounded at a divisor that leaves a few blocks over; only these go one by one.
    """
    keys = [k for k, s in shares.items() if s > 0 and capacity.get(k, 0) > 0]
    given = dict.fromkeys(shares, 0)
    full: set[str] = set()
    while free := [k for k in keys if k not in full]:
        rest, whole = blocks - sum(given[k] for k in full), sum(shares[k] for k in free)
        scale = max(0.0, rest - len(free) / 2 - 1) / whole
        for k in free:
            given[k] = int(shares[k] * scale + 0.5)
        over = {k for k in free if given[k] >= capacity[k]}
        for k in over:
            given[k] = capacity[k]
        if not over:
            break
        full |= over
    blocks -= sum(given.values())
    heap = [(-shares[k] / (2 * given[k] + 1), k) for k in keys if given[k] < capacity[k]]
    heapq.heapify(heap)
    while blocks > 0 and heap:
        _, k = heapq.heappop(heap)
        given[k] += 1
        blocks -= 1
        if given[k] < capacity[k]:
            heapq.heappush(heap, (-shares[k] / (2 * given[k] + 1), k))
    return given


def quotas(available: dict[str, int], targets: dict[str, tuple[float, int]], total: int | None = None, blocks: int | None = None) -> dict[str, int]:
    """Tokens to take from each source. targets: source -> (share, most copies)."""
    present = {s: w for s, (w, r) in targets.items() if available.get(s, 0) > 0 and w > 0 and r > 0}
    if not present:
        return {}
    norm = sum(present.values())
    shares = {s: w / norm for s, w in present.items()}
    limit = {s: available[s] * targets[s][1] for s in present}
    if total is None:
        total = int(min(limit[s] / shares[s] for s in present))
    blocks = min(blocks or max(BLOCKS, int(PER_SHARE / min(shares.values()))), max(1, total))
    size = total / blocks
    room = {s: int(limit[s] / size + 1e-9) for s in present}
    return {s: min(limit[s], round(n * size)) for s, n in apportion(shares, blocks, room).items()}


def shard_quotas(sizes: DataFrame, quota: DataFrame) -> DataFrame:
    """sizes(source, shard, t), quota(source, q, most) -> (source, shard, t, rounds, rest): each source's q tokens over its
    shards by Sainte-Laguë, in units of a PER_SHARD-th of a shard's average; rounds * t + rest tokens for a shard."""
    own, first = Window.partitionBy("source"), Window.partitionBy("source").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    x = sizes.join(F.broadcast(quota), "source")  # one row per target
    x = x.withColumns({"n": F.count("*").over(own), "whole": F.sum("t").over(own)})
    x = x.withColumn("unit", F.greatest(F.lit(1), F.expr("q div (n * %d)" % PER_SHARD)))
    x = x.withColumns({"blocks": F.expr("q div unit"), "room": F.ceil(F.col("t") * F.col("most") / F.col("unit"))})
    x = x.withColumn("k", F.least("room", F.floor(F.col("t") / F.col("whole") * F.col("blocks") + 0.5)))
    x = x.withColumn("off", F.col("blocks") - F.sum("k").over(own))
    more = F.when(F.col("k") < F.col("room"), F.col("t") / (2 * F.col("k") + 1)).otherwise(-1.0)
    less = F.when(F.col("k") > 0, F.col("t") / (2 * F.col("k") - 1)).otherwise(F.lit(float("inf")))
    up, down = (F.row_number().over(Window.partitionBy("source").orderBy(c, "shard")) for c in (F.desc("more"), F.asc("less")))
    x = x.withColumns({"more": more, "less": less}).withColumns({"up": up, "down": down})
    x = x.withColumn("k", F.col("k") + F.when((F.col("off") > 0) & (F.col("up") <= F.col("off")) & (F.col("more") >= 0), 1).when((F.col("off") < 0) & (F.col("down") <= -F.col("off")) & (F.col("k") > 0), -1).otherwise(0))
    x = x.withColumn("x", F.least(F.col("k") * F.col("unit"), F.col("t") * F.col("most")))
    x = x.withColumns({"left": F.col("q") - F.sum("x").over(own), "spare": F.col("t") * F.col("most") - F.col("x")})
    given = F.greatest(F.lit(0), F.least("spare", F.col("left") - F.coalesce(F.sum("spare").over(first), F.lit(0))))
    x = x.withColumn("x", F.col("x") + F.when(F.col("left") > 0, given).otherwise(0))
    return x.select("source", "shard", "t", F.expr("x div t").alias("rounds"), F.expr("x % t").alias("rest"))


def mix(documents: DataFrame, targets: DataFrame, total: int | None = None, seed: int = SEED) -> tuple[DataFrame, DataFrame]:
    """documents(doc_id, source, tokens), targets(source, target_share, max_repeat) -> (chosen, report).

    chosen(doc_id, source, tokens, copies); report(source, target_share, max_repeat, available, tokens, actual_share, most_copies),
    one row per row of targets.
    """
    spark = documents.sparkSession
    goal = {r["source"]: (float(r["target_share"]), int(r["max_repeat"])) for r in targets.filter("source is not null and target_share is not null and max_repeat is not null").collect()}  # a table of parameters
    wanted = spark.createDataFrame([(s,) for s in goal], "source string")
    docs = materialize(documents.filter("tokens > 0").select("doc_id", "source", "tokens").join(F.broadcast(wanted), "source"), "mix-sizes")
    most = docs.groupBy("source").agg(F.count("*").alias("n"), F.sum("tokens").alias("t")).collect()  # one row per target
    shards = max(1, -(-max((r["n"] for r in most), default=1) // SHARD_ROWS))
    quota = quotas({r["source"]: r["t"] for r in most}, goal, total)
    limits = spark.createDataFrame([(s, int(q), goal[s][1]) for s, q in quota.items()], "source string, q long, most long")
    docs = docs.withColumn("o", F.xxhash64(F.lit(seed), "doc_id"))
    docs = docs.withColumn("shard", F.pmod(F.shiftright("o", 17), F.lit(shards)).cast("int"))
    plan = shard_quotas(docs.groupBy("source", "shard").agg(F.sum("tokens").alias("t")), limits)
    own = Window.partitionBy("source", "shard")
    ordered = own.orderBy("o", "doc_id").rowsBetween(Window.unboundedPreceding, 0)
    placed = docs.join(plan.select("source", "shard", "rounds", "rest"), ["source", "shard"]).withColumn("fits", F.sum("tokens").over(ordered) <= F.col("rest"))
    placed = placed.withColumn("gap", F.col("rest") - F.sum(F.when(F.col("fits"), F.col("tokens")).otherwise(0)).over(own))
    off = F.abs(F.col("tokens") - F.col("gap"))
    near = placed.withColumn("last", F.when(~F.col("fits") & (off < F.col("gap")), F.struct(off.alias("off"), "o", "doc_id")))
    near = near.withColumn("extra", F.col("last").eqNullSafe(F.min("last").over(own)) & F.col("last").isNotNull())
    chosen = materialize(
        near.withColumn("copies", F.col("rounds") + F.when(F.col("fits") | F.col("extra"), 1).otherwise(0))
        .filter("copies > 0")
        .select("doc_id", "source", "tokens", "copies"),
        "mix-chosen",
    )
    taken = chosen.groupBy("source").agg(F.sum(F.col("tokens") * F.col("copies")).alias("taken"), F.max("copies").alias("most_copies"))
    have = docs.groupBy("source").agg(F.sum("tokens").alias("available"))
    sums = taken.agg(F.sum("taken").alias("all"))
    report = (
        targets.join(have, "source", "left").join(taken, "source", "left").join(F.broadcast(sums))
        .select(
            "source", "target_share", "max_repeat", F.coalesce("available", F.lit(0)).alias("available"), F.coalesce("taken", F.lit(0)).alias("tokens"),
            (F.coalesce("taken", F.lit(0)) / F.col("all")).alias("actual_share"), F.coalesce("most_copies", F.lit(0)).alias("most_copies"),
        )
    )
    return chosen, report
