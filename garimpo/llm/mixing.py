"""Problem 8: sources mixed to target shares, by Sainte-Lague apportionment of blocks.

1. Sizes in tokens, one pass over the texts; only (id, source, size) goes on.
2. Documents are spread over shards of bounded size by a seeded hash, so that a
   shard is a small copy of the whole and a source, however large, is never one
   task's work. Within a shard and source, documents in seeded order form blocks
   of about equal size.
3. The blocks of all shards together are apportioned, from one row per source:
   each goes to the source with the highest quotient of target share and twice
   the blocks it has plus one, counted in tokens because blocks are only about
   equal. A source whose documents have all been used max_repeats times gets no
   more.
4. A source's quota of q blocks out of n gives every block q // n copies and as
   many blocks, by shard and in seeded order, one more as come closest to q % n
   mean blocks. Shards are seeded too, so that is a seeded order of all blocks;
   its running sum is made of sums of shards.

The total is, by default, the largest at which every source can meet its share
without more than max_repeats copies.
"""

from __future__ import annotations

import heapq
import math

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize


def apportion(shares: list[float], block: list[float], limit: list[int], total: float) -> list[int]:
    """Blocks for each source: highest quotients first until `total` tokens are given; at most `limit` blocks each.

    The quotient share / (given + block / 2) is Sainte-Lague's share / (2k + 1)
    for blocks of one size. Stops at the block that would overshoot by more
    than it leaves open.
    """
    live = [i for i, (s, b, n) in enumerate(zip(shares, block, limit)) if s > 0 and b > 0 and n > 0]

    def above(quotient: float) -> list[int]:
        """The quotas when all quotients above this one have been served."""
        quota = [0] * len(shares)
        for i in live:
            quota[i] = max(0, min(limit[i], math.ceil(shares[i] / (block[i] * quotient) - 0.5)))
        return quota

    # the blocks that surely come before the last ones are given at once
    quota = [0] * len(shares)
    high = max((2 * shares[i] / block[i] for i in live), default=0.0)
    low = 0.0
    for _ in range(60):
        middle = (low + high) / 2
        if middle <= 0 or min((shares[i] / (block[i] * middle) for i in live), default=0) > 1e15:
            break
        tried = above(middle)
        if sum(q * b for q, b in zip(tried, block)) + max(block) <= total:
            quota, high = tried, middle
        else:
            low = middle
    heap = [(-shares[i] / ((quota[i] + 0.5) * block[i]), i) for i in live if quota[i] < limit[i]]
    heapq.heapify(heap)
    given = float(sum(q * b for q, b in zip(quota, block)))
    while heap:
        _, i = heapq.heappop(heap)
        if given + block[i] / 2 > total:
            break
        quota[i] += 1
        given += block[i]
        if quota[i] < limit[i]:
            heapq.heappush(heap, (-shares[i] / ((quota[i] + 0.5) * block[i]), i))
    return quota


def mix(
    sizes: DataFrame,
    weights: DataFrame,
    *,
    total_tokens: int | None = None,
    block_tokens: int = 1024,
    shard_tokens: int = 20_000_000,
    seed: int = 42,
) -> DataFrame:
    """(id, source, tokens, copies, target_share) of the chosen documents, copies >= 1.

    sizes: (id, source, tokens); weights: (source, target_share, max_repeats).
    Documents without tokens, or of a source that is null, has no weight or a
    weight of 0, are not chosen. Sources are compared as written. A weighted
    source without documents leaves its share to the others, in proportion.
    max_repeats null means 1. Rows of the same id are taken each. A share is met
    to about half a block of block_tokens.
    """
    w = weights.groupBy("source").agg(F.max("target_share").alias("target_share"), F.max(F.coalesce("max_repeats", F.lit(1))).cast("long").alias("max_repeats")).where("source IS NOT NULL AND target_share > 0 AND max_repeats > 0")
    few = w.count() <= 100_000
    w = F.broadcast(w) if few else w
    known = materialize(sizes.where("tokens > 0").join(w, "source"), "weighted")
    per_source = known.groupBy("source").agg(F.sum("tokens").alias("tokens"), F.first("target_share").alias("share"), F.first("max_repeats").alias("repeats"))
    present = per_source.agg(F.sum("share")).first()[0] or 1.0
    summed = per_source.agg(F.sum("tokens"), F.min(F.col("tokens") * F.col("repeats") / (F.col("share") / F.lit(present)))).first()
    everything, reachable = summed[0] or 0, summed[1] or 0.0
    total = float(total_tokens if total_tokens is not None else reachable)
    shards = max(1, math.ceil(everything / shard_tokens))

    order = F.xxhash64(F.lit(seed), "id", "source")
    placed = known.withColumn("order", order).withColumn("shard", F.pmod(F.xxhash64(F.lit(seed + 1), "id"), F.lit(shards)))
    run = Window.partitionBy("shard", "source").orderBy("order", "id").rowsBetween(Window.unboundedPreceding, -1)
    blocks = placed.withColumn("block", F.floor(F.coalesce(F.sum("tokens").over(run), F.lit(0)) / F.lit(block_tokens)))
    blocks = materialize(blocks.select("id", "source", "tokens", "target_share", "max_repeats", "shard", "block"), "blocks")
    # a document may begin several blocks; only blocks in which one begins exist
    counted = blocks.groupBy("shard", "source").agg(F.sum("tokens").alias("tokens"), F.count_distinct("block").alias("n"), F.first("target_share").alias("share"), F.first("max_repeats").alias("repeats"))

    def quotas(table: pa.Table) -> pa.Table:
        tokens, n = table["tokens"].to_numpy().astype(float), table["n"].to_numpy()
        shares = table["share"].to_numpy()
        quota = apportion((shares / shares.sum()).tolist(), (tokens / n).tolist(), (n * table["repeats"].to_numpy()).tolist(), total)
        return pa.table({"source": table["source"], "n": table["n"], "mean": pa.array(tokens / n, pa.float64()), "quota": pa.array(quota, pa.int64())})

    totals = counted.groupBy("source").agg(F.sum("tokens").alias("tokens"), F.sum("n").alias("n"), F.first("share").alias("share"), F.first("repeats").alias("repeats"))
    allotted = totals.groupBy().applyInArrow(quotas, "source string, n long, mean double, quota long")
    earlier = Window.partitionBy("source").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    starts = counted.select("shard", "source", F.coalesce(F.sum("tokens").over(earlier), F.lit(0)).alias("start"))
    names = blocks.groupBy("shard", "source", "block").agg(F.sum("tokens").alias("block_size"))
    rank = Window.partitionBy("shard", "source").orderBy(F.xxhash64(F.lit(seed + 2), "block", "source", "shard"), "block")
    before = F.coalesce(F.sum("block_size").over(rank.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    # blocks are only about equal: the last, partial round ends where its blocks' tokens come closest to the quota's
    part = (F.col("quota") % F.col("n")) * F.col("mean")
    chosen = (
        names.withColumn("before", before)
        .join(starts, ["shard", "source"])
        .withColumn("before", F.col("start") + F.col("before"))
        .join(F.broadcast(allotted) if few else allotted, "source")
        .withColumn("copies", F.floor(F.col("quota") / F.col("n")) + F.when((F.col("quota") % F.col("n") > 0) & (F.col("before") + F.col("block_size") / 2 <= part), 1).otherwise(0))
        .where("copies > 0")
        .select("shard", "source", "block", "copies")
    )
    return blocks.join(chosen, ["shard", "source", "block"]).select("id", "source", "tokens", "copies", (F.col("target_share") / F.lit(present)).alias("target_share"))


def share_report(mixed: DataFrame, weights: DataFrame) -> DataFrame:
    """Every weighted source: documents, copies, most copies of one document, tokens, actual and target share."""
    total = mixed.agg(F.sum(F.col("tokens") * F.col("copies"))).first()[0] or 1
    got = mixed.groupBy("source").agg(
        F.count("*").alias("documents"),
        F.sum("copies").alias("copies"),
        F.max("copies").alias("most_copies"),
        F.sum(F.col("tokens") * F.col("copies")).alias("tokens"),
    )
    base = weights.where("source IS NOT NULL").groupBy("source").agg(F.max("target_share").alias("target_share"), F.max("max_repeats").alias("max_repeats"))
    return base.join(got, "source", "left").na.fill(0, ["documents", "copies", "most_copies", "tokens"]).withColumn("actual_share", F.round(F.col("tokens") / F.lit(total), 6))
