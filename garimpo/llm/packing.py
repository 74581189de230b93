"""Problem 7: texts into containers of fixed capacity, by best-fit decreasing.

Sizes are counted in one pass over the texts; only (id, size) goes on. Items
are spread over shards of bounded size by a hash, and each shard is packed in
one task: items in order of decreasing size, each into the tightest open
container, which a segment tree over the remaining capacities finds in
logarithmic time. Containers that a shard left with much room are packed again
as items, spread anew over shards of the same bound, round by round, until one
shard holds them all or a round saves next to nothing: containers that are left
then have no room for each other. So sharding costs no space that grows with the
number of shards, and no task holds more than a shard.

Only an item beyond the capacity is divided: into full containers of its own
and a remainder, which is packed as an item.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize


# Kinds of containers are sent to all tasks; more than this are no table of kinds.
KINDS = 10_000
# A round of packing half-full containers again must save this share of them for another one to follow.
LEAST_SAVED = 0.01


class RoomTree:
    """Open containers by remaining capacity 0..capacity: a segment tree of counts over the capacities, a stack of containers at each leaf."""

    def __init__(self, capacity: int):
        self.leaves = 1 << max(1, capacity).bit_length()
        self.count = [0] * (2 * self.leaves)
        self.bins: list[list[int]] = [[] for _ in range(capacity + 1)]

    def put(self, room: int, container: int) -> None:
        self.bins[room].append(container)
        i = room + self.leaves
        while i:
            self.count[i] += 1
            i >>= 1

    def take(self, need: int) -> tuple[int, int] | None:
        """(room, container) of the tightest container with at least `need` room, taken out; None if there is none."""
        count = self.count
        i = need + self.leaves
        if not count[i]:
            # climb until a right sibling holds a container, then descend to its least room
            while i > 1 and (i & 1 or not count[i + 1]):
                i >>= 1
            if i <= 1:
                return None
            i += 1
            while i < self.leaves:
                i = 2 * i if count[2 * i] else 2 * i + 1
        room = i - self.leaves
        while i:
            count[i] -= 1
            i >>= 1
        return room, self.bins[room].pop()


def best_fit_decreasing(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """(container of each item, room left in each container). Sizes must be between 0 and capacity; ties keep the given order."""
    tree = RoomTree(capacity)
    where = np.empty(len(sizes), np.int64)
    room: list[int] = []
    for i in np.argsort(-sizes, kind="stable"):
        size = int(sizes[i])
        got = tree.take(size)
        if got is None:
            container = len(room)
            room.append(capacity)
            left = capacity - size
        else:
            container = got[1]
            left = got[0] - size
        room[container] = left
        where[i] = container
        tree.put(left, container)
    return where, np.array(room, np.int64)


def _pack_shards(items: DataFrame) -> DataFrame:
    """(container_name, capacity, item, size, bin, room): items (container_name, capacity, shard, item, size) packed shard by shard.

    A bin is named after its first item, which is unique among items.
    """

    def pack(key: tuple, table: pa.Table) -> pa.Table:
        order = np.argsort(table["item"].to_numpy(zero_copy_only=False).astype(str), kind="stable")
        table = table.take(pa.array(order))
        capacity = table["capacity"][0].as_py()
        where, room = best_fit_decreasing(table["size"].to_numpy(), capacity)
        names = table["item"].to_pylist()
        first = dict(zip(where[::-1].tolist(), range(len(where) - 1, -1, -1)))
        return pa.table(
            {
                "container_name": table["container_name"],
                "capacity": table["capacity"],
                "item": table["item"],
                "size": table["size"],
                "bin": pa.array([names[first[b]] for b in where.tolist()], pa.string()),
                "room": pa.array(room[where], pa.int64()),
            }
        )

    return items.groupBy("container_name", "shard").applyInArrow(pack, "container_name string, capacity long, item string, size long, bin string, room long")


def pack(
    sizes: DataFrame,
    containers: DataFrame,
    *,
    name_col: str = "container_name",
    capacity_col: str = "capacity_tokens",
    shard_items: int = 25_000,
    roomy: float = 0.02,
) -> DataFrame:
    """(container_name, capacity, id, piece_no, piece_tokens, container_id) of every item for every kind of container.

    sizes: (id, tokens). Pieces are numbered from 1; an item of 0 tokens has one
    empty piece. container_id is unique within its kind. Containers of null
    name, or of null or non-positive capacity, are left out, and equal rows
    count once. Rows of the same id are packed each, under names of their own.
    """
    kinds = containers.select(containers[f"`{name_col}`"].alias("container_name"), containers[f"`{capacity_col}`"].cast("long").alias("capacity")).where("container_name IS NOT NULL AND capacity > 0").distinct()
    if kinds.count() > KINDS:
        raise ValueError(f"more than {KINDS} kinds of containers")
    written = materialize(sizes.select("id", "tokens"), "sizes")
    keyed = written.withColumn("copy", F.lit(0).cast("long"))
    if written.groupBy("id").count().where("count > 1").head(1):
        keyed = materialize(written.withColumn("copy", F.monotonically_increasing_id()), "sizes")
    keyed = keyed.select("id", "copy", "tokens")
    # every item is packed for every kind: the product is the task itself; kinds are few, which is checked above
    kinds = F.broadcast(kinds)
    pieces = keyed.crossJoin(kinds) if kinds.head(1) else keyed.join(kinds, F.lit(False))
    pieces = pieces.withColumn("whole", F.floor(F.col("tokens") / F.col("capacity"))).withColumn("rest", F.col("tokens") % F.col("capacity"))
    name = F.concat_ws("-", F.lpad(F.col("id").cast("string"), 20, "0"), F.col("copy").cast("string"))
    full = pieces.where("whole > 0").select(
        "container_name", "capacity", "id", F.explode(F.sequence(F.lit(1).cast("long"), "whole")).alias("piece_no"), F.col("capacity").alias("piece_tokens"), name.alias("item")
    ).withColumn("container_id", F.concat_ws("/", "item", F.col("piece_no").cast("string"))).drop("item")
    loose = pieces.where("rest > 0 OR whole = 0").select("container_name", "capacity", "id", (F.col("whole") + 1).alias("piece_no"), F.col("rest").alias("size"), name.alias("item"))

    shards = max(1, math.ceil(keyed.count() / shard_items))
    packed = materialize(_pack_shards(loose.select("container_name", "capacity", F.pmod(F.xxhash64("item"), F.lit(shards)).alias("shard"), "item", "size")), "packed")
    final = packed.select("container_name", "item", "bin")
    bins = packed.groupBy("container_name", "capacity", "bin").agg((F.first("capacity") - F.first("room")).alias("size"))
    moved = None
    salt = 0
    while shards > 1:
        salt += 1
        open_bins = materialize(bins.where(F.col("size") < F.col("capacity") * (1 - roomy)), "open")
        most = open_bins.groupBy("container_name").count().agg(F.sum("count").alias("all"), F.max("count").alias("most")).first()
        if not most.most:
            break
        shards = max(1, math.ceil(most.most / shard_items))
        again = materialize(_pack_shards(open_bins.select("container_name", "capacity", F.pmod(F.xxhash64(F.lit(salt), "bin"), F.lit(shards)).alias("shard"), F.col("bin").alias("item"), "size")), "repacked")
        step = again.select("container_name", F.col("item").alias("bin"), F.col("bin").alias("next"))
        moved = step if moved is None else materialize(
            moved.join(step.select("container_name", F.col("bin").alias("next"), F.col("next").alias("last")), ["container_name", "next"], "left").select("container_name", "bin", F.coalesce("last", "next").alias("next")).unionByName(step.join(moved, ["container_name", "bin"], "left_anti")), "moved"
        )
        bins = again.groupBy("container_name", "capacity", F.col("bin")).agg((F.first("capacity") - F.first("room")).alias("size"))
        if bins.count() > most.all * (1 - LEAST_SAVED):
            break
    if moved is not None:
        final = final.join(moved, ["container_name", "bin"], "left").select("container_name", "item", F.coalesce("next", "bin").alias("bin"))
    fitted = loose.join(final, ["container_name", "item"]).select("container_name", "capacity", "id", "piece_no", F.col("size").alias("piece_tokens"), F.col("bin").alias("container_id"))
    return full.select(*fitted.columns).unionByName(fitted)


def packing_report(packed: DataFrame) -> DataFrame:
    """Per kind: containers, tokens, unused tokens and their share, the least possible number of containers."""
    return packed.groupBy("container_name", "capacity").agg(
        F.count_distinct("container_id").alias("containers"),
        F.sum("piece_tokens").alias("tokens"),
        (F.count_distinct("container_id") * F.col("capacity") - F.sum("piece_tokens")).alias("unused_tokens"),
        F.round(1 - F.sum("piece_tokens") / (F.count_distinct("container_id") * F.col("capacity")), 6).alias("unused_share"),
        F.ceil(F.sum("piece_tokens") / F.col("capacity")).alias("least_containers"),
    )
