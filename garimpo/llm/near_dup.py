"""Problem 1: near-duplicate texts by bottom-k sketches from one hash function.

Plan, for N texts:

1. One Python pass hashes each text's word runs and keeps the k smallest hashes
   (the sketch), the set size, a digest of the whole set and the list keys of
   step 3, written once.
2. Texts with the same set form a class; only its representative goes on, so a
   group of copies, however large, costs one row.
3. Inverted lists. A list of a single retained value is as long as the value is
   common, so texts are listed under `run` retained values together: the hashes
   are laid on CIRCLES circles (one hash, multiplied by odd numbers, which only
   reorders it), and from each of STARTS points of a circle the next `run`
   values are one key. Two texts are in a common list exactly if the first `run`
   values of their union from that point are all shared, whose probability is
   J ** run, whatever else the texts share with others and however rare or
   common their values are. No list is cut or left out. `run` is as long as
   `missed` stays below MISS (see there). Texts of up to SHORT runs have keys of
   three values, and those of up to TINY runs are listed under each of their
   n - ceil(threshold * n) + 1 smallest values: partners share one of these, so
   none is lost.
4. The lists are read in the order of their keys, as a stream, and give pairs.
   Lists of more than `list_limit` texts are paired apart: split into blocks
   that go to several tasks, each pair tested on 128 bits of the two texts (one
   bit of the first value of each key) before it leaves the join.
5. Pairs overlapping in two lists or more are estimated from the sketch of the
   union (the k smallest values of both); only pairs within a wide margin remain.
6. Exact Jaccard similarity on the full sets, read again for the remaining
   texts only.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WordHashes, chunks, list_array, materialize, mix, pick, shingle_sets


# Ids of texts to verify are sent to all tasks up to this number (8 MB); beyond it the texts are shuffled to them.
BROADCAST_IDS = 1_000_000
# List keys of a text: so many circles, and points on each.
CIRCLES, STARTS = 8, 16
# A pair must be in so many common lists.
OVERLAPS = 2
# A pair exactly at the threshold may be missed with this probability; pairs above it are missed far less often.
MISS = 5e-4
# Texts of at most TINY runs have keys of single values, those of at most SHORT runs keys of three.
TINY, SHORT = 24, 96
_ODD = [np.uint64((0x9E3779B97F4A7C15 * (2 * c + 1) | 1) & (2**64 - 1)) for c in range(CIRCLES)]


def missed(similarity: float, run: int) -> float:
    """The probability that a pair of this similarity is in fewer than OVERLAPS common lists of keys of `run` values."""
    p, n = similarity**run, CIRCLES * STARTS
    return sum(math.comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(OVERLAPS))


def run_length(threshold: float, *, most: int = 5) -> int:
    """The most values in a key with which no more than MISS of the pairs at the threshold are lost."""
    return max(r for r in range(1, most + 1) if r == 1 or missed(threshold, r) <= MISS)


def _tiers(threshold: float) -> list[tuple[int, float, int]]:
    """(texts of more runs than this, of at most so many, values in a key, 0 for the smallest values singly); partners of any size have a tier in common."""
    top = run_length(threshold)
    return [(0, TINY / threshold, 0), (TINY, SHORT / threshold, min(3, top)), (SHORT, math.inf, top)]


def list_keys(sets: list[np.ndarray], threshold: float) -> tuple[list[np.ndarray], np.ndarray]:
    """The list keys of each set (none may be empty), and two rows of 64 bits for each."""
    count = len(sets)
    n = np.array([len(x) for x in sets], np.int64)
    base = np.cumsum(n) - n
    flat = np.concatenate(sets)
    owner = np.arange(count, dtype=np.uint64) << np.uint64(52)
    marks = owner[:, None] | (np.arange(STARTS, dtype=np.uint64) << np.uint64(48))
    tiers = [(np.nonzero((n > low) & (n <= high))[0], r) for low, high, r in _tiers(threshold)]
    found: list[list[np.ndarray]] = [[] for _ in tiers]
    bits = np.zeros((count, 2), np.uint64)
    for c, odd in enumerate(_ODD):
        w = np.sort((flat * odd >> np.uint64(12)) | np.repeat(owner, n))
        first = np.searchsorted(w, marks) - base[:, None]
        for t, (texts, r) in enumerate(tiers):
            if not r:
                continue
            key = np.broadcast_to((np.arange(STARTS) + (c * STARTS + 1 + 1000 * r)).astype(np.uint64), (len(texts), STARTS)).copy()
            for d in range(r):
                value = w[base[texts, None] + (first[texts] + d) % n[texts, None]] & np.uint64(2**52 - 1)
                key = mix(key, value)
            found[t].append(key)
        lead = w[base[:, None] + first % n[:, None]] >> np.uint64(3)
        shift = np.arange(STARTS, dtype=np.uint64) + np.uint64(STARTS * c % 64)
        bits[:, STARTS * c // 64] |= np.bitwise_or.reduce((lead & np.uint64(1)) << shift, axis=1)
    keys: list[list[np.ndarray]] = [[] for _ in sets]
    for (texts, r), parts in zip(tiers, found):
        if not r:
            for i in texts:
                least = np.sort(sets[i])[: len(sets[i]) - math.ceil(threshold * len(sets[i]) - 1e-9) + 1]
                # a value is as many lists as a pair must have in common
                keys[i] += [mix(least, np.full(len(least), k, np.uint64)) for k in range(OVERLAPS)]
        elif len(texts):
            for i, row in zip(texts, np.concatenate(parts, axis=1)):
                keys[i].append(row)
    return [np.concatenate(x) for x in keys], bits


def sketches(df: DataFrame, *, id_col: str, text_col: str, words: int = 5, threshold: float = 0.8, k: int = 40) -> DataFrame:
    """(id, n, digest, sketch, bits_a, bits_b, keys) of each text with at least one run of `words` words."""
    src = pick(df, id=id_col, text=text_col).where("id IS NOT NULL AND text IS NOT NULL")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for b in chunks(batches, 2000):
            sets = shingle_sets(b.column(1).to_pylist(), words, hashes)
            keep = [i for i, s in enumerate(sets) if len(s)]
            if not keep:
                continue
            sets = [sets[i] for i in keep]
            keys, bits = list_keys(sets, threshold)
            # the bits of a short text come from too few values
            few = np.array([len(s) <= SHORT for s in sets])
            yield pa.RecordBatch.from_arrays(
                [
                    b.column(0).take(pa.array(keep, pa.int64())).cast(pa.int64()),
                    pa.array([len(s) for s in sets], pa.int32()),
                    pa.array([xxhash.xxh3_128_hexdigest(s.tobytes()) for s in sets], pa.string()),
                    list_array([s[:k] for s in sets]),
                    pa.array(bits[:, 0].view(np.int64), mask=few),
                    pa.array(bits[:, 1].view(np.int64), mask=few),
                    list_array(keys),
                ],
                names=["id", "n", "digest", "sketch", "bits_a", "bits_b", "keys"],
            )

    return src.withColumn("id", F.col("id").cast("long")).mapInArrow(run, "id long, n int, digest string, sketch array<long>, bits_a long, bits_b long, keys array<long>")


def _full_sets(src: DataFrame, words: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for b in chunks(batches, 2000):
            sets = shingle_sets(b.column(1).to_pylist(), words, hashes)
            yield pa.RecordBatch.from_arrays([b.column(0), list_array(sets)], names=["id", "shingles"])

    return src.mapInArrow(run, "id long, shingles array<long>")


def read_lists(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[pa.RecordBatch]:
    """(key, a, b) of postings (key, id) that come in the order of their keys: all pairs of a list of at most `limit` ids; b is null for each id of a longer list.

    A list may go on in the next batch: what is held is at most limit postings,
    and whether the last list has proved long.
    """
    rest_key, rest_id = np.empty(0, np.int64), np.empty(0, np.int64)
    long_key: int | None = None
    for last, b in _with_last(batches):
        key = np.concatenate([rest_key, b.column(0).to_numpy()]) if b is not None else rest_key
        ids = np.concatenate([rest_id, b.column(1).to_numpy()]) if b is not None else rest_id
        if not len(key):
            continue
        begin = np.nonzero(np.concatenate(([True], key[1:] != key[:-1])))[0]
        size = np.diff(np.append(begin, len(key)))
        end = len(key)
        long = size > limit
        if long_key is not None:
            long |= key[begin] == long_key
        if not last and not long[-1]:
            # the last list is complete only when the next one begins
            end = begin[-1]
            begin, size, long = begin[:-1], size[:-1], long[:-1]
        long_key = int(key[end - 1]) if end and len(long) and long[-1] else None
        rest_key, rest_id = key[end:], ids[end:]
        whole = np.repeat(long, size)
        key, ids = key[:end], ids[:end]
        out = [(key[whole], ids[whole], None)]
        place = np.repeat(np.cumsum(size) - size, size)
        short = ~whole
        for d in range(1, int(size[~long].max(initial=1))):
            at = np.nonzero((place[d:] == place[:-d]) & short[d:] & (ids[d:] != ids[:-d]))[0]
            x, y = ids[at], ids[at + d]
            out.append((key[at], np.minimum(x, y), np.maximum(x, y)))
        paired = [o for o in out[1:]]
        both = [np.concatenate([o[i] for o in paired]) if paired else np.empty(0, np.int64) for i in range(3)]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.concatenate([out[0][0], both[0]])),
                pa.array(np.concatenate([out[0][1], both[1]])),
                pa.array(np.concatenate([np.zeros(len(out[0][0]), np.int64), both[2]]), mask=np.concatenate([np.ones(len(out[0][0]), bool), np.zeros(len(both[0]), bool)])),
            ],
            names=["key", "a", "b"],
        )


def _with_last(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[bool, pa.RecordBatch | None]]:
    for b in batches:
        yield False, b
    yield True, None


def _overlapping(reps: DataFrame, threshold: float, list_limit: int, block: int = 1024) -> DataFrame:
    """(a, b), a < b, of texts in at least OVERLAPS common lists. reps: id, keys, bits_a, bits_b."""
    postings = reps.select(F.explode("keys").alias("key"), "id").repartition("key").sortWithinPartitions("key")
    read = materialize(postings.mapInArrow(lambda batches: read_lists(batches, list_limit), "key long, a long, b long"), "lists")
    pairs = read.where("b IS NOT NULL").select("a", "b")
    long = read.where("b IS NULL").select("key", F.col("a").alias("id"))
    if long.head(1):
        # bits of a pair differ with probability (1 - J) / 2 each; four standard deviations are allowed
        p, n = (1 - threshold) / 2, CIRCLES * STARTS
        differ = p * n + 4 * (p * (1 - p) * n) ** 0.5
        blocks = long.groupBy("key").agg(F.ceil(F.count("*") / block).cast("int").alias("blocks"))
        listed = materialize(long.join(reps.select("id", "bits_a", "bits_b"), "id").join(blocks, "key"), "long")
        x = listed.select("key", F.pmod(F.xxhash64("id"), "blocks").alias("block"), *[F.col(c).alias(f"x_{c}") for c in ("id", "bits_a", "bits_b")])
        y = listed.select("key", F.explode(F.expr("sequence(0L, blocks - 1L)")).alias("block"), *[F.col(c).alias(f"y_{c}") for c in ("id", "bits_a", "bits_b")])
        alike = F.bit_count(F.col("x_bits_a").bitwiseXOR(F.col("y_bits_a"))) + F.bit_count(F.col("x_bits_b").bitwiseXOR(F.col("y_bits_b"))) <= differ
        pairs = pairs.unionByName(x.join(y, ["key", "block"]).where((F.col("x_id") < F.col("y_id")) & F.coalesce(alike, F.lit(True))).select(F.col("x_id").alias("a"), F.col("y_id").alias("b")))
    return pairs.groupBy("a", "b").agg(F.count("*").alias("overlaps")).where(F.col("overlaps") >= OVERLAPS).select("a", "b")


def near_duplicate_pairs(
    df: DataFrame,
    *,
    id_col: str,
    text_col: str,
    words: int = 5,
    threshold: float = 0.8,
    k: int = 40,
    list_limit: int = 64,
) -> tuple[DataFrame, DataFrame]:
    """Pairs of class representatives and the classes' members.

    Returns (pairs, members): pairs has a, b (a < b, representatives of
    different sets) and similarity >= threshold, exact; members has id, rep for
    every text that has at least one word run, rep being the smallest id with
    the same set.

    Null ids and texts, and texts of fewer than `words` words, are in neither.
    A row repeated whole counts once. Ids must be integers.
    """
    low = float(threshold)
    table = materialize(sketches(df, id_col=id_col, text_col=text_col, words=words, threshold=low, k=k), "sketches")
    classes = table.groupBy("digest").agg(F.min("id").alias("rep"), F.count("*").alias("size"))
    several = classes.where("size > 1").select("digest", "rep")
    grouped = materialize(table.select("id", "digest").join(several, "digest").select("id", "rep").distinct(), "copies")
    spare = grouped.where("id <> rep").select("id")
    reps = table.join(spare, "id", "left_anti") if spare.head(1) else table

    shared = _overlapping(reps, low, list_limit)
    margin = 3.5 * (low * (1 - low) / k) ** 0.5 + 0.02
    sk = reps.select("id", "n", "sketch")
    close = (
        shared.join(sk.select(F.col("id").alias("a"), F.col("n").alias("na"), F.col("sketch").alias("ska")), "a")
        .join(sk.select(F.col("id").alias("b"), F.col("n").alias("nb"), F.col("sketch").alias("skb")), "b")
        .where(F.least("na", "nb") >= F.greatest("na", "nb") * F.lit(low) - 1e-9)
        .withColumn("both", F.expr(f"slice(array_sort(array_union(ska, skb)), 1, {k})"))
        .where(F.expr(f"size(array_intersect(both, array_intersect(ska, skb))) >= {low - margin} * size(both)"))
        .select("a", "b")
    )
    close = materialize(close, "close")

    wanted = close.select(F.col("a").alias("id")).union(close.select("b")).distinct()
    if wanted.count() <= BROADCAST_IDS:
        wanted = F.broadcast(wanted)
    src = pick(df, id=id_col, text=text_col).where("id IS NOT NULL AND text IS NOT NULL").withColumn("id", F.col("id").cast("long"))
    sets = _full_sets(src.join(wanted, "id", "left_semi"), words)
    sets = materialize(sets, "sets")
    pairs = (
        close.join(sets.select(F.col("id").alias("a"), F.col("shingles").alias("sa")), "a")
        .join(sets.select(F.col("id").alias("b"), F.col("shingles").alias("sb")), "b")
        .withColumn("common", F.size(F.array_intersect("sa", "sb")))
        .select("a", "b", (F.col("common") / (F.size("sa") + F.size("sb") - F.col("common"))).alias("similarity"))
        .where(F.col("similarity") >= low)
        .groupBy("a", "b")
        .agg(F.max("similarity").alias("similarity"))
    )
    members = table.select("id").distinct().join(grouped, "id", "left").select("id", F.coalesce("rep", "id").alias("rep"))
    return pairs, members


def expand_pairs(pairs: DataFrame, members: DataFrame) -> DataFrame:
    """All pairs (id_a < id_b) of members of linked classes, and of members of one class.

    The joins are on the representative; a class of very many copies is split
    by AQE's skew join, since neither side is grouped.
    """
    m = members.select("id", "rep")
    left = m.select(F.col("id").alias("x"), F.col("rep").alias("a"))
    right = m.select(F.col("id").alias("y"), F.col("rep").alias("b"))
    across = pairs.select("a", "b").join(left, "a").join(right, "b").select("x", "y")
    rep = m.where("id <> rep").select("rep").distinct()
    inside = left.join(rep, F.col("a") == F.col("rep"), "left_semi")
    within = inside.join(right, F.col("a") == F.col("b")).where("x < y").select("x", "y")
    return across.unionByName(within).select(F.least("x", "y").alias("id_a"), F.greatest("x", "y").alias("id_b"))


def connected_groups(edges: DataFrame, *, max_rounds: int = 40) -> DataFrame:
    """(id, group) of the connected components of edges a-b; group is the smallest id.

    Alternating large-star and small-star rounds: each shuffles only the edges,
    with map-side minima, and is cut by a written table. Ends when no edge
    changes, which takes a logarithmic number of rounds; more than max_rounds
    raises an error instead of returning an unfinished result.
    """
    e = materialize(edges.select(F.col("a").alias("u"), F.col("b").alias("v")).where("u <> v").distinct(), "edges")
    before = None
    for _ in range(max_rounds):
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        low = down.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            down.join(low, "u")
            .select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct(F.col("u"), F.col("m").alias("v")))).alias("x"))
            .select("x.u", "x.v")
            .where("u <> v")
            .distinct()
        )
        e = materialize(small, "edges")
        now = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            return e.select(F.col("u").alias("id"), F.col("v").alias("group")).unionByName(e.select(F.col("v").alias("id"), F.col("v").alias("group")).distinct())
        before = now
    raise RuntimeError("connected components did not settle")


def near_duplicate_groups(df: DataFrame, *, id_col: str, text_col: str, words: int = 5, threshold: float = 0.8, **more: int) -> DataFrame:
    """One row per text with a word run: id, class_id (same set), group_id (linked classes), links.

    links counts the linked classes of the text's class, copies not expanded.
    Texts without any link are their own group with 0 links.
    """
    pairs, members = near_duplicate_pairs(df, id_col=id_col, text_col=text_col, words=words, threshold=threshold, **more)
    pairs = materialize(pairs.select("a", "b"), "pairs")
    groups = connected_groups(pairs)
    degree = pairs.select(F.col("a").alias("rep")).unionAll(pairs.select("b")).groupBy("rep").agg(F.count("*").alias("links"))
    info = groups.select(F.col("id").alias("rep"), F.col("group").alias("group_id")).join(degree, "rep", "left")
    return members.join(info, "rep", "left").select(
        "id", F.col("rep").alias("class_id"), F.coalesce("group_id", "rep").alias("group_id"), F.coalesce("links", F.lit(0)).cast("long").alias("links")
    )
