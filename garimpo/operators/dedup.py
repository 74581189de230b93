"""Order-dependent deduplication on unordered data: the order is a column."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _names(df: DataFrame) -> list[Column]:
    return [df[f"`{c}`"] for c in df.columns]


def keep_first(df: DataFrame, keys: list[str], seq: str) -> DataFrame:
    """Of each key the row with the least seq. Rows with a null key are dropped; whole repeated rows count once.

    One shuffle with map-side minima (min_by), so a key that holds a large part
    of all rows costs one row per task, unlike a window.
    """
    present = df.where(" AND ".join(f"`{k}` IS NOT NULL" for k in keys)) if keys else df
    packed = present.groupBy(*[F.col(f"`{k}`").alias(f"__k{i}") for i, k in enumerate(keys)]).agg(F.min_by(F.struct(*_names(present)), F.struct(F.col(f"`{seq}`"), F.xxhash64(*_names(present)))).alias("__row"))
    return packed.select("__row.*")


def keep_latest(df: DataFrame, key: str, order: list[str], seq: str) -> DataFrame:
    """Of each non-blank key the row with the greatest order columns, compared as text, null as ""; ties keep the first seen.

    Adds first_seq, the seq at which the key first appeared: ordering by it gives
    the keys in order of appearance. Null and blank keys are dropped.
    """
    present = df.where(F.trim(F.coalesce(F.col(f"`{key}`"), F.lit(""))) != "")
    rank = F.struct(*[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in order], -F.col(f"`{seq}`"))
    packed = present.groupBy(F.col(f"`{key}`").alias("__key")).agg(F.max_by(F.struct(*_names(present)), rank).alias("__row"), F.min(f"`{seq}`").alias("first_seq"))
    return packed.select("__row.*", "first_seq")


def union_distinct(parts: list[DataFrame], keys: list[str]) -> DataFrame:
    """Parts one after the other, each key at its first place. Every part has a column seq; the result's seq numbers part and place."""
    joined = None
    for n, part in enumerate(parts):
        part = part.withColumn("seq", F.struct(F.lit(n).alias("part"), F.col("seq").cast("long").alias("place")))
        joined = part if joined is None else joined.unionByName(part, allowMissingColumns=True)
    return keep_first(joined, keys, "seq")


def not_seen(df: DataFrame, seen: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key isn't in seen; rows of null keys stay."""
    return df.join(seen.select(*keys).distinct(), keys, "left_anti")
