"""Run statistics as one aggregation each."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def counters(df: DataFrame, named: dict[str, Column], by: list[str] | None = None) -> DataFrame:
    """How many rows meet each condition, over all rows or by group, and `rows`. Conditions that are null count as not met."""
    return df.groupBy(*(by or [])).agg(F.count("*").alias("rows"), *[F.count_if(c).alias(n) for n, c in named.items()])


def counter_map(df: DataFrame, by: str, named: dict[str, Column]) -> DataFrame:
    """Counters by group as one map<string, bigint> a group."""
    wide = counters(df, named, [by])
    return wide.select(by, F.map_from_arrays(F.array(*map(F.lit, named)), F.array(*[F.col(n) for n in named])).alias("counters"))


def rejection_split(df: DataFrame, year_ok: Column, policy_ok: Column, by: list[str] | None = None) -> DataFrame:
    """Rows rejected by year, those rejected by policy of the others, and the accepted ones."""
    return counters(df, {"rejected_year": ~year_ok, "rejected_policy": year_ok & ~policy_ok, "accepted": year_ok & policy_ok}, by)
