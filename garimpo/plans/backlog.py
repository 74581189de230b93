"""The backlog of claims: order, activity, matches and counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import dates, text


def deadline_of(metadata: Column) -> Column:
    return dates.parse_datetime(F.get_json_object(metadata, "$.dataEncerramentoProposta"))


def order(df: DataFrame, now: Column) -> tuple[DataFrame, list[Column]]:
    """The claims with deadline and priority, and their five-key order: active first, notices first, deadline, discovery, id; nulls last."""
    keyed = df.withColumn("deadline", deadline_of(F.col("candidate_metadata"))).withColumn("priority", F.coalesce(F.get_json_object("candidate_metadata", "$.priority").try_cast("int"), F.lit(text.OTHER_PRIORITY)))
    return keyed, [F.when(F.col("deadline") > now, 0).otherwise(1), F.when(F.col("priority") == 10, 0).otherwise(1), F.asc_nulls_last("deadline"), F.asc_nulls_last("discovered_at"), F.col("id")]


def next_claims(df: DataFrame, *, now: Column, limit: int, active_only: bool = False) -> DataFrame:
    """The first claims in order. Activity is filtered after the limit, so fewer rows than the limit may come."""
    keyed, by = order(df, now)
    first = keyed.orderBy(*by).limit(limit)
    return first.where(F.col("deadline") > now) if active_only else first
