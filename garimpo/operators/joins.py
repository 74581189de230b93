"""Joins: records with their documents, cross products of small parameter tables, leases."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A parameter table larger than this is an error: it isn't one.
PARAMETER_ROWS = 100_000


def dependent(left: DataFrame, right: DataFrame, keys: dict[str, str], how: str = "inner") -> DataFrame:
    """Each left row with the right rows of its key, {left column: right column}. Null and empty keys match nothing.

    Equal keys of both sides are joined by whatever Catalyst and AQE choose; a
    key that holds a large part of one side is split by the skew join.
    """
    r = right.select(*[right[f"`{c}`"].alias(f"__r_{c}") if c in keys.values() else right[f"`{c}`"] for c in right.columns])
    cond = None
    for a, b in keys.items():
        one = (left[f"`{a}`"] == r[f"`__r_{b}`"]) & (left[f"`{a}`"].cast("string") != "")
        cond = one if cond is None else cond & one
    return left.join(r, cond, how).drop(*[f"__r_{c}" for c in keys.values()])


def parameter_product(*tables: DataFrame) -> DataFrame:
    """All combinations of small parameter tables (scopes, endpoints, codes); their sizes are checked."""
    out = tables[0]
    for t in tables[1:]:
        if (n := t.count()) > PARAMETER_ROWS:
            raise ValueError(f"{n} rows are no parameter table")
        out = out.crossJoin(F.broadcast(t))
    return out


def left_count(left: DataFrame, right: DataFrame, key: str, matched: str) -> DataFrame:
    """One row: left rows joined, matched rows, unmatched rows, of a left join on a key. The right side is counted by key first."""
    counts = right.groupBy(F.col(f"`{key}`").alias(key)).agg(F.count(f"`{matched}`").alias("__m"), F.count("*").alias("__n"))
    j = left.select(f"`{key}`").join(counts, key, "left")
    return j.agg(
        F.sum(F.coalesce("__n", F.lit(1))).alias("joined"),
        F.sum(F.coalesce("__m", F.lit(0))).alias("matched"),
        F.count_if(F.col("__n").isNull()).alias("unmatched"),
    )


def coalesce_relations(primary: DataFrame, fallback: DataFrame, group: str) -> DataFrame:
    """The primary rows of each group, and the fallback rows of groups without any: a fallback scan used only where it is needed."""
    have = primary.select(group).distinct()
    return primary.unionByName(fallback.join(have, group, "left_anti"), allowMissingColumns=True)


# ---------------------------------------------------------------- leases


def claim(queue: DataFrame, leases: DataFrame, *, key: str, order: list[Column], now: Column, limit: int) -> DataFrame:
    """The first `limit` rows of the queue whose key has no lease that is running or done.

    leases: (key, token, expires_at, state) with state running, done or failed.
    """
    held = leases.where((F.col("state") == "done") | ((F.col("state") == "running") & (F.col("expires_at") > now))).select(key).distinct()
    return queue.join(held, key, "left_anti").orderBy(*order).limit(limit)


def settle(leases: DataFrame, calls: DataFrame, *, key: str, now: Column) -> DataFrame:
    """Answers to renew, complete and fail calls: (key, token, action, status): 200, or 409 if the lease is another's, over or unknown."""
    joined = calls.alias("c").join(leases.alias("l"), F.col(f"c.`{key}`") == F.col(f"l.`{key}`"), "left")
    ok = (F.col("c.token") == F.col("l.token")) & (F.col("l.state") == "running") & (F.col("l.expires_at") > now)
    return joined.select(F.col(f"c.`{key}`"), "c.token", "c.action", F.when(F.coalesce(ok, F.lit(False)), 200).otherwise(409).alias("status"))


def apply_calls(leases: DataFrame, answered: DataFrame, *, key: str, now: Column, seconds: int) -> DataFrame:
    """The lease table after the accepted calls, each key called at most once."""
    good = answered.where("status = 200").select(F.col(f"`{key}`").alias("__key"), "action")
    j = leases.join(good, leases[f"`{key}`"] == good["__key"], "left")
    return j.select(
        leases[f"`{key}`"],
        "token",
        F.when(F.col("action") == "renew", now + F.expr(f"INTERVAL {seconds} SECONDS")).otherwise(F.col("expires_at")).alias("expires_at"),
        F.when(F.col("action") == "complete", "done").when(F.col("action") == "fail", "failed").otherwise(F.col("state")).alias("state"),
    )
