"""Batches for a sink: what may be submitted, in chunks of fixed size, up to the first failed batch."""

from __future__ import annotations

from collections.abc import Callable
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import caps

BATCH_SIZE = 30
MAX_ATTEMPTS = 4
# A run submits what its budgets let through; more rows than this are no run's results.
MOST_ROWS = 100_000


def submittable(result: Column, error: Column) -> Column:
    """A result is there and no error."""
    return result.isNotNull() & (F.coalesce(error, F.lit("")) == "")


def batches(df: DataFrame, *, seq: str, size: int = BATCH_SIZE) -> DataFrame:
    """Adds batch_no (from 0) and place (from 0 within the batch) in the order of seq, without a single-task window."""
    placed = caps.running(df, seq, {"__before": F.lit(1).cast("long")})
    return placed.withColumn("batch_no", F.floor(F.col("__before") / size)).withColumn("place", F.col("__before") % size).drop("__before")


def up_to_first_failure(outcomes: DataFrame) -> DataFrame:
    """Of (batch_no, ok) the batches that were sent: up to and with the first failed one."""
    failed = outcomes.where(~F.coalesce(F.col("ok"), F.lit(False))).agg(F.min("batch_no").alias("stop"))
    return outcomes.join(F.broadcast(failed)).where(F.col("stop").isNull() | (F.col("batch_no") <= F.col("stop"))).drop("stop")


def summary(df: DataFrame, *, result: Column, error: Column, size: int = BATCH_SIZE) -> DataFrame:
    """One row: total, filtered_out, submitted, batches, with_error."""
    good = submittable(result, error)
    return df.agg(
        F.count("*").alias("total"),
        F.count_if(~good).alias("filtered_out"),
        F.count_if(good).alias("submitted"),
        F.ceil(F.count_if(good) / size).alias("batches"),
        F.count_if(F.coalesce(error, F.lit("")) != "").alias("with_error"),
    )


def delay(attempt: int) -> int:
    """Seconds to wait after a failed attempt: 5, 25, 125."""
    return 5**attempt


def post_batch(rows: list[dict], send: Callable[[list[dict]], tuple[int, Any]], *, sleep: Callable[[float], None], attempts: int = MAX_ATTEMPTS) -> dict:
    """One batch with retries: {"ok", "status", "response", "attempts"}. Codes 408, 425, 429 and from 500 on are tried again; others fail at once.

    A success without a JSON body counts as accepted.
    """
    status, response = 0, None
    for attempt in range(1, attempts + 1):
        status, response = send(rows)
        if 200 <= status < 300:
            return {"ok": True, "status": status, "response": response if isinstance(response, dict) else {"status": "accepted"}, "attempts": attempt}
        if not (status in (0, 408, 425, 429) or status >= 500) or attempt == attempts:
            break
        sleep(delay(attempt))
    return {"ok": False, "status": status, "response": response, "attempts": attempt}


def submit(df: DataFrame, send: Callable[[list[dict]], tuple[int, Any]], *, seq: str, sleep: Callable[[float], None], size: int = BATCH_SIZE, source: str | None = None, most: int = MOST_ROWS) -> dict:
    """Sends the batches in order and stops at the first failure: submitted, batches, failed_batches, errors, last_result.

    Each batch waits for the one before, so the sink is sequential by its nature
    and bounded: more than `most` rows are an error. Rows stream to the driver one
    partition at a time. With source, each row names it.
    """
    if source is not None:
        df = df.withColumn("source", F.lit(source))
    if (rows := df.count()) > most:
        raise ValueError(f"{rows} rows are more than a run submits")
    ordered = batches(df, seq=seq, size=size).orderBy(seq)
    out = {"submitted": 0, "batches": 0, "failed_batches": 0, "errors": [], "last_result": None}
    batch: list[dict] = []

    def flush() -> bool:
        done = post_batch(batch, send, sleep=sleep)
        out["batches"] += 1
        if done["ok"]:
            out["submitted"] += len(batch)
            out["last_result"] = done["response"]
        else:
            out["failed_batches"] += 1
            out["errors"].append(f"batch {out['batches']}: status {done['status']}")
        batch.clear()
        return done["ok"]

    for row in ordered.toLocalIterator(prefetchPartitions=True):
        batch.append(row.asDict(recursive=True))
        if len(batch) == size and not flush():
            return out
    if batch:
        flush()
    return out


def may_advance(result: dict) -> bool:
    """Whether a checkpoint may advance after a submission: something was submitted and no batch failed."""
    return result["failed_batches"] == 0 and result["submitted"] > 0


def upsert(state: DataFrame, changes: DataFrame, keys: list[str], *, compare: list[str], active: str | None = None) -> DataFrame:
    """The state after idempotent changes, with outcome: inserted, updated, reactivated, duplicate or kept.

    With active, the name of a boolean column, a change to a row that is not
    active reactivates it, whether or not anything else differs.

    changes hold each key once. A change equal to the state in the compared
    columns is a duplicate and changes nothing.
    """
    s, c = state.withColumn("__there", F.lit(1)).alias("s"), changes.withColumn("__there", F.lit(1)).alias("c")
    joined = s.join(c, [F.col(f"s.`{k}`").eqNullSafe(F.col(f"c.`{k}`")) for k in keys], "full")
    flag_s, flag_c = F.col("s.__there").isNotNull(), F.col("c.__there").isNotNull()
    equal = F.lit(True)
    for k in compare:
        equal = equal & F.col(f"s.`{k}`").eqNullSafe(F.col(f"c.`{k}`"))
    outcome = F.when(~flag_c, "kept").when(~flag_s, "inserted").when(~F.coalesce(F.col(f"s.`{active}`"), F.lit(True)) & F.coalesce(F.col(f"c.`{active}`"), F.lit(True)) if active else F.lit(False), "reactivated").when(equal, "duplicate").otherwise("updated")
    return joined.select(*[F.when(flag_c, F.col(f"c.`{n}`")).otherwise(F.col(f"s.`{n}`")).alias(n) for n in state.columns], outcome.alias("outcome"))
