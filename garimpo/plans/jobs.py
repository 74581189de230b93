"""The runs: discovery, processing within a budget, submission, checkpoint; for one source, several, the backlog and leases.

Exit codes: 0 done or nothing to do, 1 failed, 2 wrong settings. What a run
tries is bounded by its budgets, so its rounds and its ordered sink are small;
discovery before it is distributed.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators import joins, submit
from ..session import materialize
from ..sources import landing
from ..sources.specs import names

# Successes, and attempts of the API source, in a run.
BUDGET = 5
ATTEMPTS = 20

# (url, ...) rows to (url, worker_result, error) rows.
Process = Callable[[DataFrame], DataFrame]


@dataclass
class Run:
    exit_code: int = 0
    stats: dict[str, int] = field(default_factory=dict)
    results: DataFrame | None = None
    submission: dict | None = None
    message: str = ""


def process_within(candidates: DataFrame, process: Process, *, seq: str, budget: int, attempts: int | None = None) -> tuple[DataFrame, int, int]:
    """(results, tried, successes): candidates in order of seq (unique) until `budget` of them succeeded or `attempts` were tried.

    Failures use up attempts only. A round takes as many candidates as successes
    are missing, so none is tried that one-by-one processing would not try.
    Results have the candidates' columns and worker_result, error.
    """
    done: DataFrame | None = None
    tried = successes = 0
    after = None
    while successes < budget and (attempts is None or tried < attempts):
        size = budget - successes if attempts is None else min(budget - successes, attempts - tried)
        rest = candidates if after is None else candidates.where(F.col(seq) > F.lit(after))
        part = materialize(rest.orderBy(seq).limit(size), "round")
        seen = part.agg(F.count("*").alias("n"), F.max(seq).alias("last")).first()
        if not seen.n:
            break
        outcome = process(part).select(F.col("url").alias("__url"), "worker_result", "error").dropDuplicates(["__url"])
        rows = materialize(part.join(outcome, F.col("url") == F.col("__url"), "left").drop("__url"), "processed")
        done = rows if done is None else done.unionByName(rows)
        tried += seen.n
        successes += rows.where("worker_result IS NOT NULL").count()
        after = seen.last
    if done is None:
        empty = candidates.limit(0)
        outcome = process(empty).select(F.col("url").alias("__url"), "worker_result", "error")
        done = empty.join(outcome, F.col("url") == F.col("__url"), "left").drop("__url")
    return done, tried, successes


def _submitted(run: Run, send: Callable, *, seq: str, source: str | None, sleep: Callable[[float], None]) -> None:
    good = run.results.where(submit.submittable(F.col("worker_result"), F.col("error")))
    run.submission = submit.submit(good, send, seq=seq, sleep=sleep, source=source)


def run_source(
    candidates: DataFrame,
    process: Process,
    send: Callable,
    *,
    seq: str,
    sleep: Callable[[float], None],
    source: str | None = None,
    budget: int = BUDGET,
    attempts: int | None = None,
    search_failures: int = 0,
    checkpoint: tuple[str, datetime] | None = None,
) -> Run:
    """One source's candidates, processed within the budget and submitted.

    Code 1: no candidates though searches failed, no success among candidates,
    or nothing submitted. The checkpoint (path, start of the discovery) advances
    only if something was submitted and no batch failed.
    """
    run = Run(stats={"candidates": candidates.count()})
    if not run.stats["candidates"]:
        if search_failures:
            run.exit_code, run.message = 1, "searches failed and gave no candidates"
        return run
    run.results, run.stats["processed"], run.stats["successes"] = process_within(candidates, process, seq=seq, budget=budget, attempts=attempts)
    run.stats["failures"] = run.results.where("error IS NOT NULL").count()
    if not run.stats["successes"]:
        run.exit_code, run.message = 1, "no candidate could be processed"
        return run
    _submitted(run, send, seq=seq, source=source, sleep=sleep)
    if not run.submission["submitted"]:
        run.exit_code, run.message = 1, "nothing was submitted"
    elif checkpoint and submit.may_advance(run.submission):
        landing.save_checkpoint(*checkpoint)
    return run


def orchestrate(listed: str | None, discover: Callable[[str], DataFrame], process: Process, send: Callable, *, seq: str, sleep: Callable[[float], None], budget: int = BUDGET, known: list[str] | None = None) -> tuple[int, dict[str, Run]]:
    """(exit code, runs): several sources in the order given, sharing one budget of successes.

    No or unknown sources are code 2. A source that fails makes the code 1 and
    the next one follows; once the budget is used up no further source begins.
    """
    try:
        wanted = names(listed) if known is None else [n.strip() for n in (listed or "").split(",") if n.strip()]
    except ValueError:
        return 2, {}
    if not (listed or "").strip() or any(n not in (known or wanted) for n in wanted):
        return 2, {}
    code, left, runs = 0, budget, {}
    for source in dict.fromkeys(wanted):
        if left <= 0:
            break
        try:
            runs[source] = run_source(discover(source), process, send, seq=seq, sleep=sleep, source=source, budget=left)
        except Exception as e:  # noqa: BLE001
            runs[source] = Run(1, {"errors": 1}, message=f"{type(e).__name__}: {e}")
        left -= runs[source].stats.get("successes", 0)
        code = max(code, runs[source].exit_code)
    return code, runs


def run_backfill(claims: DataFrame, process: Process, send: Callable, *, seq: str, sleep: Callable[[float], None], source: str | None = None, attempts: int = ATTEMPTS, budget: int = BUDGET) -> Run:
    """Claimed candidates (landing.claimed), processed within both caps and submitted; code 1 if nothing was submitted or a batch failed."""
    run = Run(stats={"claimed": claims.count()})
    if not run.stats["claimed"]:
        return run
    run.results, run.stats["processed"], run.stats["successes"] = process_within(claims, process, seq=seq, budget=budget, attempts=attempts)
    run.stats["failures"] = run.stats["processed"] - run.stats["successes"]
    _submitted(run, send, seq=seq, source=source, sleep=sleep)
    run.exit_code = 0 if submit.may_advance(run.submission) else 1
    return run


@dataclass(frozen=True)
class WorkerSettings:
    """Claims a run, seconds between renewals, and a lease's seconds."""

    claims: int = 5
    renewal: float = 60.0
    lease: int = 300


def run_worker(queue: DataFrame, leases: DataFrame, process: Process, *, key: str, order: list[Column], now: Column, token: str, lost: DataFrame | None = None, settings: WorkerSettings = WorkerSettings()) -> tuple[DataFrame, DataFrame]:
    """(answers, leases after them) of one worker run: claim, process, then complete what succeeded and fail what didn't.

    queue: key, url; leases: key, token, expires_at, state. Claims take a lease
    under `token`; keys in `lost` were taken over while they were processed
    (see streaming.leases), so their calls are answered with 409 and their
    results are dropped.
    """
    claimed = materialize(joins.claim(queue, leases, key=key, order=order, now=now, limit=settings.claims), "claimed")
    taken = claimed.select(key, F.lit(token).alias("token"), (now + F.expr(f"INTERVAL {settings.lease} SECONDS")).alias("expires_at"), F.lit("running").alias("state"))
    if lost is not None:
        gone = lost.select(F.col(key).alias("__lost")).distinct()
        taken = taken.join(gone, F.col(key) == F.col("__lost"), "left").withColumn("token", F.when(F.col("__lost").isNotNull(), F.concat(F.lit("not "), F.lit(token))).otherwise(F.col("token"))).drop("__lost")
    held = leases.join(claimed.select(F.col(key).alias("__key")), F.col(key) == F.col("__key"), "left_anti").unionByName(taken)
    outcome = process(claimed).select(F.col("url").alias("__url"), "worker_result", "error")
    calls = claimed.join(outcome, F.col("url") == F.col("__url"), "left").select(key, F.lit(token).alias("token"), F.when(F.col("worker_result").isNotNull(), "complete").otherwise("fail").alias("action"))
    answers = materialize(joins.settle(held, calls, key=key, now=now), "answers")
    return answers, joins.apply_calls(held, answers, key=key, now=now, seconds=settings.lease)
