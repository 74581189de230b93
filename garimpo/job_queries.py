"""Queries of whole runs: landed candidates through a budget to submission, leases and their heartbeats."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators import submit
from .plans import jobs
from .queries import _SOURCE, _now, _sourced, _t, query
from .session import materialize, work_dir
from .streaming import leases

BUDGET = 120
# The last source of the run gives what the budget has left.
RUN_SOURCES = ("bndes", "brde", "funbio", "wwf", "pncp")


def _landed(spark: SparkSession, sf_dir: str) -> jobs.Process:
    """Processing as it was landed: the outcome of a candidate's download stands for download and recognition."""
    d = _t(spark, sf_dir, "downloads").where("candidate_id IS NOT NULL").select(F.col("candidate_id").alias("__id"), "outcome", "content_hash")

    def process(rows: DataFrame) -> DataFrame:
        j = rows.join(d, F.col("candidate_id") == F.col("__id"), "left")
        good = F.coalesce(F.col("outcome") == "valid_pdf", F.lit(False))
        return j.select("url", F.when(good, F.coalesce("content_hash", F.lit(""))).alias("worker_result"), F.when(~good, F.coalesce("outcome", F.lit("download: missing"))).alias("error"))

    return process


def _tries(spark: SparkSession, sf_dir: str, source: str) -> DataFrame:
    """A source's candidates, the first of each url, in order of discovery."""
    c = _sourced(spark, sf_dir).where(F.col("source") == source).groupBy("url").agg(F.min("candidate_id").alias("candidate_id"))
    return c.select("candidate_id", "url")


_RUN_SQL = f"""with s as (select * from (values {", ".join(f"({i}, '{n}')" for i, n in enumerate(RUN_SOURCES))}) v(k, source)),
    c as (select {_SOURCE} as source, url, min(candidate_id) as candidate_id from candidates where url is not null group by all), o as (select k, source, candidate_id, coalesce(outcome = 'valid_pdf', false) as ok from c join s using (source) left join downloads using (candidate_id)),
    r as (select *, coalesce(sum(ok::int) over (order by k, candidate_id rows between unbounded preceding and 1 preceding), 0) as before from o), t as (select * from r where before < {BUDGET}),
    b as (select *, case when ok then sum(ok::int) over (partition by k order by candidate_id) end as no from t)
    select source, candidate_id, ok, cast(floor((no - 1) / 30) as bigint) as batch_no from b"""


@query(_RUN_SQL)
def source_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Several sources under one budget of successes, each submitted in batches of 30 as long as none fails."""
    sent: list[dict] = []

    def send(rows: list[dict]) -> tuple[int, dict]:
        sent.extend({"candidate_id": r["candidate_id"], "batch_no": r["batch_no"]} for r in rows)
        return 200, {"status": "accepted"}

    _, runs = jobs.orchestrate(",".join(RUN_SOURCES), lambda n: _tries(spark, sf_dir, n), _landed(spark, sf_dir), send, seq="candidate_id", sleep=lambda _: None, budget=BUDGET, known=list(RUN_SOURCES))
    done = spark.createDataFrame([], "source string, candidate_id long, ok boolean")
    for name, run in runs.items():
        if run.results is not None:
            done = done.unionByName(run.results.select(F.lit(name).alias("source"), "candidate_id", F.col("worker_result").isNotNull().alias("ok")))
    # at most the budget's rows were sent
    batches = spark.createDataFrame([(r["candidate_id"], r["batch_no"]) for r in sent], "sent long, batch_no long")
    return done.join(batches, F.col("candidate_id") == F.col("sent"), "left").select("source", "candidate_id", "ok", "batch_no")


@query(
    """with c as (select id, trim(url) as url, min(id) over (partition by trim(url)) as first from backfill_claims where trim(coalesce(url, '')) <> ''), k as (select min(candidate_id) as candidate_id, url from candidates group by url),
    o as (select c.id, coalesce(outcome = 'valid_pdf', false) as ok from c left join k using (url) left join downloads using (candidate_id) where c.id = c.first),
    r as (select *, coalesce(sum(ok::int) over (order by id rows between unbounded preceding and 1 preceding), 0) as before, row_number() over (order by id) as n from o)
    select id, ok from r where before < 20 and n <= 60"""
)
def backfill_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Claims processed in order, at most 60 attempts and 20 successes, then submitted."""
    c = _t(spark, sf_dir, "backfill_claims").select("id", F.trim("url").alias("url")).where("url IS NOT NULL AND url <> ''").groupBy("url").agg(F.min("id").alias("id"))
    known = _t(spark, sf_dir, "candidates").groupBy(F.col("url").alias("__u")).agg(F.min("candidate_id").alias("candidate_id"))
    claims = c.join(known, F.col("url") == F.col("__u"), "left").drop("__u")
    run = jobs.run_backfill(materialize(claims, "claims"), _landed(spark, sf_dir), lambda rows: (200, {"status": "accepted"}), seq="id", sleep=lambda _: None, attempts=60, budget=20)
    return run.results.select("id", F.col("worker_result").isNotNull().alias("ok"))


@query(
    """with k as (select min(candidate_id) as candidate_id, url from candidates group by url), q as (select id, url, discovered_at from backfill_claims where trim(coalesce(url, '')) <> ''),
    c as (select * from q order by discovered_at nulls last, id limit 50), o as (select c.id, coalesce(bool_or(outcome = 'valid_pdf'), false) as ok from c left join k on k.url = c.url left join downloads using (candidate_id) group by c.id)
    select id, case when ok then 'complete' else 'fail' end as action, case when id % 7 = 0 then 409 else 200 end as status, case when id % 7 = 0 then 'running' when ok then 'done' else 'failed' end as state from o"""
)
def worker_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """50 claims leased, processed, completed or failed; leases that were taken over are answered with 409."""
    known = _t(spark, sf_dir, "candidates").groupBy(F.col("url").alias("__u")).agg(F.min("candidate_id").alias("candidate_id"))
    q = _t(spark, sf_dir, "backfill_claims").where("trim(coalesce(url, '')) <> ''").select("id", "url", "discovered_at").join(known, F.col("url") == F.col("__u"), "left").drop("__u")
    none = spark.createDataFrame([], "id long, token string, expires_at timestamp, state string")
    process = lambda rows: _landed(spark, sf_dir)(rows).groupBy("url").agg(F.max("worker_result").alias("worker_result"), F.max("error").alias("error"))
    lost = q.where("id % 7 = 0").select("id")
    order = [F.asc_nulls_last("discovered_at"), F.col("id")]
    answers, after = jobs.run_worker(q, none, process, key="id", order=order, now=_now(), token="w1", lost=lost, settings=jobs.WorkerSettings(claims=50))
    return answers.join(after.select(F.col("id").alias("__id"), "state"), F.col("id") == F.col("__id")).select("id", "action", "status", "state")


@query("select user_id % 50 as k, cast(count(*) as bigint) as calls from events where user_id is not null group by 1")
def lease_heartbeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T4: every event as a claim or renewal of one of 50 leases, by a stream with a timer for each; each call is answered exactly once."""
    src = _t(spark, sf_dir, "events").where("user_id IS NOT NULL")
    base = f"{work_dir(spark)}/garimpo/leases-{uuid.uuid4().hex[:12]}"
    src.select((F.col("user_id") % 50).cast("string").alias("key"), F.col("user_id").cast("string").alias("token"), F.when(F.col("event_id") % 3 == 0, "claim").otherwise("renew").alias("action"), F.col("ts").cast("timestamp").alias("at")).write.parquet(f"{base}/calls")
    calls = spark.readStream.schema("key string, token string, action string, at timestamp").parquet(f"{base}/calls")
    q = leases.heartbeats(calls, seconds=60, late="36500 days").writeStream.format("parquet").option("path", f"{base}/out").option("checkpointLocation", f"{base}/checkpoint").outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination()
    answered = spark.read.schema(leases.OUT).parquet(f"{base}/out").where("event <> 'expired'")
    return answered.groupBy(F.col("key").cast("long").alias("k")).agg(F.count("*").alias("calls"))


@query("select result_id, candidate_id, case when s.result_id % 5 = 0 then 'reactivated' when s.result_id % 5 = 1 then 'duplicate' when s.result_id % 5 = 2 then 'updated' else 'kept' end as outcome from worker_results s where candidate_id is not null")
def reactivations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K6: an upsert in which every fifth row was inactive: changes reactivate it whether or not anything differs."""
    s = _t(spark, sf_dir, "worker_results").where("candidate_id IS NOT NULL").select("result_id", "candidate_id", F.lit("a").alias("v"), (F.col("result_id") % 5 != 0).alias("active"))
    c = s.where("result_id % 5 < 3").select("result_id", "candidate_id", F.when(F.col("result_id") % 5 == 2, "b").otherwise("a").alias("v"), F.lit(True).alias("active"))
    return submit.upsert(s, c, ["result_id"], compare=["v"], active="active").select("result_id", "candidate_id", "outcome")
