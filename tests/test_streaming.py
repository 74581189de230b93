from pyspark.sql import functions as F

from garimpo.streaming.incremental import arrivals, latest_state, run_available


def test_runs_commit_after_the_sink(spark, tmp_path):
    source, state, check = f"{tmp_path}/in", f"{tmp_path}/state", f"{tmp_path}/check"
    schema = "k string, v int, ts timestamp"

    def put(rows):
        spark.createDataFrame(rows, "k string, v int, t string").select("k", "v", F.col("t").cast("timestamp").alias("ts")).write.mode("append").parquet(source)

    seen = []

    def sink(batch, n):
        seen.append(n)
        latest_state(spark, f"{state}-{n - 1}", batch, "k", ["ts"]).write.mode("overwrite").parquet(f"{state}-{n}")

    def failing(batch, n):
        raise RuntimeError("sink is down")

    put([("a", 1, "2026-01-01"), ("b", 1, "2026-01-01")])
    q = run_available(arrivals(spark, source, schema, ts="ts"), failing, check)
    try:
        q.awaitTermination()
    except Exception:
        pass
    run_available(arrivals(spark, source, schema, ts="ts"), sink, check).awaitTermination()
    put([("a", 2, "2026-01-02"), ("a", 0, "2025-01-01")])
    run_available(arrivals(spark, source, schema, ts="ts"), sink, check).awaitTermination()
    got = spark.read.parquet(f"{state}-{seen[-1]}").collect()
    assert {r.k: r.v for r in got} == {"a": 2, "b": 1}


def test_duplicates_within_the_overlap(spark, tmp_path):
    source = f"{tmp_path}/in"
    rows = [("a", "2026-01-01 00:00:00"), ("a", "2026-01-01 10:00:00"), ("b", "2026-01-01 00:00:00")]
    spark.createDataFrame(rows, "k string, t string").select("k", F.col("t").cast("timestamp").alias("ts")).write.parquet(source)
    out = []
    stream = arrivals(spark, source, "k string, ts timestamp", ts="ts", keys=["k"])
    run_available(stream, lambda batch, n: out.extend(r.k for r in batch.collect()), f"{tmp_path}/check").awaitTermination()
    assert sorted(out) == ["a", "b"]
