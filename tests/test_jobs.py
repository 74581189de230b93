"""Runs, PDF pages, leases and caps: against loops, and with hot groups and far-off orders."""

import random
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from garimpo.operators import caps, submit
from garimpo.plans import jobs, pdf
from garimpo.sources import landing
from garimpo.streaming import leases


def largest_task(df):
    return df.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]


def test_ranges_hold_few_rows_whatever_the_order(spark):
    rows = [(i, "hot", 1) for i in range(999)] + [(10**15, "hot", 1)]
    df = spark.createDataFrame(rows, "seq long, g string, v long")
    sizes = df.withColumn("r", caps._range_of(df, "seq", 100)).groupBy("r").count().collect()
    assert len(sizes) >= 8 and max(r["count"] for r in sizes) <= 150
    got = caps.running(df, "seq", {"before": F.col("v")}, group=["g"], rows=100).orderBy("seq").collect()
    assert [r.before for r in got] == list(range(1000))


@pytest.mark.parametrize("seed", [1, 2])
def test_streaks_of_a_hot_group_over_many_ranges(spark, seed):
    rng = random.Random(seed)
    rows = [(i * 7 - 900, "hot", rng.random() < 0.7) for i in range(400)]
    want, streak = [], 0
    for seq, _, bad in rows:
        streak = streak + 1 if bad else 0
        want.append((seq, streak))
        if streak == 12:
            break
    df = spark.createDataFrame(rows, "seq long, g string, bad boolean")
    assert [(r.seq, r.streak) for r in caps.stop_after_streak(df, 12, F.col("bad"), "seq", ["g"], rows=30).orderBy("seq").collect()] == want
    assert [(r.seq, r.streak) for r in caps.stop_after_streak(df, 12, F.col("bad"), "seq", [], rows=30).orderBy("seq").collect()] == want


def candidates(spark, n=30):
    return spark.createDataFrame([(i, f"u{i}") for i in range(n)], "seq long, url string")


def outcome(bad):
    def process(rows):
        failed = F.col("seq").isin(*bad) if bad else F.lit(False)
        return rows.select("url", F.when(~failed, F.lit("text")).alias("worker_result"), F.when(failed, F.lit("download: HTTP 404")).alias("error"))

    return process


def accept(rows):
    return 200, {"status": "accepted"}


def test_a_run_tries_what_one_by_one_would(spark):
    results, tried, ok = jobs.process_within(candidates(spark), outcome({0, 2, 3, 4}), seq="seq", budget=3)
    assert (tried, ok) == (7, 3) and sorted(r.seq for r in results.collect()) == list(range(7))
    assert jobs.process_within(candidates(spark), outcome(set(range(30))), seq="seq", budget=3, attempts=5)[1:] == (5, 0)
    empty, tried, ok = jobs.process_within(candidates(spark).limit(0), outcome({1}), seq="seq", budget=3)
    assert (empty.count(), tried, ok) == (0, 0, 0)


def test_exit_codes_and_checkpoint(spark, tmp_path):
    at, path = datetime(2026, 1, 1, tzinfo=timezone.utc), str(tmp_path / "c" / "s.json")
    run = lambda **k: jobs.run_source(k.pop("rows", candidates(spark)), k.pop("process", outcome({1})), k.pop("send", accept), seq="seq", sleep=lambda _: None, checkpoint=(path, at), **k)
    assert run(rows=candidates(spark).limit(0)).exit_code == 0 and run(rows=candidates(spark).limit(0), search_failures=2).exit_code == 1
    assert run(process=outcome(set(range(30))), attempts=4).exit_code == 1 and run(send=lambda rows: (400, None)).exit_code == 1
    assert landing.load_checkpoint(path) is None
    done = run(source="x")
    assert done.exit_code == 0 and done.submission["submitted"] == 5 and landing.load_checkpoint(path) == at
    assert not submit.may_advance({"failed_batches": 1, "submitted": 30})


def test_sources_share_a_budget(spark):
    def discover(name):
        if name == "b":
            raise RuntimeError("down")
        return candidates(spark, 4)

    go = lambda listed: jobs.orchestrate(listed, discover, outcome({0}), accept, seq="seq", sleep=lambda _: None, budget=5, known=["a", "b", "c", "d"])
    code, runs = go("a,b,c,d")
    assert code == 1 and list(runs) == ["a", "b", "c"] and [r.stats.get("successes") for r in runs.values()] == [3, None, 2]
    assert go("")[0] == go("a,x")[0] == 2 and jobs.orchestrate("nowhere", discover, outcome({0}), accept, seq="seq", sleep=lambda _: None)[0] == 2


def test_backfill_and_bounded_sink(spark):
    assert jobs.run_backfill(candidates(spark).limit(0), outcome({0}), accept, seq="seq", sleep=lambda _: None).exit_code == 0
    run = jobs.run_backfill(candidates(spark), outcome({0}), accept, seq="seq", sleep=lambda _: None, attempts=4)
    assert run.exit_code == 0 and run.stats == {"claimed": 30, "processed": 4, "successes": 3, "failures": 1}
    assert jobs.run_backfill(candidates(spark), outcome({0}), lambda rows: (400, None), seq="seq", sleep=lambda _: None).exit_code == 1
    with pytest.raises(ValueError):
        submit.submit(candidates(spark), accept, seq="seq", sleep=lambda _: None, most=10)


def test_pdf_pages():
    read = lambda data: [pdf.Page(t != "~", t, t) for t in data.decode().split("|")] if data != b"bad" else 1 / 0
    reader = pdf.Reader(read, lambda pages: "|".join(p.handle for p in pages).encode())
    assert pdf.optimised(b"a|~|b|c", reader, most=2) == b"a|b" and pdf.optimised(b"ab|c", reader, least_text=2) == b"ab"
    for broken in (b"", b"~|~", b"bad"):
        with pytest.raises(pdf.PdfError):
            pdf.optimised(broken, reader)
    extract = pdf.markdown_extractor(reader, lambda data: "seen " + data.decode() if data != b" " else "")
    assert extract(b"a|~|b") == "a\n\n<!-- Página 2 -->\n\nb" and extract(b"bad") == "seen bad" and extract(b"~|  ") == "seen   "
    with pytest.raises(pdf.PdfError):
        extract(b" ")
    assert pdf.validate(b"", most=9) == "empty" and pdf.validate(b"%PDF-1", most=3) == "too large" and pdf.validate(b"%PDF-1", most=9) is None and pdf.validate(b"<html>", most=9)


def test_leases_end_by_their_timers(spark, tmp_path):
    rows = [("k", "a", "claim", 0), ("k", "b", "claim", 10), ("k", "a", "renew", 50), ("k", "a", "complete", 100), ("m", "a", "claim", 0), ("m", "a", "renew", 200), ("n", "z", "renew", 5), (None, "a", "claim", 0), ("o", "a", "claim", 0)]
    frame = lambda rs: spark.createDataFrame([(k, t, a, datetime.fromtimestamp(1_700_000_000 + s, timezone.utc)) for k, t, a, s in rs], "key string, token string, action string, at timestamp")
    frame(rows).coalesce(1).write.parquet(str(tmp_path / "in" / "p=1"))
    schema = "key string, token string, action string, at timestamp"

    def go():
        calls = spark.readStream.schema(schema).parquet(str(tmp_path / "in" / "*"))
        q = leases.heartbeats(calls, seconds=60).writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
        q.awaitTermination()

    go()
    frame([("x", "x", "claim", 5000)]).coalesce(1).write.parquet(str(tmp_path / "in" / "p=2"))
    go()
    frame([("x", "x", "complete", 5001)]).coalesce(1).write.parquet(str(tmp_path / "in" / "p=3"))
    go()
    got = {}
    for r in spark.read.parquet(str(tmp_path / "out")).orderBy("key", "at").collect():
        got.setdefault(r.key, []).append(r.event)
    assert got["k"] == ["claimed", "lost", "renewed", "completed"] and got["m"] == ["claimed", "expired", "lost"] and got["n"] == ["lost"]
    assert got["o"] == ["claimed", "expired"] and got["x"][0] == "claimed"
